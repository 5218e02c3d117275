"""Append-only keyed tables with first-writer-wins inserts."""

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from obsmill.functions.text import is_missing_text
from obsmill.operators.observations import (
    absent_from,
    first_writer,
    with_defaults,
    with_value_text,
)
from obsmill.schemas import KEY, OBSERVATION
from obsmill.sinks.paths import discard, exists, written

BATCH = "batch_id"


@dataclass(frozen=True)
class InsertReport:
    attempted: int
    rejected: int
    inserted: int


def observed(frame: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """`frame` as a written table, and aggregates of it that are taken while it is written.

    The metrics stand last before the write, so that a repeated task of an earlier stage doesn't count twice.
    """
    watched = Observation(f"{name}-{uuid.uuid4().hex}")
    table = written(frame.observe(watched, *metrics), name)
    return table, watched.get


class KeyedStore:
    """Parquet table that keeps the first row written for each key.

    Each batch is one `batch_id=` folder, which is only ever added to. A replay finds its rows there
    and adds what is missing; another insert under the same id adds its own. One writer at a time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: list[str],
        partition_by: list[str] = (),
        prune_by: list[str] = (),
        required: list[str] = (),
    ):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.key = list(key)
        self.required = [*key, *required]
        self.partition_by = list(partition_by)
        self.prune_by = list(prune_by)

    def read(self, except_batch: str | None = None, only_batch: str | None = None) -> DataFrame:
        """Stored rows; of one batch only its own folder is listed."""
        columns = self.schema.fieldNames()
        stored = T.StructType([*self.schema.fields, T.StructField(BATCH, T.StringType())])
        path = self.path if only_batch is None else f"{self.path}/{BATCH}={only_batch}"
        if not exists(self.spark, path):
            # A limit of none tells Spark that there is nothing to join with.
            return self.spark.createDataFrame([], self.schema).limit(0)
        rows = self.spark.read.schema(stored).option("basePath", self.path).parquet(path)
        if except_batch is not None:
            rows = rows.filter(F.col(BATCH) != except_batch)
        return rows.select(*columns)

    def insert(self, rows: DataFrame, batch_id: str, order: list[str], computed: bool = False) -> InsertReport:
        """Write the rows whose key is new, the first of each key by `order`.

        Rows are counted, and the ranges of `prune_by` taken, while the input is written, so the anti join reads
        only the stored files that can hold one of the new keys. Rows with a
        null key part or required column are rejected, before they could count as a first writer.
        The input is computed once; one that is read from a written table anyhow (`computed`) is counted in a pass of
        its own instead, which takes a few of its columns. `inserted` counts the input's keys that no other batch holds.
        """
        incomplete = reduce(Column.__or__, [F.col(c).isNull() for c in self.required])
        metrics = [
            F.count("*").alias("attempted"),
            F.count_if(incomplete).alias("rejected"),
            *[F.min(c).alias(f"min_{c}") for c in self.prune_by],
            *[F.max(c).alias(f"max_{c}") for c in self.prune_by],
        ]
        if computed:
            summary, scratch = rows.agg(*metrics).first().asDict(), []
        else:
            rows, summary = observed(rows, "insert", *metrics)
            scratch = [rows]
        if not summary["attempted"]:
            discard(*scratch)
            return InsertReport(0, 0, 0)
        firsts = first_writer(rows.dropna(subset=self.required), order, self.key)
        absent = self._absent(firsts, batch_id, summary).select(*self.schema.fieldNames())
        if exists(self.spark, f"{self.path}/{BATCH}={batch_id}"):
            fresh, counts = observed(absent, "fresh", F.count("*").alias("inserted"))
            self._write(absent_from(fresh, self.read(only_batch=batch_id), self.key), batch_id)
            scratch.append(fresh)
        else:
            # Nothing of the batch is there to be left out, so its rows are counted as they enter the store.
            watched = Observation(f"fresh-{uuid.uuid4().hex}")
            self._write(absent, batch_id, watched)
            counts = watched.get
        discard(*scratch)
        return InsertReport(summary["attempted"], summary["rejected"], counts["inserted"] or 0)

    def _absent(self, firsts: DataFrame, batch_id: str, summary: dict) -> DataFrame:
        """The first rows whose key no other batch holds."""
        stored = self.read(except_batch=batch_id)
        for c in self.prune_by:
            stored = stored.filter(F.col(c).between(summary[f"min_{c}"], summary[f"max_{c}"]))
        return absent_from(firsts, stored, self.key)

    def _write(self, rows: DataFrame, batch_id: str, watched: Observation | None = None) -> None:
        if self.partition_by:
            # Few files per folder; a hot folder is split by size.
            rows = rows.hint("rebalance", *self.partition_by)
        if watched is not None:
            rows = rows.observe(watched, F.count("*").alias("inserted"))
        writer = rows.write.mode("append")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/{BATCH}={batch_id}")


class _Observations:
    """What a store of observations does with its rows before it inserts them."""

    def insert(self, rows: DataFrame, batch_id: str, order: list[str], computed: bool = False) -> InsertReport:
        """Insert-if-absent with defaults filled and values as text, stamped once per batch.

        Rows without a value, not-a-number included, are rejected.
        """
        filled = with_value_text(with_defaults(rows)).withColumns(
            {
                "value": F.when(~is_missing_text(F.col("value")), F.col("value")),
                "fetched_at": F.current_timestamp(),
            }
        )
        return super().insert(filled, batch_id, order, computed)


class ObservationStore(_Observations, KeyedStore):
    """The observation table, in folders by batch, granularity and concept."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(
            spark,
            path,
            OBSERVATION,
            KEY,
            partition_by=["granularity", "concept_id"],
            prune_by=["concept_id", "date"],
            required=["value"],
        )


class BucketedStore(KeyedStore):
    """A keyed store whose rows lie in buckets by key, so that an insert doesn't shuffle what is stored.

    Every batch folder has the same `buckets`; rows of a bucket are sorted by `prune_by`, whose ranges prune row
    groups. An insert deals its own keys to the buckets and streams the stored keys past them: neither an exchange nor a
    sort of the stored side. Spark knows buckets of catalogued tables only, so the folder is
    entered into the session's catalog under `name` when the store is opened.
    The number of buckets belongs to the store: open it with the number it was made with.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: list[str], name: str, buckets: int = 64, **options):
        super().__init__(spark, path, schema, key, **options)
        if self.partition_by:
            raise ValueError("buckets take the place of folders")
        self.name = name
        self.buckets = buckets
        self.sorted_by = self.prune_by or self.key
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys, order = (", ".join(f"`{c}`" for c in names) for names in (self.key, self.sorted_by))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}, `{BATCH}` string) USING parquet PARTITIONED BY (`{BATCH}`) "
            f"CLUSTERED BY ({keys}) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        if exists(spark, path):
            # Batches that another session wrote.
            spark.catalog.recoverPartitions(name)

    def table(self) -> DataFrame:
        """The store with its buckets."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def read(self, except_batch: str | None = None, only_batch: str | None = None) -> DataFrame:
        rows = self.table()
        if except_batch is not None:
            rows = rows.filter(F.col(BATCH) != except_batch)
        if only_batch is not None:
            rows = rows.filter(F.col(BATCH) == only_batch)
        return rows.select(*self.schema.fieldNames())

    def _absent(self, firsts: DataFrame, batch_id: str, summary: dict) -> DataFrame:
        """The stored keys that the batch has are found first; they are no more than the batch itself."""
        firsts = written(firsts, "firsts")
        return absent_from(firsts, self.hits(firsts, batch_id, summary), self.key)

    def hits(self, firsts: DataFrame, batch_id: str, summary: dict) -> DataFrame:
        stored = self.read(except_batch=batch_id)
        for c in self.prune_by:
            stored = stored.filter(F.col(c).between(summary[f"min_{c}"], summary[f"max_{c}"]))
        wanted = firsts.select(*self.key).repartition(self.buckets, *self.key).hint("shuffle_hash")
        return stored.select(*self.key).join(wanted, self.key, "left_semi")

    def _write(self, rows: DataFrame, batch_id: str, watched: Observation | None = None) -> None:
        """One file per bucket: rows are dealt out as the buckets are."""
        dealt = rows.withColumn(BATCH, F.lit(batch_id)).repartition(self.buckets, *self.key)
        if watched is not None:
            dealt = dealt.observe(watched, F.count("*").alias("inserted"))
        writer = dealt.write.mode("append").format("parquet").partitionBy(BATCH)
        writer.bucketBy(self.buckets, *self.key).sortBy(*self.sorted_by).option("path", self.path).saveAsTable(self.name)


class BucketedObservations(_Observations, BucketedStore):
    """The observation table in buckets by key."""

    def __init__(self, spark: SparkSession, path: str, name: str, buckets: int = 64):
        super().__init__(spark, path, OBSERVATION, KEY, name, buckets, prune_by=["concept_id", "date"], required=["value"])


def append_audit(items: DataFrame, path: str, batch_id: str | None = None) -> None:
    """Append items, not exploded, as JSON lines with nulls and all characters kept.

    Items with a typed series are written with that one, so that numbers are numbers and texts are texts; a whole
    number loses its point, and infinities, which JSON doesn't know, are quoted.
    With a batch id the lines form a folder of their own, which a replay replaces.
    """
    if "typed" in items.columns:
        items = items.withColumn("series", F.col("typed")).drop("typed")
    writer = items.write.option("ignoreNullFields", False)
    if batch_id is None:
        writer.mode("append").json(path)
    else:
        writer.mode("overwrite").json(f"{path}/{BATCH}={batch_id}")
