"""Readers with explicit schemas. Live calls are re-aimed onto landed files."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from obsmill.schemas import IDENTIFIERS, PAGE, PLAN, RESPONSE


def parse_plans(docs: DataFrame, text: str = "doc") -> DataFrame:
    """Turn a column of plan JSON into plan columns; malformed documents raise."""
    parsed = F.from_json(F.col(text), PLAN, {"mode": "FAILFAST"})
    kept = [c for c in docs.columns if c != text]
    return docs.select(*kept, parsed.alias("plan")).select(*kept, "plan.*")


def read_plans(spark: SparkSession, path: str) -> DataFrame:
    """Plan documents, one JSON object per file; `plan_id` is the file's path."""
    plans = spark.read.schema(PLAN).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return plans.select(F.col("_metadata.file_path").alias("plan_id"), *PLAN.fieldNames())


def read_plan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Many plans as JSON lines, each with a `plan_id` of its own."""
    schema = T.StructType([T.StructField("plan_id", T.LongType()), *PLAN.fields])
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_identifiers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(IDENTIFIERS).parquet(path)


def read_identifiers_jdbc(
    spark: SparkSession, url: str, table: str, bounds: tuple[int, int], partitions: int, **options
) -> DataFrame:
    """The identifier map from a relational store, read in parallel ranges of `entity_id`."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    return (
        reader.option("partitionColumn", "entity_id")
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", partitions)
        .load()
        .select(*IDENTIFIERS.fieldNames())
    )


def scan_identifiers(
    identifiers: DataFrame, source: str | None = None, entity_type: str | None = None
) -> DataFrame:
    """(entity_id, identifier) of one source and type; both predicates reach the scan."""
    rows = identifiers
    if source is not None:
        rows = rows.filter(F.col("source") == source)
    if entity_type is not None:
        rows = rows.filter(F.col("entity_type") == entity_type)
    return rows


def read_frames(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options
) -> DataFrame:
    """Provider frames landed as parquet, JSON, CSV or ORC."""
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def read_open_frames(spark: SparkSession, path: str) -> DataFrame:
    """JSON rows of frames with unlike columns: `row`, a map of variants, and the folders' own columns.

    Each row keeps the order of its columns, and no schema has to hold the columns of all frames. Lines that
    aren't an object have a null row.
    """
    lines = spark.read.text(path)
    return lines.withColumn("row", F.from_json("value", "map<string,variant>")).drop("value")


def read_responses(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(RESPONSE).format(fmt).load(path)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(PAGE).format(fmt).load(path)


def fetched_ok(pages: DataFrame, status: Column | None = None) -> DataFrame:
    """Listing pages that arrived with status 200."""
    return pages.filter((F.col("status") if status is None else status) == 200)
