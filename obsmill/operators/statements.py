"""Financial statements, wide or transposed, to observation rows."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from obsmill.functions.text import is_missing_text, truthy, value_text
from obsmill.schemas import (
    DEFAULT_GRANULARITY,
    LEGACY_ENTITY_TYPE,
    LEGACY_UNIT,
    STATEMENT_CONCEPTS,
    STATEMENT_FUNCTIONS,
)

# Legacy tables: date column and concept of each value column. Ours: only the price close and the
# six statement fields have known concept ids.
LEGACY_TABLES = {
    "astock": ("date", {"close": 234}),
    "astock-hk": ("date", {"close": 234}),
    "astock-us": ("date", {"close": 234}),
    "astock-balance": ("REPORT_DATE", dict(STATEMENT_CONCEPTS["akshare"]["bs"])),
    "astock-profit": ("REPORT_DATE", dict(STATEMENT_CONCEPTS["akshare"]["is"])),
    "astock-cashflow": ("REPORT_DATE", dict(STATEMENT_CONCEPTS["akshare"]["cf"])),
}


def concept_map(spark: SparkSession) -> DataFrame:
    """(source, function_name, field, concept_id): a fixed table of 24 rows."""
    rows = [
        (source, f"{period}_{kind}", field, concept)
        for source, kinds in STATEMENT_CONCEPTS.items()
        for period in ("annual", "quarterly")
        for kind, fields in kinds.items()
        for field, concept in fields
    ]
    return spark.createDataFrame(
        rows, "source STRING, function_name STRING, field STRING, concept_id INT"
    )


def map_concepts(melted: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds `concept_id`; fields and functions outside the mapping drop out.

    The mapping is a fixed table, so it is broadcast outright.
    """
    return melted.join(F.broadcast(mapping), ["source", "function_name", "field"])


def not_missing(value: Column, dtype: T.DataType) -> Column:
    """Not null, not a not-a-number and not its text: the rule of the store as well."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return value.isNotNull() & ~F.isnan(value)
    return ~is_missing_text(value.cast("string"))


def _melt(frame: DataFrame, ids: list[Column | str], columns: list[str]) -> DataFrame:
    """(ids, name, value text) for each of `columns`; missing values are dropped.

    Columns of one type unfold first and become text once; mixed types need a common one before.
    """
    types = {frame.schema[c].dataType for c in columns}
    shared = types.pop() if len(types) == 1 else None
    values = [
        F.col(f"`{c}`") if shared else value_text(F.col(f"`{c}`"), frame.schema[c].dataType).alias(c)
        for c in columns
    ]
    prepared = frame.select(*ids, *values)
    kept = [c for c in prepared.columns if c not in columns]
    melted = prepared.unpivot(kept, [F.col(f"`{c}`") for c in columns], "name", "value")
    present = melted.filter(not_missing(F.col("value"), shared or T.StringType()))
    if shared is None:
        return present
    return present.withColumn("value", value_text(F.col("value"), shared))


def melt_wide(
    frame: DataFrame, ids: list[str], fields: list[str], date: str = "REPORT_DATE"
) -> DataFrame:
    """Row per report and field: `date` is the first ten characters, empty or null drops out."""
    day = F.substring(F.col(date).cast("string"), 1, 10)
    present = [f for f in fields if f in frame.columns]
    melted = _melt(frame.filter(day != ""), [*ids, day.alias("date")], present)
    return melted.withColumnRenamed("name", "field")


def melt_transposed(
    frame: DataFrame, ids: list[str], dates: list[str], field: str = "field"
) -> DataFrame:
    """Row per field and date column; `date` is the first ten characters of the column name."""
    melted = _melt(frame, [*ids, F.col(field).alias("field")], dates)
    return melted.withColumn("date", F.substring("name", 1, 10)).drop("name")


def entity_code(frame: DataFrame) -> Column:
    """The provider's own entity code: SECUCODE, else SECURITY_CODE."""
    return truthy(F.col("SECUCODE"), F.col("SECURITY_CODE"))


def parse_wide(frame: DataFrame, ids: list[str], date: str = "REPORT_DATE") -> DataFrame:
    """Wide frames tagged with a `function_name`, as (ids, field, concept_id, date, value).

    The same result as `melt_wide` and `map_concepts`, but a row unfolds into the fields of its
    own function only, so there is no join and no other field is turned into text. Fields unfold by type and become
    text once, after those without a value are gone.
    """
    source = "akshare"
    day = F.substring(F.col(date).cast("string"), 1, 10)
    entries = F.lit(None)
    present = [field for fields in STATEMENT_CONCEPTS[source].values() for field, _ in fields if field in frame.columns]
    types = list(dict.fromkeys(frame.schema[field].dataType for field in present))
    for kind, fields in STATEMENT_CONCEPTS[source].items():
        mapped = [
            F.struct(
                F.lit(field).alias("field"),
                F.lit(concept).alias("concept_id"),
                *[
                    (F.col(field) if frame.schema[field].dataType == dtype else F.lit(None).cast(dtype)).alias(f"_v{n}")
                    for n, dtype in enumerate(types)
                ],
            )
            for field, concept in fields
            if field in frame.columns
        ]
        functions = [f"annual_{kind}", f"quarterly_{kind}"]
        if mapped:
            entries = F.when(F.col("function_name").isin(functions), F.array(*mapped)).otherwise(
                entries
            )
    rows = frame.filter(day != "").select(
        *ids,
        F.lit(source).alias("source"),
        "function_name",
        day.alias("date"),
        F.inline(entries),
    )
    given = reduce(Column.__or__, [not_missing(F.col(f"_v{n}"), dtype) for n, dtype in enumerate(types)])
    values = F.coalesce(*[value_text(F.col(f"_v{n}"), dtype) for n, dtype in enumerate(types)])
    return rows.filter(given).select(*ids, "source", "function_name", "date", "field", "concept_id", values.alias("value"))


def parse_transposed(frame: DataFrame, ids: list[str], dates: list[str]) -> DataFrame:
    """Transposed frames tagged with a `function_name`; unmapped fields drop out before melting."""
    tagged = frame.withColumn("source", F.lit("yfinance"))
    mapped = map_concepts(tagged, concept_map(frame.sparkSession))
    return melt_transposed(mapped, [*ids, "source", "function_name", "concept_id"], dates)


def date_columns(frame: DataFrame) -> list[str]:
    """Columns of a transposed frame whose names begin with a plain date."""
    return [c for c in frame.columns if re.match(r"\d{4}-\d{2}-\d{2}", c)]


def parse_frames(wide: DataFrame | None, transposed: DataFrame | None) -> DataFrame:
    """Landed frames of both forms as (entity_id, source, function_name, concept_id, date, value, arrival).

    `arrival` is the function's place in the fixed list, the order in which an entity's tasks are made.
    """
    parsed = []
    if wide is not None:
        parsed.append(parse_wide(wide, ["entity_id"]))
    if transposed is not None:
        parsed.append(parse_transposed(transposed, ["entity_id"], date_columns(transposed)))
    columns = ["entity_id", "source", "function_name", "concept_id", "date", "value"]
    rows = reduce(DataFrame.unionByName, [p.select(*columns) for p in parsed])
    places = [F.lit(f"{source} {name}") for source, name, _ in STATEMENT_FUNCTIONS]
    return rows.withColumn("arrival", F.array_position(F.array(*places), F.concat_ws(" ", "source", "function_name")))


def legacy_rows(parsed: DataFrame, granularity: str = DEFAULT_GRANULARITY) -> DataFrame:
    """Observation rows of the statement writer: constant entity type and unit."""
    return parsed.select(
        "concept_id",
        F.lit(LEGACY_ENTITY_TYPE).alias("entity_type"),
        "entity_id",
        "date",
        F.lit(granularity).alias("granularity"),
        "value",
        F.lit(LEGACY_UNIT).alias("unit"),
        F.col("source").alias("source_used"),
        *[c for c in ["arrival"] if c in parsed.columns],
    )


def migrate_legacy(
    table: DataFrame,
    name: str,
    symbol: str | None = None,
    limit: int | None = None,
    symbol_column: str = "symbol",
    entity_column: str = "entity_id",
    arrival: str | None = None,
) -> DataFrame:
    """A legacy per-source table as observation rows, with their `arrival`.

    `symbol` and `limit` select source rows, as the command's options do; the limit takes the
    first rows by symbol, date and arrival. Rows arrive in the order of the column `arrival`, else in
    that of the table's files: of several rows of one key the first to arrive is the first writer.
    """
    date, concepts = LEGACY_TABLES[name]
    place = F.col(arrival).cast("long") if arrival else F.monotonically_increasing_id()
    rows = table.withColumn("_arrival", place)
    if symbol is not None:
        rows = rows.filter(F.col(symbol_column) == symbol)
    if limit is not None:
        rows = rows.orderBy(symbol_column, date, "_arrival").limit(limit)
    ids = [F.col(entity_column).alias("entity_id")]
    melted = _melt(
        rows,
        [*ids, F.substring(F.col(date).cast("string"), 1, 10).alias("date"), F.col("_arrival").alias("arrival")],
        [c for c in concepts if c in table.columns],
    )
    concept = F.create_map(*[F.lit(x) for pair in concepts.items() for x in pair])
    return legacy_rows(
        melted.filter(F.col("date") != "").select(
            "entity_id", "date", "value", concept[F.col("name")].alias("concept_id"),
            F.lit(name).alias("source"), "arrival",
        )
    )
