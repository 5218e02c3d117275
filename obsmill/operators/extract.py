"""Values out of landed provider frames."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from obsmill.functions import text
from obsmill.functions.text import is_missing_text, value_text
from obsmill.schemas import DATE_COLUMN_NAMES

#: The most selective columns first, for joins and aggregates sort by them in this order.
POINT_KEY = ["identifier", "date", "source", "column"]
POINT = ["source", "identifier", "date", "column", "value"]


def date_column(frame: DataFrame) -> str | None:
    """First column, in column order, with a known date name in any letter case."""
    return next((c for c in frame.columns if c.lower() in DATE_COLUMN_NAMES), None)


def _name(column: str) -> str:
    return f"`{column.replace('`', '``')}`"


def day_text(frame: DataFrame, dated: str) -> Column:
    """The plain day of a frame's date column: of a timestamp its day, of a text itself if it is a day."""
    kind = frame.schema[dated].dataType
    name = F.col(_name(dated))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(name).cast("string")
    plain = name.cast("string")
    return F.when(F.length(plain) == 10, plain)


def frame_points(frame: DataFrame, order: str, on: str = "identifier", daily: bool = False) -> DataFrame:
    """(source, identifier, date, column, value): a frame with a `source` column, unfolded.

    Each date has the values of its first row by `order`; repeats are reduced map-side, before the
    columns unfold. Missing values, not-a-number included, are left out. A frame without a date
    column has no points. Dates are the column's own texts, or with `daily` plain days, which is what
    series are made of: a timestamp counts for its day, and the day's first row has its values.
    """
    dated = date_column(frame)
    if dated is None:
        return frame.sparkSession.createDataFrame([], ", ".join(f"`{c}` STRING" for c in POINT))
    values = [c for c in frame.columns if c not in (dated, order, on, "source")]
    row = F.struct(*[value_text(F.col(_name(c)), frame.schema[c].dataType).alias(f"v{n}") for n, c in enumerate(values)])
    date = day_text(frame, dated) if daily else F.col(_name(dated)).cast("string")
    rows = frame.filter(date.isNotNull()) if daily else frame
    firsts = rows.groupBy(F.col(on).alias("identifier"), date.alias("date"), "source").agg(F.min_by(row, order).alias("_row"))
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"_row.v{n}").alias("value")) for n, c in enumerate(values)]
    unfolded = firsts.select("source", "identifier", "date", F.inline(F.array(*entries)))
    return unfolded.filter(~is_missing_text(F.col("value")))


def open_points(rows: DataFrame, order: str, on: str = "identifier", daily: bool = False) -> DataFrame:
    """`frame_points` of rows with unlike columns: `source` and `row`, a map of variants.

    Fields `on` and `order` (a whole number) are each row's identifier and place; the first other field with a known
    date name, in the row's own order, has its date. A row without one has no points. With `daily` only the first ten
    characters of a date count, if they are a day.
    """
    fields = F.map_entries("row")
    dated = F.filter(fields, lambda e: F.lower(e["key"]).isin(*DATE_COLUMN_NAMES))
    told = rows.select(
        "source",
        F.try_variant_get(F.col("row")[on], "$", "string").alias("identifier"),
        F.try_variant_get(F.col("row")[order], "$", "bigint").alias("_order"),
        # Unfolded, for a filter by the date would reach down to the reader and decode each row once more.
        F.explode(F.slice(dated, 1, 1)).alias("_dated"),
        "row",
    )
    date = F.try_variant_get(F.col("_dated.value"), "$", "string")
    if daily:
        day = F.substring(date, 1, 10)
        date = F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}\z"), day)
    told = told.withColumn("date", date).filter("date IS NOT NULL")
    firsts = told.groupBy("identifier", "date", "source").agg(
        F.min_by(F.struct("row", F.col("_dated.key").alias("dated")), "_order").alias("_first")
    )
    unfolded = firsts.select("source", "identifier", "date", "_first.dated", F.explode("_first.row").alias("column", "_value"))
    values = unfolded.filter(~F.col("column").isin(on, order) & (F.col("column") != F.col("dated")))
    # A variant's plain text tells whether its value is missing; only the others are spelled out.
    given = values.filter(~is_missing_text(F.col("_value").cast("string"))).withColumns(text.variant_parts(F.col("_value")))
    return given.select("source", "identifier", "date", "column", text.parts_text().alias("value"))


def extract_points(tasks: DataFrame, points: DataFrame) -> DataFrame:
    """Each task's value: that of its own source, identifier, date and column, else null.

    Dates match by their text, so a timestamp column matches no plain date.
    """
    others = [c for f in (tasks, points) for c in f.columns if c not in POINT_KEY]
    return tasks.join(points, POINT_KEY, "left").select("source", "identifier", "date", "column", *others)


def extract_ranges(tasks: DataFrame, points: DataFrame, task: list[str]) -> DataFrame:
    """The `task` columns of series tasks and a map from date to value over each inclusive range.

    Points are `daily` ones; they join on source, identifier and column. A task's map holds at most one
    entry a day of its range. Points whose date is not a plain day, and tasks without a value, drop out.
    """
    days = points.filter(F.length("date") == 10).withColumnRenamed("date", "_day")
    inside: Column = F.col("_day").between(F.col("start"), F.col("end"))
    found = tasks.join(days, ["identifier", "source", "column"]).filter(inside)
    entries = F.array_sort(F.collect_list(F.struct("_day", "value")))
    return found.groupBy(*task).agg(F.map_from_entries(entries).alias("series"))


def extract_series(
    frame: DataFrame,
    keys: list[str],
    column: str,
    order: str,
    start: str,
    end: str,
    dated: str | None = None,
) -> DataFrame:
    """Map from date to value per `keys`, over the inclusive range.

    One value per date (the first by `order`) is kept before the values of a key are collected,
    and only days count, so a series never holds more entries than the range has days. A timestamp
    counts for its day; a text counts if it is a plain date.
    """
    dated = dated or date_column(frame)
    day = day_text(frame, dated)
    value = value_text(F.col(column), frame.schema[column].dataType)
    points = (
        frame.filter(day.between(start, end))
        .groupBy(*keys, day.alias("_day"))
        .agg(F.min_by(F.col(column), F.col(order)).alias(column))
        .select(*keys, "_day", value.alias("_value"))
        .filter(~is_missing_text(F.col("_value")))
    )
    entries = F.array_sort(F.collect_list(F.struct("_day", "_value")))
    return points.groupBy(*keys).agg(F.map_from_entries(entries).alias("series"))
