"""Responses to items, items to observation rows, and reads of stored observations."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from obsmill.functions import dates, text
from obsmill.schemas import DEFAULT_GRANULARITY, KEY, OPEN_END, SELECTIVE


#: Raw texts that a text and a value of another type may share.
_AMBIGUOUS = r'^(true|false|"-?Infinity"|"NaN"|-?\d\.\d+E-?\d+)\z'


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once per row.

    A column of its own is written out again at every use when a filter moves below it, also inside a
    lambda, where it would be computed for each entry.
    """
    return F.transform(F.array(value), use)[0]


def _lasts(entries: Column) -> Column:
    """Places of a body's entries, of a repeated key the last only, in order of the keys if any repeats.

    Sorted by key and place, the last entry of a run is the one that another key follows.
    """

    def last(ordered: Column) -> Column:
        following = F.concat(F.slice(ordered["key"], 2, F.size(ordered)), F.array(F.lit(None).cast("string")))
        places = F.zip_with(
            ordered, following, lambda e, after: F.when(after.isNull() | (after != e["key"]), e["at"])
        )
        return F.filter(places, lambda at: at.isNotNull())

    keys = entries["key"]
    ordered = F.array_sort(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("at"))))
    repeats = F.size(F.array_distinct(keys)) < F.size(keys)
    # Bodies without repeats skip the sort.
    return F.when(repeats, _bound(ordered, last)).otherwise(F.transform(keys, lambda key, i: i))


def decode_series(rows: DataFrame, body: Column, out: str = "series", typed: str | None = None) -> DataFrame:
    """Adds a JSON body as a date -> value map; null where malformed. A repeated key keeps its last value.

    Values are texts: numbers are spelled like stored values, `true` and `Infinity` as `True` and `inf`, and texts
    stay as they are. `typed` names a second map that keeps numbers, texts and booleans apart, as variants.
    Only bodies whose raw texts don't tell the types are read as variants for the first map. A body is read once for
    each form, whatever filters and columns follow.
    """
    raws = F.map_entries(F.from_json(body, "map<string,string>"))
    variants = F.map_entries(F.from_json(body, "map<string,variant>"))

    def spelled(raw: Column, at: Column) -> Column:
        unclear = F.exists(raw, lambda e: F.coalesce(e["value"].rlike(_AMBIGUOUS), F.lit(False)))
        plain = F.transform(at, lambda i: raw[i])

        def by_type(kinds: Column) -> Column:
            return F.transform(
                at,
                lambda i: F.struct(
                    raw[i]["key"].alias("key"),
                    text.json_text(raw[i]["value"], F.schema_of_variant(kinds[i]["value"])).alias("value"),
                ),
            )

        return _bound(
            F.when(unclear, variants),
            lambda kinds: F.map_from_entries(F.when(kinds.isNotNull(), by_type(kinds)).otherwise(plain)),
        )

    series = {out: _bound(raws, lambda raw: _bound(_lasts(raw), lambda at: spelled(raw, at)))}
    if typed is not None:
        kept = lambda at: _bound(variants, lambda v: F.map_from_entries(F.transform(at, lambda i: v[i])))
        series[typed] = _bound(raws, lambda raw: _bound(_lasts(raw), kept))
    return rows.withColumns(series)


def decode_faults(responses: DataFrame) -> DataFrame:
    """Series bodies per source, and how many of them are malformed and so give no rows."""
    served = responses.filter((F.col("status") == 200) & (F.col("body") != "") & F.col("date").isNull())
    malformed = F.from_json("body", "map<string,string>").isNull()
    return served.groupBy("source").agg(
        F.count("*").alias("bodies"), F.count_if(malformed).alias("malformed")
    )


def parse_responses(responses: DataFrame, keep: tuple[str, ...] = (), typed: bool = False) -> DataFrame:
    """Served responses as items: a null date makes a series item, any other a per-date item.

    `keep` names further columns to carry along, such as an arrival order. With `typed` items also
    have their series with numbers as numbers, for the audit log.
    """
    served = responses.filter((F.col("status") == 200) & (F.col("body") != ""))
    is_series = F.col("date").isNull()
    decoded = decode_series(served, F.when(is_series, F.col("body")), typed="typed" if typed else None)
    return decoded.select(
        "concept_id",
        "entity_type",
        "entity_id",
        "date",
        F.when(~is_series, F.col("body")).alias("value"),
        "series",
        F.when(is_series, F.col("start")).alias("start"),
        F.when(is_series, F.col("end")).alias("end"),
        "unit",
        F.col("source").alias("source_used"),
        text.truthy(F.col("granularity"), DEFAULT_GRANULARITY).alias("granularity"),
        *(["typed"] if typed else []),
        *keep,
    )


def _in_range(date: Column) -> Column:
    """Text comparison, both ends included, open where a bound is missing."""
    return date.between(
        text.truthy(F.col("start"), ""), text.truthy(F.col("end"), OPEN_END)
    )


_ITEM_ONLY = ("series", "typed", "date", "value", "start", "end")


def explode_series(items: DataFrame) -> DataFrame:
    """Series items as one row per date inside the item's range; empty series give no rows."""
    kept = [c for c in items.columns if c not in _ITEM_ONLY]
    rows = items.select(*kept, "start", "end", F.explode("series").alias("date", "value"))
    inside = rows.filter(_in_range(F.col("date")) & ~text.is_missing_text(F.col("value")))
    return with_defaults(inside.drop("start", "end"))


def item_rows(items: DataFrame) -> DataFrame:
    """Both item shapes as observation rows: per-date items unchanged, series items exploded.

    A per-date item counts as an entry of its own, so that one explode serves both shapes and the
    items are computed once.
    """
    kept = [c for c in items.columns if c not in _ITEM_ONLY]
    is_series = F.col("date").isNull()
    own = F.array(F.struct(F.col("date").alias("key"), F.col("value").alias("value")))
    rows = items.select(
        *kept,
        "start",
        "end",
        is_series.alias("_is_series"),
        F.explode(F.when(is_series, F.map_entries("series")).otherwise(own)).alias("_entry"),
    ).select("*", F.col("_entry.key").alias("date"), F.col("_entry.value").alias("value"))
    inside = _in_range(F.col("date")) & ~text.is_missing_text(F.col("value"))
    wanted = rows.filter(~F.col("_is_series") | inside)
    return with_defaults(wanted.drop("start", "end", "_is_series", "_entry"))


def clamp_counts() -> tuple[Column, Column]:
    """An item's numbers of entries inside and outside its range."""
    days = F.coalesce(F.map_keys("series"), F.array().cast("array<string>"))
    kept = F.size(F.filter(days, _in_range))
    return kept, F.size(days) - kept


def clamp_stats(items: DataFrame) -> DataFrame:
    """Adds the numbers of entries inside and outside the range: per row, without exploding."""
    kept, dropped = clamp_counts()
    return items.withColumns({"kept": kept, "dropped": dropped})


def with_defaults(rows: DataFrame) -> DataFrame:
    """Fill granularity, unit and source where null or empty."""
    return rows.withColumns(
        {
            "granularity": text.truthy(F.col("granularity"), DEFAULT_GRANULARITY),
            "unit": text.truthy(F.col("unit"), ""),
            "source_used": text.truthy(F.col("source_used"), ""),
        }
    )


def with_value_text(rows: DataFrame, column: str = "value") -> DataFrame:
    return rows.withColumn(column, text.value_text(F.col(column), rows.schema[column].dataType))


def complete_keys(rows: DataFrame) -> DataFrame:
    """Rows without a null key part; a null part would never meet a stored key."""
    return rows.dropna(subset=KEY)


def first_writer(rows: DataFrame, order: list[str], key: list[str] = KEY) -> DataFrame:
    """The first row of each key by `order`.

    Spark keeps one row per key and task before the exchange, so a hot key sends at most one row
    per task to its reducer. Rows are sorted by the key's most selective columns first.
    """
    sorted_by = sorted(key, key=lambda c: c not in SELECTIVE)
    by_arrival = Window.partitionBy(*sorted_by).orderBy(*order)
    return (
        rows.withColumn("_place", F.row_number().over(by_arrival))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def absent_from(rows: DataFrame, stored: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Rows whose key is not stored yet."""
    return rows.join(stored.select(*key), key, "left_anti")


def in_period(
    stored: DataFrame, start: str, end: str, concept_id=None, entity_id=None
) -> DataFrame:
    """Stored rows of a concept, an entity and a text range of dates; all filters push down."""
    rows = stored.filter(F.col("date").between(start, end))
    if concept_id is not None:
        rows = rows.filter(F.col("concept_id") == concept_id)
    if entity_id is not None:
        rows = rows.filter(F.col("entity_id") == entity_id)
    return rows


def count_in_period(stored: DataFrame, start: str, end: str) -> DataFrame:
    """Rows per concept and entity in a text range of dates."""
    return in_period(stored, start, end).groupBy("concept_id", "entity_id").agg(
        F.count("*").alias("observations")
    )


#: Bits of a coverage map, and the number of its first day, so that every day of year 1 on has a place.
COVERED_DAYS = 32_768
_FIRST_DAY = 719_163
SERIES_KEY = [c for c in KEY if c != "date"]


def _place(day: Column) -> Column:
    """A day's number, from 1 for the first day of year 1."""
    return (F.unix_date(day) + _FIRST_DAY).cast("long")


def coverage(stored: DataFrame) -> DataFrame:
    """Which days each series holds: SERIES_KEY, bucket, `covered` (a bitmap) and `days`.

    A bucket is a bitmap of 32,768 days, put together map-side; a series has one, seldom two. Dates that aren't a
    plain day have no place in it.
    """
    day = F.try_to_date("date", "yyyy-MM-dd")
    placed = stored.withColumn("_day", _place(day)).filter((F.length("date") == 10) & F.col("_day").isNotNull())
    return (
        placed.groupBy(*SERIES_KEY, F.bitmap_bucket_number("_day").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_day")).alias("covered"))
        .withColumn("days", F.bitmap_count("covered"))
    )


def cache_misses(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Dates of wanted (SERIES_KEY, start, end, frequency) rows that the store does not hold.

    The store is reduced to bitmaps of covered days, and a wanted range is compared with them as a whole: only
    the dates that are missing become rows. Further columns stay.
    """
    unit = dates.cadence(F.col("frequency"))
    first, last = dates.spine_steps(F.col("start"), F.col("end"), F.col("frequency"))
    ranged = wanted.withColumns({"_unit": unit, "_first": first, "_last": last}).filter("_first IS NOT NULL")
    day = lambda step: _place(dates.step_date(F.col("_unit"), step))
    buckets = F.sequence(F.bitmap_bucket_number(day(F.col("_first"))), F.bitmap_bucket_number(day(F.col("_last"))))
    cut = ranged.withColumn("bucket", F.explode(buckets))
    compared = cut.join(coverage(stored).drop("days"), [*SERIES_KEY, "bucket"], "left")
    # Only the steps of days can be many, so only these are cut to the bucket beforehand.
    low = (F.col("bucket") - 1) * COVERED_DAYS + 1 - _FIRST_DAY
    daily = F.col("_unit") == "day"
    begin = F.when(daily, F.greatest(F.col("_first").cast("long"), low)).otherwise(F.col("_first"))
    end = F.when(daily, F.least(F.col("_last").cast("long"), low + COVERED_DAYS - 1)).otherwise(F.col("_last"))

    def missing(step: Column) -> Column:
        at = F.bitmap_bit_position(day(step))
        octet = F.conv(F.hex(F.substring("covered", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        held = F.coalesce(F.expr("1").cast("int").bitwiseAND(F.call_function("shiftright", octet, (at % 8).cast("int"))), F.lit(0))
        return (F.bitmap_bucket_number(day(step)) == F.col("bucket")) & (held == 0)

    steps = F.filter(F.sequence(begin.cast("long"), end.cast("long")), missing)
    found = compared.withColumn("_step", F.explode(steps))
    return found.select(*wanted.columns, dates.step_text(F.col("_unit"), F.col("_step")).alias("date"))
