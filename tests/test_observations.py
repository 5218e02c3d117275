import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from obsmill import schemas
from obsmill.operators import observations as obs
from obsmill.sinks.paths import discard, exists, written
from obsmill.sinks.store import BucketedObservations, ObservationStore, append_audit, observed

TASK = {"source": "akshare", "command": "c", "identifier": "1", "date": None, "column": "x", "concept_id": 64,
        "entity_type": "bond", "entity_id": 9001, "unit": "SEK", "granularity": None,
        "start": "2024-01-01", "end": "2024-12-31"}
ITEM = ("concept_id INT, entity_type STRING, entity_id BIGINT, date STRING, value STRING, series MAP<STRING,STRING>,"
        " start STRING, end STRING, unit STRING, source_used STRING, granularity STRING")


def _responses(spark, *changes):
    return spark.createDataFrame([TASK | {"status": 200} | c for c in changes], schemas.RESPONSE)


def _series(spark, series, start="2024-01-01", end="2024-12-31", granularity=None):
    row = (64, "bond", 9001, None, None, series, start, end, "SEK", "akshare", granularity)
    return spark.createDataFrame([row], ITEM)


def _decoded(spark, body):
    frame = spark.createDataFrame([(body,)], "body STRING")
    return obs.decode_series(frame, F.col("body")).first()["series"]


def test_series_item_over_new_year(spark):
    """A null day, a repeated day, a text and a number without a point; the task's bounds go along."""
    body = '{"2018-12-31": 3, "2019-01-01": null, "2019-01-02": 7.25, "2018-12-31": "n/a"}'
    found = obs.parse_responses(_responses(spark, {"body": body, "start": "2018-12-30", "end": None, "granularity": "week"}))
    (item,) = found.collect()
    assert item.series == {"2018-12-31": "n/a", "2019-01-01": None, "2019-01-02": "7.25"}
    assert (item.value, item.start, item.end, item.granularity) == (None, "2018-12-30", None, "week")
    assert [r.date for r in obs.item_rows(found).sort("date").collect()] == ["2018-12-31", "2019-01-02"]


def test_dated_item_keeps_its_body(spark, rows):
    """The body is the value whatever it looks like, and bounds belong to series only."""
    bodies = ["0", "{}", " ", "null"]
    found = obs.parse_responses(_responses(spark, *[{"body": b, "date": f"2019-03-0{n}"} for n, b in enumerate(bodies, 1)]))
    assert rows(found, "date", "value", "series", "start", "end") == [
        (f"2019-03-0{n}", b, None, None, None) for n, b in enumerate(bodies, 1)
    ]


def test_decoding_by_type(spark):
    body = ('{"a": true, "b": "true", "c": "1.5E3", "d": 1.5E3, "e": 12345678901234567890123, "f": Infinity,'
            ' "g": -Infinity, "h": "x", "a": false, "i": NaN, "j": "1e5", "k": -0.0}')
    want = {"a": "False", "b": "true", "c": "1.5E3", "d": "1500.0", "e": "12345678901234567890123", "f": "inf",
            "g": "-inf", "h": "x", "i": "nan", "j": "1e5", "k": "-0.0"}
    assert _decoded(spark, body) == want
    frame = spark.createDataFrame([(body,), ("no json",), (None,)], "body STRING")
    both = obs.decode_series(frame, F.col("body"), typed="typed")
    kinds = both.filter("body LIKE '{%'").select(F.explode("typed").alias("k", "v")).select("k", F.schema_of_variant("v"))
    assert {k for k, kind in kinds.collect() if kind == "STRING"} == {"b", "c", "h", "j"}
    assert [r.typed for r in both.filter("body NOT LIKE '{%' OR body IS NULL").collect()] == [None, None]


def test_audit_keeps_numbers(spark, tmp_path):
    body = '{"2019-01-01": 2.50, "2019-01-02": "2.50", "2019-01-03": true, "2019-01-04": null}'
    items = obs.parse_responses(_responses(spark, {"body": body}, {"body": "7", "date": "2019-03-05"}), typed=True)
    append_audit(items, f"{tmp_path}/audit")
    lines = sorted((json.loads(r.value) for r in spark.read.text(f"{tmp_path}/audit").collect()), key=str)
    series = [line["series"] for line in lines]
    assert {"2019-01-01": 2.5, "2019-01-02": "2.50", "2019-01-03": True, "2019-01-04": None} in series and None in series
    assert all("typed" not in line for line in lines)


def test_unserved_and_empty_responses_drop_out(spark):
    responses = _responses(spark, {"status": 204, "body": "1"}, {"status": 503, "body": "1"}, {"body": ""})
    assert obs.parse_responses(responses).isEmpty()


def test_decoding(spark):
    assert _decoded(spark, '{"a": 1.50, "b": 1e16, "a": 2, "c": null, "d": "x", "e": 7}') == {
        "a": "2", "b": "1e+16", "c": None, "d": "x", "e": "7"
    }
    assert _decoded(spark, '{"b": 1, "a": 2, "b": 3, "b": 4}') == {"a": "2", "b": "4"}
    assert _decoded(spark, "{}") == {}
    assert _decoded(spark, "no json") is None


@pytest.mark.parametrize("start,end", [("2019-03-01", "2019-03-20"), ("2019-03-05", "2019-03-05"), ("2019-04-01", None), ("2019-05-01", "2019-04-01")])
def test_clamp_against_a_plain_filter(spark, rows, start, end):
    rng = random.Random(5)
    days = [(datetime.date(2019, 2, 20) + datetime.timedelta(n)).isoformat() for n in range(60)]
    series = {day: str(rng.randint(1, 99)) for day in rng.sample(days, 40)} | {"2019-03-05": "7"}
    kept = sorted((d, v, "day") for d, v in series.items() if start <= d and (end is None or d <= end))
    item = _series(spark, series, start, end)
    assert rows(obs.explode_series(item), "date", "value", "granularity") == kept
    stats = obs.clamp_stats(item).first()
    assert (stats.kept, stats.dropped) == (len(kept), len(series) - len(kept))


def test_malformed_bodies_are_counted(spark, rows):
    bodies = ['{"2019-03-05": 1}', '{"2019-03-05": 1', "plain", "{}"]
    responses = _responses(spark, *[{"body": b} for b in bodies], {"body": "x", "date": "2019-03-05"}, {"body": "x", "status": 503})
    assert rows(obs.decode_faults(responses)) == [("akshare", 4, 2)]


def test_clamp_compares_text_and_is_open_without_bounds(spark, rows):
    series = {"2024-12-31 00:00:00": "1", "9999-12-31": "2", "": "3"}
    assert rows(obs.explode_series(_series(spark, series)), "date") == []
    assert rows(obs.explode_series(_series(spark, series, None, "")), "date") == [
        ("",), ("2024-12-31 00:00:00",), ("9999-12-31",)
    ]
    assert obs.explode_series(_series(spark, {})).isEmpty()
    assert obs.explode_series(_series(spark, None)).isEmpty()


def test_missing_values_do_not_become_rows(spark, rows):
    series = {"2024-01-02": None, "2024-01-03": "NaN", "2024-01-04": "1"}
    assert rows(obs.explode_series(_series(spark, series)), "date") == [("2024-01-04",)]


def test_monthly_series_keeps_its_tag(spark, rows):
    exploded = obs.explode_series(_series(spark, {"2024-06-01": "1.5", "2024-07-01": "1.6"}, granularity="month"))
    assert rows(exploded, "date", "granularity") == [("2024-06-01", "month"), ("2024-07-01", "month")]


def test_both_shapes_in_one_sink(spark, rows):
    dated = spark.createDataFrame(
        [(64, "bond", 9001, "2024-06-01", "1.5", None, None, None, "SEK", "akshare", "month")], ITEM)
    items = dated.union(_series(spark, {"2024-01-02": "1.5", "2031-01-02": "9"}))
    assert rows(obs.item_rows(items), *schemas.KEY, "value", "unit", "source_used") == [
        (64, "bond", 9001, "2024-01-02", "day", "1.5", "SEK", "akshare"),
        (64, "bond", 9001, "2024-06-01", "month", "1.5", "SEK", "akshare"),
    ]


def _rows(spark, *tuples):
    return spark.createDataFrame(
        [(1, "stock", e, d, g, v, None, None, n) for n, (e, d, g, v) in enumerate(tuples)],
        "concept_id INT, entity_type STRING, entity_id BIGINT, date STRING, granularity STRING, value DOUBLE,"
        " unit STRING, source_used STRING, arrival INT")


def test_insert_keeps_the_first_writer(spark, tmp_path, rows):
    store = ObservationStore(spark, str(tmp_path / "store"))
    first = _rows(spark, (1, "2024-06-01", None, 1.0), (1, "2024-06-01", "day", 2.0),
                  (1, "2024-06-01", "month", 3.0), (None, "2024-06-01", "day", 4.0))
    report = store.insert(first, "0", ["arrival"])
    assert (report.attempted, report.rejected, report.inserted) == (4, 1, 2)
    second = _rows(spark, (1, "2024-06-01", "day", 9.0), (2, "2024-06-01", "day", 1e7))
    assert store.insert(second, "1", ["arrival"]).inserted == 1
    kept = [(1, "day", "1.0"), (1, "month", "3.0"), (2, "day", "10000000.0")]
    assert rows(store.read(), "entity_id", "granularity", "value") == kept
    # The same rows again add nothing, and a replayed batch gives the same rows again.
    assert store.insert(second, "2", ["arrival"]).inserted == 0
    assert store.insert(second, "1", ["arrival"]).inserted == 1
    assert store.insert(first, "0", ["arrival"]).inserted == 2
    assert rows(store.read(), "entity_id", "granularity", "value") == kept
    assert store.insert(first.limit(0), "3", ["arrival"]).attempted == 0
    assert store.read().filter("unit <> '' OR source_used <> '' OR fetched_at IS NULL").isEmpty()


def test_store_reads_only_touched_partitions(spark, tmp_path):
    store = ObservationStore(spark, str(tmp_path / "store"))
    store.insert(_rows(spark, (1, "2024-06-01", "day", 1.0)), "0", ["arrival"])
    plan = obs.in_period(store.read("1"), "2024-01-01", "2024-12-31", concept_id=1)
    text = plan._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in text and "concept_id" in text.split("PartitionFilters")[1][:200]
    assert "GreaterThanOrEqual(date,2024-01-01)" in text


def test_hot_key_is_reduced_before_the_exchange(spark):
    hot = spark.range(20000).selectExpr(
        "1 AS concept_id", "'stock' AS entity_type", "if(id % 3 = 0, 0, id) AS entity_id", "'2024-01-01' AS date",
        "'day' AS granularity", "id AS arrival")
    first = obs.first_writer(hot, ["arrival"])
    assert first.count() == first.select("entity_id").distinct().count() == 20000 - 6667 + 1
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_audit_keeps_nulls_and_characters(spark, tmp_path):
    path = str(tmp_path / "audit")
    items = _series(spark, {"2024-01-02": "1.5"}).withColumn("unit", F.lit("元"))
    append_audit(items, path)
    append_audit(items, path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(lines) == 2 and lines[0]["unit"] == "元"
    assert "granularity" in lines[0] and lines[0]["granularity"] is None
    assert lines[0]["series"] == {"2024-01-02": "1.5"}


def test_range_count_and_misses(spark, rows):
    stored = _rows(spark, (1, "2024-01-01", "day", 1.0), (1, "2024-01-03", "day", 1.0), (2, "2024-02-01", "day", 1.0))
    assert rows(obs.count_in_period(stored, "2024-01-01", "2024-01-31")) == [(1, 1, 2)]
    wanted = spark.createDataFrame(
        [(1, "stock", 1, "day", "daily", "2024-01-01", "2024-01-04")],
        "concept_id INT, entity_type STRING, entity_id BIGINT, granularity STRING, frequency STRING,"
        " start STRING, end STRING")
    assert rows(obs.cache_misses(wanted, stored), "date") == [("2024-01-02",), ("2024-01-04",)]


def test_different_inserts_under_one_batch_id_keep_both(spark, tmp_path, rows):
    store = ObservationStore(spark, str(tmp_path / "store"))
    assert store.insert(_rows(spark, (71, "2023-02-28", "day", 1.5)), "same", ["arrival"]).inserted == 1
    assert store.insert(_rows(spark, (72, "2023-03-01", "day", 2.5)), "same", ["arrival"]).inserted == 1
    store.insert(_rows(spark, (71, "2023-02-28", "day", 9.5)), "same", ["arrival"])
    assert rows(store.read(), "entity_id", "value") == [(71, "1.5"), (72, "2.5")]


def test_bucketed_store_keeps_first_writers_without_moving_the_store(spark, tmp_path, rows):
    store = BucketedObservations(spark, f"{tmp_path}/store", "bucketed_observations", buckets=4)
    first = _rows(spark, *[(e, f"2024-01-{d:02d}", "day", e + d / 10) for e in range(40) for d in (1, 2)])
    report = store.insert(first, "1", ["arrival"])
    assert (report.attempted, report.rejected, report.inserted) == (80, 0, 80)
    later = _rows(spark, (3, "2024-01-01", "day", 9.0), (3, "2024-01-01", "month", 7.0), (99, "2024-01-01", "day", None), (50, "2024-01-02", "day", 8.0))
    for _ in range(2):  # a replay
        report = store.insert(later, "2", ["arrival"])
        assert (report.attempted, report.rejected, report.inserted) == (4, 1, 2)
    again = BucketedObservations(spark, f"{tmp_path}/store", "bucketed_again", buckets=4)
    assert again.read().count() == 82 == store.read().count()
    assert rows(again.read().filter("entity_id = 3 AND date = '2024-01-01'"), "granularity", "value") == [("day", "3.1"), ("month", "7.0")]
    summary = {"min_concept_id": 1, "max_concept_id": 1, "min_date": "2024-01-01", "max_date": "2024-01-31"}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.hits(later, "9", summary)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The stored side is read by bucket: the only exchange is the batch's own.
    stored_side = plan[plan.index("ShuffledHashJoin") : plan.index("bucketed_observations")]
    assert "Bucketed: true" in plan and "Exchange" not in stored_side and "Sort " not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError):
        BucketedObservations.__mro__[2](spark, "x", schemas.OBSERVATION, schemas.KEY, "x", partition_by=["unit"])


def test_counts_are_taken_while_rows_are_written(spark, rows):
    frame = _rows(spark, (1, "2024-01-01", "day", 1.0), (1, "2024-01-02", "day", None))
    table, counts = observed(frame, "probe", F.count("*").alias("n"), F.max("date").alias("last"))
    assert counts == {"n": 2, "last": "2024-01-02"} and rows(table) == rows(frame)
    discard(table)
    assert not exists(spark, table._scratch)
    empty, counts = observed(frame.limit(0), "probe", F.count("*").alias("n"), F.max("date").alias("last"))
    assert counts["n"] == 0 and counts["last"] is None and empty.isEmpty()


@pytest.mark.parametrize("frequency", ["daily", "monthly", "yearly", None])
def test_misses_without_unfolding_what_is_stored(spark, rows, frequency):
    """Against sets, over ranges that span two bitmaps; odd dates cover nothing."""
    rng = random.Random(11)
    spans = [(7, "1999-12-20", "2000-02-03"), (7, "2000-01-05", "1999-11-30"), (8, "1955-01-01", "1976-12-31"), (9, "2020-02-28", "2020-02-28")]
    wanted = spark.createDataFrame([(1, "x", e, "day", frequency, a, b, "kept") for e, a, b in spans],
                                   "concept_id INT, entity_type STRING, entity_id BIGINT, granularity STRING, frequency STRING, start STRING, end STRING, note STRING")
    spine = wanted.select("entity_id", F.explode(obs.dates.date_spine(F.col("start"), F.col("end"), F.col("frequency"))).alias("date"))
    days = sorted({(r.entity_id, r.date) for r in spine.collect()})
    held = set(rng.sample(days, len(days) // 2)) | {(7, "not a day"), (7, "2000-01-01 00:00:00"), (99, "2000-01-01")}
    stored = spark.createDataFrame([(1, "x", e, d, g) for e, d in held for g in ("day", "day")] + [(1, "x", 9, "2020-02-28", "month")],
                                   "concept_id INT, entity_type STRING, entity_id BIGINT, date STRING, granularity STRING")
    misses = obs.cache_misses(wanted, stored)
    old = obs.absent_from(wanted.select("*", F.explode(obs.dates.date_spine(F.col("start"), F.col("end"), F.col("frequency"))).alias("date")), stored)
    assert rows(misses, *old.columns) == rows(old, *old.columns) and misses.columns == [*wanted.columns, "date"]
    covered = obs.coverage(stored).groupBy("entity_id").agg(F.sum("days"))
    plain = [e for e, d in held if len(d) == 10 and d[4] == "-" and e != 9]
    assert dict(rows(covered.filter("entity_id != 9"))) == {e: plain.count(e) for e in set(plain)}


def test_a_body_is_not_read_once_per_entry(spark):
    """A filter on decoded series takes the decoding along as a whole, not into its lambdas."""
    responses = spark.createDataFrame(
        [(1, "fund", 7, None, '{"2024-01-02": 1.5E3, "2024-01-02": true, "2024-01-03": "x"}', 200, "", "day", "s", None, None)],
        "concept_id INT, entity_type STRING, entity_id BIGINT, date STRING, body STRING, status INT, unit STRING,"
        " granularity STRING, source STRING, start STRING, end STRING",
    )
    items = obs.parse_responses(responses).filter("series IS NOT NULL")
    exploded = obs.explode_series(items)
    assert sorted(tuple(r) for r in exploded.select("date", "value").collect()) == [("2024-01-02", "True"), ("2024-01-03", "x")]
    plan = exploded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 8


def test_new_batch_is_written_once(spark, tmp_path, monkeypatch):
    """Rows out of a written table go into a new batch without a copy on the way; a replay still adds what is missing."""
    rows = _rows(spark, (1, "2024-06-01", "day", 1.0), (1, "2024-06-01", "day", 2.0), (2, "2024-06-01", "day", None))
    store = ObservationStore(spark, str(tmp_path / "once"))
    copies = []
    monkeypatch.setattr("obsmill.sinks.store.written", lambda frame, name: copies.append(name) or written(frame, name))
    report = store.insert(rows, "0", ["arrival"], computed=True)
    assert (report.attempted, report.rejected, report.inserted) == (3, 1, 1) and copies == []
    assert store.insert(rows, "0", ["arrival"], computed=True).inserted == 1 and store.read().count() == 1
    assert store.insert(rows, "1", ["arrival"]).inserted == 0 and store.read().count() == 1
