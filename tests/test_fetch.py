import datetime
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from obsmill import schemas
from obsmill.operators import extract, failover
from obsmill.plans import crawl
from obsmill.plans.expansion import request_key
from obsmill.sources import landed
from obsmill.sources.adapters import Adapter, FetchError, SourceUnavailable, call_groups, fetch_attempts, fetch_table, GROUP_CALLS

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[fetch_attempts.__module__])

ATTEMPT = "task INT, rank INT, source STRING, value STRING, series MAP<STRING,STRING>, error STRING"


def _resolve(spark, *attempts):
    frame = spark.createDataFrame([(1, *a) for a in attempts], ATTEMPT)
    return tuple(failover.resolve(frame, ["task"]).first())[1:]


def test_error_then_value(spark):
    got = _resolve(spark, (0, "a", None, None, "down"), (1, "b", "1.5", None, None), (2, "c", "9", None, None))
    assert got == (200, "1.5", "b", None)


def test_error_then_no_value(spark):
    got = _resolve(spark, (0, "a", None, None, "first"), (1, "b", None, None, "second"), (2, "c", None, None, None))
    assert got == (503, "", None, "second")


def test_no_value_everywhere(spark):
    assert _resolve(spark, (0, "a", None, None, None), (1, "b", "nan", None, None)) == (204, "", None, None)


def test_empty_series_is_skipped(spark):
    got = _resolve(spark, (0, "a", None, {}, None), (1, "b", None, {"2024-01-02": "1.5"}, None))
    assert got == (200, '{"2024-01-02":"1.5"}', "b", None)
    assert _resolve(spark, (0, "a", None, {}, None)) == (204, "", None, None)


def test_chain(spark, rows):
    schema = ("id INT, source STRING, command STRING, column STRING,"
              " chain ARRAY<STRUCT<source: STRING, command: STRING, column_name: STRING>>")
    tasks = spark.createDataFrame(
        [(1, "a", "ca", "x", [("b", "cb", None), ("c", "cc", "y")]), (2, "a", "ca", "x", []), (3, "a", "ca", "x", None)],
        schema)
    assert rows(failover.with_chain(tasks), "id", "rank", "source", "command", "column") == [
        (1, 0, "b", "cb", "x"), (1, 1, "c", "cc", "y"), (2, 0, "a", "ca", "x"), (3, 0, "a", "ca", "x")
    ]


def test_points(spark, rows):
    day = datetime.date(2024, 1, 2)
    frame = spark.createDataFrame(
        [(2, "A", day, day, 2.5), (1, "A", day, day, 1.5), (3, "B", day, day, float("nan"))],
        "n INT, identifier STRING, `Date` DATE, `时间` DATE, close DOUBLE")
    tasks = spark.createDataFrame([("A", "2024-01-02"), ("A", "2024-01-03"), ("B", "2024-01-02")], "identifier STRING, date STRING")
    assert extract.date_column(frame) == "Date"
    expected = [("A", "2024-01-02", "1.5"), ("A", "2024-01-03", None), ("B", "2024-01-02", None)]
    frame = frame.withColumn("source", F.lit("a"))
    tasks = tasks.withColumns({"source": F.lit("a"), "column": F.lit("close")})
    assert rows(extract.extract_points(tasks, extract.frame_points(frame, "n")), "identifier", "date", "value") == expected
    stamped = frame.withColumn("Date", F.col("Date").cast("timestamp_ntz"))
    for other in (stamped, frame.drop("Date", "时间"), frame.drop("close"), frame.withColumn("source", F.lit("b"))):
        assert rows(extract.extract_points(tasks, extract.frame_points(other, "n")).select("value").distinct()) == [(None,)]


def test_points_of_the_task_s_own_column(spark, rows):
    frame = spark.createDataFrame([(1, "a", "A", "d", 1.5, 7)], "n INT, source STRING, identifier STRING, date STRING, `x.y` DOUBLE, z INT")
    tasks = spark.createDataFrame([("a", "A", "d", c) for c in ("x.y", "z", "none")], "source STRING, identifier STRING, date STRING, column STRING")
    got = extract.extract_points(tasks, extract.frame_points(frame, "n"))
    assert rows(got, "column", "value") == [("none", None), ("x.y", "1.5"), ("z", "7")]


def test_ranges(spark, rows):
    points = spark.createDataFrame(
        [("a", "A", d, "x", v) for d, v in [("2021-03-01", "1"), ("2021-03-02", "2"), ("2021-03-04", "4"), ("2021-03-02 00:00:00", "9")]],
        "source STRING, identifier STRING, date STRING, column STRING, value STRING")
    tasks = spark.createDataFrame(
        [(1, "a", "A", None, "x", "2021-03-02", "2021-03-04"), (2, "a", "A", None, "y", "2021-03-02", "2021-03-04"),
         (3, "a", "A", None, "x", "2021-03-04", "2021-03-02")],
        "task INT, source STRING, identifier STRING, date STRING, column STRING, start STRING, end STRING")
    got = extract.extract_ranges(tasks, points, ["task", "source"])
    assert rows(got) == [(1, "a", {"2021-03-02": "2", "2021-03-04": "4"})]


def test_tasks_without_attempts_have_a_status(spark, rows):
    tasks = spark.createDataFrame([(1,), (2,)], "task INT")
    attempts = spark.createDataFrame([(1, 0, "a", "5", None, None)], ATTEMPT)
    assert rows(failover.outcomes(tasks, attempts, ["task"]), "task", "status", "body") == [(1, 200, "5"), (2, 204, "")]


def test_series(spark, rows):
    frame = spark.createDataFrame(
        [("A", "2024-01-02", 2, 2.0), ("A", "2024-01-02", 1, 1.0), ("A", "2024-01-05", 3, 3.0),
         ("A", "2024-01-06", 4, 4.0), ("A", "2024-01-02 00:00:00", 5, 5.0), ("A", "2024-01-03", 6, None),
         ("B", "2024-01-06", 7, 7.0)],
        "identifier STRING, date STRING, n INT, close DOUBLE")
    got = extract.extract_series(frame, ["identifier"], "close", "n", "2024-01-01", "2024-01-05")
    assert rows(got) == [("A", {"2024-01-02": "1.0", "2024-01-05": "3.0"})]


def test_series_of_a_frame_with_times(spark, rows):
    frame = spark.sql(
        "SELECT 'Q' AS identifier, timestamp'2023-05-06 07:08:09' AS date, 1 AS n, 2.25D AS close"
        " UNION ALL SELECT 'Q', timestamp'2023-05-06 09:00:00', 2, 8D UNION ALL SELECT 'Q', timestamp'2023-06-01 00:00:00', 3, 4D"
    )
    got = extract.extract_series(frame, ["identifier"], "close", "n", "2023-05-01", "2023-05-31")
    assert rows(got) == [("Q", {"2023-05-06": "2.25"})]


class _Ranged(Adapter):
    def range_params(self, command, identifier, start, end, column):
        return {"id": identifier, "first": start, "last": end}

    def fetch(self, command, params):
        return params

    def extract_value(self, result, column, date, identifier):
        return float("nan") if identifier == "nan" else f"{column}@{result['date']}"

    def extract_series(self, result, column, start, end):
        return {result["first"]: 1.5, "2024-01-02T": None, "2024-01-02U": float("nan"), result["last"]: 1.6}


class _Failing(Adapter):
    def fetch(self, command, params):
        if params["symbol"] == "closed":
            raise SourceUnavailable
        if params["symbol"] == "odd":
            raise ValueError("not a number")
        raise FetchError("HTTP 500")


class _PointOnly(Adapter):
    def fetch(self, command, params):
        return params

    def extract_value(self, result, column, date, identifier):
        return None


def _adapters():
    return {"akshare": _Ranged(), "bad": _Failing(), "points": _PointOnly()}


class _Rows(Adapter):
    def fetch(self, command, params):
        return [{"Date": "2021-03-01", "x": 1}, {"Date": params["date"], "x": 2.5}]


def test_sources_without_an_adapter_of_their_own(spark):
    task = dict.fromkeys(schemas.TASK_FIELDS) | {"source": "new", "command": "c", "identifier": "A", "date": "2021-03-02"}
    tasks = spark.createDataFrame([task | {"column": c} for c in ("x", "y")], schemas.TASK).withColumn("request_key", F.col("column"))
    got = fetch_attempts(tasks, lambda: {"*": _Rows()}).orderBy("request_key").collect()
    assert [(r.value, r.error) for r in got] == [("2.5", None), (None, None)]


def _fetch(spark, rows, chain, **changes):
    task = {"source": "akshare", "command": "c", "identifier": "730285", "date": None, "column": "yield",
            "concept_id": 64, "entity_type": "bond", "entity_id": 9001, "unit": "SEK", "granularity": "day",
            "start": "2024-01-02", "end": "2024-01-03"}
    tasks = spark.createDataFrame([task | changes], schemas.TASK)
    if chain is not None:
        entry = [F.struct(F.lit(s).alias("source"), F.lit("c").alias("command"), F.lit(c).alias("column_name"))
                 for s, c in chain]
        tasks = tasks.withColumn("chain", F.array(*entry))
    tasks = tasks.withColumn("request_key", request_key())
    attempts = fetch_attempts(tasks, _adapters, "chain" if chain is not None else None, calls=2)
    outcome = failover.resolve(attempts, ["request_key"]).first()
    return attempts.count(), tuple(outcome)[1:]


def test_adapter_serves_a_series(spark, rows):
    assert _fetch(spark, rows, None) == (1, (200, '{"2024-01-02":1.5,"2024-01-03":1.6}', "akshare", None))


def test_walk_stops_at_the_first_that_serves(spark, rows):
    chain = [("bad", ""), ("akshare", "spread"), ("points", "")]
    calls, outcome = _fetch(spark, rows, chain, date="2024-01-02")
    assert (calls, outcome) == (2, (200, "spread@2024-01-02", "akshare", None))


def test_failures(spark, rows):
    assert _fetch(spark, rows, [("bad", ""), ("points", "")], date="d")[1] == (503, "", None, "HTTP 500")
    assert _fetch(spark, rows, [("bad", "")], identifier="closed")[1] == (503, "", None, "bad unavailable")
    assert _fetch(spark, rows, [("bad", "")], identifier="odd")[1] == (503, "", None, "ValueError: not a number")
    assert _fetch(spark, rows, [("nowhere", "")])[1] == (503, "", None, "nowhere unavailable")
    assert _fetch(spark, rows, [("points", "")])[1] == (503, "", None, "points/c has no extract_series")
    assert _fetch(spark, rows, [("points", "")], date="d")[1] == (204, "", None, None)
    assert _fetch(spark, rows, None, date="d", identifier="nan")[1] == (204, "", None, None)


def test_open_frames_have_unlike_columns(spark, tmp_path, rows):
    """Two JSON frames under one look-up; the first known date name of a row counts, in the row's own order."""
    lines = {
        "a": ['{"id": "x", "n": 2, "Date": "2020-01-01", "v": 5.0, "w": "t"}', '{"id": "x", "n": 1, "Date": "2020-01-01", "v": 1e20}',
              '{"id": "x", "n": 3, "datetime": "2020-01-02 10:00:00", "date": "1999-01-01", "v": true}', "no row", '{"id": "x", "v": 1}'],
        "b": ['{"日期": "2020-01-01", "id": "x", "n": 1, "收 盘`": 12, "v": null, "z": NaN}'],
    }
    for source, rows_of in lines.items():
        (tmp_path / f"source={source}").mkdir()
        (tmp_path / f"source={source}" / "f.json").write_text("\n".join(rows_of), encoding="utf-8")
    frames = landed.read_open_frames(spark, str(tmp_path))
    found = extract.open_points(frames, "n", on="id")
    assert rows(found) == [
        ("a", "x", "2020-01-01", "v", "1e+20"), ("a", "x", "2020-01-02 10:00:00", "date", "1999-01-01"),
        ("a", "x", "2020-01-02 10:00:00", "v", "True"), ("b", "x", "2020-01-01", "收 盘`", "12"),
    ]
    daily = extract.open_points(frames, "n", on="id", daily=True)
    assert ("a", "x", "2020-01-02", "v", "True") in rows(daily)
    tasks = spark.createDataFrame([("b", "x", "2020-01-01", "收 盘`", 1), ("a", "x", "2020-01-01", "收 盘`", 2)],
                                  "source STRING, identifier STRING, date STRING, column STRING, n INT")
    assert rows(extract.extract_points(tasks, found), "n", "value") == [(1, "12"), (2, None)]


def test_ranges_over_time_stamps(spark, rows):
    """The first row of a day counts, also where its value is missing."""
    frame = spark.sql("SELECT * FROM VALUES (1, 's', 'x', timestamp_ntz'2020-01-01 09:00:00', 1.5D), "
                      "(0, 's', 'x', timestamp_ntz'2020-01-01 17:00:00', 2.5D), (2, 's', 'x', timestamp_ntz'2020-01-02 00:00:00', double('nan')), "
                      "(3, 's', 'x', timestamp_ntz'2020-01-02 01:00:00', 9D), (4, 's', 'x', timestamp_ntz'2020-01-03 23:59:59', 3D) AS t(n, source, identifier, date, v)")
    tasks = spark.createDataFrame([("s", "x", "v", "2020-01-01", "2020-01-03")], "source STRING, identifier STRING, column STRING, start STRING, end STRING")
    days = extract.frame_points(frame, "n", daily=True)
    (found,) = extract.extract_ranges(tasks, days, ["identifier"]).collect()
    assert found.series == {"2020-01-01": "2.5", "2020-01-03": "3.0"}
    assert extract.extract_ranges(tasks, extract.frame_points(frame, "n"), ["identifier"]).isEmpty()


class _Counted(Adapter):
    """Leaves a mark for each call; breaks off the whole task where a file says so."""

    def __init__(self, folder):
        self.folder = folder

    def fetch(self, command, params):
        with open(f"{self.folder}/{params['symbol']}", "a") as marks:
            marks.write(".")
        if params["symbol"] == "5" and os.path.exists(f"{self.folder}/break"):
            raise SystemExit("the executor is gone")
        if params["symbol"] == "6":
            raise FetchError("no")
        return [{"date": "2024-01-02", "v": params["symbol"]}]


def test_a_repeated_task_makes_no_call_twice(spark, tmp_path, rows):
    calls = tmp_path / "calls"
    calls.mkdir()
    tasks = spark.createDataFrame([(f"k{n}", "s", "c", str(n), "2024-01-02", "v", 1, "x", n, "", "day", None, None) for n in range(8)],
                                  ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in [schemas.T.StructField("request_key", schemas.T.StringType()), *schemas.TASK.fields]))
    folder = str(calls)
    run = lambda: fetch_attempts(tasks, lambda: {"s": _Counted(folder)}, calls=1, landing=f"{tmp_path}/landed")
    (calls / "break").write_text("")
    with pytest.raises(Exception):
        run().collect()
    made = {p.name: len(p.read_text()) for p in calls.iterdir() if p.name != "break"}
    assert made["5"] == 1 and 1 < len(made) <= 8
    (calls / "break").unlink()
    want = [(str(n), None if n == 6 else str(n), "no" if n == 6 else None) for n in range(8)]
    assert rows(run(), "identifier", "value", "error") == want
    # Only the call in hand was made again.
    assert {p.name: len(p.read_text()) for p in calls.iterdir()} == {str(n): 2 if n == 5 else 1 for n in range(8)}
    tasks.withColumn("part", F.lit(0)).createOrReplaceTempView("counted_tasks")
    spark.udtf.register("counted", fetch_table(lambda: {"s": _Counted(folder)}, landing=f"{tmp_path}/landed"))
    again = spark.sql("SELECT * FROM counted(TABLE(counted_tasks) PARTITION BY (source, part))")
    assert rows(again, "identifier", "value", "error") == want
    assert sum(len(p.read_text()) for p in calls.iterdir()) == 9


def test_only_the_chain_s_attempts_count(spark, rows):
    entry = "struct<source:string,command:string,column_name:string>"
    tasks = spark.createDataFrame(
        [("a", "own", "c", "v", [("p", "c", ""), ("q", "c", "")]), ("b", "own", "c", "v", []), ("c", "own", "c", "v", None)],
        f"request_key STRING, source STRING, command STRING, column STRING, chain ARRAY<{entry}>")
    attempts = spark.createDataFrame(
        [("a", 0, "q", "misplaced"), ("a", 1, "q", "1"), ("a", 0, "stranger", "2"), ("b", 0, "own", "3"), ("b", 1, "own", "4"), ("c", 0, "own", "5"), ("d", 0, "own", "6")],
        "request_key STRING, rank INT, source STRING, value STRING").withColumn("error", F.lit(None).cast("string"))
    assert rows(failover.in_chain(tasks, attempts, ["request_key"]), "value") == [("1",), ("3",), ("5",)]
    assert rows(failover.in_chain(tasks.drop("chain"), attempts, ["request_key"]), "value") == [("3",), ("5",)]
    found = crawl.task_responses(tasks, attempts)
    assert rows(found, "request_key", "status", "body") == [("a", 200, "1"), ("b", 200, "3"), ("c", 200, "5")]


def test_groups_of_calls_grow_in_number_only():
    assert call_groups(0, 12) == 12
    assert call_groups(54_000_000, 12) == 5_400
    assert all(n / call_groups(n, 4) <= GROUP_CALLS for n in (1, 40_000, 40_001, 9_000_000))


def test_open_rows_are_decoded_once(spark, tmp_path):
    """A row's JSON is decoded once, and a variant's text is made for values that are there only."""
    (tmp_path / "source=a").mkdir()
    lines = ['{"Date": "2024-01-02", "id": "x", "n": 1, "v": 1.50, "w": "nan", "u": null, "t": "NaN x"}', '{"id": "x", "n": 2, "v": 2}',
             '{"Date": null, "id": "x", "n": 0, "v": 3}', "[1]", '{"id": "y", "日期": "2024-01-02", "date": "z", "n": 1, "v": true}']
    (tmp_path / "source=a" / "rows.json").write_text("\n".join(lines), encoding="utf-8")
    points = extract.open_points(landed.read_open_frames(spark, str(tmp_path)), "n", "id")
    assert {(r["identifier"], r["date"], r["column"], r["value"]) for r in points.collect()} == {
        ("x", "2024-01-02", "v", "1.5"), ("x", "2024-01-02", "t", "NaN x"), ("y", "2024-01-02", "v", "True"), ("y", "2024-01-02", "date", "z")}
    plan = points._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("schemaOfVariant(") == 1
