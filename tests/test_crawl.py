import json

import pytest
from pyspark.sql import functions as F

from obsmill import schemas
from obsmill.__main__ import main
from obsmill.plans import crawl
from obsmill.schemas import ENDPOINT_REGISTRY
from obsmill.sinks.snapshots import SnapshotTable
from obsmill.sinks.store import ObservationStore
from obsmill.sources import landed
from test_fetch import _adapters, fetch_attempts
from test_plans import IDS, _plan

ATTEMPT = "request_key STRING, rank INT, source STRING, value STRING, series MAP<STRING,STRING>, error STRING"


@pytest.fixture
def inputs(spark, tmp_path):
    def write(plan):
        (tmp_path / "plan.json").write_text(json.dumps(plan), encoding="utf-8")
        ids = [("akshare", "bond", 9001, "730285"), ("yfinance", "bond", 9001, "F1")]
        spark.createDataFrame(ids, IDS).write.parquet(f"{tmp_path}/ids")
        return landed.read_plans(spark, f"{tmp_path}/plan.json"), landed.read_identifiers(spark, f"{tmp_path}/ids")

    return write


def test_crawl_command(spark, tmp_path, inputs, rows):
    sources = ("akshare", "yfinance")
    plans, ids = inputs(_plan(mode="per_date", frequency="monthly", sources=sources))
    tasks = crawl.plan_tasks(plans, ids)
    assert tasks.count() == 24
    value = F.when((F.col("source") == "yfinance") | (F.col("date") > "2024-06"), F.concat(F.col("source"), F.lit("!")))
    attempts = tasks.select(
        "request_key", F.lit(0).alias("rank"), "source", value.alias("value"),
        F.lit(None).cast("map<string,string>").alias("series"), F.lit(None).cast("string").alias("error"))
    attempts.write.parquet(f"{tmp_path}/attempts")
    for batch in ("1", "2"):
        main(["crawl", "--plan", f"{tmp_path}/plan.json", "--identifiers", f"{tmp_path}/ids", "--attempts",
              f"{tmp_path}/attempts", "--store", f"{tmp_path}/store", "--batch", batch, "--audit", f"{tmp_path}/audit"])
    stored = ObservationStore(spark, f"{tmp_path}/store").read()
    expected = [(f"2024-{m:02d}-01", "month", "akshare!" if m >= 6 else "yfinance!") for m in range(1, 13)]
    assert rows(stored, "date", "granularity", "value") == expected
    assert spark.read.json(f"{tmp_path}/audit").count() == 2 * (12 + 7)


def test_crawl_through_adapters(spark, tmp_path, inputs, rows):
    plans, ids = inputs(_plan(sources=("akshare", "bad")))
    tasks = crawl.plan_tasks(plans, ids, chained=True)
    assert [c.source for c in tasks.first().chain] == ["akshare", "bad"]
    responses = crawl.task_responses(tasks, fetch_attempts(tasks, _adapters, "chain"))
    store = ObservationStore(spark, f"{tmp_path}/store")
    assert crawl.store_responses(responses, store, "1").inserted == 2
    assert rows(store.read(), "concept_id", "entity_id", "date", "value", "unit") == [
        (64, 9001, "2024-01-01", "1.5", "SEK"), (64, 9001, "2024-12-31", "1.6", "SEK")
    ]


def test_other_commands(spark, tmp_path, inputs, rows):
    inputs(_plan())
    base = str(tmp_path)
    tasks = ["tasks", "--plan", f"{base}/plan.json", "--identifiers", f"{base}/ids", "--out"]
    main([*tasks, f"{base}/tasks"])
    main([*tasks, f"{base}/again", "--seen", f"{base}/tasks"])
    assert spark.read.parquet(f"{base}/tasks").count() == 1 and spark.read.parquet(f"{base}/again").isEmpty()
    main(["statement-tasks", "--identifiers", f"{base}/ids", "--out", f"{base}/st", "--entity-type", "bond", "--concepts", "239, 240"])
    statement = spark.read.json(f"{base}/st")
    assert statement.count() == 12 and statement.first().concept_ids == [239, 240]
    prices = spark.createDataFrame([(1, "000001", "2024-01-02", 1.4)], "entity_id BIGINT, symbol STRING, date STRING, close DOUBLE")
    prices.write.parquet(f"{base}/prices")
    main(["migrate", "astock", "--table", f"{base}/prices", "--store", f"{base}/m", "--batch", "1", "--symbol", "000001"])
    assert rows(ObservationStore(spark, f"{base}/m").read(), "concept_id", "value") == [(234, "1.4")]


def test_runs_extend_the_record_of_tasks(spark, tmp_path, inputs):
    inputs(_plan(mode="per_date", frequency="monthly"))
    base = str(tmp_path)
    found = []
    for k, end in enumerate(("2024-03-31", "2024-07-31", "2024-07-31", "2024-03-31")):
        plan = _plan(mode="per_date", frequency="monthly")
        text = json.dumps(plan).replace("2024-12-31", end)
        (tmp_path / f"plan{k}.json").write_text(text, encoding="utf-8")
        main(["tasks", "--plan", f"{base}/plan{k}.json", "--identifiers", f"{base}/ids", "--out", f"{base}/out{k}",
              "--record", f"{base}/record"])
        found.append(spark.read.parquet(f"{base}/out{k}").count())
    assert found == [3, 4, 0, 0]
    assert crawl.seen_tasks(spark, f"{base}/record").read().distinct().count() == 7


def test_statements_command(spark, tmp_path, capsys, rows):
    base = str(tmp_path)
    spark.createDataFrame(
        [(5, "quarterly_bs", "2023-06-30", 3.5, 1.0), (5, "annual_bs", "2023-06-30 00:00:00", 2.5, None),
         (6, "annual_bs", None, 9.0, 9.0), (6, "unknown", "2023-06-30", 9.0, 9.0)],
        "entity_id BIGINT, function_name STRING, REPORT_DATE STRING, TOTAL_ASSETS DOUBLE, TOTAL_EQUITY DOUBLE",
    ).write.parquet(f"{base}/wide")
    spark.createDataFrame(
        [(5, "annual_bs", "Total Assets", 7.5, 8.5), (5, "annual_is", "Net Income", None, None)],
        "entity_id BIGINT, function_name STRING, field STRING, `2023-06-30 00:00:00` DOUBLE, `2022-06-30` DOUBLE",
    ).write.parquet(f"{base}/transposed")
    tasks = [(entity, source, name) for entity in (5, 6) for source in ("akshare", "yfinance")
             for name in ("annual_bs", "annual_is", "quarterly_bs")]
    spark.createDataFrame(tasks, "entity_id BIGINT, source STRING, function_name STRING").write.json(f"{base}/tasks")
    command = ["statements", "--tasks", f"{base}/tasks", "--wide", f"{base}/wide", "--transposed", f"{base}/transposed",
               "--store", f"{base}/store", "--batch"]
    main([*command, "1"])
    shown = capsys.readouterr().out
    assert "attempted=5, rejected=0, inserted=3" in shown
    outcome = [tuple(line.strip("|").replace(" ", "").split("|")) for line in shown.splitlines() if "akshare" in line or "yfinance" in line]
    assert sorted(outcome) == [("akshare", "2", "4"), ("yfinance", "1", "5")]
    stored = ObservationStore(spark, f"{base}/store")
    want = [(242, 5, "2022-06-30", "8.5", "yfinance"), (242, 5, "2023-06-30", "2.5", "akshare"),
            (244, 5, "2023-06-30", "1.0", "akshare")]
    assert rows(stored.read(), "concept_id", "entity_id", "date", "value", "source_used") == want
    main([*command, "2"])
    assert "inserted=0" in capsys.readouterr().out and stored.read().count() == 3


def test_refresh_and_health_commands(spark, tmp_path, capsys, rows):
    base = str(tmp_path)
    registry = spark.createDataFrame(
        [(1, "http", "1.1.1.1", 80, None, "active", "free-proxy", None, None, None)],
        ENDPOINT_REGISTRY)
    SnapshotTable(spark, f"{base}/registry").replace(registry)
    spark.createDataFrame([("a", 0, 200, "3.3.3.3 <td>80</td>")], landed.PAGE).write.parquet(f"{base}/pages")
    spark.createDataFrame([("3.3.3.3", 80, "tencent", 200)], "ip STRING, port INT, target STRING, status INT").write.parquet(f"{base}/probes")
    main(["refresh", "--registry", f"{base}/registry", "--pages", f"{base}/pages", "--probes", f"{base}/probes", "--now", "2024-01-31T12:00:00"])
    assert rows(SnapshotTable(spark, f"{base}/registry").read(), "ip", "status") == [("1.1.1.1", "retired"), ("3.3.3.3", "active")]
    main(["refresh", "--registry", f"{base}/first", "--pages", f"{base}/pages", "--probes", f"{base}/probes", "--now", "2024-01-31T12:00:00"])
    first = SnapshotTable(spark, f"{base}/first")
    assert first.version() == 1 and rows(first.read(), "ip", "status") == [("3.3.3.3", "active")]
    assert '{"touched": 1, "inserted": 1, "retired": 0}' in capsys.readouterr().out
    spark.createDataFrame([("a", "x", 10, None)], "source STRING, command STRING, elapsed_ms INT, error STRING").write.parquet(f"{base}/log")
    main(["health", "--log", f"{base}/log"])
    assert "slowest_ms" in capsys.readouterr().out


def test_responses_and_tasks_arrive_by_command(spark, tmp_path, capsys, rows):
    base = str(tmp_path)
    task = {"source": "akshare", "command": "c", "identifier": "1", "column": "x", "concept_id": 64, "entity_type": "bond", "entity_id": 9001,
            "unit": "", "granularity": "day", "start": "2019-03-01", "end": "2019-03-31", "status": 200}
    (tmp_path / "in").mkdir()
    for n, body in enumerate(('{"2019-03-04": 1.25, "2019-05-01": 2}', '{"2019-03-04": 9, "2019-03-05": 3}')):
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps(task | {"body": body}) + "\n", encoding="utf-8")
        main(["take-responses", "--incoming", f"{base}/in", "--store", f"{base}/store", "--checkpoint", f"{base}/check", "--audit", f"{base}/audit"])
    assert rows(ObservationStore(spark, f"{base}/store").read(), "date", "value") == [("2019-03-04", "1.25"), ("2019-03-05", "3")]
    lines = [json.loads(r.value)["series"] for r in spark.read.text(f"{base}/audit").collect()]
    assert {"2019-03-04": 1.25, "2019-05-01": 2} in lines and len(lines) == 2
    (tmp_path / "tasks").mkdir()
    waiting = {"entity_id": 3, "identifier": "600000", "source": "akshare", "function_name": "annual_bs", "function_command": "b"}
    for n in range(2):
        (tmp_path / "tasks" / f"{n}.json").write_text(json.dumps(waiting) + "\n", encoding="utf-8")
        main(["take-tasks", "--incoming", f"{base}/tasks", "--queue", f"{base}/queue", "--checkpoint", f"{base}/check-tasks"])
    assert capsys.readouterr().out.split() == ["1", "2", "1", "1"]


def test_size_command(spark, tmp_path, capsys, inputs):
    inputs(_plan(mode="per_date", frequency="monthly", sources=("akshare", "yfinance")))
    main(["size", "--identifiers", f"{tmp_path}/ids", "--plan", f"{tmp_path}/plan.json", "--entity-type", "bond"])
    found = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert found[-1] == {"stocks": 1, "functions": 12, "tasks": 12}
    assert sorted((r["concept_id"] or 0, r["source"] or "", r["tasks"]) for r in found[:-1]) == [
        (0, "", 24), (64, "", 24), (64, "akshare", 12), (64, "yfinance", 12)]


def test_report_counts_entries_beyond_their_range(spark, tmp_path):
    response = {"source": "akshare", "command": "c", "identifier": "1", "column": "x", "concept_id": 64, "entity_type": "bond", "entity_id": 1,
                "unit": "", "granularity": "day", "start": "2019-03-01", "end": "2019-03-31", "status": 200, "rank": 0, "body": '{"2019-03-04": 1, "2019-04-01": 2, "2019-02-28": 3}'}
    frame = spark.createDataFrame([response | {"date": None}], schemas.T.StructType([*schemas.RESPONSE.fields, schemas.T.StructField("rank", schemas.T.IntegerType())]))
    report = crawl.store_responses(frame, ObservationStore(spark, f"{tmp_path}/store"), "1")
    assert (report.attempted, report.inserted, report.kept, report.dropped) == (1, 1, 1, 2)
    assert crawl.store_responses(frame.limit(0), ObservationStore(spark, f"{tmp_path}/store"), "2").kept == 0


def test_the_first_row_to_arrive_is_migrated(spark, tmp_path, rows):
    table = spark.createDataFrame([(1, "s", "2020-01-01", 9.0, 1), (1, "s", "2020-01-01", 10.0, 0), (1, "t", "2020-01-01", 3.0, 2)],
                                  "entity_id BIGINT, symbol STRING, date STRING, close DOUBLE, n INT").coalesce(1)
    table.write.parquet(f"{tmp_path}/t")
    for store, option, want in (("a", [], "9.0"), ("b", ["--arrival", "n"], "10.0"), ("c", ["--arrival", "n", "--limit", "1"], "10.0")):
        main(["migrate", "astock-us", "--table", f"{tmp_path}/t", "--store", f"{tmp_path}/{store}", "--batch", "1", *option])
        assert rows(ObservationStore(spark, f"{tmp_path}/{store}").read(), "value") == [(want,)]
