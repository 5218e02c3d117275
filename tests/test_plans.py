import json
import urllib.parse

import pytest
from pyspark.sql import functions as F

from obsmill import schemas
from obsmill.plans import expansion, providers, ranges, statements
from obsmill.sources import landed

IDS = "source STRING, entity_type STRING, entity_id BIGINT, identifier STRING"


def _plan(mode="series", ids=(9001,), frequency="daily", sources=("akshare",), **changes):
    """A plan of one concept, with the fields that expansion reads."""
    ranked = [{"source": s, "function_command": "nav history", "column_name": "yield"} for s in sources]
    concept = {"concept_id": 64, "entity_type": "bond", "unit": "SEK", "frequency": frequency,
               "ranked_sources": ranked}
    scope = {"entity_type": "bond", "entity_ids": None if ids is None else list(ids)}
    plan = {"mode": mode, "wanted_concepts": [concept], "entity_scope": scope,
            "date_range": {"start": "2024-01-01", "end": "2024-12-31"}}
    return plan | changes


@pytest.fixture
def plans(spark, tmp_path):
    def load(*documents):
        for n, document in enumerate(documents):
            (tmp_path / f"plan{n}.json").write_text(json.dumps(document, indent=1), encoding="utf-8")
        return landed.read_plans(spark, str(tmp_path))

    return load


@pytest.fixture
def identifiers(spark):
    return spark.createDataFrame(
        [("akshare", "bond", 9001, "730285"), ("akshare", "bond", 9002, "730296"),
         ("yfinance", "bond", 9001, "F9001"), ("akshare", "stock", 9001, "600000")], IDS)


def test_flatten(plans, rows):
    flat = expansion.flatten_plan(plans(_plan(sources=("akshare", "yfinance"))))
    assert rows(flat, "concept_id", "rank", "source", "column", "granularity", "is_series") == [
        (64, 0, "akshare", "yield", "day", True), (64, 1, "yfinance", "yield", "day", True)
    ]


def test_series_tasks_are_not_dated(plans, identifiers, rows):
    """Two sources over a reversed window: a task per source that knows the entity, bounds as they were."""
    window = {"start": "2022-03-01", "end": "2021-11-15"}
    plan = _plan(ids=(9001, 9002), sources=("yfinance", "akshare"), date_range=window)
    tasks = expansion.expand_tasks(plans(plan), identifiers)
    assert rows(tasks, "source", "entity_id", "rank") == [("akshare", 9001, 1), ("akshare", 9002, 1), ("yfinance", 9001, 0)]
    assert {(r.date, r.start, r.end) for r in tasks.collect()} == {(None, "2022-03-01", "2021-11-15")}
    keys = [key for (key,) in rows(tasks, expansion.request_key())]
    assert len(set(keys)) == 3 and not any("&date=" in key for key in keys)


def test_dated_tasks_walk_the_window_either_way(plans, identifiers):
    """119 days from mid November to mid March in a leap year, for two sources, whichever bound comes first."""
    ahead, back = ({"start": a, "end": b} for a, b in (("2019-11-18", "2020-03-15"), ("2020-03-15", "2019-11-18")))
    for window in (ahead, back):
        plan = _plan(mode="per_date", sources=("akshare", "yfinance"), date_range=window)
        tasks = expansion.expand_tasks(plans(plan), identifiers)
        per_source = {r.source: (r.n, r.low, r.high) for r in tasks.groupBy("source").agg(
            F.countDistinct("date").alias("n"), F.min("date").alias("low"), F.max("date").alias("high")).collect()}
        assert per_source == dict.fromkeys(("akshare", "yfinance"), (119, "2019-11-18", "2020-03-15"))
        assert tasks.filter("start IS NOT NULL OR end IS NOT NULL").isEmpty()


def test_absent_mode_means_per_date(plans, identifiers):
    document = _plan(frequency="yearly")
    del document["mode"]
    tasks = expansion.expand_tasks(plans(document), identifiers, mode="per_date")
    assert [r.date for r in tasks.collect()] == ["2024-12-31"]


@pytest.mark.parametrize("ids", [None, ()])
def test_no_ids_reach_all_entities_of_the_type(plans, identifiers, rows, ids):
    scoped = expansion.scoped_entities(plans(_plan(ids=ids)), identifiers)
    assert rows(scoped, "source", "entity_id") == [("akshare", 9001), ("akshare", 9002), ("yfinance", 9001)]


def test_repeated_ids_count_once(plans, identifiers, rows):
    scoped = expansion.scoped_entities(plans(_plan(ids=(9001, 9001))), identifiers)
    assert rows(scoped, "source", "identifier") == [("akshare", "730285"), ("yfinance", "F9001")]


def test_reversed_range_stays_reversed_in_series_mode(plans, identifiers, rows):
    document = _plan(date_range={"start": "2024-12-31", "end": "2024-01-01"})
    tasks = expansion.expand_tasks(plans(document), identifiers)
    assert rows(tasks, "start", "end") == [("2024-12-31", "2024-01-01")]


def test_request_key_is_the_form_encoded_task(spark):
    task = {"source": "akshare", "command": "a b/c*~", "identifier": "11 0+", "date": None, "column": "yield",
            "concept_id": 64, "entity_type": "bond", "entity_id": 9001, "unit": "", "granularity": "day",
            "start": "2024-01-01", "end": "2024-12-31"}
    got = spark.createDataFrame([task], schemas.TASK).select(expansion.request_key()).first()[0]
    query = urllib.parse.urlencode({k: str(v) for k, v in task.items() if v is not None})
    assert got == f"fetch://akshare/{urllib.parse.quote(task['command'])}?{query}"


def test_repeats_and_seen_tasks_drop_out(plans, identifiers):
    once = _plan(frequency="monthly", mode="per_date")
    tasks = expansion.distinct_tasks(expansion.expand_tasks(plans(once, once), identifiers))
    assert tasks.count() == 12
    assert expansion.unseen_tasks(tasks, tasks.filter("date < '2024-03-01'")).count() == 10
    assert expansion.unseen_tasks(tasks, tasks).isEmpty()


def test_size_without_expansion_equals_the_expansion(plans, identifiers, rows):
    loaded = plans(_plan(mode="per_date", ids=None), _plan(frequency="monthly", mode="per_date"), _plan())
    size = expansion.plan_size(loaded, identifiers)
    counted = expansion.expand_tasks(loaded, identifiers).groupBy("concept_id", "source").count()
    assert rows(size, "concept_id", "source", "tasks") == rows(counted)
    assert rows(size, "tasks") == [(2 * 366 + 12 + 1,)]


def test_malformed_plan_raises(spark):
    docs = spark.createDataFrame([(1, "{not json")], "plan_id INT, doc STRING")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        landed.parse_plans(docs).collect()


def test_plan_text_parses_like_plan_files(spark, plans, rows):
    document = _plan(sources=("akshare", "yfinance"))
    docs = spark.createDataFrame([(1, json.dumps(document))], "plan_id INT, doc STRING")
    columns = [c for c in expansion.flatten_plan(plans(document)).columns if c != "plan_id"]
    assert rows(expansion.flatten_plan(landed.parse_plans(docs)), *columns) == rows(
        expansion.flatten_plan(plans(document)), *columns)


def test_stock_codes_are_exactly_six_digits(spark, rows):
    codes = ["600000", "000001", "60000", "6000000", "HK0001", "600000\n", "６０００００"]
    frame = spark.createDataFrame([(c,) for c in codes], "identifier STRING")
    assert rows(statements.stock_codes(frame)) == [("000001",), ("600000",)]


def test_statement_tasks(spark, rows):
    stocks = spark.createDataFrame([(2, "000001"), (1, "600000"), (1, "600001")], "entity_id BIGINT, identifier STRING")
    assert statements.statement_tasks(stocks).count() == 36
    seen = spark.createDataFrame([("1:akshare:annual_bs",)], "task_key STRING")
    fresh = statements.new_statement_tasks(stocks, seen, concept_ids=[239, 240])
    assert fresh.count() == 23
    assert rows(fresh.filter("entity_id = 1").select("identifier").distinct()) == [("600000",)]
    assert statements.new_statement_tasks(stocks, fresh.select("task_key").union(seen)).isEmpty()
    assert [r.entity_id for r in statements.in_entity_order(stocks).collect()] == [1, 1, 2]


def test_provider_params(spark):
    one = spark.range(1)
    got = one.select(
        providers.point_params(F.lit("a"), F.lit("2024-01-02")),
        providers.range_params(F.lit("a")),
        providers.history_params(F.lit("a"), F.lit("2024-01-02"), F.lit("2024-02-01")),
        providers.statement_params(F.lit("yfinance"), F.lit("600000")),
        providers.statement_params(F.lit("yfinance"), F.lit("000001")),
        providers.statement_params(F.lit("akshare"), F.lit("600000")),
        providers.statement_params(F.lit("other"), F.lit("600000")),
    ).first()
    assert tuple(got) == (
        {"symbol": "a", "date": "2024-01-02"}, {"symbol": "a"},
        {"symbol": "a", "start_date": "20240102", "end_date": "20240201", "adjust": "qfq"},
        {"symbol": "600000.SS"}, {"symbol": "000001.SZ"}, {"symbol": "600000"}, None,
    )


def test_a_hot_plan_is_split_at_run_time(spark, tmp_path):
    """One plan holds nearly all tasks; without broadcasts its join is split by AQE."""
    entities = 40000
    concept = ("named_struct('concept_id', 1, 'code', 'c', 'entity_type', 'bond', 'unit', '', 'frequency', 'daily',"
               " 'granularity', '', 'ranked_sources', array(named_struct('source', 'akshare', 'function_command', 'c',"
               " 'column_name', 'x')))")
    plans = spark.range(2000).selectExpr(
        "id AS plan_id", "'series' AS mode", f"array({concept}) AS wanted_concepts",
        f"named_struct('entity_type', 'bond', 'entity_ids', if(id = 0, sequence(0L, {entities - 1}L), array(id)))"
        " AS entity_scope", "named_struct('start', '2024-01-01', 'end', '2024-12-31') AS date_range")
    ids = spark.range(entities).selectExpr(
        "'akshare' AS source", "'bond' AS entity_type", "id AS entity_id", "cast(id AS string) AS identifier")
    plans.write.parquet(f"{tmp_path}/plans")
    ids.repartition(8).write.parquet(f"{tmp_path}/ids")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "65536",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        inputs = spark.read.parquet(f"{tmp_path}/plans"), spark.read.parquet(f"{tmp_path}/ids")
        assert expansion.distinct_tasks(expansion.expand_tasks(*inputs)).count() == entities
        # The join is done on ranges, which are written before they are dealt out.
        counted = ranges.task_ranges(*inputs).agg(F.count("*"), F.max("identifier"))
        counted.collect()
        assert "SortMergeJoin(skew=true)" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
