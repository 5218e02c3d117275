import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from obsmill.__main__ import main
from obsmill.plans import crawl, expansion, ranges
from test_plans import IDS, _plan, identifiers, plans  # noqa: F401

SPAN = "k STRING, rank INT, first LONG, last LONG"


def covered(rows):
    best = {}
    for k, rank, first, last in rows:
        for step in range(first, last + 1):
            best[k, step] = min(rank, best.get((k, step), rank))
    return best


@pytest.mark.parametrize("seed,ranks", [(1, 1), (2, 3), (3, 200)])
def test_sweep_equals_sets_of_steps(spark, seed, ranks):
    draw = random.Random(seed)
    spans = lambda n: [
        (draw.choice(["a", "b", None, "hot", "hot", "hot"]), draw.randrange(ranks), a := draw.randint(-40, 60), a + draw.choice([0, 0, 1, 5, 30]))
        for _ in range(n)
    ]
    wanted, taken = spans(150), spans(20)
    wanted += wanted[:10]
    frame = spark.createDataFrame([(*r, "x") for r in wanted], SPAN + ", note STRING")
    seen = spark.createDataFrame(taken, SPAN).drop("rank")
    found = [tuple(r) for r in ranges.swept(frame, ["k"], seen, ranks).collect()]
    gone = {(k, s) for k, _, a, b in taken for s in range(a, b + 1)}
    want = {at: rank for at, rank in covered(wanted).items() if at not in gone}
    assert covered(found) == want and sum(b - a + 1 for *_, a, b in found) == len(want)
    plain = [tuple(r) for r in ranges.swept(frame, ["k"], ranks=ranks).collect()]
    assert covered(plain) == covered(wanted)
    if ranks == 1:
        # As few ranges as can be.
        steps = defaultdict(set)
        for k, s in covered(wanted):
            steps[k].add(s)
        assert len(plain) == sum(s - 1 not in each for each in steps.values() for s in each)
    assert ranges.swept(frame.limit(0), ["k"], seen, ranks).count() == 0


def _keys(frame):
    return sorted(r[0] for r in frame.select("request_key").collect())


def test_distinct_ranges_expand_to_the_distinct_tasks(spark, plans, identifiers):  # noqa: F811
    spans = [("2023-12-20", "2024-02-10"), ("2024-02-01", "2024-03-05"), ("2024-03-05", "2023-11-30"), ("2024-01-31", "2024-01-31")]
    documents = []
    for k, (start, end) in enumerate(spans):
        for frequency in ("daily", "monthly", "yearly", None):
            plan = _plan(mode="per_date", frequency=frequency, ids=None, sources=("akshare", "yfinance")[:: 1 if k % 2 else -1])
            plan["date_range"] = {"start": start, "end": end}
            # Two cadences under one tag name one task.
            plan["wanted_concepts"][0]["granularity"] = "quarter" if k % 2 else ""
            documents.append(plan)
    documents.append(_plan(ids=None))
    documents.append(_plan(ids=None, date_range={"start": "2024-12-31", "end": "2024-01-01"}))
    loaded = plans(*documents, *documents[:3])
    old = expansion.distinct_tasks(expansion.expand_tasks(loaded, identifiers))
    new = crawl.plan_tasks(loaded, identifiers)
    columns = ["request_key", "rank"]
    assert sorted(map(tuple, new.select(columns).collect())) == sorted(map(tuple, old.select(columns).collect()))
    assert "2024-12-31" in {r.date for r in new.filter("granularity = 'quarter'").collect()}


def test_no_expanded_row_is_shuffled(plans, identifiers):  # noqa: F811
    tasks = crawl.plan_tasks(plans(_plan(mode="per_date"), _plan(mode="per_date", ids=None)), identifiers)
    text = tasks._jdf.queryExecution().optimizedPlan().toString()
    expanding = text.index("_step")
    assert "Repartition" not in text[:expanding] and "Aggregate" not in text[:expanding] and "Join" not in text[:expanding]


def test_partitions_hold_even_shares_of_a_long_range(spark, plans, identifiers):  # noqa: F811
    long = _plan(mode="per_date", date_range={"start": "1996-01-01", "end": "2023-05-18"})
    short = [_plan(mode="per_date", ids=(9002,), date_range={"start": f"2024-01-{k:02d}", "end": "2024-01-31"}) for k in range(1, 20)]
    found = ranges.distinct_ranges(plans(long, *short), identifiers)
    tasks = ranges.expand(ranges.balanced(found, partitions=12, run=64))
    sizes = sorted(r[1] for r in tasks.groupBy(F.spark_partition_id()).count().collect())
    assert sum(sizes) == 10_000 + 31 and len(sizes) == 12 and sizes[-1] <= 2 * sizes[6]
    tasks = ranges.expand(ranges.balanced(found, partitions=2, most=1_000))
    assert tasks.select(F.spark_partition_id()).distinct().count() == 11
    assert ranges.expand(ranges.balanced(found.limit(0))).count() == 0


def test_runs_compare_ranges(spark, tmp_path, plans, identifiers):  # noqa: F811
    base = str(tmp_path / "runs")
    identifiers.write.parquet(f"{base}/ids")
    found = []
    for k, (frequency, end) in enumerate([("monthly", "03-31"), ("daily", "02-01"), ("monthly", "07-31"), ("daily", "02-01"), ("monthly", "07-31")]):
        plan = _plan(mode="per_date", frequency=frequency, date_range={"start": "2024-01-01", "end": f"2024-{end}"})
        plan["wanted_concepts"][0]["granularity"] = "tag"
        (tmp_path / f"run{k}.json").write_text(json.dumps(plan), encoding="utf-8")
        main(["tasks", "--plan", f"{tmp_path}/run{k}.json", "--identifiers", f"{base}/ids", "--out", f"{base}/out{k}", "--taken", f"{base}/taken"])
        found.append(spark.read.parquet(f"{base}/out{k}").count())
    # The first of January and of February are known to the second run, under the same tag.
    assert found == [3, 30, 4, 0, 0]
    other = _plan(mode="per_date", frequency="yearly", ids=None)
    taken = ranges.read_ranges(spark, f"{base}/taken")
    assert crawl.plan_tasks(plans(other), identifiers, taken=taken).count() == 2
    assert ranges.read_ranges(spark, f"{base}/nothing").isEmpty()


def test_balance_takes_no_sort_by_fields(spark):
    """Runs are dealt round, also equal ones, without windows over them."""
    fields = {f.name: F.lit(None).cast(f.dataType) for f in ranges.RANGE.fields}
    equal = spark.range(4_000).select(*[v.alias(c) for c, v in {**fields, "first": F.lit(1), "last": F.lit(3)}.items()])
    equal = equal.withColumns({"axis": F.lit("day"), "first": F.col("first").cast("long"), "last": F.col("last").cast("long")})
    dealt = ranges.balanced(equal, partitions=8)
    assert "Window" not in dealt._jdf.queryExecution().optimizedPlan().toString()
    sizes = [r[1] for r in ranges.expand(dealt).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 12_000 and len(sizes) == 8 and max(sizes) <= 1.1 * min(sizes)


def test_key_parts(spark):
    """A key made of its range's parts is the key of the task, whatever is null or has to be encoded."""
    null = F.lit(None).cast("string")
    base = {f.name: F.lit("a b*~é&/") if f.dataType.simpleString() == "string" else F.lit(5).cast(f.dataType) for f in ranges.TASK.fields}
    for change in ({}, {"date": null}, {"date": F.lit("2024-01-31")}, {"date": F.lit("+12024-01-31")}, {"identifier": null, "unit": F.lit("")},
                   {"source": null}, {c: null for c in ("command", "date")}, {c: F.lit(None).cast(ranges.TASK[c].dataType) for c in base if c not in ("source", "command")}):
        tasks = spark.range(1).select(*[v.alias(c) for c, v in {**base, **change}.items()])
        parted = tasks.withColumns(expansion.request_key_parts())
        assert parted.select(expansion.joined_request_key()).first()[0] == tasks.select(expansion.request_key()).first()[0]
