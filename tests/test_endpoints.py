import random
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from obsmill.operators import endpoints, health
from obsmill.schemas import ENDPOINT_REGISTRY
from obsmill.sinks.snapshots import SnapshotTable
from obsmill.sources.landed import fetched_ok

NOW = datetime(2024, 1, 31, 12, 0)
ENDPOINT = "source STRING, pos INT, scheme STRING, ip STRING, port INT"


def _ranked(frame):
    """Sources come in reverse order of their names."""
    return frame.withColumn("source_rank", -F.ascii(F.substring("source", -1, 1)) - 100 * F.ascii(F.substring("source", -2, 1)))


PROBE = "ip STRING, port INT, target STRING, status INT"


def _page(spark, html, source="a", status=200):
    return spark.createDataFrame([(source, status, html)], "source STRING, status INT, html STRING").withColumn("source_rank", F.lit(1))


def test_pairs_by_position(spark, rows):
    html = "1.1.1.1 <td>80</td> 2.2.2.2 <td>8080</td> 3.3.3.3 <td>1</td><td>123456</td>"
    assert rows(endpoints.pair_endpoints(_page(spark, html)), "pos", "ip", "port") == [
        (0, "1.1.1.1", 80), (1, "2.2.2.2", 8080)
    ]


def test_bad_ports_drop_after_pairing(spark, rows):
    html = "1.1.1.1 <td>99999</td> 2.2.2.2 <td>00</td> 3.3.3.3 <td>65535</td>"
    assert rows(endpoints.pair_endpoints(_page(spark, html)), "ip", "port") == [("3.3.3.3", 65535)]
    assert endpoints.pair_endpoints(_page(spark, "no table")).isEmpty()
    assert fetched_ok(_page(spark, html, status=404)).isEmpty()


def _many(spark, *sizes):
    return _ranked(spark.createDataFrame(
        [(f"s{99 - n:02d}", i, "http", f"{n}.0.0.{i % 20}", 80) for n, size in enumerate(sizes) for i in range(size)], ENDPOINT))


@pytest.mark.parametrize("sizes,budget", [
    ((30, 30, 30), 50), ((50, 1), 50), ((49, 1, 1), 50), ((1,) * 60, 50), ((100, 5), 50), ((3, 4, 5), 1)
])
def test_budget_against_a_plain_loop(spark, rows, sizes, budget):
    used, total = [], 0
    for n, size in enumerate(sizes):
        if total >= budget:
            break
        used.append((f"s{99 - n:02d}",))
        total += size
    kept = endpoints.within_budget(_many(spark, *sizes), budget)
    assert rows(kept.select("source").distinct()) == sorted(used) and kept.count() == total


def test_first_seen_and_top(spark, rows):
    frame = spark.createDataFrame(
        [("b", 0, "http", "1.1.1.1", 80), ("a", 5, "http", "1.1.1.1", 80), ("a", 9, "http", "1.1.1.1", 80),
         ("a", 7, "http", "1.1.1.1", 81)], ENDPOINT)
    frame = _ranked(frame)
    assert rows(endpoints.first_seen(frame), "source", "pos", "port") == [("a", 7, 81), ("b", 0, 80)]
    assert rows(endpoints.first_n(frame, 2), "source", "pos") == [("a", 5), ("b", 0)]


def test_validity_and_rates(spark, rows):
    found = spark.createDataFrame([("a", i, "http", f"1.1.1.{i}", 80) for i in range(3)], ENDPOINT)
    probes = spark.createDataFrame(
        [("1.1.1.0", 80, "eastmoney", 503), ("1.1.1.0", 80, "tencent", None), ("1.1.1.1", 80, "tencent", 600),
         ("1.1.1.2", 80, "elsewhere", 200)], PROBE)
    assert rows(endpoints.valid_endpoints(found, probes), "ip") == [("1.1.1.0",)]
    rates = endpoints.success_rates(endpoints.probe_results(found, probes))
    assert rows(rates, "target", "passed", "tried", "rate") == [
        ("eastmoney", 1, 3, 33.3), ("overall", 1, 3, 33.3), ("tencent", 0, 3, 0.0), ("yahoo_finance", 0, 3, 0.0)
    ]
    empty = endpoints.success_rates(endpoints.probe_results(found.limit(0), probes))
    assert rows(empty, "target", "tried", "rate") == [
        ("eastmoney", 0, 0.0), ("overall", 0, 0.0), ("tencent", 0, 0.0), ("yahoo_finance", 0, 0.0)
    ]


def _registry(spark, *entries):
    return spark.createDataFrame(
        [(n, "https", ip, 80, "u", status, "paid", NOW, at, retired) for n, (ip, status, at, retired) in enumerate(entries)],
        ENDPOINT_REGISTRY)


def test_upsert(spark, rows):
    old = NOW - timedelta(days=1)
    registry = _registry(spark, ("1.1.1.1", "retired", old, old), ("2.2.2.2", "retired", old, old))
    fresh = spark.createDataFrame([("a", 0, "http", "1.1.1.1", 80), ("a", 1, "http", "3.3.3.3", 80)], ENDPOINT)
    got = rows(endpoints.upsert(registry, fresh, NOW), "ip", "id", "scheme", "auth", "status", "label", "updated_at", "retired_at")
    assert got == [
        ("1.1.1.1", 0, "https", "u", "active", "paid", NOW, None),
        ("2.2.2.2", 1, "https", "u", "retired", "paid", old, old),
        ("3.3.3.3", None, "http", None, "active", "free-proxy", NOW, None),
    ]


def test_retirement(spark, rows):
    edge = NOW - timedelta(minutes=30)
    registry = _registry(
        spark, ("1.1.1.1", "active", None, None), ("2.2.2.2", "active", edge, None),
        ("3.3.3.3", "active", edge - timedelta(seconds=1), None), ("4.4.4.4", "pending", None, None))
    assert rows(endpoints.retire(registry, NOW), "ip", "status", "retired_at") == [
        ("1.1.1.1", "retired", NOW), ("2.2.2.2", "active", None), ("3.3.3.3", "retired", NOW), ("4.4.4.4", "pending", None)
    ]


def test_refresh_without_valid_endpoints_changes_nothing(spark, rows):
    registry = _registry(spark, ("1.1.1.1", "active", None, None))
    pages = _page(spark, "3.3.3.3 <td>80</td>")
    none = spark.createDataFrame([("3.3.3.3", 80, "tencent", None)], PROBE)
    assert rows(endpoints.refresh(registry, pages, none, NOW), "ip", "status") == [("1.1.1.1", "active")]
    good = spark.createDataFrame([("3.3.3.3", 80, "tencent", 200)], PROBE)
    assert rows(endpoints.refresh(registry, pages, good, NOW), "ip", "status") == [
        ("1.1.1.1", "retired"), ("3.3.3.3", "active")
    ]


def test_snapshots(spark, tmp_path, rows):
    table = SnapshotTable(spark, str(tmp_path / "registry"))
    assert table.version() == 0
    table.replace(_registry(spark, ("1.1.1.1", "active", None, None)))
    assert table.replace(endpoints.retire(table.read(), NOW)) == 2
    assert rows(table.read(), "status") == [("retired",)]


def test_reports(spark, rows):
    registry = _registry(spark, *[(f"1.1.1.{n}", s, NOW, None) for n, s in enumerate(["retired", "active", "new", "active"])])
    assert [tuple(r) for r in health.status_counts(registry).collect()] == [("active", 2), ("retired", 1)]
    log = spark.createDataFrame(
        [("akshare" if n % 2 else "other", n, NOW + timedelta(seconds=random.Random(n).random())) for n in range(40)],
        "source STRING, n INT, timestamp TIMESTAMP_NTZ")
    latest = sorted(log.collect(), key=lambda r: r.timestamp)[-10:]
    expected = sorted((r.n,) for r in latest if r.source == "akshare")
    assert sorted(rows(health.recent_outcomes(log, ["akshare"]), "n")) == expected
    circuits = spark.createDataFrame(
        [(f"circuit:{s}:{n:02d}", "OPEN") for s in ("akshare", "akshare2") for n in range(12)], "key STRING, state STRING")
    states = rows(health.circuit_states(circuits, "akshare"), "endpoint_id", "source")
    assert states == [(f"{n:02d}", "akshare") for n in range(10)]


def test_health_and_outcomes(spark, rows):
    log = spark.createDataFrame(
        [("a", "x", 10, None), ("a", "x", 30, "E" * 80), ("b", "y", 20, None)],
        "source STRING, command STRING, elapsed_ms INT, error STRING")
    lines = health.health_lines(log)
    assert rows(lines, "outcome", "detail") == [("FAIL", "E" * 50), ("OK", None), ("OK", None)]
    assert rows(health.source_health(lines), "source", "ok", "failed", "slowest_ms") == [
        ("a", 1, 1, 30), ("b", 1, 0, 20), (None, 2, 1, 30)
    ]
    assert rows(health.frame_profile(log, ["source"]), "profile") == [("DataFrame(1r×3c)",), ("DataFrame(2r×3c)",)]
    tasks = spark.createDataFrame([(n, "a") for n in range(5)], "task INT, source STRING")
    written = spark.createDataFrame([(0, 1.0), (0, 2.0), (3, 1.0)], "task INT, value DOUBLE")
    assert rows(health.task_outcomes(tasks, written, ["task"])) == [("a", 2, 3)]
