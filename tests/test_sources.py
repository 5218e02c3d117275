import json

import pytest
from pyspark.sql import functions as F, types as T

from obsmill import schemas
from obsmill.operators.joins import salted_join
from obsmill.sinks import paths
from obsmill.sources import landed

FRAME = T.StructType([T.StructField("日期", T.StringType()), T.StructField("close", T.DoubleType())])


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_frames_in_every_format(spark, tmp_path, rows, fmt):
    path = f"{tmp_path}/frame"
    frame = spark.createDataFrame([("2024-01-02", 1.5), ("2024-01-03", None)], FRAME)
    frame.write.format(fmt).option("header", True).save(path)
    got = landed.read_frames(spark, path, FRAME, fmt, header=True)
    assert got.schema == FRAME and rows(got) == rows(frame)


def test_responses_as_json_lines(spark, tmp_path):
    lines = [{"source": "akshare", "date": None, "status": 200, "body": '{"2024-01-02": 1.5}'}, {"status": 204}]
    (tmp_path / "r.json").write_text("\n".join(json.dumps(line) for line in lines), encoding="utf-8")
    got = landed.read_responses(spark, str(tmp_path))
    assert got.schema == schemas.RESPONSE
    assert [(r.status, r.body) for r in got.orderBy("status").collect()] == [(200, '{"2024-01-02": 1.5}'), (204, None)]


def test_plan_lines_keep_their_ids(spark, tmp_path, rows):
    lines = [{"plan_id": n, "mode": "series", "wanted_concepts": [{"concept_id": n}]} for n in (1, 2)]
    (tmp_path / "p.json").write_text("\n".join(json.dumps(line) for line in lines), encoding="utf-8")
    assert rows(landed.read_plan_lines(spark, str(tmp_path)), "plan_id", "wanted_concepts.concept_id") == [(1, [1]), (2, [2])]


def test_identifier_scan_pushes_both_predicates(spark, tmp_path, rows):
    ids = [("akshare", "stock", 1, "600000"), ("akshare", "fund", 2, "110011"), ("yfinance", "stock", 1, "X")]
    spark.createDataFrame(ids, schemas.IDENTIFIERS).write.parquet(f"{tmp_path}/ids")
    scan = landed.scan_identifiers(landed.read_identifiers(spark, f"{tmp_path}/ids"), "akshare", "stock")
    assert rows(scan, "entity_id", "identifier") == [(1, "600000")]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source,akshare)" in plan and "EqualTo(entity_type,stock)" in plan


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_salted_join_equals_the_plain_join(spark, threshold):
    big = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (0, "b"), (5, "c"), (99, "d")], "k BIGINT, w STRING")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for how in ("inner", "left", "left_semi", "left_anti"):
            salted, plain = salted_join(big, small, ["k"], ["v"], how), big.join(small, "k", how)
            assert salted.columns == plain.columns
            assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_salted_join_repeats_and_broadcasts_within_bounds_only(spark):
    big = spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    small = spark.range(40).select((F.col("id") % 3).alias("k"), F.col("id").alias("w"))
    plain = big.join(small, "k")
    for bound in (40, 39):
        joined = salted_join(big, small, ["k"], ["v"], broadcast_rows=bound)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (bound == 40)
        assert joined.count() == plain.count() and joined.exceptAll(plain).isEmpty()


def test_written_tables_go_to_the_shared_folder(spark):
    frame = paths.written(spark.range(5), "numbers")
    assert frame.count() == 5
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in frame.inputFiles())
