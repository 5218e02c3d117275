import pytest
from pyspark.sql import functions as F

from obsmill.functions.text import value_text
from obsmill.operators import statements
from obsmill.schemas import KEY

NAN = float("nan")


@pytest.fixture
def wide(spark):
    return spark.createDataFrame(
        [(1, "annual_bs", "2024-12-31 00:00:00", "", "000001", 1.5, "nan", 7),
         (1, "quarterly_bs", "2024-09-30", "600000.SH", "600000", NAN, "NAN", None),
         (2, "annual_bs", None, None, "x", 1.0, "1", 1), (2, "annual_bs", "", None, "x", 1.0, "1", 1),
         (2, "balance_sheet", "2024-12-31", None, "x", 1.0, "1", 1)],
        "entity_id BIGINT, function_name STRING, REPORT_DATE STRING, SECUCODE STRING, SECURITY_CODE STRING,"
        " TOTAL_ASSETS DOUBLE, TOTAL_LIABILITIES STRING, TOTAL_EQUITY INT")


BALANCE = [
    (1, "2024-09-30", 243, "NAN"), (1, "2024-12-31", 242, "1.5"), (1, "2024-12-31", 244, "7")
]


def test_wide_statements(wide, rows):
    assert rows(statements.parse_wide(wide, ["entity_id"]), "entity_id", "date", "concept_id", "value") == BALANCE


def test_melting_and_mapping_apart_gives_the_same(spark, wide, rows):
    tagged = wide.withColumn("source", F.lit("akshare"))
    fields = ["TOTAL_ASSETS", "TOTAL_LIABILITIES", "TOTAL_EQUITY", "NETPROFIT"]
    melted = statements.melt_wide(tagged, ["entity_id", "source", "function_name"], fields)
    assert melted.count() == 6
    mapped = statements.map_concepts(melted, statements.concept_map(spark))
    assert rows(mapped, "entity_id", "date", "concept_id", "value") == BALANCE


def test_transposed_statements(spark, rows):
    frame = spark.createDataFrame(
        [(1, "annual_is", "Total Revenue", 1e7, NAN), (1, "annual_is", "Net Income", None, 2.0),
         (1, "annual_is", "Total Assets", 1.0, 1.0)],
        "entity_id BIGINT, function_name STRING, field STRING, `2024-12-31 00:00:00` DOUBLE, `2023-12-31` DOUBLE")
    parsed = statements.parse_transposed(frame, ["entity_id"], ["2024-12-31 00:00:00", "2023-12-31"])
    assert rows(parsed, "date", "concept_id", "value") == [
        ("2023-12-31", 240, "2.0"), ("2024-12-31", 239, "10000000.0")
    ]


def test_mapping_has_six_functions_per_source(spark, rows):
    counts = statements.concept_map(spark).groupBy("source").agg(F.countDistinct("function_name"), F.count("*"))
    assert rows(counts) == [("akshare", 6, 12), ("yfinance", 6, 12)]


def test_entity_code(wide, rows):
    codes = wide.limit(2).select(statements.entity_code(wide).alias("code"))
    assert rows(codes) == [("000001",), ("600000.SH",)]


def test_legacy_constants(wide, rows):
    legacy = statements.legacy_rows(statements.parse_wide(wide, ["entity_id"]))
    assert rows(legacy.select("entity_type", "granularity", "unit", "source_used").distinct()) == [
        ("stock", "day", "currency", "akshare")
    ]
    assert set(KEY) <= set(legacy.columns)


def test_migration(spark, rows):
    table = spark.createDataFrame(
        [(1, "000001", "2024-01-03", 1.5), (1, "000001", "2024-01-02", 1.4), (2, "600000", "2024-01-02", None)],
        "entity_id BIGINT, symbol STRING, date STRING, close DOUBLE")
    assert statements.migrate_legacy(table, "astock").count() == 2
    assert statements.migrate_legacy(table, "astock-hk", symbol="600000").isEmpty()
    first = statements.migrate_legacy(table, "astock-us", limit=1)
    assert rows(first, "entity_id", "concept_id", "date", "value") == [(1, 234, "2024-01-02", "1.4")]
    with pytest.raises(KeyError):
        statements.migrate_legacy(table, "other")


def test_values_become_text_once(spark):
    """Fields of one type share one conversion to text, after they unfold."""
    frame = spark.createDataFrame(
        [(1, "annual_bs", "2024-03-31", 1e20, float("nan"), "nan"), (2, "annual_bs", "2024-03-31", 0.1, None, "7")],
        "entity_id LONG, function_name STRING, REPORT_DATE STRING, TOTAL_ASSETS DOUBLE, TOTAL_LIABILITIES DOUBLE, TOTAL_EQUITY STRING",
    )
    parsed = statements.parse_wide(frame, ["entity_id"])
    found = {(r["entity_id"], r["field"], r["value"]) for r in parsed.collect()}
    assert found == {(1, "TOTAL_ASSETS", "1e+20"), (2, "TOTAL_ASSETS", "0.1"), (2, "TOTAL_EQUITY", "7")}
    plan = lambda rows: rows._jdf.queryExecution().optimizedPlan().toString()
    one = frame.select(value_text(F.col("TOTAL_ASSETS"), frame.schema["TOTAL_ASSETS"].dataType).alias("value"))
    assert plan(parsed).count("format_string") == plan(one).count("format_string") > 0
