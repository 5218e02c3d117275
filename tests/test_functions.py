import random
import struct
import urllib.parse

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from obsmill.functions import dates, text


def _spine(spark, start, end, frequency):
    frame = spark.createDataFrame([(start, end, frequency)], "s STRING, e STRING, f STRING")
    cols = F.col("s"), F.col("e"), F.col("f")
    row = frame.select(dates.date_spine(*cols), dates.spine_size(*cols)).first()
    assert len(row[0]) == row[1]
    return row[0]


@pytest.mark.parametrize("cadence,tag", [("monthly", "month"), ("yearly", "year"), ("hourly", "day"), ("", "day"), (None, "day")])
def test_cadence_without_a_tag_of_its_own(spark, cadence, tag):
    assert spark.range(1).select(dates.granularity_of(F.lit(cadence).cast("string"))).first()[0] == tag


def test_own_tag_wins_unless_empty(spark, rows):
    frame = spark.createDataFrame([("quarter", "daily"), ("", "yearly"), (None, "monthly")], "g STRING, f STRING")
    assert rows(frame, dates.granularity_tag(F.col("g"), F.col("f"))) == [("month",), ("quarter",), ("year",)]


def test_spine_across_a_leap_day_and_new_year(spark):
    assert _spine(spark, "2028-02-27", "2028-03-01", "daily") == ["2028-02-27", "2028-02-28", "2028-02-29", "2028-03-01"]
    assert _spine(spark, "2021-12-31", "2022-01-01", "weekly") == ["2021-12-31", "2022-01-01"]
    assert _spine(spark, "2022-02-10", "2021-11-20", "monthly") == ["2021-11-01", "2021-12-01", "2022-01-01", "2022-02-01"]
    assert _spine(spark, "1999-05-05", "2001-02-02", "yearly") == ["1999-12-31", "2000-12-31", "2001-12-31"]


def test_spine_edges(spark):
    assert _spine(spark, "2024-01-03", "2024-01-01", None) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert _spine(spark, "2024-03-15", "2024-06-30", "yearly") == ["2024-12-31"]
    assert _spine(spark, "2023-03-15", "2024-01-01", "yearly") == ["2023-12-31", "2024-12-31"]
    assert _spine(spark, "2024-03-15", "2024-04-10", "monthly") == ["2024-03-01", "2024-04-01"]
    assert _spine(spark, "2024-01-31", "2024-03-01", "monthly") == ["2024-01-01", "2024-02-01", "2024-03-01"]


def test_float_text_is_the_shortest_round_trip(spark):
    rng = random.Random(3)
    values = [0.0, -0.0, 1e7, 1e16, 1e-4, 9.99e-5, 0.1 + 0.2, 2e23, 123456789.125, float("inf"), float("-inf")]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 16) for _ in range(3000)]
    values += [rng.randint(1, 99) * 10.0 ** rng.randint(-30, 30) for _ in range(1000)]
    values += [x for x in (struct.unpack("d", rng.randbytes(8))[0] for _ in range(500)) if x == x and abs(x) > 1e-300]
    frame = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    got = [r[0] for r in frame.select(text.float_text(F.col("x"))).collect()]
    assert got == [repr(v) for v in values]


def test_other_value_texts(spark):
    frame = spark.createDataFrame([(True, 7, 0.1, "x", None)], "b BOOLEAN, i INT, f FLOAT, s STRING, n DOUBLE")
    got = frame.select(*[text.value_text(F.col(f.name), f.dataType) for f in frame.schema]).first()
    assert tuple(got) == ("True", "7", "0.1", "x", None)


@pytest.fixture(scope="module")
def encode(spark):
    def run(value):
        frame = spark.createDataFrame([(value,)], "x STRING")
        return tuple(frame.select(text.form_encode(F.col("x")), text.path_quote(F.col("x"))).first())

    return run


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(value=st.text(st.characters(codec="utf-8"), max_size=30))
def test_url_encoding(encode, value):
    assert encode(value) == (urllib.parse.quote_plus(value), urllib.parse.quote(value))


def test_url_encoding_of_special_characters(encode):
    value = " ~*+/&=%?#'()!.-_收盘"
    assert encode(value) == (urllib.parse.quote_plus(value), urllib.parse.quote(value))


def test_small_functions(spark):
    frame = spark.createDataFrame([("2024-01-31", " 1, 2,3", "600000", "000001", "")], "d STRING, l STRING, a STRING, b STRING, e STRING")
    got = frame.select(
        text.compact_date(F.col("d")), text.int_list(F.col("l")), text.market_symbol(F.col("a")),
        text.market_symbol(F.col("b")), text.truthy(F.col("e"), "day"),
        text.composite_key(F.lit(5), F.lit("akshare"), F.lit("annual_bs")),
        text.percentage(F.lit(1), F.lit(3)), text.percentage(F.lit(1), F.lit(0)), text.money(F.lit(2.5)),
        dates.days_inclusive(F.lit("2024-06-24"), F.lit("2024-06-28")),
    ).first()
    assert tuple(got) == (
        "20240131", [1, 2, 3], "600000.SS", "000001.SZ", "day", "5:akshare:annual_bs", 33.3, 0.0, "2.50", 5
    )


def test_json_number_text(spark, rows):
    frame = spark.createDataFrame([("1.0E7",), ("1.5",), ("1.0E-4",), ("2.0E16",), ("x",), (None,)], "v STRING")
    assert rows(frame, text.json_number_text(F.col("v"))) == [
        ("0.0001",), ("1.5",), ("10000000.0",), ("2e+16",), ("x",), (None,)
    ]
