import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankforge.functions import (date_text, epoch_to_timestamp, minutes_seconds, ms_to_seconds,
                                 normalize_time_fields, roundfloat, surrogate_key, to_title_case,
                                 trim_whitespace)


def one(spark, expr, value, dtype=None):
    df = spark.createDataFrame([(value,)], f"v {dtype or 'string'}")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("text,case,expected", [
    ("WhiteMage", "pascal", "White Mage"),
    ("aBcDEf", "Pascal ", "A Bc Def"),
    ("dark_knight__x", "snake", "Dark Knight X"),
    ("red-mage", " KEBAB", "Red Mage"),
])
def test_title_case(spark, text, case, expected):
    assert one(spark, lambda c: to_title_case(c, case), text) == expected


def test_title_case_rejects_unknown_style():
    with pytest.raises(ValueError):
        to_title_case(F.col("x"), "camel")


@pytest.mark.parametrize("text,expected", [
    (" a\r\n  b\tc  ", "a b c"),
    (" \n ", ""),
    (None, None),
])
def test_trim_whitespace(spark, text, expected):
    assert one(spark, trim_whitespace, text) == expected


def test_capitalise_then_trim_orders_differ(spark):
    df = spark.createDataFrame([("foo\nbar",)], "v string")
    row = df.select(trim_whitespace(F.initcap("v")).alias("enc"),
                    F.initcap(trim_whitespace("v")).alias("gld")).first()
    assert (row.enc, row.gld) == ("Foo bar", "Foo Bar")


def test_roundfloat_half_up_to_float(spark):
    df = spark.createDataFrame([(0.125,), (12453.674,), (0.004,)], "v double")
    out = [r.o for r in df.select(roundfloat("v", 2).alias("o")).collect()]
    assert out == pytest.approx([0.13, 12453.67, 0.0], rel=1e-6)
    assert dict(df.select(roundfloat("v").alias("o")).dtypes)["o"] == "float"


def test_ms_to_seconds_truncates(spark):
    df = spark.createDataFrame([(485999,), (900,), (None,)], "v int")
    assert [r.o for r in df.select(ms_to_seconds("v").alias("o")).collect()] == [485, 0, None]


def test_epoch_to_timestamp_units_and_truncation(spark):
    df = spark.createDataFrame([(1717200000999,), (-1500,)], "v bigint")
    out = [r.o for r in df.select(epoch_to_timestamp("v", "ms").alias("o")).collect()]
    assert out[0] == dt.datetime(2024, 6, 1, 0, 0, 0)
    assert out[1] == dt.datetime(1969, 12, 31, 23, 59, 59)
    s = spark.createDataFrame([(1717200000,)], "v bigint")
    assert s.select(epoch_to_timestamp("v", " S ").alias("o")).first().o == dt.datetime(2024, 6, 1)
    with pytest.raises(ValueError):
        epoch_to_timestamp(F.col("v"), "ns")


@pytest.mark.parametrize("secs,truncate,expected", [
    (485, True, "08:05"), (6000, True, "10:00"), (6000, False, "100:00"), (59, True, "00:59"),
])
def test_minutes_seconds(spark, secs, truncate, expected):
    assert one(spark, lambda c: minutes_seconds(c, truncate), secs, "int") == expected


def test_normalize_time_fields(spark):
    df = spark.createDataFrame([("2024-06-01 00:00:01", 5, "x")], "start_time string, end_time int, other string")
    row = normalize_time_fields(df).first()
    assert row.start_time == 1717200001000.0 and row.end_time == 5.0 and row.other == "x"


def test_surrogate_key_separates_null_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    keys = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert keys[0] == keys[2] and keys[0] != keys[1] and len(keys[0]) == 64
    clash = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("\\N", "c"), (None, "c")], "x string, y string")
    assert len({r.k for r in clash.select(surrogate_key("x", "y").alias("k")).collect()}) == 4


def test_date_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 6, 1, 23, 59, 59),)], "v timestamp")
    assert df.select(date_text("v").alias("o")).first().o == "2024-06-01"
