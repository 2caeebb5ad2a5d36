import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.casts import (
    amount_from_text,
    date_from_text,
    id_from_text,
    timestamp_from_text,
    to_text,
)

INT, MONEY = T.IntegerType(), T.DecimalType(15, 2)


def one(spark, value, make, kind="string"):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(make(F.col("v")).alias("out")).first()["out"]


@pytest.mark.parametrize("text, want", [("17.0", 17), ("100.0", 100), ("17", 17), ("-3.0", -3), (None, None)])
def test_id(spark, text, want):
    assert one(spark, text, lambda c: id_from_text(c, INT)) == want


@pytest.mark.parametrize("text", ["abc", "1.05", "3000000000"])
def test_bad_id(spark, text):
    with pytest.raises(Exception, match="CAST"):
        one(spark, text, lambda c: id_from_text(c, INT))
    assert one(spark, text, lambda c: id_from_text(c, INT, "null")) is None


def test_wide_id(spark):
    assert one(spark, "3000000000.0", lambda c: id_from_text(c, T.LongType())) == 3_000_000_000


@pytest.mark.parametrize("on_bad", ["error", "null"])
@pytest.mark.parametrize(
    "text, want",
    [
        ("2025-03-01 12:34:56.789012", dt.datetime(2025, 3, 1, 12, 34, 56)),
        ("2025-03-01 12:34:56", dt.datetime(2025, 3, 1, 12, 34, 56)),
        ("1700-05-03 00:00:00", dt.datetime(1700, 5, 3)),
    ],
)
def test_timestamp(spark, on_bad, text, want):
    assert one(spark, text, lambda c: timestamp_from_text(c, on_bad)) == want


def test_bad_timestamp(spark):
    with pytest.raises(Exception, match="PARSE"):
        one(spark, "yesterday", timestamp_from_text)
    for text in ("yesterday", "2025-13-01 00:00:00"):
        assert one(spark, text, lambda c: timestamp_from_text(c, "null")) is None


def test_date(spark):
    assert one(spark, "1990-07-09", date_from_text) == dt.date(1990, 7, 9)
    assert one(spark, "1990-07-09", lambda c: date_from_text(c, "null")) == dt.date(1990, 7, 9)
    assert one(spark, "09.07.1990", lambda c: date_from_text(c, "null")) is None


@pytest.mark.parametrize("text, want", [("12345.675", "12345.68"), ("0.005", "0.01"), ("1.2345E7", "12345000.00")])
def test_amount_rounds_half_up(spark, text, want):
    assert one(spark, text, lambda c: amount_from_text(c, MONEY)) == Decimal(want)


def test_amount_overflow(spark):
    with pytest.raises(Exception):
        one(spark, "1" * 14 + ".00", lambda c: amount_from_text(c, MONEY))
    assert one(spark, "1" * 14, lambda c: amount_from_text(c, MONEY, "null")) is None


@pytest.mark.parametrize(
    "value, want",
    [(17.0, "17.0"), (1e7, "10000000.0"), (123456789012.0, "123456789012.0"), (5.25, "5.25"), (float("nan"), None)],
)
def test_double_text(spark, value, want):
    assert one(spark, value, lambda c: to_text(c, T.DoubleType()), "double") == want


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="on_bad"):
        id_from_text(F.lit("1"), INT, "skip")


def test_text_of_doubles_follows_one_rule(spark):
    values = [0.0, -0.0, 1.5, 17.0, 1e7, 12345678.5, -98765432.25, 1e15, 123456789012345.6, 1e16, 1.5e16, 1e100, 0.001, 0.0001, 1.25e-4, 1e-5, -3.5e-12]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", to_text(F.col("v"), T.DoubleType()).alias("text")).collect()
    assert [r["text"] for r in rows] == [str(v) for v in values]
