"""Scalar functions on literal values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderwake.functions import coerce, keys
from orderwake.functions import (
    aging_bucket,
    at_least_zero,
    canonical_document,
    canonical_item,
    canonical_key,
    finite_or_zero,
    instant,
    number,
    ratio,
    text_key,
    week_start,
    whole_days,
)
from orderwake.functions.keys import DOCUMENT_MODULUS


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(expression(df).alias("x"), "i").orderBy("i").collect()]


def test_canonical_document_folds_notations_and_the_leading_range(spark):
    values = ["4500000051", "51", " 51 ", "51.0", "0000000051", "abc", None, "1d", "nan", "inf", ""]
    expected = ["51", "51", "51", "51", "51", "", "", "", "", "", ""]
    assert column(spark, values, "string", lambda d: canonical_document(d.v)) == expected


def test_canonical_document_keeps_numbers_outside_the_ranges_whole(spark):
    values = ["-5", "100000051", "4600000000", "4599999999"]
    assert column(spark, values, "string", lambda d: canonical_document(d.v)) == ["-5", "100000051", "4600000000", "99999999"]
    assert column(spark, values, "string", lambda d: canonical_document(d.v, DOCUMENT_MODULUS)) == ["99999995", "51", "0", "99999999"]


def test_canonical_item(spark):
    values = ["000010", "10", "10.0", "1e1", "x", None, "99999999999999999999999"]
    assert column(spark, values, "string", lambda d: canonical_item(d.v)) == ["10", "10", "10", "10", "", "", ""]


def test_text_key_strips_every_kind_of_space(spark):
    values = [" a ", "\tb\n", " c　", "d e", None, " é "]
    assert column(spark, values, "string", lambda d: text_key(d.v)) == ["a", "b", "c", "d e", "", "é"]


def test_canonical_key_repairs_damaged_keys(spark):
    values = ["0001", "1.0", "1", "1000.0", "000", "A01", None]
    expected = ["1", "1", "1", "1000", "0", "A01", None]
    assert column(spark, values, "string", lambda d: canonical_key(d.v)) == expected


def test_number_takes_plain_numbers_only(spark):
    values = [" 7 ", "1e3", "-2.5", ".5", "5.", "1d", "5f", "1,000", "nan", "inf", "", None]
    expected = [7.0, 1000.0, -2.5, 0.5, 5.0, None, None, None, None, None, None, None]
    assert column(spark, values, "string", lambda d: number(d, "v")) == expected


def test_number_treats_nan_and_infinity_as_missing(spark):
    values = [1.5, float("nan"), float("inf"), float("-inf"), None]
    assert column(spark, values, "double", lambda d: number(d, "v")) == [1.5, None, None, None, None]
    assert column(spark, values, "double", lambda d: finite_or_zero(d.v)) == [1.5, 0.0, 0.0, 0.0, 0.0]


def test_instant_reads_dates_and_drops_the_zone(spark):
    values = ["2020-01-31", "2020-01-31 10:30:00", "2020-01-31 10:30:00+02:00", "20200131", "00000000", "x", None]
    day, moment = dt.datetime(2020, 1, 31), dt.datetime(2020, 1, 31, 10, 30)
    assert column(spark, values, "string", lambda d: instant(d, "v")) == [day, moment, moment, day, None, None, None]


def test_at_least_zero_keeps_null(spark):
    assert column(spark, [-1.0, 2.0, None], "double", lambda d: at_least_zero(d.v)) == [0.0, 2.0, None]


def test_ratio_guards_the_denominator(spark):
    assert column(spark, [4.0, 0.0, -1.0, None], "double", lambda d: ratio(F.lit(2.0), d.v)) == [0.5, None, None, None]
    assert column(spark, [0.0], "double", lambda d: ratio(F.lit(2.0), d.v, F.lit(0.0))) == [0.0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_weeks_start_on_monday_in_any_session_zone(spark, zone):
    values = [dt.datetime(2024, 1, 7, 23, 59, 59, 999999), dt.datetime(2024, 1, 8), dt.datetime(2024, 3, 10, 2, 30)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        weeks = column(spark, values, "timestamp_ntz", lambda d: week_start(d.v))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert weeks == ["2024-01-01", "2024-01-08", "2024-03-04"]


def test_whole_days_floor(spark):
    today = F.lit(dt.datetime(2024, 5, 10)).cast("timestamp_ntz")
    values = [
        dt.datetime(2024, 5, 10, 12),
        dt.datetime(2024, 5, 10),
        dt.datetime(2024, 5, 9, 12),
        dt.datetime(2024, 5, 12),
        dt.datetime(2024, 5, 11, 0, 0, 1),
        None,
    ]
    assert column(spark, values, "timestamp_ntz", lambda d: whole_days(d.v, today)) == [-1, 0, 0, -2, -2, None]


def test_aging_bucket_borders(spark):
    values = [None, -1.0, 0.0, 7.0, 8.0, 14.0, 15.0, 30.0, 31.0]
    expected = ["", "", "0-7", "0-7", "8-14", "8-14", "15-30", "15-30", "31+"]
    assert column(spark, values, "double", lambda d: aging_bucket(d.v)) == expected


def test_possessive_number_pattern_reads_what_the_plain_one_reads(spark):
    plain = r"^\s*[+-]?(?=\.?\d)\d*\.?\d*([eE][+-]?\d+)?\s*$"
    parts = ("", " ", "\n", "+", "-", ".", "5", "51", "e", "E3", "e-3", "d", "\u3000", "\x85", "\x00")
    texts = [(a + b + c + d,) for a in parts for b in parts for c in parts for d in parts]
    df = spark.createDataFrame(texts, "text string").repartition(8)
    assert df.filter(F.col("text").rlike(plain) != F.col("text").rlike(coerce.NUMBER_PATTERN)).count() == 0
    stripped = F.coalesce(
        keys.strip_space(F.col("text")).try_cast("bigint"),
        F.when(F.col("text").rlike(plain), F.col("text").try_cast("double")).try_cast("bigint"),
    )
    assert df.filter(~stripped.eqNullSafe(keys.whole_number(F.col("text")))).count() == 0
