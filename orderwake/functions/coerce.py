"""Lenient parsing and null-aware arithmetic, all as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Aging bucket labels and the last whole day that falls into each.
AGING_BUCKETS = (("0-7", 7), ("8-14", 14), ("15-30", 30))
AGING_OLDEST = "31+"

# Digits with an optional sign, decimal point and exponent. Spark's own cast also takes the
# Java suffixes "1d" and "5f" and the word "nan", which are not numbers in an extract. No part can begin with what the
# part before it takes, so all are possessive and nothing is tried twice.
NUMBER_PATTERN = r"^\s*+[+-]?+(?:\d++(?:\.\d*+)?+|\.\d++)(?:[eE][+-]?+\d++)?+\s*+$"


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def parse_number(text: Column) -> Column:
    """Double from text; anything that does not look like a number becomes NULL."""
    return finite_or_null(F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double")))


def finite_or_null(value: Column) -> Column:
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(~(F.isnan(value) | infinite), value)


def number(df: DataFrame, name: str) -> Column:
    """Column `name` as a finite double; unparsable, NaN and infinite values are NULL."""
    kind = type_of(df, name)
    if isinstance(kind, T.StringType):
        return parse_number(df[name])
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return finite_or_null(df[name].cast("double"))
    return df[name].cast("double")


def instant(df: DataFrame, name: str) -> Column:
    """Column `name` as a zone-less timestamp; unparsable text is NULL.

    A zone offset in the text is dropped and the wall-clock reading kept.
    """
    if isinstance(type_of(df, name), T.StringType):
        text = df[name]
        compact = F.when(text.rlike(r"^\s*\d{8}\s*$"), F.try_to_timestamp(F.trim(text), F.lit("yyyyMMdd")))
        return F.coalesce(text.try_cast("timestamp_ntz"), compact.cast("timestamp_ntz"))
    return df[name].cast("timestamp_ntz")


def at_least_zero(value: Column) -> Column:
    """Clip at zero. NULL stays NULL, which `greatest` would turn into zero."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def finite_or_zero(value: Column) -> Column:
    return F.coalesce(finite_or_null(value), F.lit(0.0))


def sum_or_zero(value: Column) -> Column:
    """Sum in which a group of nothing but NULLs adds up to zero."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def ratio(numerator: Column, denominator: Column, otherwise: Column | None = None) -> Column:
    """numerator / denominator where the denominator is positive, else `otherwise` (NULL)."""
    quotient = F.when(denominator > 0, numerator / denominator)
    return quotient if otherwise is None else quotient.otherwise(otherwise)


def week_start(moment: Column) -> Column:
    """The Monday of the week as `yyyy-MM-dd` text (independent of the session time zone)."""
    return F.trunc(moment.cast("date"), "week").cast("string")


def whole_days(since: Column, until: Column) -> Column:
    """Days from `since` to `until`, floored: minus half a day is -1, not 0."""
    elapsed = until - since
    days = F.extract(F.lit("DAY"), elapsed)
    short = elapsed < F.make_dt_interval(days=days)
    return (days - F.when(short, 1).otherwise(0)).cast("double")


def aging_bucket(days: Column) -> Column:
    """Aging label; empty for unknown or future dates."""
    label = F.when(days.isNull() | (days < 0), F.lit(""))
    for name, last_day in AGING_BUCKETS:
        label = label.when(days <= last_day, F.lit(name))
    return label.otherwise(F.lit(AGING_OLDEST))
