"""Key cleaning: whitespace, document numbers and item numbers that differ only in notation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .coerce import NUMBER_PATTERN

# Spark's one-argument trim removes the space character only; extracts also carry tabs, line ends
# and the Unicode spaces.
ASCII_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
UNICODE_SPACE = (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Number ranges (first number, size) whose documents refer to order n by first number + n.
DOCUMENT_RANGES = ((4_500_000_000, 100_000_000),)
# Most ranges that a table of them may hold: 16 bytes each.
MOST_RANGES = 100_000
# The classic rule instead: numbers that agree in their last eight digits refer to the same order.
# It confuses orders as soon as there are more than that.
DOCUMENT_MODULUS = 100_000_000


def strip_space(text: Column) -> Column:
    # Most keys are plain ASCII, for which the short list of characters is enough and faster.
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.btrim(text, F.lit(ASCII_SPACE))).otherwise(F.btrim(text, F.lit(ASCII_SPACE + UNICODE_SPACE)))


def text_key(column: Column) -> Column:
    """Key as trimmed text; a missing key is the empty string, so it joins with `=`."""
    return F.coalesce(strip_space(column.cast("string")), F.lit(""))


def whole_number(column: Column) -> Column:
    """A number as a bigint; text that is no number, or too large, is NULL."""
    text = column.cast("string")
    # Plain digits are read exactly; "51.0" and "1e3" go through double. Overflow gives NULL.
    lenient = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    # The cast ignores ASCII space itself, so only what it does not read is stripped, which costs more than the cast.
    return F.coalesce(text.try_cast("bigint"), strip_space(text).try_cast("bigint"), lenient.try_cast("bigint"))


def folded_document(number: Column, modulus: int | None = None, ranges: Column | None = None) -> Column:
    """Document number as text, '' for none. The number is used several times, so it should be a column of its own."""
    if modulus is not None:
        folded = F.pmod(number, F.lit(modulus))
    elif ranges is not None:
        folded = within_range(number, ranges)
    else:
        folded = number
        for first, size in DOCUMENT_RANGES:
            folded = F.when(number.between(first, first + size - 1), number - first).otherwise(folded)
    return F.coalesce(folded.cast("string"), F.lit(""))


def canonical_document(column: Column, modulus: int | None = None, ranges: Column | None = None) -> Column:
    """4500000051, '51' and ' 51.0 ' all become '51'; text that is no number becomes ''.

    Numbers outside the declared ranges stay whole, unless a modulus is given (DOCUMENT_MODULUS). `ranges`
    (a column with a `range_table`) takes the place of the declared ranges.
    """
    return folded_document(whole_number(column), modulus, ranges)


def canonical_item(column: Column) -> Column:
    """'000010', '10' and '10.0' all become '10'; text that is no number becomes ''."""
    return F.coalesce(whole_number(column).cast("string"), F.lit(""))


def range_table(ranges: DataFrame) -> Column:
    """Number ranges (rows of `first`, `size`) as one sorted array, to be a column that `within_range` looks into.

    The array is computed once when a query runs and its length does not change the plan. MOST_RANGES bounds it: a
    larger table is an error when it is read.
    """
    listed = F.array_sort(F.collect_list(F.struct(F.col("first").cast("bigint").alias("first"), F.col("size").cast("bigint").alias("size"))))
    too_many = F.raise_error(F.lit(f"more than {MOST_RANGES} number ranges")).cast("array<struct<first:bigint,size:bigint>>")
    return ranges.na.drop(subset=["first", "size"]).agg(F.when(F.count(F.lit(1)) <= MOST_RANGES, listed).otherwise(too_many)).scalar()


def within_range(number: Column, ranges: Column) -> Column:
    """A number less the first one of its range; a number of no range stays whole.

    Binary search: the steps halve, and each is taken if the range it leads to begins at or below the number. Of
    ranges that overlap the one that begins last counts.
    """
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(MOST_RANGES.bit_length()))))

    def offset(value: Column) -> Column:
        def nearer(place: Column, step: Column) -> Column:
            ahead = F.get(ranges, place + step)["first"]
            return F.when(ahead <= value, place + step).otherwise(place)

        found = F.get(ranges, F.aggregate(steps, F.lit(-1), nearer))
        return F.when(value - found["first"] < found["size"], value - found["first"]).otherwise(value)

    # Bound to a name by the lambda, so that the number is not parsed again in every step.
    return F.get(F.transform(F.array(number), offset), 0)


def canonical_key(column: Column) -> Column:
    """Undo damage by type inference: drop a trailing '.0' and leading zeros of all-digit keys."""
    text = strip_space(column.cast("string"))
    digits = F.regexp_extract(text, r"^0*(\d+?)(?:\.0+)?$", 1)
    return F.when(digits != "", digits).otherwise(text)
