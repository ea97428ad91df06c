"""Numbers found in a table of number ranges, both of any size.

Numbers and the beginnings of ranges are stacked and cut into contiguous buckets of the number line, as for running
totals. Within a bucket the range of a number is the last one that began before it; the last range of the earlier
buckets is handed on, one row per bucket. No row carries the ranges and no task sees all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .running import numeric_buckets


def counted_in_ranges(numbers: DataFrame, column: str, ranges: DataFrame) -> DataFrame:
    """(number, folded, n_rows) per distinct number: `folded` is the number less the first one of its range.

    `ranges` are rows of `first` and `size`; a number of no range stays whole. Of ranges that overlap the one that
    begins last counts, of those that begin alike the longest. Rows without a number are counted as one NULL.
    """
    rows = numbers.select(F.col(column).cast("bigint").alias("number"), F.lit(1).alias("_one"), F.lit(None).cast("bigint").alias("_size"))
    known = ranges.select(F.col("first").cast("bigint").alias("number"), F.lit(0).alias("_one"), F.col("size").cast("bigint").alias("_size"))
    stacked = rows.unionByName(known.na.drop(subset=["number", "_size"]))
    # As doubles, neighbours may share a place; the order within a bucket is that of the numbers.
    placed = numeric_buckets(stacked.withColumn("_place", F.coalesce(F.col("number").cast("double"), F.lit(-(2.0**63)))), "_place")
    counted = placed.groupBy("_bucket", "number").agg(F.sum("_one").alias("n_rows"), F.max("_size").alias("_size"))

    begins = F.when(F.col("_size").isNotNull(), F.struct(F.col("number").alias("first"), F.col("_size").alias("size")))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    handed_on = counted.groupBy("_bucket").agg(F.max(begins).alias("_last"))
    handed_on = handed_on.select(F.col("_bucket").alias("_own_bucket"), F.max("_last").over(earlier).alias("_handed_on"))
    so_far = Window.partitionBy("_bucket").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    found = counted.join(handed_on, F.col("_bucket") == F.col("_own_bucket")).withColumn("_begun", F.last(begins, ignorenulls=True).over(so_far))
    found = found.filter("n_rows > 0").withColumn("_range", F.coalesce("_begun", "_handed_on"))
    offset = F.col("number") - F.col("_range.first")
    folded = F.when(F.col("number").isNotNull() & (offset < F.col("_range.size")), offset).otherwise(F.col("number"))
    return found.select("number", folded.alias("folded"), "n_rows")
