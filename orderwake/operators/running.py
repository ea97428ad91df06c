"""Running totals over a whole table without passing it through one task.

The rows are cut into contiguous buckets of the ordering column. Totals per bucket are few (one
row per bucket) and are accumulated in one small window; rows are accumulated inside their own
bucket; the sum of both is the running total. Buckets only decide where the work happens: any
monotone bucketing gives the same result.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


LEAST_BUCKETS = 256


def numeric_buckets(df: DataFrame, column: str, bucket: str = "_bucket", buckets: int | None = None) -> DataFrame:
    """Add a bucket number that grows with `column`, cut at approximate quantiles.

    By default there are at least as many buckets as shuffle partitions. The cut points are fetched
    once, so every use of the returned frame sees the same cuts even if a task is run again.
    """
    buckets = buckets or max(LEAST_BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    wanted = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(column, wanted, 10 * buckets).alias("cuts")).first()["cuts"] or []
    cuts = [float("-inf"), *sorted(set(found)), float("inf")]
    if len(cuts) < 3:
        return df.withColumn(bucket, F.lit(0.0))
    return Bucketizer(splits=cuts, inputCol=column, outputCol=bucket).transform(df)


def running_totals(
    df: DataFrame,
    order_by: str,
    totals: dict[str, str],
    bucket: str = "_bucket",
    descending: bool = False,
) -> DataFrame:
    """Add running totals in the order of `order_by`, which must be unique.

    `totals` maps each new column to the column it accumulates. `bucket` must grow with `order_by`.
    """
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    per_bucket = df.groupBy(bucket).agg(*(F.sum(source).alias(f"_all_{name}") for name, source in totals.items()))
    earlier = Window.orderBy(direction(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        F.col(bucket).alias("_offset_bucket"),
        *(F.coalesce(F.sum(f"_all_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in totals),
    )
    so_far = Window.partitionBy(bucket).orderBy(direction(order_by)).rowsBetween(Window.unboundedPreceding, 0)
    # Not hinted: if the offsets are too many to broadcast, the join shuffles by bucket, which the
    # window needs anyway.
    placed = df.join(offsets, F.col(bucket) == F.col("_offset_bucket"))
    for name, source in totals.items():
        placed = placed.withColumn(name, F.sum(source).over(so_far) + F.col(f"_before_{name}"))
    return placed.drop("_offset_bucket", bucket, *(f"_before_{name}" for name in totals))


def string_buckets(df: DataFrame, column: str, bucket: str = "_bucket", buckets: int | None = None) -> DataFrame:
    """Add a bucket number that grows with a text column of distinct values.

    The cuts are values picked by their hash, a few per bucket, so that buckets hold about as many
    values each however alike their beginnings are. Any cuts give the same running totals.
    """
    buckets = buckets or max(LEAST_BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    values = df.filter(F.col(column).isNotNull()).select(column)
    every = max(1, values.count() // (4 * buckets))
    picked = sorted(r[0] for r in values.filter(F.pmod(F.xxhash64(column), F.lit(every)) == 0).collect())
    cuts = picked[:: max(1, len(picked) // buckets)]
    below = F.filter(F.array(*map(F.lit, cuts)).cast("array<string>"), lambda cut: cut <= F.col(column))
    return df.withColumn(bucket, F.size(below))
