"""One row per key, chosen by a stated total order.

Rows have no order of their own in Spark, so "the first row" is always spelled out: by the record
timestamp where there is one, then by every remaining column, NULLs last. A filter on
`row_number() = 1` lets Spark keep one row per key in each map task before the shuffle
(WindowGroupLimit), so a key that holds a third of the table still sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RECORD_TIMESTAMP = "record_timestamp"


def _top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    within_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(within_key)).filter("_place = 1").drop("_place")


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per key; NULL keys form groups of their own."""
    if not order_by and RECORD_TIMESTAMP in df.columns:
        order_by = [RECORD_TIMESTAMP]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    order = [F.col(c).asc_nulls_last() for c in [*order_by, *rest]]
    return _top_row(df, keys, order or [F.lit(1)])


def newest_image(df: DataFrame, keys: Sequence[str], recorded: str = RECORD_TIMESTAMP) -> DataFrame:
    """The newest image per key, deletions included; of images recorded at one time the least by the other columns."""
    rest = [c for c in df.columns if c not in keys and c != recorded]
    return _top_row(df, keys, [F.col(recorded).desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in rest)])


def is_deletion(deleted: str = "is_deleted") -> Column:
    return F.coalesce(F.lower(F.col(deleted).cast("string")).isin("true", "1", "x"), F.lit(False))


def latest_image(
    df: DataFrame,
    keys: Sequence[str],
    recorded: str = RECORD_TIMESTAMP,
    deleted: str = "is_deleted",
) -> DataFrame:
    """Resolve a change log: the newest image per key, and no row where that image is a deletion."""
    newest = newest_image(df, keys, recorded)
    return newest.filter(~is_deletion(deleted)) if deleted in df.columns else newest


def duplicate_rows(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """How many rows repeat a key already seen; NULL keys count as equal to each other."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    surplus = F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).cast("bigint")
    return per_key.agg(F.lit(label).alias("table_name"), surplus.alias("duplicate_rows"))
