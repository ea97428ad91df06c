"""Gapless numbers for rows, group by group, in a stated order and without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwake.llm.common import durable


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with `place`, their number from 0 within the group by `order`, and `size`, the rows of the group.

    All rows are sorted by group and order over all tasks, so a large group fills many tasks; the rows of a group
    in one task are counted, and running sums of these counts (one number for each task and group that meet) give
    where each task begins. Rows equal in group and order are told apart by their place in a written copy, so one
    key may hold any share of the rows; which of them comes first is not defined. Nulls come first. Both copies
    are written, so a repeated task finds the same rows in the same places.
    """
    salted = durable(rows).withColumn("_salt", F.monotonically_increasing_id())
    laid = durable(salted.orderBy(group, *order, "_salt").drop("_salt"))
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the row's number within its task
    laid = laid.select("*", F.spark_partition_id().alias("_task"), inside.alias("_inside"))
    met = laid.groupBy(F.col(group).alias("_group"), F.col("_task").alias("_met")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_inside").alias("_first")
    )
    before = Window.partitionBy("_group").orderBy("_met").rowsBetween(Window.unboundedPreceding, -1)
    begins = met.select(
        "_group",
        "_met",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy("_group")).alias("size"),
    )
    return laid.join(begins, (F.col("_task") == F.col("_met")) & F.col(group).eqNullSafe(F.col("_group"))).select(
        *rows.columns, (F.col("_inside") + F.col("_shift")).alias("place"), "size"
    )
