"""Risk labels on order lines and on stock rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import number
from ..operators import hot_keys, lookup_join
from .metrics import SERIES

OVERSTOCK_WEEKS = 26.0


def order_targets(order_metrics: DataFrame) -> DataFrame:
    """target_backorder_risk: 1 where backorder_units > 0; 0 where unknown or the column is absent."""
    units = number(order_metrics, "backorder_units") if "backorder_units" in order_metrics.columns else F.lit(0.0)
    return order_metrics.withColumn("target_backorder_risk", (F.coalesce(units, F.lit(0.0)) > 0).cast("int"))


def inventory_targets(
    inventory: DataFrame, coverage: DataFrame, overstock_woc_threshold_weeks: float = OVERSTOCK_WEEKS
) -> DataFrame:
    """target_overstock_risk: 1 where there is demand and coverage exceeds the threshold."""
    inventory, coverage = _text_series(inventory), _text_series(coverage)
    hot = hot_keys(inventory, series=SERIES)["series"]
    spread = [c for c in ("storage_location", "unrestricted_stock") if c in inventory.columns]
    rows = lookup_join(
        inventory, coverage.select(*SERIES, "woc", "awd"), SERIES, hot, spread, null_safe=True
    )
    overstocked = (number(rows, "awd") > 0) & (F.col("woc") > overstock_woc_threshold_weeks)
    return rows.withColumn("target_overstock_risk", F.coalesce(overstocked, F.lit(False)).cast("int"))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Rows and share in percent per class."""
    counts = df.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.select("label", "n_rows", F.round(F.col("n_rows") * 100.0 / total, 6).alias("pct"))


def _text_series(df: DataFrame) -> DataFrame:
    text = {c: F.col(c).cast("string") for c in SERIES}
    return df.withColumns({**text, "plant_code": F.coalesce(text["plant_code"], F.lit(""))})
