"""Data discovery: missing values, ranges, duplicates, outliers, consistency across tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import at_least_zero, folded_document, instant, number, range_table, text_key, whole_number
from ..operators import duplicate_rows, quantiles
from .masters import ORDER_GRAIN

# What identifies a row of the masters.
INVENTORY_KEY = ["client_id", "material_number", "plant_code", "storage_location"]
PURCHASE_KEY = ["client_id", "purchase_order_number", "purchase_order_item_number"]
DESCRIBED_AT_ONCE = 8

# The quantiles and columns that the outlier report shows.
OUTLIER_QUANTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
OUTLIER_COLUMNS = ["cumulative_order_quantity", "total_delivery_quantity", "net_value"]


def missing_summary(df: DataFrame, blank_is_missing: bool = True) -> DataFrame:
    """Count and percentage per column with missing values, most first; one pass over the table.

    Blank text counts as missing by default, as it does once a table has been through CSV.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(_is_missing(df, c, blank_is_missing)).alias(c) for c in df.columns),
    )
    rows = counts.unpivot("_rows", df.columns, "column_name", "n_missing").filter("n_missing > 0")
    pct = F.round(F.col("n_missing") * 100.0 / F.col("_rows"), 1)
    return rows.select("column_name", "n_missing", pct.alias("pct")).orderBy(F.desc("n_missing"), "column_name")


def _is_missing(df: DataFrame, name: str, blank_is_missing: bool) -> Column:
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(name)
    if blank_is_missing and isinstance(df.schema[name].dataType, T.StringType):
        missing = missing | (F.col(name) == "")
    return missing


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max, one row per numeric column."""
    columns = list(columns or numeric_columns(df))
    # One wide row per group of columns, so that no row is copied; groups keep the generated code small.
    parts = [_moments(df, columns[i : i + DESCRIBED_AT_ONCE]) for i in range(0, len(columns), DESCRIBED_AT_ONCE)]
    moments = reduce(DataFrame.unionByName, parts)
    quartiles = quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("column_name").agg(
        *(F.max(F.when(F.col("probability") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in (0.25, 0.5, 0.75))
    )
    # Both sides hold one row per column of the table.
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", "p25", "p50", "p75", "max", "skew"
    )


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = df.select(*(number(df, c).alias(c) for c in columns))
    rows = (
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
            _unbiased_skew(F.col(c)).alias("skew"),
        )
        for c in columns
    )
    return values.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _unbiased_skew(value: Column) -> Column:
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def order_summary_stats(orders: DataFrame) -> DataFrame:
    """Distribution of ordered, delivered and missing quantity and of net value per order line."""
    ordered = F.coalesce(number(orders, "cumulative_order_quantity"), F.lit(0.0))
    delivered = F.coalesce(number(orders, "total_quantity_delivered"), F.lit(0.0))
    measures = orders.select(
        ordered.alias("order_qty"),
        delivered.alias("delivered_qty"),
        at_least_zero(ordered - delivered).alias("shortfall"),
        number(orders, "net_value").alias("net_value"),
    )
    return describe(measures)


def outlier_quantiles(orders: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS) -> DataFrame:
    """Percentiles of the key quantities, one row per column and probability."""
    columns = [c for c in columns if c in orders.columns]
    return quantiles(orders, columns, OUTLIER_QUANTILES)


def winsorize(df: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS, upper: float = 0.99) -> DataFrame:
    """Cap each column at its own upper quantile; missing values stay missing."""
    columns = [c for c in columns if c in df.columns]
    caps = quantiles(df, columns, [upper]).agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "value")))  # one entry per column
    ).scalar()
    capped = {c: F.when(number(df, c).isNotNull(), F.least(number(df, c), F.try_element_at(caps, F.lit(c)))) for c in columns}
    return df.withColumns(capped)


def validity_checks(orders: DataFrame, inventory: DataFrame, today: dt.date) -> DataFrame:
    """Negative quantities, future order dates and negative stock, as (check_name, n_rows)."""
    in_future = instant(orders, "order_date") > F.lit(dt.datetime.combine(today, dt.time())).cast("timestamp_ntz")
    order_checks = orders.agg(
        F.count_if(number(orders, "cumulative_order_quantity") < 0).alias("negative_order_quantity"),
        F.count_if(number(orders, "total_delivery_quantity") < 0).alias("negative_delivery_quantity"),
        F.count_if(in_future).alias("future_order_date"),
    )
    stock_checks = inventory.agg(F.count_if(number(inventory, "unrestricted_stock") < 0).alias("negative_stock"))
    as_rows = [c.unpivot([], c.columns, "check_name", "n_rows") for c in (order_checks, stock_checks)]
    return as_rows[0].unionByName(as_rows[1])


def duplicate_checks(orders: DataFrame, inventory: DataFrame, purchase: DataFrame) -> DataFrame:
    """Rows per master that repeat an earlier key."""
    return (
        duplicate_rows(orders, ORDER_GRAIN, "order")
        .unionByName(duplicate_rows(inventory, INVENTORY_KEY, "inventory"))
        .unionByName(duplicate_rows(purchase, PURCHASE_KEY, "purchase"))
    )


def duplicate_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows per clean table that repeat an earlier key; joins on such keys multiply rows."""
    counts = [duplicate_rows(df, [k for k in keys[name] if k in df.columns], name) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def material_overlap(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """Distinct materials in orders, in stock, in both and in one only.

    Both sets are stacked and grouped once, which answers all set questions in one shuffle.
    """
    material = F.col("material_number").cast("string").alias("material_number")
    seen = orders.select(material, F.lit(True).alias("ordered"), F.lit(False).alias("stocked")).unionByName(
        inventory.select(material, F.lit(False).alias("ordered"), F.lit(True).alias("stocked"))
    )
    per_material = (
        seen.na.drop(subset=["material_number"])
        .groupBy("material_number")
        .agg(F.bool_or("ordered").alias("ordered"), F.bool_or("stocked").alias("stocked"))
    )
    return per_material.agg(
        F.count_if("ordered").alias("order_materials"),
        F.count_if("stocked").alias("inventory_materials"),
        F.count_if(F.expr("ordered and stocked")).alias("in_both"),
        F.count_if(F.expr("ordered and not stocked")).alias("order_only"),
        F.count_if(F.expr("stocked and not ordered")).alias("inventory_only"),
    )


def backorder_overview(order_metrics: DataFrame) -> DataFrame:
    """Share of open lines, count and share of backordered lines."""
    backordered = F.col("backorder_units") > 0
    return order_metrics.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(F.avg(F.col("is_open").cast("double")) * 100, 6).alias("pct_open"),
        F.count_if(backordered).alias("n_backordered"),
        F.round(F.avg(backordered.cast("double")) * 100, 6).alias("pct_backordered"),
    )


def reference_collisions(
    documents: DataFrame, column: str = "sales_document_number", modulus: int | None = None, ranges: DataFrame | None = None
) -> DataFrame:
    """Canonical document numbers that stand for more than one original number."""
    # Originals are made distinct before they are parsed; spelling is compared without the spaces around it.
    spelled = documents.select(text_key(F.col(column)).alias("original")).distinct()
    numbered = spelled.withColumn("_number", whole_number(F.col("original"))).filter("_number is not null")
    if ranges is not None:
        numbered = numbered.withColumn("_ranges", range_table(ranges))
    own_ranges = F.col("_ranges") if ranges is not None else None
    folded = numbered.select(folded_document(F.col("_number"), modulus, own_ranges).alias("canonical"))
    return folded.groupBy("canonical").agg(F.count(F.lit(1)).alias("n_documents")).filter("n_documents > 1")


def feature_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, all pairs in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    measured = df.select(*(number(df, c).alias(c) for c in columns))
    row = measured.agg(
        F.array(
            *(
                F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.corr(a, b).alias("correlation"))
                for a, b in pairs
            )
        ).alias("pairs")
    )
    return row.select(F.inline("pairs"))
