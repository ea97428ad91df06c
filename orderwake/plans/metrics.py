"""Business metrics: backorders and their aging, weekly shipments, weeks of coverage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import aging_bucket, at_least_zero, instant, number, ratio, sum_or_zero, week_start, whole_days
from ..operators import HotKeys, hot_keys, lookup_join
from .masters import MATERIAL, ORDER_GRAIN

SERIES = ["client_id", "material_number", "plant_code"]
WOC_WEEKS = 24
WOC_LOW_WEEKS = 2.0


def saleable_inventory(inventory: DataFrame) -> DataFrame:
    """Unrestricted stock per client and material, over all plants."""
    return (
        _text_client(inventory)
        .groupBy(*MATERIAL)
        .agg(sum_or_zero(number(inventory, "unrestricted_stock")).alias("saleable_inventory"))
    )


def stock_by_material(inventory: DataFrame) -> list[DataFrame]:
    """What `order_fulfillment` needs (as `by_material`) to look the stock up with the attributes of the material."""
    return [saleable_inventory(inventory)] if "unrestricted_stock" in inventory.columns else []


def order_backorder_metrics(
    orders: DataFrame, inventory: DataFrame, reference_date: dt.datetime | dt.date, hot: HotKeys | None = None
) -> DataFrame:
    """Outstanding quantity, backorder units and value, and aging per order line.

    Every open line is held against the material's full stock; stock is not used up line by line. Orders that come with
    the stock of `stock_by_material` keep it. Else materials with many lines are looked for in `orders`, which runs a
    plan that is not written yet; pass them as `hot` if they are known.
    """
    orders = _text_client(orders)
    if "unrestricted_stock" in inventory.columns:
        if "saleable_inventory" not in orders.columns:
            hot = hot_keys(orders, material=MATERIAL)["material"] if hot is None else hot
            orders = lookup_join(orders, saleable_inventory(inventory), MATERIAL, hot, ORDER_GRAIN, null_safe=True)
        on_hand = F.coalesce("saleable_inventory", F.lit(0.0))
    else:
        on_hand = F.lit(0.0)

    dates = ["requested_delivery_date_schedule", "requested_delivery_date", "order_date"]
    orders = orders.withColumns({c: instant(orders, c) for c in dates})
    ordered = F.coalesce(number(orders, "cumulative_order_quantity"), F.lit(0.0))
    delivered = F.coalesce(number(orders, "total_quantity_delivered"), F.lit(0.0))
    value = F.coalesce(number(orders, "net_value"), F.lit(0.0))
    is_open, units, days = F.col("is_open"), F.col("backorder_units"), F.col("backorder_aging_days")
    today = F.lit(_midnight_if_date(reference_date)).cast("timestamp_ntz")
    short = at_least_zero(F.col("outstanding_qty") - F.col("saleable_inventory"))

    orders = orders.withColumn("effective_shipment_date", F.coalesce(*dates))
    orders = orders.withColumn("outstanding_qty", at_least_zero(ordered - delivered))
    orders = orders.withColumn("is_open", F.col("outstanding_qty") > 0)
    orders = orders.withColumn("saleable_inventory", on_hand)
    orders = orders.withColumn("backorder_units", F.when(is_open, short).otherwise(0.0))
    orders = orders.withColumn("backorder_amount", units * ratio(value, ordered, F.lit(0.0)))
    orders = orders.withColumn(
        "backorder_aging_days", F.when(is_open, whole_days(F.col("effective_shipment_date"), today))
    )
    return orders.withColumn("backorder_aging_bucket", aging_bucket(days))


def shipment_history(delivery_item: DataFrame, delivery_header: DataFrame) -> DataFrame:
    """Delivered quantity per client, material, plant and Monday week; issued deliveries only."""
    if "goods_issue_date" not in delivery_header.columns or "quantity_delivered" not in delivery_item.columns:
        schema = ", ".join(f"{c} string" for c in (*SERIES, "shipment_week")) + ", quantity_shipped double"
        return delivery_item.sparkSession.createDataFrame([], schema)
    delivery = ["client_id", "sales_document_number"]
    items = _text_client(delivery_item)
    items = items.select(*delivery, "material_number", "plant_code", number(items, "quantity_delivered").alias("_shipped"))
    items = items.filter("_shipped > 0")
    headers = _text_client(delivery_header)
    headers = headers.select(*delivery, instant(headers, "goods_issue_date").alias("_issued")).na.drop(subset=["_issued"])
    hot = hot_keys(items, delivery=delivery)["delivery"]
    issued = lookup_join(items, headers, delivery, hot, SERIES, null_safe=True, how="inner")
    return issued.groupBy(
        "client_id",
        "material_number",
        F.coalesce(F.col("plant_code").cast("string"), F.lit("")).alias("plant_code"),
        week_start(F.col("_issued")).alias("shipment_week"),
    ).agg(F.sum("_shipped").alias("quantity_shipped"))


def weeks_of_coverage(
    inventory: DataFrame,
    shipments: DataFrame,
    order_metrics: DataFrame,
    woc_weeks: int = WOC_WEEKS,
    woc_low_threshold_weeks: float = WOC_LOW_WEEKS,
) -> DataFrame:
    """Net stock over average weekly demand, per client, material and plant that has a stock row.

    Stock, open orders and recent shipments have the same grain, so they are stacked and summed in
    one aggregation instead of being joined: one shuffle, partial sums first. The demand window
    reaches back `woc_weeks` weeks from the last week of any series, both ends included, and is
    always divided by `woc_weeks`.
    """
    if "unrestricted_stock" not in inventory.columns:
        schema = "client_id string, material_number string, plant_code string"
        return inventory.sparkSession.createDataFrame([], schema)

    stock = _series(inventory, number(inventory, "unrestricted_stock").alias("stock"), F.lit(1).alias("stocked"))
    # An open line without a material number belongs to no stock row.
    open_lines = order_metrics.filter("is_open and material_number is not null")
    open_orders = _series(open_lines, F.col("outstanding_qty").alias("open_qty"))

    week = F.col("shipment_week").try_cast("date")
    dated = shipments.withColumn("_week", week).na.drop(subset=["_week"])
    last_week = dated.agg(F.max("_week")).scalar()
    recent = dated.filter(F.col("_week") >= F.date_sub(last_week, 7 * woc_weeks))
    shipped = _series(recent, number(recent, "quantity_shipped").alias("shipped"), F.lit(1).alias("moved"))

    stacked = stock.unionByName(open_orders, allowMissingColumns=True).unionByName(shipped, allowMissingColumns=True)
    summed = stacked.groupBy(*SERIES).agg(
        sum_or_zero(F.col("stock")).alias("saleable_inventory"),
        sum_or_zero(F.col("open_qty")).alias("open_order_qty"),
        F.when(F.count("moved") > 0, sum_or_zero(F.col("shipped")) / woc_weeks).alias("awd"),
        F.count("stocked").alias("_stock_rows"),
    )
    net = at_least_zero(F.col("saleable_inventory") - F.col("open_order_qty"))
    covered = summed.filter("_stock_rows > 0").withColumn("net_available", net)
    covered = covered.withColumn("woc", ratio(F.col("net_available"), F.col("awd")))
    low = F.col("woc").isNotNull() & (F.col("woc") <= woc_low_threshold_weeks)
    return covered.select(
        *SERIES,
        "saleable_inventory",
        "open_order_qty",
        "net_available",
        "awd",
        "woc",
        low.alias("woc_low_flag"),
    )


def _text_client(df: DataFrame) -> DataFrame:
    return df.withColumn("client_id", F.col("client_id").cast("string"))


def _series(df: DataFrame, *measures: Column) -> DataFrame:
    plant = F.coalesce(F.col("plant_code").cast("string"), F.lit("")).alias("plant_code")
    return _text_client(df).select("client_id", "material_number", plant, *measures)


def _midnight_if_date(moment: dt.datetime | dt.date) -> dt.datetime:
    if isinstance(moment, dt.datetime):
        return moment
    return dt.datetime.combine(moment, dt.time())
