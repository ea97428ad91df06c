"""Demand forecast from weekly shipments and excess stock over a coverage target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import at_least_zero, number
from .metrics import SERIES

WINDOW_ROWS = 12
TARGET_WOC_WEEKS = 8


def weekly_demand(shipments: DataFrame) -> DataFrame:
    """Demand per series and week, with the ISO week of the year.

    Rows without a week or a quantity are left out; a quantity that is no number counts as zero.
    """
    week = F.col("shipment_week").try_cast("date")
    quantity = F.coalesce(number(shipments, "quantity_shipped"), F.lit(0.0))
    demand = (
        shipments.filter("quantity_shipped is not null")
        .select(*SERIES, week.alias("shipment_week"), quantity.alias("quantity"))
        .na.drop(subset=["shipment_week"])
        .groupBy(*SERIES, "shipment_week")
        .agg(F.sum("quantity").alias("quantity_shipped"))
    )
    return demand.withColumn("week_of_year", F.weekofyear("shipment_week"))


def _known_series(demand: DataFrame) -> DataFrame:
    """Series with all keys known; a blank plant counts as unknown."""
    return demand.na.drop(subset=SERIES).filter("plant_code <> ''")


def rolling_demand(shipments: DataFrame, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Mean of the last `window_rows` recorded weeks, per series and week; empty weeks are not filled in.

    A series holds one row per week after the aggregation, so its window is bounded by the calendar.
    """
    recorded = Window.partitionBy(*SERIES).orderBy("shipment_week").rowsBetween(1 - window_rows, 0)
    demand = _known_series(weekly_demand(shipments))
    return demand.withColumn("roll_mean", F.avg("quantity_shipped").over(recorded))


def dense_demand(shipments: DataFrame) -> DataFrame:
    """Demand per series and calendar week, from the series' first to its last recorded week; empty weeks are zero.

    Each recorded week also makes the empty weeks up to the next one, so no calendar is joined and a series has
    as many rows as its own span has weeks.
    """
    demand = _known_series(weekly_demand(shipments))
    own = _own_weeks(Window.partitionBy(*SERIES).orderBy("shipment_week"))
    dense = demand.withColumn("_weeks", own).withColumn("week", F.explode("_weeks"))
    recorded = F.col("week") == F.col("shipment_week")
    return dense.select(
        *SERIES,
        F.col("week").alias("shipment_week"),
        F.when(recorded, F.col("quantity_shipped")).otherwise(0.0).alias("quantity_shipped"),
        F.weekofyear("week").alias("week_of_year"),
    )


def _own_weeks(by_week: WindowSpec) -> Column:
    """A recorded week and the empty weeks up to the next recorded one, as an array."""
    until = F.coalesce(F.date_sub(F.lead("shipment_week").over(by_week), 7), F.col("shipment_week"))
    return F.sequence("shipment_week", until, F.expr("INTERVAL 7 DAYS"))


def calendar_demand(shipments: DataFrame, window_weeks: int = WINDOW_ROWS) -> DataFrame:
    """Mean of the last `window_weeks` calendar weeks, per series and week, with empty weeks as zero.

    At the start of a series the mean is over the weeks that it has. Each recorded week carries the recorded weeks
    before it that its own weeks may look back to, at most `window_weeks`, so the rows that are made of it, as
    many as the calendar has, are neither sorted nor kept.
    """
    by_week = Window.partitionBy(*SERIES).orderBy("shipment_week")
    back = 7 * (window_weeks - 1)
    day = lambda column: F.datediff(column, F.lit("1970-01-05").cast("date"))
    demand = _known_series(weekly_demand(shipments)).withColumn("_weeks", _own_weeks(by_week)).withColumn("_day", day("shipment_week"))
    segment = F.struct(F.col("_day").alias("day"), F.size("_weeks").alias("weeks"), F.col("quantity_shipped").alias("quantity"))
    near = F.collect_list(segment).over(by_week.rowsBetween(-window_weeks, 0))
    reaches = lambda e: e["day"] + 7 * (e["weeks"] - 1) >= F.col("_day") - back
    demand = demand.withColumn("_near", near).withColumn("_near", F.filter("_near", reaches))

    made = demand.withColumn("week", F.explode("_weeks")).withColumn("_at", day("week"))
    first_seen = F.col("_at") - back
    total = F.aggregate("_near", F.lit(0.0), lambda a, e: a + F.when(e["day"] >= first_seen, e["quantity"]).otherwise(0.0))
    weeks = F.aggregate("_near", F.lit(0).cast("bigint"), lambda a, e: a + _weeks_between(e, first_seen, F.col("_at")))
    return made.select(
        *SERIES,
        F.col("week").alias("shipment_week"),
        F.when(F.col("_at") == F.col("_day"), F.col("quantity_shipped")).otherwise(0.0).alias("quantity_shipped"),
        F.weekofyear("week").alias("week_of_year"),
        (total / weeks).alias("roll_mean"),
    )


def _weeks_between(segment: Column, first: Column, last: Column) -> Column:
    """How many of the weeks that a recorded week makes lie between two days, both included."""
    newest = F.least(segment["weeks"] - 1, F.floor((last - segment["day"]) / 7))
    oldest = F.greatest(F.lit(0), F.ceil((first - segment["day"]) / 7))
    return F.greatest(newest - oldest + 1, F.lit(0)).cast("bigint")


def demand_forecast(shipments: DataFrame, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Latest rolling mean per series, as of that series' own last week."""
    newest = Window.partitionBy(*SERIES).orderBy(F.desc("shipment_week"))
    demand = _known_series(weekly_demand(shipments)).withColumn("_age", F.row_number().over(newest))
    return (
        demand.filter(F.col("_age") <= window_rows)
        .groupBy(*SERIES)
        .agg(F.avg("quantity_shipped").alias("demand_forecast"), F.max("shipment_week").alias("forecast_as_of"))
    )


def excess_inventory(coverage: DataFrame, target_woc_weeks: float = TARGET_WOC_WEEKS) -> DataFrame:
    """Stock above `target_woc_weeks` of average demand, for series with demand."""
    demand = F.coalesce(number(coverage, "awd"), F.lit(0.0))
    stock = F.coalesce(number(coverage, "saleable_inventory"), F.lit(0.0))
    rows = coverage.select(*SERIES, stock.alias("saleable_inventory"), demand.alias("awd"), "woc").filter("awd > 0")
    excess = at_least_zero(F.col("saleable_inventory") - F.col("awd") * target_woc_weeks)
    return rows.withColumn("excess_units", excess)


def top_excess(excess: DataFrame, rows: int = 10) -> DataFrame:
    """The series with the most excess stock."""
    return excess.filter("excess_units > 0").orderBy(F.desc("excess_units"), *SERIES).limit(rows)


def forecast_excess_summary(forecast: DataFrame, excess: DataFrame) -> DataFrame:
    """Materials with a forecast, series with excess stock and total excess units, as (metric, value)."""
    forecasts = forecast.agg(F.count_distinct("material_number").cast("double").alias("value")).select(
        F.lit("materials_with_forecast").alias("metric"), "value"
    )
    totals = excess.agg(
        F.count_if(F.col("excess_units") > 0).cast("double").alias("materials_with_excess"),
        F.coalesce(F.sum("excess_units"), F.lit(0.0)).alias("total_excess_units"),
    )
    return forecasts.unionByName(
        totals.unpivot([], ["materials_with_excess", "total_excess_units"], "metric", "value")
    )
