"""Every query by name, run on a star-schema folder through the clean-table views.

Stage tables (order lines, masters, metrics, coverage, features) are written once per session and
folder and read by the queries of the next stage, as in the pipeline.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import canonical_key, finite_or_zero, instant, number, text_key, week_start, whole_days, whole_number
from .operators import counted_in_ranges, latest_image
from .plans import evaluate, features, forecast, masters, metrics, models, pipeline, quality, targets, tree_checks
from .sources import ChangeLogTable, File, Workspace, read_extracts, read_json_rows, read_typed, rename_columns, typed, write_json_rows, write_table
from .sources.catalog import CLEAN_TABLES
from .sources.star_schema import CLIENT, StarSchema

REFERENCE_DATE = dt.date(2001, 8, 1)
VALIDITY_DATE = dt.date(2000, 1, 1)
SCORE_THRESHOLD = 20

ORDER_INPUTS = (
    "sales_order_item",
    "sales_order_header",
    "delivery_item",
    "billing_document_item",
    "sales_order_schedule_line",
    "material_master",
    "material_description",
    "customer_master",
    "sales_document_status_item",
)
INVENTORY_INPUTS = ("material_stock", "material_master", "material_description", "plant")
PURCHASE_INPUTS = ("purchase_order_item", "purchase_order_header", "vendor_master", "material_master")


class Dataset:
    """Clean views and stage tables of one folder in one session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.workspace = Workspace(spark, hashlib.md5(folder.encode()).hexdigest()[:12])
        self.clean = StarSchema(spark, folder, self.workspace)
        self._models: dict[str, PipelineModel] = {}
        self._nodes: dict[str, DataFrame] = {}

    def build_orders(self, by_material: Sequence[DataFrame] = ()) -> DataFrame:
        return masters.order_fulfillment(self.clean.tables(*ORDER_INPUTS), by_material=by_material)

    def build_inventory(self) -> DataFrame:
        return masters.inventory_material(self.clean.tables(*INVENTORY_INPUTS))

    def build_purchase(self) -> DataFrame:
        return masters.purchase(self.clean.tables(*PURCHASE_INPUTS))

    def build_metrics(self) -> DataFrame:
        """Metrics of the orders as they come from their last join, unless the orders are written already.

        Those look the stock up together with the attributes of the material, so the wide rows are shuffled and written
        once less.
        """
        inventory = self.inventory()
        if self.workspace.has("master_order_fulfillment"):
            return metrics.order_backorder_metrics(self.orders(), inventory, REFERENCE_DATE)
        return metrics.order_backorder_metrics(self.build_orders(metrics.stock_by_material(inventory)), inventory, REFERENCE_DATE)

    def build_shipments(self) -> DataFrame:
        return metrics.shipment_history(self.clean["delivery_item"], self.clean["delivery_header"])

    def build_coverage(self) -> DataFrame:
        return metrics.weeks_of_coverage(self.inventory(), self.shipments(), self.metrics())

    def build_features(self) -> DataFrame:
        keys = [*masters.ORDER_GRAIN, "material_number", "plant_code", "backorder_units"]
        return self.workspace.table("encoded", lambda: features.encoded_features(self.targets(), keys))

    def build_split(self) -> DataFrame:
        return features.stratified_split(self.build_features())

    def orders(self) -> DataFrame:
        return self.workspace.table("master_order_fulfillment", self.build_orders)

    def inventory(self) -> DataFrame:
        return self.workspace.table("master_inventory_material", self.build_inventory)

    def purchase(self) -> DataFrame:
        return self.workspace.table("master_purchase", self.build_purchase)

    def metrics(self) -> DataFrame:
        return self.workspace.table("master_order_fulfillment_brd", self.build_metrics)

    def metrics_once(self) -> DataFrame:
        """The metrics for a query that reads them once: the stage table if it is written, else the rows unwritten."""
        return self.metrics() if self.workspace.has("master_order_fulfillment_brd") else self.build_metrics()

    def shipments(self) -> DataFrame:
        return self.workspace.table("shipment_history", self.build_shipments)

    def coverage(self) -> DataFrame:
        return self.workspace.table("master_woc", self.build_coverage)

    def split(self) -> DataFrame:
        return self.workspace.table("split", lambda: features.in_stable_order(self.build_split()))

    def targets(self) -> DataFrame:
        return targets.order_targets(self.metrics())

    def fitted(self, name: str, fit: Callable, exclude_leaky: bool = False) -> tuple[PipelineModel, DataFrame]:
        """A model on the training rows, fitted once, and its scored test rows, written once.

        Evaluation reads the scored rows several times; scoring them again each time costs more.
        """
        if name not in self._models:
            model, scored = fit(self.split(), features.feature_names(exclude_leaky))
            self._models[name] = model
            self.workspace.table(f"{name}_scored", lambda: scored)
        return self._models[name], self.workspace.table(f"{name}_scored")

    def magnitude(self, name: str, **how) -> DataFrame:
        """Test rows with the predicted magnitude; fitted once, without the features that define it."""

        return models.regression_metrics(self.regression(name, **how)[1], name)

    def regression(self, name: str, **how) -> tuple[PipelineModel, DataFrame]:
        """A magnitude model, fitted once, and its predicted test rows, written once."""
        if name not in self._models:
            model, predicted = models.magnitude_regression(self.split(), features.feature_names(exclude_leaky=True), **how)
            self._models[name] = model
            self.workspace.table(f"{name}_predicted", lambda: predicted)
        return self._models[name], self.workspace.table(f"{name}_predicted")

    def nodes(self, name: str, model: PipelineModel) -> DataFrame:
        """The nodes of a tree model, saved once."""
        if name not in self._nodes:
            self._nodes[name] = tree_checks.tree_nodes(model, self.workspace.file_path(f"trees/{name}"), self.split())
        return self._nodes[name]

    def scored(self) -> DataFrame:
        """Deterministic classifier: the outstanding quantity is the score."""
        return self.targets().select(
            *masters.ORDER_GRAIN,
            F.col(features.LABEL).alias("label"),
            (F.col("outstanding_qty") >= SCORE_THRESHOLD).cast("int").alias("prediction"),
            F.col("outstanding_qty").alias("score"),
        )


_datasets: dict[tuple[str, str], Dataset] = {}


def dataset(spark: SparkSession, folder: str) -> Dataset:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _datasets:
        _datasets[key] = Dataset(spark, folder)
    return _datasets[key]


def forget(spark: SparkSession, folder: str) -> None:
    """Drop what is known of a folder, for one whose files were written anew within the session."""
    known = _datasets.pop((spark.sparkContext.applicationId, folder), None)
    if known:
        known.workspace.close()


def presented(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates as text and doubles rounded, so that results compare across engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType, T.DateType)):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, digits)
        columns.append(column.alias(field.name))
    return df.select(columns)


# --- masters -----------------------------------------------------------------------------------


def order_fulfillment(d: Dataset) -> DataFrame:
    return d.build_orders()


def inventory_material(d: Dataset) -> DataFrame:
    return d.build_inventory()


def purchase(d: Dataset) -> DataFrame:
    return d.build_purchase()


def _plant_log(d: Dataset) -> DataFrame:
    """Five images per plant: the nations of its region, one a day."""
    day = F.lit("2020-01-01").cast("date")
    return d.clean.raw("nation").select(
        F.lit(CLIENT).alias("client_id"),
        F.col("n_regionkey").cast("string").alias("plant_code"),
        F.col("n_name").alias("name_line_1"),
        F.date_add(day, F.col("n_nationkey")).cast("timestamp_ntz").alias("record_timestamp"),
    )


def _stock_by_plant_name(d: Dataset, plants: DataFrame) -> DataFrame:
    stock = masters.inventory_material({**d.clean.tables(*INVENTORY_INPUTS), "plant": plants})
    return stock.groupBy("plant_code", "plant_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("unrestricted_stock").alias("total_stock")
    )


def inventory_unresolved_plants(d: Dataset) -> DataFrame:
    return _stock_by_plant_name(d, _plant_log(d))


def inventory_material_changelog(d: Dataset) -> DataFrame:
    return _stock_by_plant_name(d, latest_image(_plant_log(d), ["client_id", "plant_code"]))


def delivery_agg(d: Dataset) -> DataFrame:
    return masters.delivery_totals(d.clean["delivery_item"])


def billing_agg(d: Dataset) -> DataFrame:
    return masters.billing_totals(d.clean["billing_document_item"])


def schedule_agg(d: Dataset) -> DataFrame:
    return masters.schedule_totals(d.clean["sales_order_schedule_line"])


def material_text_first(d: Dataset) -> DataFrame:
    return masters.first_description(d.clean["material_description"])


# --- ingest ------------------------------------------------------------------------------------


def rename_roundtrip(d: Dataset) -> DataFrame:
    raw = d.clean.raw("lineitem").select(
        F.col("l_orderkey").alias("VBELN"),
        F.col("l_linenumber").alias("posnr"),
        F.col("l_partkey").alias(" MATNR "),
        F.col("l_quantity").alias("kwmeng"),
        F.col("l_returnflag").alias("waerk"),
        F.col("l_linestatus").alias("waers"),
        F.col("l_discount").alias("Net Weight-(KG)"),
    )
    return rename_columns(raw)


def latest_image_of_lines(d: Dataset) -> DataFrame:
    return latest_image(_line_log(d), ["l_orderkey", "l_linenumber"])


def _line_log(d: Dataset) -> DataFrame:
    return d.clean.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("record_timestamp"),
        (F.col("l_returnflag") == "R").alias("is_deleted"),
        "l_partkey",
        "l_suppkey",
        "l_quantity",
    )


def merged_change_log(d: Dataset) -> DataFrame:
    """The log of the lines in three extracts, two of them files with other column orders, merged one after the other."""
    log, folder = _line_log(d), d.workspace.file_path("change_log")
    halves = [log.filter(F.pmod("l_suppkey", F.lit(3)) == i) for i in (0, 1)]
    halves.append(log.filter(F.coalesce(F.pmod("l_suppkey", F.lit(3)) == 2, F.lit(True))))
    paths = [f"{folder}/extract_{i}" for i in range(3)]
    for path, half, order in zip(paths, halves, (log.columns, log.columns[::-1], log.columns[2:] + log.columns[:2])):
        write_table(half.select(*order), path, "csv")
    File(d.spark, f"{folder}/table").delete()
    merged = ChangeLogTable(d.spark, f"{folder}/table", ["l_orderkey", "l_linenumber"], buckets=16)
    for extract in (paths[:2], paths[2:]):
        merged.merge(typed(read_extracts(d.spark, extract), log.schema))
    merged.clean()
    return merged.load()


def folded_by_range_table(d: Dataset) -> DataFrame:
    """Lines per order, found by numbers in a range of their supplier's own; the ranges are rows of a table."""
    size = 50_000_000
    supplied = F.col("s_suppkey").cast("bigint")
    ranges = d.clean.raw("supplier").select((supplied * size + 7_000_000_000).alias("first"), F.lit(size).alias("size"))
    reference = F.col("l_orderkey") + F.col("l_suppkey").cast("bigint") * size + 7_000_000_000
    lines = d.clean.raw("lineitem").select(whole_number(F.concat(F.lit(" 0"), reference.cast("string"))).alias("reference"))
    counted = counted_in_ranges(lines, "reference", ranges)
    return counted.groupBy(F.coalesce(F.col("folded").cast("string"), F.lit("")).alias("canonical")).agg(F.sum("n_rows").alias("n_lines"))


def repaired_keys(d: Dataset) -> DataFrame:
    """Lines per order by keys that a wrong type has damaged: zeros in front, or a decimal point."""
    damaged = F.when(F.col("l_linenumber") % 2 == 0, F.format_string("%010d", F.col("l_orderkey").cast("bigint"))).otherwise(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(".0"))
    )
    return d.clean.raw("lineitem").groupBy(canonical_key(damaged).alias("sales_document_number")).agg(F.count(F.lit(1)).alias("n_lines"))


def csv_roundtrip(d: Dataset) -> DataFrame:
    """Order metrics written as CSV, columns in reverse, with texts that hold quotes and commas, and read back typed."""
    told = F.concat(F.lit('called "'), F.col("material_description_text"), F.lit('", and more'))
    table, path = d.metrics_once().withColumn("told", told), d.workspace.file_path("csv_roundtrip")
    write_table(table.select(*reversed(table.columns)), path, "csv", compressed=True)
    return read_typed(d.spark, path, table.schema)


def json_roundtrip(d: Dataset) -> DataFrame:
    """Metrics of three deterministic classifiers written as JSON rows and read back typed."""
    metrics_rows, path = _metrics_by_quantity(d), d.workspace.file_path("json_roundtrip")
    write_json_rows(metrics_rows, path)
    return read_json_rows(d.spark, path, metrics_rows.schema)


def pipeline_stage_rows(d: Dataset) -> DataFrame:
    """Rows of every stage of a whole run on clean tables in CSV; a second run must find all stages finished."""
    source, target = d.workspace.file_path("clean_csv"), d.workspace.file_path("stages")
    for name in CLEAN_TABLES:
        if hasattr(d.clean, f"_{name}"):
            write_table(d.clean[name], f"{source}/{name}.csv", "csv", compressed=True)
    pipeline.run(d.spark, source, target, REFERENCE_DATE, resume=True)
    again = pipeline.run(d.spark, source, target, REFERENCE_DATE, resume=True)
    rows = [(name, n, name in again.reused) for name, n in again.rows.items()]
    return d.spark.createDataFrame(rows, "stage string, n_rows bigint, is_reused boolean")


def key_collisions(d: Dataset) -> DataFrame:
    orders = d.clean["sales_order_header"].select("sales_document_number")
    references = d.clean["delivery_item"].select(F.col("reference_document_number").alias("sales_document_number"))
    return quality.reference_collisions(orders.unionByName(references))


def coerced_values(d: Dataset) -> DataFrame:
    """Untidy text made from the lines by key, through the lenient parsers."""
    case, day = F.col("l_orderkey") % 8, F.col("l_shipdate").cast("date")
    untidy = {
        "quantity": (F.format_string(" %d ", "l_linenumber"), "1e3", "1d", "nan", "inf", "-2.5", ""),
        "moment": (
            F.date_format(day, "yyyy-MM-dd"),
            F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:30:00+02:00")),
            F.date_format(day, "yyyyMMdd"),
            "00000000",
            "no date",
        ),
        "ratio": (1.5, "Infinity", "-Infinity", "NaN"),
    }
    columns = {}
    for name, values in untidy.items():
        column = F.lit(None)
        for i, value in enumerate(values):
            column = F.when(case == i, value if isinstance(value, Column) else F.lit(value)).otherwise(column)
        columns[name] = column.cast("double" if name == "ratio" else "string")
    text = d.clean.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("\u3000\tK"), F.col("l_partkey").cast("string"), F.lit("\xa0\n")).alias("material"),
        F.format_string("a category of part number %09d", F.col("l_partkey").cast("bigint")).alias("category"),
        *(c.alias(name) for name, c in columns.items()),
    )
    return text.select(
        "l_orderkey",
        "l_linenumber",
        text_key(F.col("material")).alias("material"),
        F.substring("category", 1, 20).alias("category"),
        number(text, "quantity").alias("quantity"),
        instant(text, "moment").alias("moment"),
        finite_or_zero(F.col("ratio")).alias("ratio"),
    )


def event_weeks(d: Dataset) -> DataFrame:
    moment = F.col("ts")
    noon = F.lit(dt.datetime(2024, 1, 15, 12)).cast("timestamp_ntz")
    return (
        d.clean.raw("events")
        .groupBy(
            week_start(moment).alias("week"),
            F.weekofyear(moment).alias("week_of_year"),
            whole_days(moment.cast("timestamp_ntz"), noon).alias("days"),
        )
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


# --- metrics and targets -----------------------------------------------------------------------


def order_backorder_metrics(d: Dataset) -> DataFrame:
    return d.build_metrics()


def backorder_aging(d: Dataset) -> DataFrame:
    return d.metrics().filter("is_open").groupBy("backorder_aging_days", "backorder_aging_bucket").agg(
        F.count(F.lit(1)).alias("n_lines")
    )


def backorder_by_bucket(d: Dataset) -> DataFrame:
    return d.metrics().groupBy("is_open", "backorder_aging_bucket").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("backorder_units").alias("backorder_units"),
        F.sum(F.col("backorder_amount").cast("decimal(28,6)")).cast("double").alias("backorder_amount"),
    )


def backorder_overview(d: Dataset) -> DataFrame:
    return quality.backorder_overview(d.metrics())


def shipment_history(d: Dataset) -> DataFrame:
    return d.build_shipments()


def weeks_of_coverage(d: Dataset) -> DataFrame:
    return d.build_coverage()


def coverage_low(d: Dataset) -> DataFrame:
    return d.coverage().filter("woc_low_flag").select(*metrics.SERIES, "net_available", "awd", "woc")


def backorder_targets(d: Dataset) -> DataFrame:
    return d.targets().select(*masters.ORDER_GRAIN, "backorder_units", features.LABEL)


def overstock_targets(d: Dataset) -> DataFrame:
    return targets.inventory_targets(d.inventory(), d.coverage())


def class_balance(d: Dataset) -> DataFrame:
    return targets.class_balance(d.targets(), features.LABEL)


# --- forecast and excess -----------------------------------------------------------------------


def demand_rolling_mean(d: Dataset) -> DataFrame:
    return forecast.rolling_demand(d.shipments())


def demand_rolling_mean_calendar(d: Dataset) -> DataFrame:
    return forecast.calendar_demand(d.shipments())


def demand_forecast(d: Dataset) -> DataFrame:
    return forecast.demand_forecast(d.shipments())


def excess_inventory(d: Dataset) -> DataFrame:
    return forecast.excess_inventory(d.coverage())


def excess_top10(d: Dataset) -> DataFrame:
    return forecast.top_excess(forecast.excess_inventory(d.coverage()))


def forecast_excess_summary(d: Dataset) -> DataFrame:
    return forecast.forecast_excess_summary(
        forecast.demand_forecast(d.shipments()), forecast.excess_inventory(d.coverage())
    )


# --- data discovery ----------------------------------------------------------------------------


def missing_summary_orders(d: Dataset) -> DataFrame:
    return quality.missing_summary(d.metrics())


def missing_summary_inventory(d: Dataset) -> DataFrame:
    return quality.missing_summary(d.inventory())


def missing_summary_purchase(d: Dataset) -> DataFrame:
    return quality.missing_summary(d.purchase())


def _moments_rounded(described: DataFrame) -> DataFrame:
    """Moments of large money columns agree between engines to fewer digits than plain values do."""
    return described.withColumns({c: F.round(c, 3) for c in ("mean", "std", "skew")})


def describe_orders(d: Dataset) -> DataFrame:
    return _moments_rounded(quality.describe(d.metrics())).drop("skew")


def quantiles_orders(d: Dataset) -> DataFrame:
    return quality.outlier_quantiles(d.metrics())


def winsorized_orders(d: Dataset) -> DataFrame:
    return quality.winsorize(d.metrics()).select(*masters.ORDER_GRAIN, *quality.OUTLIER_COLUMNS)


def order_summary_stats(d: Dataset) -> DataFrame:
    return _moments_rounded(quality.order_summary_stats(d.orders()))


def validity_checks(d: Dataset) -> DataFrame:
    return quality.validity_checks(d.metrics(), d.inventory(), VALIDITY_DATE)


def duplicate_checks(d: Dataset) -> DataFrame:
    return quality.duplicate_checks(d.orders(), d.inventory(), d.purchase())


def duplicate_keys(d: Dataset) -> DataFrame:
    names = ("sales_order_header", "delivery_header", "material_master", "customer_master", "vendor_master")
    names += ("purchase_order_header", "plant")
    return quality.duplicate_keys(d.clean.tables(*names), {n: CLEAN_TABLES[n].key for n in names})


def material_overlap(d: Dataset) -> DataFrame:
    return quality.material_overlap(d.metrics(), d.inventory())


def sql_views_sample(d: Dataset) -> DataFrame:
    pipeline.register_views({"master_order_fulfillment_brd": d.metrics()})
    return d.spark.sql(
        "SELECT * FROM order_fulfillment ORDER BY cast(sales_document_number AS bigint), cast(item_number AS int) LIMIT 5"
    )


def sql_views_by_material(d: Dataset) -> DataFrame:
    """SQL over all five views: what is open, in stock, purchased and shipped of a material, and its least coverage."""
    tables = {
        "master_order_fulfillment_brd": d.metrics(),
        "master_inventory_material": d.inventory(),
        "master_purchase": d.purchase(),
        "shipment_history": d.shipments(),
        "master_woc": d.coverage(),
    }
    pipeline.register_views(tables)
    return d.spark.sql(
        """SELECT material_number, sum(open_units) AS open_units, sum(stock_units) AS stock_units,
             sum(purchased_units) AS purchased_units, sum(shipped_units) AS shipped_units, min(woc) AS least_woc
           FROM (
             SELECT material_number, outstanding_qty AS open_units, NULL AS stock_units, NULL AS purchased_units,
               NULL AS shipped_units, NULL AS woc FROM order_fulfillment WHERE is_open
             UNION ALL SELECT material_number, NULL, unrestricted_stock, NULL, NULL, NULL FROM inventory_material
             UNION ALL SELECT material_number, NULL, NULL, quantity, NULL, NULL FROM purchase
             UNION ALL SELECT material_number, NULL, NULL, NULL, quantity_shipped, NULL FROM shipment_history
             UNION ALL SELECT material_number, NULL, NULL, NULL, NULL, woc FROM master_woc
           ) GROUP BY material_number"""
    )


def feature_correlation(d: Dataset) -> DataFrame:
    return quality.feature_correlation(d.targets(), [*features.NUMERIC_FEATURES, features.LABEL])


# --- features and evaluation -------------------------------------------------------------------


def features_encoded(d: Dataset) -> DataFrame:
    return features.encoded_features(d.targets())


def features_short_categories(d: Dataset) -> DataFrame:
    """Features with categories cut to four characters; lines without a requested date have no label and are left out."""
    label = F.when(F.col("requested_delivery_date").isNotNull(), F.col(features.LABEL))
    return features.encoded_features(d.targets().withColumn(features.LABEL, label), category_length=4)


def stratified_split(d: Dataset) -> DataFrame:
    return d.build_split().select(*masters.ORDER_GRAIN, features.LABEL, "is_test")


def features_scaled(d: Dataset) -> DataFrame:
    rows = d.split()
    names = features.feature_names()
    scaled = features.standardize(rows, names, rows.filter("not is_test"))
    return scaled.select(*masters.ORDER_GRAIN, *names)


def class_weights(d: Dataset) -> DataFrame:
    return features.class_weights(d.split().filter("not is_test"))


def confusion_matrix(d: Dataset) -> DataFrame:
    return evaluate.confusion_matrix(d.scored())


def classification_metrics(d: Dataset) -> DataFrame:
    return evaluate.classification_metrics(d.scored(), "outstanding_quantity")


def classification_report(d: Dataset) -> DataFrame:
    return evaluate.classification_report(d.scored())


def auc_exact(d: Dataset) -> DataFrame:
    """Two scores: a coarse one with many ties and a fine one with almost none."""
    coarse = evaluate.roc_auc(d.scored()).select(F.lit("outstanding_qty").alias("score_name"), "roc_auc")
    by_value = d.targets().select(F.col(features.LABEL).alias("label"), F.col("net_value").alias("score"))
    fine = evaluate.roc_auc(by_value).select(F.lit("net_value").alias("score_name"), "roc_auc")
    return coarse.unionByName(fine)


def threshold_curve(d: Dataset) -> DataFrame:
    return evaluate.threshold_curve(d.scored())


def best_threshold(d: Dataset) -> DataFrame:
    return evaluate.best_threshold(evaluate.threshold_curve(d.scored()))


# --- models ------------------------------------------------------------------------------------


def backorder_logistic(d: Dataset) -> DataFrame:
    _, scored = d.fitted("logistic_regression", models.logistic_backorder)
    return evaluate.classification_metrics(scored, "logistic_regression")


def logistic_optimality(d: Dataset) -> DataFrame:
    """Per coefficient: is the penalised loss of the fitted logistic model flat there? With the training counts."""
    model, _ = d.fitted("logistic_regression", models.logistic_backorder)
    return models.logistic_optimality(model, d.split().filter("not is_test"), features.feature_names())


def ridge_optimality(d: Dataset) -> DataFrame:
    """The same for the ridge regression that `magnitude_ridge` reports."""
    model, _ = d.regression("ridge", elastic_net=0.0)
    return models.linear_optimality(model, d.split().filter("not is_test"), features.feature_names(exclude_leaky=True))


def elasticnet_optimality(d: Dataset) -> DataFrame:
    """The same for the elastic net that `magnitude_elasticnet` reports; at a zero coefficient the loss has a kink."""
    model, _ = d.regression("elastic_net")
    return models.linear_optimality(model, d.split().filter("not is_test"), features.feature_names(exclude_leaky=True))


def saved_model_scores(d: Dataset) -> DataFrame:
    """Per test row: does the logistic model, written and read back, give the score that it gave before?"""
    model, _ = d.fitted("logistic_regression", models.logistic_backorder)
    loaded = models.saved_and_loaded(model, d.workspace.file_path("models/logistic"))
    return models.same_scores(model, loaded, d.split().filter("is_test"), masters.ORDER_GRAIN)


def backorder_forest(d: Dataset) -> DataFrame:
    _, scored = d.fitted("random_forest", models.forest_backorder)
    return evaluate.classification_metrics(scored, "random_forest")


def forest_importance(d: Dataset) -> DataFrame:
    model, scored = d.fitted("random_forest", models.forest_backorder)
    return models.feature_importance(model, scored, features.feature_names())


def importance_by_nodes(d: Dataset) -> DataFrame:
    """Per feature: is the forest's importance what follows from the gains and rows of its splits?"""
    model, _ = d.fitted("random_forest", models.forest_backorder)
    names = features.feature_names()
    own = tree_checks.importance_from_nodes(d.nodes("random_forest", model), names)
    told = models.feature_importance(model, d.split(), names).withColumnRenamed("importance", "told")
    equal = F.abs(F.col("importance") - F.col("told")) <= tree_checks.CLOSE
    return own.join(told, "feature").select("feature", "n_trees", equal.alias("is_equal"))


def forest_leaves(d: Dataset) -> DataFrame:
    """Per tree of a forest fitted on all training rows: has each leaf the class weights of its rows?"""
    train = d.split().filter("not is_test")

    def fit(data: DataFrame, names: Sequence[str]) -> tuple[PipelineModel, DataFrame]:
        return models.forest_backorder(data, names, trees=10, bootstrap=False)

    model, _ = d.fitted("whole_forest", fit)
    weighted = features.with_class_weights(train, train)
    return tree_checks.forest_leaves(model, d.nodes("whole_forest", model), weighted, F.col("weight"))


def gbt_leaves(d: Dataset) -> DataFrame:
    """Per boosted tree of the classifier: is each leaf the mean of what the trees before it leave over?"""
    train = d.split().filter("not is_test")
    model, _ = d.fitted("gradient_boosted_trees", models.gbt_backorder, exclude_leaky=True)
    weighted = features.with_class_weights(train, train)
    sign = F.col(features.LABEL) * 2.0 - 1.0
    return tree_checks.boosted_leaves(
        model, d.nodes("gradient_boosted_trees", model), weighted, sign, lambda y, f: 4 * y / (1 + F.exp(2 * y * f)), F.col("weight")
    )


def magnitude_gbt_leaves(d: Dataset) -> DataFrame:
    """The same for the boosted magnitude model, whose trees are fitted on twice the error that is left."""
    model, _ = d.regression("gradient_boosted_regression", boosted=True)
    return tree_checks.boosted_leaves(
        model,
        d.nodes("gradient_boosted_regression", model),
        d.split().filter("not is_test"),
        F.col("backorder_units").cast("double"),
        lambda y, f: 2 * (y - f),
        F.lit(1.0),
    )


def backorder_gbt(d: Dataset) -> DataFrame:
    _, scored = d.fitted("gradient_boosted_trees", models.gbt_backorder, exclude_leaky=True)
    return evaluate.classification_metrics(scored, "gradient_boosted_trees")


def magnitude_elasticnet(d: Dataset) -> DataFrame:
    return d.magnitude("elastic_net")


def magnitude_ridge(d: Dataset) -> DataFrame:
    return d.magnitude("ridge", elastic_net=0.0)


def magnitude_gbt(d: Dataset) -> DataFrame:
    return d.magnitude("gradient_boosted_regression", boosted=True)


def model_comparison(d: Dataset) -> DataFrame:
    compared = (backorder_logistic(d), backorder_forest(d), backorder_gbt(d))
    return evaluate.model_comparison(reduce(DataFrame.unionByName, compared))


def model_comparison_by_quantity(d: Dataset) -> DataFrame:
    """The model comparison for three deterministic classifiers."""
    return evaluate.model_comparison(_metrics_by_quantity(d))


def _metrics_by_quantity(d: Dataset) -> DataFrame:
    scored = d.scored()
    compared = (
        evaluate.classification_metrics(scored.withColumn("prediction", (F.col("score") >= limit).cast("int")), f"quantity_from_{limit}")
        for limit in (10, 20, 40)
    )
    return reduce(DataFrame.unionByName, compared)


def at_risk_report(d: Dataset) -> DataFrame:
    """Every line, scored by the model that was fitted on the training lines."""
    model, _ = d.fitted("logistic_regression", models.logistic_backorder)
    return models.at_risk_report(models.scored(model, d.split()), d.coverage())


def at_risk_coverage(d: Dataset) -> DataFrame:
    """The at-risk report without the model's two columns."""
    return at_risk_report(d).drop("predicted_backorder", "risk_score")


def at_risk_by_quantity(d: Dataset) -> DataFrame:
    """The at-risk report on the deterministic classifier."""
    lines = d.metrics().select(
        *metrics.SERIES,
        (F.col("outstanding_qty") >= SCORE_THRESHOLD).cast("int").alias("prediction"),
        F.col("outstanding_qty").alias("score"),
    )
    return models.at_risk_report(lines, d.coverage())


def magnitude_by_quantity(d: Dataset) -> DataFrame:
    """Regression metrics when the outstanding quantity is taken as the backorder magnitude."""
    predicted = d.metrics().select("backorder_units", F.col("outstanding_qty").alias("prediction"))
    return models.regression_metrics(predicted, "outstanding_quantity")


QUERIES: Sequence[Callable[[Dataset], DataFrame]] = (
    order_fulfillment,
    inventory_material,
    inventory_unresolved_plants,
    inventory_material_changelog,
    purchase,
    delivery_agg,
    billing_agg,
    schedule_agg,
    material_text_first,
    rename_roundtrip,
    latest_image_of_lines,
    merged_change_log,
    key_collisions,
    folded_by_range_table,
    repaired_keys,
    coerced_values,
    event_weeks,
    order_backorder_metrics,
    csv_roundtrip,
    json_roundtrip,
    pipeline_stage_rows,
    backorder_aging,
    backorder_by_bucket,
    backorder_overview,
    shipment_history,
    weeks_of_coverage,
    coverage_low,
    backorder_targets,
    overstock_targets,
    class_balance,
    demand_rolling_mean,
    demand_rolling_mean_calendar,
    demand_forecast,
    excess_inventory,
    excess_top10,
    forecast_excess_summary,
    missing_summary_orders,
    missing_summary_inventory,
    missing_summary_purchase,
    describe_orders,
    quantiles_orders,
    winsorized_orders,
    order_summary_stats,
    validity_checks,
    duplicate_checks,
    duplicate_keys,
    material_overlap,
    sql_views_sample,
    sql_views_by_material,
    feature_correlation,
    features_encoded,
    features_short_categories,
    stratified_split,
    features_scaled,
    class_weights,
    confusion_matrix,
    classification_metrics,
    classification_report,
    auc_exact,
    threshold_curve,
    best_threshold,
    backorder_logistic,
    logistic_optimality,
    saved_model_scores,
    backorder_forest,
    forest_importance,
    importance_by_nodes,
    forest_leaves,
    backorder_gbt,
    gbt_leaves,
    magnitude_elasticnet,
    elasticnet_optimality,
    magnitude_ridge,
    ridge_optimality,
    magnitude_gbt,
    magnitude_gbt_leaves,
    model_comparison,
    model_comparison_by_quantity,
    at_risk_report,
    at_risk_coverage,
    at_risk_by_quantity,
    magnitude_by_quantity,
)

# Digits to compare where six do not fit: a price per unit has more, a scaled feature fewer.
DIGITS = {"purchase": 9, "features_scaled": 5}


def runner(query: Callable[[Dataset], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return presented(query(dataset(spark, folder)), DIGITS.get(query.__name__, 6))

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run
