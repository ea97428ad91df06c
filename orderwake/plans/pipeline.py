"""The pipeline: clean tables -> masters -> metrics -> targets, each stage written and read back."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources import File, Workspace, fingerprints, read_json_rows, read_table, read_tables, read_typed, write_json_rows, write_report, write_table
from ..sources.catalog import CLEAN_TABLES
from ..sources.ingest import clean_table
from ..sources.names import TABLE_NAMES
from . import evaluate, forecast, models, quality
from .features import encoded_features, feature_names, in_stable_order, stratified_split
from .masters import ORDER_COLUMNS, ORDER_GRAIN, Tables, existing, inventory_material, order_fulfillment, purchase
from .metrics import order_backorder_metrics, shipment_history, stock_by_material, weeks_of_coverage
from .targets import OVERSTOCK_WEEKS, inventory_targets, order_targets

# SQL names of the five discovery views.
VIEWS = {
    "order_fulfillment": "master_order_fulfillment_brd",
    "inventory_material": "master_inventory_material",
    "purchase": "master_purchase",
    "shipment_history": "shipment_history",
    "master_woc": "master_woc",
}


@dataclass
class Stages:
    """Written stage tables below one folder; `rows` holds the row count of each table written.

    Each finished table has a small document beside it (`_finished/<name>.json`) that tells what it was made
    from, its schema and its rows. It is written last and removed before the table is written anew, so a table
    that was cut off halfway has none.
    """

    spark: SparkSession
    folder: str
    file_format: str = "parquet"
    suffix: str = ""
    rows: dict[str, int] = field(default_factory=dict)
    reused: list[str] = field(default_factory=list)

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}{self.suffix}"

    def save(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        for name, df in tables.items():
            self.rows[name] = write_table(df, self.path(name), self.file_format)
        return {name: self.load(name, df.schema) for name, df in tables.items()}

    def _finished(self, name: str) -> File:
        return File(self.spark, f"{self.folder.rstrip('/')}/_finished/{name}.json")

    def finished(self, name: str, made_from: str) -> dict | None:
        """What is known of a stage that was written to the end from the same inputs."""
        known = self._finished(name).load()
        return known if known and known["made_from"] == made_from else None

    def stage(self, name: str, made_from: str, build: Callable[[], DataFrame], resume: bool = True) -> DataFrame:
        """The named table: as it was written, if that was from the same inputs and to the end, else built anew."""
        known = self.finished(name, made_from) if resume else None
        if known:
            self.rows[name] = known["rows"]
            self.reused.append(name)
            return self.load(name, StructType.fromJson(known["schema"]))
        self._finished(name).delete()
        table = build()
        loaded = self.save({name: table})[name]
        self._finished(name).save(
            {"made_from": made_from, "schema": table.schema.jsonValue(), "rows": self.rows[name]}
        )
        return loaded

    def load(self, name: str, schema: StructType | None = None) -> DataFrame:
        """A written table; CSV needs the schema, since it keeps none."""
        if self.file_format == "csv" and schema is not None:
            return read_typed(self.spark, self.path(name), schema)
        reader = self.spark.read.format(self.file_format)
        if self.file_format == "csv":
            reader = reader.options(header="true", escape='"', enforceSchema="false")
        return (reader.schema(schema) if schema else reader).load(self.path(name))


def build_masters(tables: Tables, document_modulus: int | None = None) -> dict[str, DataFrame]:
    return {
        "master_order_fulfillment": order_fulfillment(tables, document_modulus),
        "master_inventory_material": inventory_material(tables),
        "master_purchase": purchase(tables),
    }


def build_metrics(masters: Tables, deliveries: Tables, reference_date: dt.date) -> dict[str, DataFrame]:
    """Order metrics, shipment history and coverage. Coverage reads both others, so write them first
    (`run` does) or accept that they are computed twice."""
    inventory = masters["master_inventory_material"]
    orders = order_backorder_metrics(masters["master_order_fulfillment"], inventory, reference_date)
    shipments = shipment_history(deliveries["delivery_item"], deliveries["delivery_header"])
    return {
        "master_order_fulfillment_brd": orders,
        "shipment_history": shipments,
        "master_woc": weeks_of_coverage(inventory, shipments, orders),
    }


def build_targets(stages: Tables, overstock_woc_threshold_weeks: float = OVERSTOCK_WEEKS) -> dict[str, DataFrame]:
    needed = ("master_order_fulfillment_brd", "master_woc", "master_inventory_material")
    missing = [name for name in needed if name not in stages]
    if missing:
        raise FileNotFoundError(f"build these tables first: {', '.join(missing)}")
    return {
        "master_order_fulfillment_with_targets": order_targets(stages["master_order_fulfillment_brd"]),
        "master_inventory_material_with_targets": inventory_targets(
            stages["master_inventory_material"], stages["master_woc"], overstock_woc_threshold_weeks
        ),
    }


def run(
    spark: SparkSession,
    source: str,
    target: str,
    reference_date: dt.date,
    supporting: str | None = None,
    source_format: str = "csv",
    target_format: str = "parquet",
    document_modulus: int | None = None,
    resume: bool = False,
) -> Stages:
    """Read the clean tables below `source`, write every stage table below `target`.

    A missing required table is an error before anything is written. With `resume` a stage that an earlier run
    has finished from the same files and parameters is taken as it is (`Stages.reused`), so a run whose driver was lost
    goes on where it stopped; a stage that was cut off halfway, or whose inputs changed, is built anew, and so is
    what follows from it.

    Orders and their metrics that are both to be built are computed together: the metrics are taken from the orders as
    they come from their last join, and the orders are the columns of the written metrics that they had before. The
    wide rows are shuffled once less than if the orders were written first.
    """
    tables = read_tables(spark, source, supporting, source_format)
    stages = Stages(spark, target, target_format)
    marks = _source_marks(spark, source, supporting, tables, source_format) if resume else dict.fromkeys(tables, "")
    done: dict[str, DataFrame] = {}
    builds: dict[str, Callable[[], DataFrame]] = {}

    def ready(name: str) -> DataFrame:
        if name not in done:
            done[name] = stages.stage(name, marks[name], builds[name], resume)
        return done[name]

    def kept(name: str) -> bool:
        return name in done or (resume and stages.finished(name, marks[name]) is not None)

    for name, inputs, parameters, build in _plan(tables, ready, kept, target_format, reference_date, document_modulus):
        told = [name, target_format, parameters, [marks[i] for i in inputs]]
        marks[name] = hashlib.sha256(json.dumps(told).encode()).hexdigest()
        builds[name] = build
    for name in builds:
        ready(name)
    stages.rows = {name: stages.rows[name] for name in builds}
    stages.reused = [name for name in builds if name in stages.reused]
    return stages


Stage = tuple[str, Sequence[str], Sequence[str], Callable[[], DataFrame]]


def _plan(
    tables: Tables,
    ready: Callable[[str], DataFrame],
    kept: Callable[[str], bool],
    target_format: str,
    reference_date: dt.date,
    document_modulus: int | None,
) -> list[Stage]:
    """The stages in order: name, the tables that each reads, the parameters that it depends on, and how to build it.

    `ready` gives a stage that was written, now or earlier; `kept` tells whether it is there without being built.
    """

    def orders() -> DataFrame:
        # A CSV file does not tell an empty text from none, so its orders are not taken from other files.
        if target_format != "parquet":
            return order_fulfillment(tables, document_modulus)
        found = ready("master_order_fulfillment_brd")
        return existing(found, ORDER_COLUMNS)

    def metrics() -> DataFrame:
        inventory = ready("master_inventory_material")
        if target_format != "parquet" or kept("master_order_fulfillment"):
            return order_backorder_metrics(ready("master_order_fulfillment"), inventory, reference_date)
        found = order_fulfillment(tables, document_modulus, by_material=stock_by_material(inventory))
        return order_backorder_metrics(found, inventory, reference_date)

    order_inputs = ("sales_order_item", "sales_order_header", "delivery_item", "billing_document_item", "sales_order_schedule_line")
    order_inputs += ("material_master", "material_description", "customer_master", "sales_document_status_item")
    return [
        ("master_order_fulfillment", order_inputs, [str(document_modulus)], orders),
        (
            "master_inventory_material",
            ("material_stock", "material_master", "material_description", "plant"),
            [],
            lambda: inventory_material(tables),
        ),
        (
            "master_purchase",
            ("purchase_order_item", "purchase_order_header", "vendor_master", "material_master"),
            [],
            lambda: purchase(tables),
        ),
        (
            "master_order_fulfillment_brd",
            ("master_order_fulfillment", "master_inventory_material"),
            [str(reference_date)],
            metrics,
        ),
        (
            "shipment_history",
            ("delivery_item", "delivery_header"),
            [],
            lambda: shipment_history(tables["delivery_item"], tables["delivery_header"]),
        ),
        (
            "master_woc",
            ("master_inventory_material", "shipment_history", "master_order_fulfillment_brd"),
            [],
            lambda: weeks_of_coverage(ready("master_inventory_material"), ready("shipment_history"), ready("master_order_fulfillment_brd")),
        ),
        (
            "master_order_fulfillment_with_targets",
            ("master_order_fulfillment_brd",),
            [],
            lambda: order_targets(ready("master_order_fulfillment_brd")),
        ),
        (
            "master_inventory_material_with_targets",
            ("master_inventory_material", "master_woc"),
            [str(OVERSTOCK_WEEKS)],
            lambda: inventory_targets(ready("master_inventory_material"), ready("master_woc"), OVERSTOCK_WEEKS),
        ),
    ]


def _source_marks(
    spark: SparkSession, source: str, supporting: str | None, tables: Tables, file_format: str
) -> dict[str, str]:
    """What tells whether the files of each table have changed; a table that is absent has an empty mark."""
    found = {folder: fingerprints(spark, folder) for folder in {source, supporting or source}}
    folders = {name: (supporting or source) if CLEAN_TABLES[name].supporting else source for name in tables}
    return {name: found[folder].get(f"{name}.{file_format}", "") for name, folder in folders.items()}


def ingest(
    spark: SparkSession,
    raw: str,
    target: str,
    tables: Sequence[str] = tuple(CLEAN_TABLES),
    resolve: bool = True,
    canonical: bool = False,
    raw_format: str = "csv",
) -> Stages:
    """Raw ERP extracts (`<raw>/vbak.csv`, ...) to clean tables; extracts that are missing are skipped.

    `resolve` keeps the newest image per key, `canonical` repairs keys that lost their zeros.
    """
    raw_names = {clean: erp for erp, clean in TABLE_NAMES.items()}
    stages = Stages(spark, target, "parquet", suffix=".parquet")
    for table in tables:
        try:
            extract = read_table(spark, raw, raw_names[table], raw_format)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        stages.save({table: clean_table(extract, table, resolve, canonical)})
    return stages


def run_discovery(stages: Tables, target: str, today: dt.date) -> dict[str, str]:
    """Write the data discovery reports as CSV; returns report name -> path."""
    orders, inventory = stages["master_order_fulfillment_brd"], stages["master_inventory_material"]
    purchases = stages["master_purchase"]
    reports = {
        "discovery_missing_order": quality.missing_summary(orders),
        "discovery_missing_inventory": quality.missing_summary(inventory),
        "discovery_missing_purchase": quality.missing_summary(purchases),
        "discovery_describe_order": quality.describe(orders),
        "discovery_validity": quality.validity_checks(orders, inventory, today),
        "discovery_duplicates": quality.duplicate_checks(orders, inventory, purchases),
        "discovery_quantiles": quality.outlier_quantiles(orders),
        "discovery_materials": quality.material_overlap(orders, inventory),
        "order_summary_stats": quality.order_summary_stats(orders),
    }
    return _write_reports(reports, target)


def run_modelling(
    stages: Tables, workspace: Workspace, target: str, exclude_leaky: bool = False, category_length: int | None = None
) -> dict[str, str]:
    """Train and evaluate the classifiers, report lines at risk, forecast demand, size excess stock.

    Writes models, metrics (JSON) and reports (CSV) below `target`; returns name -> path. Features and
    scored rows are written to the workspace, since fits and evaluations scan them many times.
    """
    targets = stages["master_order_fulfillment_with_targets"]
    keys = [*ORDER_GRAIN, "material_number", "plant_code"]
    encoded = workspace.table(
        "encoded", lambda: encoded_features(targets, keys, exclude_leaky=exclude_leaky, category_length=category_length)
    )
    data = workspace.table("split", lambda: in_stable_order(stratified_split(encoded)))
    names = feature_names(exclude_leaky)
    logistic, logistic_scored = models.logistic_backorder(data, names)
    forest, forest_scored = models.forest_backorder(data, names)
    logistic_scored = workspace.table("logistic_scored", lambda df=logistic_scored: df)
    forest_scored = workspace.table("forest_scored", lambda df=forest_scored: df)
    fitted = {"backorder_logistic": logistic, "backorder_random_forest": forest}
    paths = {name: f"{target}/models/{name}" for name in fitted}
    for name, model in fitted.items():
        model.write().overwrite().save(paths[name])

    paths["classification_metrics"] = f"{target}/models/classification_metrics"
    scores = evaluate.classification_metrics(logistic_scored, "logistic_regression").unionByName(
        evaluate.classification_metrics(forest_scored, "random_forest")
    )
    write_json_rows(scores, paths["classification_metrics"])

    forecasts = forecast.demand_forecast(stages["shipment_history"])
    excess = forecast.excess_inventory(stages["master_woc"])
    paths["regression_metrics"] = f"{target}/models/regression_metrics"
    write_json_rows(forecast.forecast_excess_summary(forecasts, excess), paths["regression_metrics"])
    written = read_json_rows(workspace.spark, paths["classification_metrics"], scores.schema)
    reports = {
        "classification_feature_importance": models.feature_importance(forest, data, names),
        "confusion_matrix": evaluate.confusion_matrix(logistic_scored),
        "classification_report": evaluate.classification_report(logistic_scored),
        "at_risk": models.at_risk_report(models.scored(logistic, data), stages["master_woc"]),
        "demand_forecast": forecasts,
        "excess_inventory": excess,
        "model_comparison": evaluate.model_comparison(written),
    }
    return paths | _write_reports(reports, target)


def _write_reports(reports: Mapping[str, DataFrame], target: str) -> dict[str, str]:
    paths = {name: f"{target.rstrip('/')}/tables/{name}" for name in reports}
    for name, df in reports.items():
        write_report(df, paths[name])
    return paths


def register_views(stages: Tables) -> None:
    """The five discovery tables as temp views for ad-hoc SQL."""
    for view, table in VIEWS.items():
        if table in stages:
            stages[table].createOrReplaceTempView(view)
