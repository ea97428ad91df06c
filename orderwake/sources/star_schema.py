"""Clean tables derived from a TPC-H-like star schema (region, nation, customer, supplier, part,
orders, lineitem), so that every query can be run on generated data.

`lineitem` repeats (l_orderkey, l_linenumber). Every row is an image of an order item, and a delivery,
billing, schedule or purchase item of its own, so order items have several of each. The rows, with their
supplier's region and their order's attributes, are written once per workspace; all document tables
are views on them and leave the choice of one row per order item to the masters. The views also hold
what real extracts hold: repeated images of dimensions, several texts per material, schedule lines
numbered without padding, references that are no number, and orders without a purchase header.
Regions and nations are tables of 5 and 25 rows by definition and get no skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import BROADCAST_BYTES, hot_keys, lookup_join, row_bytes
from .workspace import Workspace

CLIENT = "100"
LINE_KEY = ["l_orderkey", "l_linenumber"]
REFERENCE_OFFSET = 4_500_000_000


class StarSchema:
    """The clean tables of one generated data set; index by table name."""

    def __init__(self, spark: SparkSession, folder: str, workspace: Workspace):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.workspace = workspace
        self._schemas: dict[str, StructType] = {}

    def __getitem__(self, table: str) -> DataFrame:
        return getattr(self, f"_{table}")()

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {name: self[name] for name in names}

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    def lines(self) -> DataFrame:
        """All rows of lineitem, written on first use."""
        return self.workspace.table("lines", self._build_lines)

    def _build_lines(self) -> DataFrame:
        lines = over_all_cores(self.raw("lineitem"))
        nations = self.raw("nation").select("n_nationkey", "n_regionkey")
        regions = lookup_join(
            self.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")),
            nations,
            ["n_nationkey"],
        ).select("l_suppkey", "n_regionkey")
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority", "o_orderstatus"
        )
        keys = {"order": ["l_orderkey"], "supplier": ["l_suppkey"]}
        if row_bytes(regions) <= BROADCAST_BYTES:
            # Spark's own check would come after the lines are shuffled by supplier.
            regions = F.broadcast(regions)
            del keys["supplier"]
        hot = hot_keys(lines, **keys)
        lines = lookup_join(lines, orders, ["l_orderkey"], hot["order"], LINE_KEY)
        lines = lookup_join(lines, regions, ["l_suppkey"], hot.get("supplier"), LINE_KEY)
        return lines.drop("l_tax").withColumn("client_id", F.lit(CLIENT))

    def _line_keys(self) -> list[Column | str]:
        return [
            "client_id",
            _text("l_orderkey").alias("sales_document_number"),
            _text("l_linenumber").alias("item_number"),
        ]

    def _sales_order_header(self) -> DataFrame:
        return self.raw("orders").select(
            _client(),
            _text("o_orderkey").alias("sales_document_number"),
            _text("o_custkey").alias("customer_number"),
            F.col("o_orderdate").alias("order_date"),
            F.when(
                F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate") + F.expr("INTERVAL '30' DAY")
            ).alias("requested_delivery_date"),
            F.col("o_totalprice").alias("net_value"),
            F.lit("USD").alias("currency_code"),
            _missing("sales_organization"),
            F.substring("o_orderpriority", 1, 1).alias("distribution_channel"),
            _missing("division"),
        )

    def _sales_order_item(self) -> DataFrame:
        return self.lines().select(
            *self._line_keys(),
            _text("l_partkey").alias("material_number"),
            F.col("l_returnflag").alias("item_category"),
            F.col("l_quantity").alias("cumulative_order_quantity"),
            F.col("l_extendedprice").alias("net_value"),
            _text("n_regionkey").alias("plant_code"),
        )

    def _sales_order_schedule_line(self) -> DataFrame:
        urgent = self.lines().filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        place = F.col("l_suppkey") % 12 + 1
        return urgent.select(
            *self._line_keys(),
            place.cast("string").alias("schedule_line_number"),
            F.when(place != 1, F.col("l_shipdate")).alias("requested_delivery_date_schedule"),
            F.col("l_quantity").alias("requested_quantity"),
            F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("confirmed_quantity"),
        )

    def _shipped(self) -> DataFrame:
        return self.lines().filter("l_linestatus = 'F'")

    def _delivery_item(self) -> DataFrame:
        reference = (F.col("l_orderkey") + REFERENCE_OFFSET).cast("string")
        return self._shipped().select(
            "client_id",
            _delivery_number(),
            _text("l_linenumber").alias("item_number"),
            F.when(F.col("l_orderkey") % 97 != 0, reference).otherwise("unknown").alias("reference_document_number"),
            _text("l_linenumber").alias("reference_item_number"),
            _text("l_partkey").alias("material_number"),
            _text("n_regionkey").alias("plant_code"),
            F.col("l_quantity").alias("delivery_quantity"),
            F.when(F.col("l_partkey") % 53 == 0, 0.0)
            .when(F.col("l_returnflag") == "R", F.col("l_quantity") / 2)
            .otherwise(F.col("l_quantity"))
            .alias("quantity_delivered"),
        )

    def _delivery_header(self) -> DataFrame:
        """One delivery per order, issued with its first item."""
        return self._shipped().groupBy("client_id", _delivery_number()).agg(F.min("l_shipdate").alias("goods_issue_date"))

    def _billing_document_item(self) -> DataFrame:
        return (
            self.lines()
            .filter("l_returnflag <> 'N'")
            .select(
                "client_id",
                _text("l_orderkey").alias("aubel"),
                _text("l_linenumber").alias("aupos"),
                F.col("l_quantity").alias("billed_quantity"),
                (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_value"),
            )
        )

    def _sales_document_status_item(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "F", "C").when(F.col("o_orderstatus") == "P", "B")
        return self.lines().select(
            *self._line_keys(),
            status.when(F.col("o_orderstatus") == "O", "A").alias("delivery_status"),
            _missing("billing_status"),
            _missing("goods_movement_status"),
        )

    def _material_master(self) -> DataFrame:
        """Every tenth part has a second image."""
        brand = F.col("p_brand")
        images = F.when(F.col("p_partkey") % 10 == 0, F.array(brand, F.concat(F.lit("A-"), brand))).otherwise(F.array(brand))
        return self.raw("part").select(
            _client(),
            _text("p_partkey").alias("material_number"),
            F.col("p_type").alias("material_type"),
            F.explode(images).alias("material_group"),
            F.lit("EA").alias("base_unit_of_measure"),
        )

    def _material_description(self) -> DataFrame:
        """Two languages per part; the first one has a text for every fifth part only."""
        name = F.col("p_name")
        texts = F.array(
            F.struct(F.lit("A").alias("language"), F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("alt "), name)).alias("text")),
            F.struct(F.lit("E").alias("language"), name.alias("text")),
        )
        rows = self.raw("part").select(_client(), _text("p_partkey").alias("material_number"), F.explode(texts).alias("t"))
        return rows.select(
            "client_id",
            "material_number",
            F.col("t.language").alias("language_code"),
            F.col("t.text").alias("material_description_text"),
        )

    def _material_stock(self) -> DataFrame:
        # The region table has five rows by definition, so a list of its keys is a fixed size.
        regions = self.raw("region").agg(F.array_sort(F.collect_list("r_regionkey"))).scalar()
        # Each part makes ten rows, so even a small file is dealt out.
        parts = over_all_cores(self.raw("part").select("p_partkey", "p_size"))
        places = parts.select(
            "p_partkey", "p_size", F.explode(regions).alias("r_regionkey")
        ).select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("location"))
        units = (F.col("p_partkey") * 37 + F.col("r_regionkey") * 101 + F.col("location") * 53) % 40
        return places.select(
            _client(),
            _text("p_partkey").alias("material_number"),
            _text("r_regionkey").alias("plant_code"),
            _text("location").alias("storage_location"),
            F.when(F.col("p_size") % 3 != 0, units.cast("double")).alias("unrestricted_stock"),
        )

    def _plant(self) -> DataFrame:
        return self.raw("region").select(
            _client(), _text("r_regionkey").alias("plant_code"), F.col("r_name").alias("name_line_1")
        )

    def _customer_master(self) -> DataFrame:
        """Every tenth customer has a second image."""
        name = F.col("name_line_1")
        tenth = F.col("customer_number").cast("bigint") % 10 == 0
        images = F.when(tenth, F.array(name, F.concat(F.lit("Alias of "), name))).otherwise(F.array(name))
        customers = self._partners("customer", "c_custkey", "c_name", "c_nationkey", "customer_number")
        return customers.withColumn("name_line_1", F.explode(images))

    def _vendor_master(self) -> DataFrame:
        return self._partners("supplier", "s_suppkey", "s_name", "s_nationkey", "vendor_number")

    def _partners(self, table: str, key: str, name: str, nation: str, number: str) -> DataFrame:
        partners = self.raw(table).select(
            _client(), _text(key).alias(number), F.col(nation).alias("n_nationkey"), F.col(name).alias("name_line_1")
        )
        nations = self.raw("nation").select("n_nationkey", F.col("n_name").alias("country_code"))
        return lookup_join(partners, nations, ["n_nationkey"]).drop("n_nationkey")

    def _purchase_order_header(self) -> DataFrame:
        """One header per order; every fiftieth order has none."""
        per_order = self.lines().filter("l_orderkey % 50 <> 0").groupBy("client_id", "l_orderkey").agg(
            F.min("l_suppkey").alias("l_suppkey"), F.min("o_orderdate").alias("o_orderdate")
        )
        return per_order.select(
            "client_id",
            _text("l_orderkey").alias("purchase_order_number"),
            _text("l_suppkey").alias("vendor_number"),
            F.col("o_orderdate").alias("purchasing_document_date"),
        )

    def _purchase_order_item(self) -> DataFrame:
        return self.lines().select(
            "client_id",
            _text("l_orderkey").alias("purchase_order_number"),
            _text("l_linenumber").alias("purchase_order_item_number"),
            _text("l_partkey").alias("material_number"),
            F.col("l_quantity").alias("quantity"),
            F.when(F.col("l_quantity") != 0, F.col("l_extendedprice") / F.col("l_quantity")).alias("net_price"),
            F.col("l_extendedprice").alias("net_value"),
            _text("n_regionkey").alias("plant_code"),
        )


def over_all_cores(df: DataFrame) -> DataFrame:
    """A table that is stored in fewer pieces than there are cores is dealt out to all; a larger one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _client() -> Column:
    return F.lit(CLIENT).alias("client_id")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _missing(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _delivery_number() -> Column:
    return _text("l_orderkey").alias("sales_document_number")
