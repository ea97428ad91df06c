"""Master tables: order fulfilment, inventory by material, purchasing.

Each fact is brought to its grain and each right-hand side to one row per key before they meet, so
a join cannot multiply rows that a later step would have to remove again. Where a column exists on
both the fact and the dimension, the fact's column is kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical_item, folded_document, number, range_table, sum_or_zero, text_key, whole_number
from ..operators import HotKeys, first_per_key, hot_keys, lookup_in_place, lookup_join
from ..operators.dedupe import RECORD_TIMESTAMP

Tables = Mapping[str, DataFrame]
Rule = int | DataFrame | None

DOCUMENT = ["client_id", "sales_document_number"]
ORDER_GRAIN = [*DOCUMENT, "item_number"]
MATERIAL = ["client_id", "material_number"]
REFERENCE = ["client_id", "_doc", "_item"]
HOME = ["client_id", "_home"]

# Columns and column order of the three masters, and what each dimension contributes.
ORDER_COLUMNS = [
    "client_id",
    "sales_document_number",
    "item_number",
    "material_number",
    "material_description",
    "material_description_text",
    "material_type",
    "material_group",
    "product_hierarchy",
    "item_category",
    "customer_number",
    "customer_name",
    "country_code",
    "order_date",
    "requested_delivery_date",
    "requested_delivery_date_schedule",
    "cumulative_order_quantity",
    "cumulative_confirmed_quantity",
    "total_requested_quantity",
    "total_confirmed_quantity",
    "total_delivery_quantity",
    "total_quantity_delivered",
    "total_billed_quantity",
    "total_billed_value",
    "net_value",
    "order_header_net_value",
    "currency_code",
    "base_unit_of_measure",
    "sales_unit",
    "sales_organization",
    "distribution_channel",
    "division",
    "plant_code",
    "storage_location",
    "delivery_status",
    "billing_status",
    "goods_movement_status",
]
INVENTORY_COLUMNS = [
    "client_id",
    "material_number",
    "material_description_text",
    "material_type",
    "material_group",
    "plant_code",
    "plant_name",
    "storage_location",
    "unrestricted_stock",
    "returns",
    "stock_in_quality_inspection",
    "restricted_use_stock",
    "blocked_stock",
    "base_unit_of_measure",
    "country_code",
]
PURCHASE_COLUMNS = [
    "client_id",
    "purchase_order_number",
    "purchase_order_item_number",
    "material_number",
    "material_type",
    "material_group",
    "vendor_number",
    "vendor_name",
    "country_code",
    "quantity",
    "base_unit_of_measure",
    "net_price",
    "net_value",
    "purchasing_document_date",
    "currency_code",
    "company_code",
    "plant_code",
]
HEADER_ATTRIBUTES = [
    "customer_number",
    "order_date",
    "requested_delivery_date",
    "net_value",
    "currency_code",
    "sales_organization",
    "distribution_channel",
    "division",
]
MATERIAL_ATTRIBUTES = ["material_type", "material_group", "base_unit_of_measure"]
STATUS_ATTRIBUTES = ["delivery_status", "billing_status", "goods_movement_status"]


def existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that the table has, in the listed order."""
    return df.select(*(c for c in columns if c in df.columns))


def with_text_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({k: text_key(df[k]) for k in keys if k in df.columns})


def _with_timestamp(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return existing(df, [*columns, RECORD_TIMESTAMP])


def _one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys).drop(RECORD_TIMESTAMP)


def _with_document(df: DataFrame, document: str, rule: Rule) -> DataFrame:
    # The number is parsed in a step of its own, since folding it uses it several times.
    df = df.withColumn("_number", whole_number(F.col(document)))
    if isinstance(rule, DataFrame):
        listed = df.withColumn("_ranges", range_table(rule))
        return listed.withColumn("_doc", folded_document(F.col("_number"), ranges=F.col("_ranges"))).drop("_ranges")
    return df.withColumn("_doc", folded_document(F.col("_number"), rule))


def _with_home(df: DataFrame, document: str, rule: Rule) -> DataFrame:
    """Add `_home`: the canonical document, or a text of its own for each document that is no number."""
    unnumbered = F.concat(F.lit("="), F.col(document))
    home = F.when(F.col("_number").isNotNull(), F.col("_doc")).otherwise(unnumbered)
    return _with_document(df, document, rule).withColumn("_home", home).drop("_number", "_doc")


def _with_own_reference(items: DataFrame, rule: Rule) -> DataFrame:
    return _with_home(items, "sales_document_number", rule).withColumn("_item", canonical_item(F.col("item_number")))


def _referring(df: DataFrame, document: str, item: str, totals: Mapping[str, str], rule: Rule) -> DataFrame:
    """Client, canonical order item and measures (missing ones as zero) of the rows that refer to an order number."""
    df = df.withColumn("client_id", F.col("client_id").cast("string")).withColumn("_item", canonical_item(F.col(item)))
    referring = _with_document(df, document, rule).filter("_number is not null")
    measures = (F.coalesce(number(referring, source), F.lit(0.0)).alias(name) for name, source in totals.items())
    return referring.select(*REFERENCE, *measures)


def _deliveries(delivery_item: DataFrame, rule: Rule) -> DataFrame:
    totals = {"total_delivery_quantity": "delivery_quantity", "total_quantity_delivered": "quantity_delivered"}
    return _referring(delivery_item, "reference_document_number", "reference_item_number", totals, rule)


def _bills(billing_item: DataFrame, rule: Rule) -> DataFrame:
    totals = {"total_billed_quantity": "billed_quantity", "total_billed_value": "net_value"}
    return _referring(billing_item, "aubel", "aupos", totals, rule)


def _sums_by_reference(df: DataFrame) -> DataFrame:
    return df.groupBy(*REFERENCE).agg(*(F.sum(c).alias(c) for c in df.columns if c not in REFERENCE))


def delivery_totals(delivery_item: DataFrame, rule: Rule = None) -> DataFrame:
    """Sums per client and canonical order item; rows that refer to no order number are left out."""
    return _sums_by_reference(_deliveries(delivery_item, rule))


def billing_totals(billing_item: DataFrame, rule: Rule = None) -> DataFrame:
    """Sums per client and canonical order item; rows that refer to no order number are left out."""
    return _sums_by_reference(_bills(billing_item, rule))


def moved_totals(delivery_item: DataFrame, billing_item: DataFrame, rule: Rule = None) -> DataFrame:
    """Delivered and billed sums in one aggregation; an order item without a row of a kind has NULL sums of that kind."""
    return _sums_by_reference(_deliveries(delivery_item, rule).unionByName(_bills(billing_item, rule), allowMissingColumns=True))


def _first_known(df: DataFrame, column: str, order_by: Sequence[str]) -> Column:
    """The first known value of a column in a group, in the order of those columns that exist."""
    order_by = [c for c in order_by if c in df.columns]
    if not order_by:
        return F.min(column).alias(column)
    ranked = F.struct(*order_by, F.col(column))
    return F.min(F.when(F.col(column).isNotNull(), ranked))[column].alias(column)


def schedule_totals(schedule: DataFrame) -> DataFrame:
    """Per order item: the first known requested date and the quantities of all schedule lines.

    First means in the order of schedule line number (by value, text that is no number last), record
    timestamp and date, as far as present.
    """
    keyed = with_text_keys(schedule, ORDER_GRAIN)
    order = ["schedule_line_number", RECORD_TIMESTAMP]
    if "schedule_line_number" in keyed.columns:
        line = canonical_item(F.col("schedule_line_number")).try_cast("bigint")
        keyed = keyed.withColumns({"_unnumbered": line.isNull(), "_line": line})
        order = ["_unnumbered", "_line", *order]
    return keyed.groupBy(*ORDER_GRAIN).agg(
        _first_known(keyed, "requested_delivery_date_schedule", order),
        sum_or_zero(number(keyed, "requested_quantity")).alias("total_requested_quantity"),
        sum_or_zero(number(keyed, "confirmed_quantity")).alias("total_confirmed_quantity"),
    )


def first_description(description: DataFrame, text_keys: bool = False) -> DataFrame:
    """First known text per material, by language, record timestamp and text, as far as present."""
    known = description.na.drop(subset=MATERIAL)
    known = with_text_keys(known, MATERIAL) if text_keys else known
    text = _first_known(known, "material_description_text", ["language_code", RECORD_TIMESTAMP])
    return known.groupBy(*MATERIAL).agg(text)


def materials(material_master: DataFrame, text_keys: bool = False) -> DataFrame:
    """Attributes per material, one row per (client, material)."""
    listed = _with_timestamp(material_master, [*MATERIAL, *MATERIAL_ATTRIBUTES])
    return _one_per_key(with_text_keys(listed, MATERIAL) if text_keys else listed, MATERIAL)


def _headers(header: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per order with the customer's name and country; headers are far fewer than lines."""
    key = ["client_id", "customer_number"]
    header = with_text_keys(_with_timestamp(header, [*DOCUMENT, *HEADER_ATTRIBUTES]), DOCUMENT)
    hot = hot_keys(header, customer=key)["customer"]
    header = _one_per_key(header, DOCUMENT).withColumnRenamed("net_value", "order_header_net_value")
    named = _with_timestamp(customer, [*key, "country_code", "name_line_1"])
    named = with_text_keys(named.withColumnRenamed("name_line_1", "customer_name"), key)
    return lookup_join(header, _one_per_key(named, key), key, hot, DOCUMENT)


def hot_order_keys(tables: Tables, rule: Rule = None) -> dict[str, HotKeys]:
    """Documents, references and materials with many order items."""
    keyed = with_text_keys(tables["sales_order_item"], ORDER_GRAIN)
    return hot_keys(_with_own_reference(keyed, rule), document=HOME, reference=[*HOME, "_item"], material=MATERIAL)


def order_fulfillment(
    tables: Tables,
    document_modulus: int | None = None,
    document_ranges: DataFrame | None = None,
    hot: Mapping[str, HotKeys] | None = None,
    by_material: Sequence[DataFrame] = (),
) -> DataFrame:
    """One row per sales order item with header, delivery, billing, schedule, material, customer and status.

    Deliveries and billing refer to orders by the declared number ranges, by `document_ranges` (rows of `first` and
    `size`) if given, or by the remainder of document numbers with `document_modulus`. `hot` are the keys of
    `hot_order_keys`, if they are known already. Tables `by_material`, of one row per client and material, are looked up
    with the material's attributes; their other columns follow those of the orders.
    """
    rule = document_modulus if document_ranges is None else document_ranges
    keyed = with_text_keys(tables["sales_order_item"], ORDER_GRAIN)
    hot = hot_order_keys(tables, rule) if hot is None else hot
    items = existing(_one_per_key(keyed, ORDER_GRAIN), ORDER_COLUMNS)

    # Same keys as the line-up above: these two need no further shuffle of the items.
    status = _with_timestamp(tables["sales_document_status_item"], [*ORDER_GRAIN, *STATUS_ATTRIBUTES])
    items = lookup_join(items, schedule_totals(tables["sales_order_schedule_line"]), ORDER_GRAIN)
    items = lookup_join(items, _one_per_key(with_text_keys(status, ORDER_GRAIN), ORDER_GRAIN), ORDER_GRAIN)

    # Materials come before the header, whose columns make the rows wide: only one shuffle carries them all.
    described = [
        materials(tables["material_master"], text_keys=True),
        first_description(tables["material_description"], text_keys=True),
    ]
    # The right-hand keys of the attributes are never NULL, those of stock may be.
    items = lookup_join(items, [*described, *by_material], MATERIAL, hot["material"], ORDER_GRAIN, null_safe=True)

    # Headers, deliveries and billing meet the items of a document in one place.
    header = _with_home(_headers(tables["sales_order_header"], tables["customer_master"]), "sales_document_number", rule)
    moved = moved_totals(tables["delivery_item"], tables["billing_document_item"], rule).withColumnRenamed("_doc", "_home")
    own = {"_home": "sales_document_number", "_item": "item_number"}
    items = lookup_in_place(
        _with_own_reference(items, rule), moved, header, HOME, ["_item"], DOCUMENT, hot["document"], hot["reference"], ORDER_GRAIN, own
    )
    found = (c for df in by_material for c in df.columns if c not in MATERIAL)
    return existing(items, [*ORDER_COLUMNS, *found])


def inventory_material(tables: Tables) -> DataFrame:
    """One row per stock row with material, description and plant.

    The plant table is joined as it is: an unresolved change log repeats stock rows.
    """
    stock = tables["material_stock"]
    place = ["client_id", "plant_code"]
    grain = [c for c in (*MATERIAL, "plant_code", "storage_location") if c in stock.columns]
    hot = hot_keys(stock, material=MATERIAL, plant=place)
    described = [materials(tables["material_master"]), first_description(tables["material_description"])]
    stock = lookup_join(stock, described, MATERIAL, hot["material"], grain, null_safe=True)
    plants = existing(tables["plant"], [*place, "name_line_1", "country_code"])
    plants = plants.withColumnRenamed("name_line_1", "plant_name")
    stock = lookup_join(stock, plants, place, hot["plant"], grain, null_safe=True)
    return existing(stock, INVENTORY_COLUMNS)


def purchase(tables: Tables) -> DataFrame:
    """One row per purchase order item with header, vendor and material.

    Vendors are looked up once per header. Header and vendor are joined as they are and may repeat
    rows if their keys are not unique.
    """
    items, header = tables["purchase_order_item"], tables["purchase_order_header"]
    order, vendor_key = ["client_id", "purchase_order_number"], ["client_id", "vendor_number"]
    vendor = existing(tables["vendor_master"], [*vendor_key, "name_line_1", "country_code"])
    vendor = vendor.withColumnRenamed("name_line_1", "vendor_name")
    header = existing(header, [*order, "vendor_number", "purchasing_document_date", "currency_code"])
    grain = [*order, "purchase_order_item_number"]
    hot = hot_keys(items, order=order, material=MATERIAL)

    if "vendor_number" in items.columns:
        items = lookup_join(items, header, order, hot["order"], grain, null_safe=True)
        hot_vendor = hot_keys(tables["purchase_order_item"], vendor=vendor_key)["vendor"]
        items = lookup_join(items, vendor, vendor_key, hot_vendor, grain, null_safe=True)
    else:
        hot_vendor = hot_keys(header, vendor=vendor_key)["vendor"]
        header = lookup_join(header, vendor, vendor_key, hot_vendor, order, null_safe=True)
        items = lookup_join(items, header, order, hot["order"], grain, null_safe=True)
    attributes = materials(tables["material_master"])
    items = lookup_join(items, attributes, MATERIAL, hot["material"], grain, null_safe=True)
    return existing(items, PURCHASE_COLUMNS)
