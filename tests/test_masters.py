"""Masters on small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from orderwake.operators import hot_keys, latest_image
from orderwake.plans import masters
from orderwake.sources.catalog import CLEAN_TABLES


@pytest.fixture
def tables(spark):
    """Empty clean tables, filled per test by column name."""

    class Tables(dict):
        def fill(self, table, *records):
            schema = CLEAN_TABLES[table].schema
            extra = sorted({k for r in records for k in r} - set(schema.names))
            full = [tuple(r.get(c) for c in [*schema.names, *extra]) for r in records]
            kinds = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in schema] + [f"{c} string" for c in extra])
            self[table] = spark.createDataFrame(full, kinds)
            return self

    empty = Tables()
    for name, table in CLEAN_TABLES.items():
        empty[name] = spark.createDataFrame([], table.schema)
    return empty


def item(doc="1", number="10", material="M", **more):
    return dict(client_id="100", sales_document_number=doc, item_number=number, material_number=material, **more)


def test_group_of_missing_quantities_sums_to_zero(tables, rows):
    tables.fill(
        "delivery_item",
        dict(client_id="100", reference_document_number="4500000051", reference_item_number="000010"),
        dict(client_id="100", reference_document_number="52", reference_item_number="x", quantity_delivered=2.0),
        dict(client_id="100", reference_document_number="abc", reference_item_number="1", quantity_delivered=9.0),
    )
    assert rows(masters.delivery_totals(tables["delivery_item"])) == [
        ("100", "51", "10", 0.0, 0.0),
        ("100", "52", "", 0.0, 2.0),
    ]


def test_deliveries_and_billing_match_over_notations(tables, rows):
    tables.fill("sales_order_item", item(" 51 ", "10"), item("77", "10"))
    tables.fill(
        "delivery_item",
        dict(client_id="100", reference_document_number="4500000051", reference_item_number="000010", quantity_delivered=3.0),
        dict(client_id="100", reference_document_number="51", reference_item_number="10.0", quantity_delivered=4.0),
    )
    tables.fill("billing_document_item", dict(client_id="100", aubel="51", aupos="10", billed_quantity=2.0, net_value=8.0))
    found = rows(
        masters.order_fulfillment(tables),
        "sales_document_number",
        "total_quantity_delivered",
        "total_billed_quantity",
        "total_billed_value",
    )
    assert found == [("51", 7.0, 2.0, 8.0), ("77", None, None, None)]


def test_schedule_takes_the_first_known_date(tables, rows, day):
    key = dict(client_id="100", sales_document_number="1", item_number="10")
    tables.fill(
        "sales_order_schedule_line",
        dict(key, schedule_line_number="1", requested_quantity=1.0),
        dict(key, schedule_line_number="2", requested_quantity=2.0, requested_delivery_date_schedule=day("2024-05-02")),
        dict(key, schedule_line_number="3", confirmed_quantity=5.0, requested_delivery_date_schedule=day("2024-05-01")),
    )
    assert rows(masters.schedule_totals(tables["sales_order_schedule_line"])) == [
        ("100", "1", "10", day("2024-05-02"), 3.0, 5.0)
    ]


def test_schedule_lines_are_ordered_by_number(tables, rows, day):
    key = dict(client_id="100", sales_document_number="1", item_number="10")
    tables.fill(
        "sales_order_schedule_line",
        dict(key, schedule_line_number="x", requested_delivery_date_schedule=day("2024-01-01")),
        dict(key, schedule_line_number="10", requested_delivery_date_schedule=day("2024-03-03")),
        dict(key, schedule_line_number="2", requested_delivery_date_schedule=day("2024-01-02")),
        dict(key, schedule_line_number="0001"),
    )
    assert rows(masters.schedule_totals(tables["sales_order_schedule_line"])) == [("100", "1", "10", day("2024-01-02"), 0.0, 0.0)]


def test_document_modulus_is_an_option(tables, rows):
    tables.fill("sales_order_item", item("100000051", "10"))
    tables.fill(
        "delivery_item",
        dict(client_id="100", reference_document_number="51", reference_item_number="10", quantity_delivered=3.0),
    )
    found = lambda **how: rows(masters.order_fulfillment(tables, **how), "total_quantity_delivered")
    assert found() == [(None,)] and found(document_modulus=100_000_000) == [(3.0,)]


def test_description_skips_missing_texts_and_keys(tables, rows):
    tables.fill(
        "material_description",
        dict(client_id="100", material_number="M", language_code="D"),
        dict(client_id="100", material_number="M", language_code="E", material_description_text="bolt"),
        dict(client_id="100", material_number="M", language_code="F", material_description_text="boulon"),
        dict(client_id="100", material_number="N", language_code="E"),
        dict(client_id="100", material_number=None, language_code="E", material_description_text="nobody"),
    )
    assert rows(masters.first_description(tables["material_description"])) == [("100", "M", "bolt"), ("100", "N", None)]


def test_order_grain_is_unique_and_follows_the_first_row(tables, rows):
    tables.fill(
        "sales_order_item",
        item(cumulative_order_quantity=9.0, record_timestamp="2024-01-02"),
        item(cumulative_order_quantity=5.0, record_timestamp="2024-01-01"),
        item(number="20"),
    )
    header = dict(client_id="100", sales_document_number="1")
    tables.fill("sales_order_header", dict(header, customer_number="C2"), dict(header, customer_number="C1"))
    tables.fill(
        "customer_master",
        dict(client_id="100", customer_number="C1", name_line_1="One", country_code="DE"),
        dict(client_id="100", customer_number="C1 ", name_line_1="Other", country_code="US"),
    )
    found = masters.order_fulfillment(tables)
    picked = rows(found, "item_number", "cumulative_order_quantity", "customer_number", "customer_name")
    assert picked == [("10", 5.0, "C1", "One"), ("20", None, "C1", "One")]
    assert "record_timestamp" not in found.columns


def test_a_column_on_both_sides_is_taken_from_the_line(tables, rows):
    tables.fill("sales_order_item", item(currency_code="EUR", material_group="G1"))
    tables.fill("sales_order_header", dict(client_id="100", sales_document_number="1", currency_code="USD", net_value=5.0))
    tables.fill(
        "material_master",
        dict(client_id="100", material_number="M", material_group="G2", material_type="FERT"),
    )
    found = masters.order_fulfillment(tables)
    assert rows(found, "currency_code", "material_group", "material_type", "order_header_net_value") == [
        ("EUR", "G1", "FERT", 5.0)
    ]


def test_missing_keys_match_each_other_in_stock_joins(tables, rows):
    tables.fill("material_stock", dict(client_id="100", plant_code="1", unrestricted_stock=1.0))
    tables.fill("material_master", dict(client_id="100", material_type="ROH"))
    tables.fill("plant", dict(client_id="100", plant_code="1", name_line_1="Werk", country_code="DE"))
    found = masters.inventory_material(tables)
    assert rows(found, "material_number", "material_type", "plant_name", "country_code") == [(None, "ROH", "Werk", "DE")]


def test_unresolved_plants_repeat_stock_rows_and_resolved_ones_do_not(tables, rows):
    tables.fill("material_stock", dict(client_id="100", material_number="M", plant_code="1", unrestricted_stock=4.0))
    images = [
        dict(client_id="100", plant_code="1", name_line_1=f"n{i}", record_timestamp=f"2022-01-0{i}", is_deleted="False")
        for i in range(1, 6)
    ]
    tables.fill("plant", *images)
    assert masters.inventory_material(tables).count() == 5
    tables["plant"] = latest_image(tables["plant"], ["client_id", "plant_code"])
    assert rows(masters.inventory_material(tables), "plant_name", "unrestricted_stock") == [("n5", 4.0)]


def test_purchase_keeps_the_line_columns_and_repeats_for_repeated_headers(tables, rows):
    tables.fill(
        "purchase_order_item",
        dict(client_id="100", purchase_order_number="7", purchase_order_item_number="1", currency_code="EUR", quantity=2.0),
        dict(client_id="100", purchase_order_number="8", purchase_order_item_number="1", currency_code="EUR"),
    )
    tables.fill(
        "purchase_order_header",
        dict(client_id="100", purchase_order_number="7", vendor_number="V", currency_code="USD"),
        dict(client_id="100", purchase_order_number="7", vendor_number=None, currency_code="USD"),
    )
    tables.fill(
        "vendor_master",
        dict(client_id="100", vendor_number="V", name_line_1="Vendor", country_code="FR"),
        dict(client_id="100", vendor_number=None, name_line_1="Nobody"),
    )
    found = rows(masters.purchase(tables), "purchase_order_number", "vendor_number", "vendor_name", "currency_code")
    assert found == [("7", "V", "Vendor", "EUR"), ("7", None, "Nobody", "EUR"), ("8", None, None, "EUR")]


def test_order_columns_come_in_the_declared_order(tables):
    tables.fill("sales_order_item", item())
    found = masters.order_fulfillment(tables).columns
    assert found == masters.ORDER_COLUMNS


def test_result_does_not_depend_on_partitions_or_row_order(spark, tables, rows):
    records = [item(str(i % 40), str(i % 3), f"M{i % 5}", cumulative_order_quantity=float(i)) for i in range(400)]
    tables.fill("sales_order_item", *records)
    expected = rows(masters.order_fulfillment(tables))
    tables["sales_order_item"] = tables["sales_order_item"].orderBy(F.rand(5)).repartition(13)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert rows(masters.order_fulfillment(tables)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_hot_documents_materials_and_customers_change_nothing(tables, rows, monkeypatch):
    """A third of the lines in one order, a third with one material, a third of the orders from one customer."""
    lines = [
        item("1" if i % 3 == 0 else str(i // 4), str(i), "HOT" if i % 3 == 1 else f"M{i % 50}", cumulative_order_quantity=float(i))
        for i in range(3000)
    ]
    tables.fill("sales_order_item", *lines, *lines[:900])
    headers = [
        dict(client_id="100", sales_document_number=str(i), customer_number="C0" if i % 3 else f"C{i % 9}") for i in range(750)
    ]
    tables.fill("sales_order_header", *headers)
    tables.fill("customer_master", *(dict(client_id="100", customer_number=f"C{i}", name_line_1=f"n{i}") for i in range(9)))
    tables.fill("material_master", *(dict(client_id="100", material_number=m, material_type=m) for m in ("HOT", "M1", "M2")))
    moved = [
        dict(client_id="100", reference_document_number=str(4500000000 + i % 500), reference_item_number=str(i), quantity_delivered=1.0)
        for i in range(2000)
    ]
    tables.fill("delivery_item", *moved)

    spread = []

    def look_at_everything(df, **keys):
        found = hot_keys(df, looked_at=1.0, **keys)
        spread.extend(name for name, hot in found.items() if hot)
        return found

    monkeypatch.setattr(masters, "hot_keys", look_at_everything)
    with_hot_keys = rows(masters.order_fulfillment(tables))
    assert set(spread) == {"document", "material", "customer"}
    monkeypatch.setattr(masters, "hot_keys", lambda df, **keys: {name: {} for name in keys})
    assert with_hot_keys == rows(masters.order_fulfillment(tables))
    assert len(with_hot_keys) == 3000


@pytest.mark.parametrize("looked", [True, False])
def test_one_document_with_many_notations_of_one_item(tables, rows, monkeypatch, looked):
    """A third of the lines are one canonical item of one order, another third unnumbered items of it."""
    same = [item("7", "0" * i + "1", cumulative_order_quantity=float(i)) for i in range(300)]
    unnumbered = [item("4500000007", f"x{i}") for i in range(300)]
    other = [item(str(i), "1") for i in range(8, 308)]
    tables.fill("sales_order_item", *same, *unnumbered, *other, item("text", "1"), item("", ""))
    header = lambda doc, value: dict(client_id="100", sales_document_number=doc, net_value=value)
    tables.fill("sales_order_header", header("7", 1.0), header("4500000007", 2.0), header("text", 3.0), header("9", 4.0))
    moved = lambda doc, n, q: dict(client_id="100", reference_document_number=doc, reference_item_number=n, quantity_delivered=q)
    tables.fill("delivery_item", moved("7", "1", 5.0), moved("4500000007", "01", 6.0), moved("7", "y", 7.0), moved("8", "1", None), moved("text", "1", 9.0))
    tables.fill("billing_document_item", dict(client_id="100", aubel="9", aupos="1", billed_quantity=2.0))
    seen = lambda df, **keys: hot_keys(df, looked_at=1.0, **keys) if looked else {name: {} for name in keys}
    monkeypatch.setattr(masters, "hot_keys", seen)
    found = masters.order_fulfillment(tables).groupBy(
        "order_header_net_value", "total_quantity_delivered", "total_billed_quantity", "total_billed_value"
    ).count()
    assert rows(found) == sorted(
        [(1.0, 11.0, None, None, 300), (2.0, 7.0, None, None, 300), (3.0, None, None, None, 1), (4.0, None, 2.0, 0.0, 1), (None, 0.0, None, None, 1), (None, None, None, None, 299)],
        key=repr,
    )
