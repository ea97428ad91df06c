"""The views on generated data hold what the operators are there for."""

from conftest import DATA
from pyspark.sql import functions as F

from orderwake import registry
from orderwake.sources.catalog import CLEAN_TABLES


def several(df, *keys):
    return df.groupBy(*keys).count().filter("count > 1").count()


def test_views_keep_every_row_and_have_several_per_group(spark):
    clean = registry.dataset(spark, DATA).clean
    raw = spark.read.parquet(f"{DATA}/lineitem.parquet")
    assert clean["sales_order_item"].count() == clean["purchase_order_item"].count() == raw.count()
    assert clean["delivery_item"].count() == raw.filter("l_linestatus = 'F'").count()
    item = ["client_id", "sales_document_number", "item_number"]
    assert several(clean["sales_order_item"], *item) and several(clean["sales_order_schedule_line"], *item)
    assert several(clean["delivery_item"], "client_id", "reference_document_number", "reference_item_number")
    assert several(clean["billing_document_item"], "client_id", "aubel", "aupos")
    assert several(clean["delivery_item"], "sales_document_number") and not several(clean["delivery_header"], "sales_document_number")
    for name in ("material_master", "customer_master", "material_description"):
        assert several(clean[name], *(k for k in CLEAN_TABLES[name].key if k != "language_code"))
    schedule = clean["sales_order_schedule_line"]
    assert schedule.filter(F.length("schedule_line_number") == 2).count() and schedule.filter("requested_delivery_date_schedule is null").count()
    assert clean["delivery_item"].filter("reference_document_number = 'unknown'").count()


def test_checks_have_something_to_count(spark):
    d = registry.dataset(spark, DATA)
    counts = {r[0]: r[1] for r in registry.duplicate_keys(d).collect()}
    assert counts["material_master"] and counts["customer_master"]
    assert {r[0]: r[1] for r in registry.duplicate_checks(d).collect()}["purchase"]
    assert {r[0]: r[1] for r in registry.validity_checks(d).collect()}["future_order_date"]
    assert registry.missing_summary_purchase(d).count()


def test_a_rewritten_folder_can_be_forgotten(spark):
    first = registry.dataset(spark, DATA + "/")
    assert registry.dataset(spark, DATA + "/") is first
    registry.forget(spark, DATA + "/")
    assert registry.dataset(spark, DATA + "/") is not first
