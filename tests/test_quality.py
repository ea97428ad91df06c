"""Data discovery on small hand-made tables."""

import datetime as dt

import pytest

from orderwake.plans import quality


def test_missing_summary(spark):
    df = spark.createDataFrame([("", None, 1), ("x", None, None), ("y", None, 2)], "t string, d date, n int")
    found = [tuple(r) for r in quality.missing_summary(df).collect()]
    assert found == [("d", 3, 100.0), ("n", 1, 33.3), ("t", 1, 33.3)]
    assert quality.missing_summary(df, blank_is_missing=False).count() == 2


def test_describe(spark):
    data = [(float(v), "a") for v in (1, 2, 3, 4, 100)]
    found = quality.describe(spark.createDataFrame(data, "v double, t string")).first()
    assert found.column_name == "v" and found.n == 5
    assert (found["mean"], found["min"], found.p25, found.p50, found.p75, found["max"]) == (22.0, 1.0, 2.0, 3.0, 4.0, 100.0)
    assert found["std"] == pytest.approx(43.617656)
    assert found["skew"] == pytest.approx(2.232396, abs=1e-5)


def test_shortfall_is_clipped(spark):
    orders = spark.createDataFrame(
        [(10.0, 4.0, 1.0), (-2.0, None, None), (3.0, 5.0, 2.0)],
        "cumulative_order_quantity double, total_quantity_delivered double, net_value double",
    )
    found = {r.column_name: r for r in quality.order_summary_stats(orders).collect()}
    assert found["order_qty"]["min"] == -2.0
    assert (found["shortfall"]["min"], found["shortfall"]["max"]) == (0.0, 6.0)
    assert found["net_value"].n == 2


def test_winsorize_caps_the_upper_end_and_keeps_missing_values(spark, rows):
    df = spark.createDataFrame([(float(i), None) for i in range(101)] + [(None, None)], "v double, w double")
    found = rows(quality.winsorize(df, ["v", "w"]))
    assert max(v for v, _ in found if v is not None) == 99.0
    assert sum(v is None for v, _ in found) == 1
    assert all(w is None for _, w in found)


def test_validity_checks(spark, rows):
    orders = spark.createDataFrame(
        [("-1", "x", "2024-06-01"), ("2", "-3", "2024-05-10"), (None, None, "bad")],
        "cumulative_order_quantity string, total_delivery_quantity string, order_date string",
    )
    stock = spark.createDataFrame([(-1.0,), (None,)], "unrestricted_stock double")
    assert rows(quality.validity_checks(orders, stock, dt.date(2024, 5, 10))) == [
        ("future_order_date", 1),
        ("negative_delivery_quantity", 1),
        ("negative_order_quantity", 1),
        ("negative_stock", 1),
    ]


def test_material_overlap(spark):
    orders = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "material_number string")
    stock = spark.createDataFrame([("b",), ("c",), ("d",), (None,)], "material_number string")
    assert tuple(quality.material_overlap(orders, stock).first()) == (2, 3, 1, 1, 2)


def test_reference_collisions(spark, rows):
    df = spark.createDataFrame([("51",), ("4500000051",), ("51",), ("7",), ("x",), ("y",)], "sales_document_number string")
    assert rows(quality.reference_collisions(df)) == [("51", 2)]


def test_feature_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 1.0), (3.0, 6.0, 2.0)], "a double, b double, c double")
    found = {(r.left_column, r.right_column): r.correlation for r in quality.feature_correlation(df, ["a", "b", "c"]).collect()}
    assert found["a", "b"] == pytest.approx(1.0)
    assert found["a", "c"] == pytest.approx(-0.5)
