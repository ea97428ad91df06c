"""Distributed operators against brute force on small data."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderwake.operators import (
    duplicate_rows,
    first_per_key,
    hot_keys,
    latest_image,
    lookup_in_place,
    lookup_join,
    numeric_buckets,
    quantiles,
    running_totals,
    row_bytes,
)
from orderwake.operators.joins import sketch_size
from orderwake.operators.running import string_buckets


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, a sixth have none, and many rows are exact copies."""
    random.seed(7)
    data = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else (None if i % 6 == 1 else f"k{random.randrange(200)}")
        data.append((key, i % 5 if key == "hot" else i))
    return spark.createDataFrame(data, "k string, v int").repartition(16)


@pytest.fixture
def names(spark):
    data = [("hot", "H1"), ("hot", "H2"), (None, "N")] + [(f"k{i}", f"K{i}") for i in range(0, 200, 2)]
    return spark.createDataFrame(data, "k string, name string")


def test_hot_keys_finds_the_heavy_key_only(spark, skewed):
    found = hot_keys(skewed, looked_at=1.0, key=["k"])["key"]
    hot_hash = spark.sql("select xxhash64('hot')").first()[0]
    null_hash = spark.sql("select xxhash64(cast(null as string))").first()[0]
    assert set(found) == {hot_hash, null_hash}
    assert found[hot_hash] == math.ceil(2 * 8 / 3)


def test_the_sketch_follows_the_partition_count():
    for partitions in (8, 1_024, 4_000, 20_000):
        returned, tracked = sketch_size(partitions)
        assert returned >= partitions and tracked >= 16 * partitions
    assert sketch_size(10**6) == (100_000, 1_000_000)


def test_a_key_of_a_two_thousandth_is_spread_over_4000_partitions(spark):
    keyed = spark.range(200_000).select(F.when(F.col("id") % 2_000 == 0, -1).otherwise(F.col("id")).alias("k"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4000")
    try:
        found = hot_keys(keyed, looked_at=1.0, key=["k"])["key"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == {spark.sql("select xxhash64(cast(-1 as bigint))").first()[0]: 4}


def test_text_buckets_are_even_however_alike_the_values_begin(spark):
    values = spark.range(20_000).select(F.format_string("common beginning %07d", "id").alias("v"), F.lit(1).alias("one"))
    bucketed = string_buckets(values, "v", buckets=64)
    sizes = [r["count"] for r in bucketed.groupBy("_bucket").count().collect()]
    assert len(sizes) >= 50 and max(sizes) < 20 * 20_000 / 64
    totals = running_totals(bucketed, "v", {"number": "one"})
    assert totals.filter(F.substring("v", -7, 7).cast("int") + 1 != F.col("number")).count() == 0


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain_join(spark, rows, skewed, names, null_safe, how):
    hot = hot_keys(skewed, looked_at=1.0, key=["k"])["key"]
    plain = lookup_join(skewed, names, ["k"], None, null_safe=null_safe, how=how)
    spread = lookup_join(skewed, names, ["k"], hot, ["v"], null_safe=null_safe, how=how)
    assert spread.columns == ["k", "v", "name"]
    assert rows(spread) == rows(plain)


def test_hot_rows_are_spread_over_many_partitions(spark, skewed, names):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = hot_keys(skewed, looked_at=1.0, key=["k"])["key"]
        joined = lookup_join(skewed, names, ["k"], hot, ["v"]).filter("k = 'hot'")
        places = joined.select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert places >= 3


def test_lookup_join_keeps_the_left_columns(spark, rows):
    left = spark.createDataFrame([("a", 1)], "k string, x int")
    right = spark.createDataFrame([("a", 2, 3)], "k string, x int, y int")
    assert rows(lookup_join(left, right, ["k"])) == [("a", 1, 3)]


def test_lookup_join_refuses_keys_of_different_types(spark):
    left, right = spark.createDataFrame([("1",)], "k string"), spark.createDataFrame([(1,)], "k int")
    with pytest.raises(TypeError):
        lookup_join(left, right, ["k"])


def test_first_per_key_follows_the_stated_order(spark, rows):
    data = [("a", 2, None), ("a", 1, "y"), ("a", 1, "x"), (None, 5, "z"), (None, 4, "z")]
    df = spark.createDataFrame(data, "k string, n int, t string")
    assert rows(first_per_key(df, ["k"])) == [("a", 1, "x"), (None, 4, "z")]
    assert rows(first_per_key(df, ["k"], ["t"])) == [("a", 1, "x"), (None, 4, "z")]


def test_dedupe_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = first_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange")


def test_latest_image_drops_deleted_keys(spark, rows):
    data = [
        ("p1", "old", False, "2022-01-01"),
        ("p1", "new", False, "2022-02-01"),
        ("p2", "gone", True, "2022-02-01"),
        ("p2", "was", False, "2022-01-01"),
        ("p3", "undated", None, None),
        ("p3", "dated", False, "2021-01-01"),
    ]
    df = spark.createDataFrame(data, "k string, name string, is_deleted boolean, record_timestamp string")
    assert rows(latest_image(df, ["k"]), "k", "name") == [("p1", "new"), ("p3", "dated")]


def test_duplicate_rows_counts_null_keys(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "b"), ("a", None)], "x string, y string")
    assert rows(duplicate_rows(df, ["x", "y"], "t")) == [("t", 2)]
    assert rows(duplicate_rows(df.limit(0), ["x", "y"], "t")) == [("t", 0)]


@pytest.mark.parametrize("accuracy", [None, 4, 100])
def test_quantiles_are_exact_however_coarse_the_sketch(spark, accuracy):
    rng = np.random.default_rng(3)
    wide = rng.lognormal(0, 4, 5000)
    tied = np.where(np.arange(5000) % 3 == 0, 0.0, rng.integers(0, 50, 5000).astype(float))
    data = [(float(a), float(b), None, 7.0) for a, b in zip(wide, tied)]
    df = spark.createDataFrame(data, "wide double, tied double, empty double, same double").repartition(6)
    wanted = [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    found = {
        (r.column_name, r.probability): r.value
        for r in quantiles(df, ["wide", "tied", "empty", "same"], wanted, accuracy).collect()
    }
    assert {c for c, _ in found} == {"wide", "tied", "same"}
    for p in wanted:
        assert found["wide", p] == pytest.approx(np.quantile(wide, p), rel=1e-12)
        assert found["tied", p] == pytest.approx(np.quantile(tied, p), rel=1e-12)
        assert found["same", p] == 7.0


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "x double")
    assert quantiles(df, ["x"], [0.5]).collect() == []


@pytest.mark.parametrize("buckets", [2, 7, None])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_do_not_depend_on_the_buckets(spark, buckets, descending):
    data = [(float(i * i % 997), i % 4) for i in range(997)]
    df = spark.createDataFrame(data, "s double, n int").groupBy("s").agg(F.sum("n").alias("n"))
    got = {
        r.s: r.total
        for r in running_totals(numeric_buckets(df, "s", buckets=buckets), "s", {"total": "n"}, descending=descending).collect()
    }
    expected, total = {}, 0
    for r in sorted(df.collect(), key=lambda r: r.s, reverse=descending):
        total += r.n
        expected[r.s] = total
    assert got == expected


@pytest.mark.parametrize("spread", ["nothing", "homes", "homes and items"])
def test_lookup_in_place_agrees_with_two_joins(spark, rows, spread):
    """One home holds half the rows, and one item of it a third; documents of a home have headers of their own."""
    lines = [("h", "h1" if i % 2 else "h2", "i" if i % 3 else str(i % 40), i) for i in range(600)]
    lines += [(f"g{i % 50}", f"g{i % 50}", str(i % 7), i) for i in range(600)]
    lines += [(None, "h1", "i", 1), ("h", None, "i", 2), ("h", "h1", None, 3)]
    left = spark.createDataFrame([(*line[:3], f"{n}", line[3]) for n, line in enumerate(lines)], "home string, doc string, item string, number string, v int")
    facts = spark.createDataFrame(
        [("h", str(i), float(i)) for i in range(0, 40, 2)] + [("h", "i", -5.0), ("g3", "4", 7.0), (None, "i", 8.0), ("h", None, 9.0), ("g4", "1", None)],
        "home string, item string, total double",
    )
    headers = spark.createDataFrame(
        [("h", "h1", "one"), ("h", "h2", "two"), ("g3", "g3", "three"), (None, "h1", "nobody"), ("h", None, "nobody")], "home string, doc string, name string"
    )
    known = hot_keys(left, looked_at=1.0, home=["home"], item=["home", "item"])
    assert known["home"] and known["item"]
    hot = {"nothing": (None, None), "homes": (known["home"], None), "homes and items": (known["home"], known["item"])}[spread]
    found = lookup_in_place(left, facts, headers, ["home"], ["item"], ["home", "doc"], *hot, spread_by=["number"])
    expected = lookup_join(lookup_join(left, facts, ["home", "item"]), headers, ["home", "doc"])
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)
    assert found.filter("home = 'h' and item = 'i' and doc is not null").select(F.max("total"), F.count("name")).first() == (-5.0, 400)


def test_row_bytes_counts_texts_columns_and_rows(spark):
    df = spark.createDataFrame([("ab", 1), (None, None), ("\u00e4", 3)], "name string, n bigint")
    assert row_bytes(df) == 3 * (16 + 2 * 8) + 2 + 2
    assert row_bytes(df.limit(0)) == 0


def test_home_columns_that_repeat_the_key_are_left_out_and_come_back(spark, rows):
    left = [("a", "a", "1", "1"), ("b", "B", "2", "02"), (None, "=", "3", "3"), ("c", "c", "9", "9")]
    left = spark.createDataFrame(left, "doc string, home string, place string, item string")
    facts = spark.createDataFrame([("a", "1", 5), ("B", "02", 6), ("=", "3", 7), ("c", "8", 8)], "home string, place string, fact int")
    headers = spark.createDataFrame([("a", "a", "x"), ("b", "B", "y"), ("d", "d", "z")], "doc string, home string, told string")
    facts = facts.withColumnRenamed("place", "item")
    how = (left, facts, headers, ["home"], ["item"], ["doc"])
    expected = [(None, "=", "3", "3", 7, None), ("a", "a", "1", "1", 5, "x"), ("b", "B", "2", "02", 6, "y"), ("c", "c", "9", "9", None, None)]
    for repeats in (None, {"home": "doc"}, {"home": "doc", "item": "place"}):
        found = lookup_in_place(*how, repeats=repeats)
        assert rows(found, "doc", "home", "place", "item", "fact", "told") == sorted(expected, key=repr)
