"""Steps whose memory, shuffles or time used to grow faster than their tables."""

import datetime as dt
import os
import random
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from orderwake import registry
from orderwake.functions import keys
from orderwake.operators import counted_in_ranges
from orderwake.plans import forecast, models
from orderwake.plans.features import LABEL
from orderwake.plans.metrics import SERIES
from orderwake.sources import sinks, workspace


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_more_ranges_than_an_array_may_hold(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(keys, "MOST_RANGES", 3)
    suppliers = [(n,) for n in range(1, 9)]
    spark.createDataFrame([*suppliers, (None,)], "s_suppkey bigint").write.parquet(str(tmp_path / "supplier.parquet"))
    lines = [(5, 1), (5, 8), (6, 3), (6, 3), (None, 2), (7, None), (7, 9)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_suppkey bigint").write.parquet(str(tmp_path / "lineitem.parquet"))
    found = registry.runner(registry.folded_by_range_table)
    beyond = str(7_000_000_000 + 9 * 50_000_000 + 7)
    assert rows(found(spark, str(tmp_path)), "canonical", "n_lines") == sorted([("", 2), ("5", 2), ("6", 2), (beyond, 1)])


def test_ranges_by_buckets_agree_with_brute_force(spark):
    random.seed(3)
    big = 2**60
    ranges = [(random.randrange(50_000), random.choice((0, 1, 3, 400))) for _ in range(600)] + [(big, 10), (big + 5, 2), (7, 3), (7, 9), (None, 4), (80, None)]
    numbers = [random.randrange(-500, 60_000) for _ in range(4_000)] + [big - 1, big, big + 4, big + 6, big + 7, big + 9, None, None]
    found = counted_in_ranges(spark.createDataFrame([(n,) for n in numbers], "n bigint"), "n", spark.createDataFrame(ranges, "first bigint, size bigint"))
    known = sorted((f, s) for f, s in ranges if f is not None and s is not None)

    def folded(n):
        begun = [r for r in known if n is not None and r[0] <= n]
        return n - begun[-1][0] if begun and n - begun[-1][0] < begun[-1][1] else n

    collected = found.collect()
    assert {r.number: (r.folded, r.n_rows) for r in collected} == {n: (folded(n), numbers.count(n)) for n in set(numbers)}
    assert len(collected) == len(set(numbers))
    none = counted_in_ranges(spark.createDataFrame([(3,)], "n bigint"), "n", spark.createDataFrame([], "first bigint, size bigint"))
    assert [tuple(r) for r in none.collect()] == [(3, 3, 1)]


def test_empty_weeks_are_made_after_the_last_sort(spark):
    random.seed(5)
    monday = dt.date(2023, 1, 2)
    weeks = [
        ("1", f"M{i}", "P", (monday + dt.timedelta(weeks=w, days=(2 * i if w > 40 else 0))).isoformat(), random.random() * 50)
        for i in range(3)
        for w in sorted(random.sample(range(0, 120), 25 if i else 3))
        if w not in (41, 42)
    ]
    shipments = spark.createDataFrame(weeks, "client_id string, material_number string, plant_code string, shipment_week string, quantity_shipped double")
    day = F.datediff("shipment_week", F.lit("1970-01-05").cast("date"))
    for window in (1, 4, 12):
        trailing = Window.partitionBy(*SERIES).orderBy("_day").rangeBetween(-7 * (window - 1), 0)
        plain = forecast.dense_demand(shipments).withColumn("_day", day).withColumn("roll_mean", F.avg("quantity_shipped").over(trailing)).drop("_day")
        made = forecast.calendar_demand(shipments, window)
        assert made.columns == plain.columns
        assert sorted(map(tuple, made.collect())) == sorted(map(tuple, plain.collect()))
    above = plan_of(made).split("Generate")[0]
    assert "Sort" not in above and "Window" not in above


def test_tree_fits_hold_few_rows_in_a_partition(spark, monkeypatch):
    random.seed(2)
    data = [(f"k{i}", random.random(), random.random(), i % 5 == 0) for i in range(900)]
    frame = spark.createDataFrame(data, "k string, a double, b double, is_test boolean").coalesce(1)
    frame = frame.withColumn(LABEL, (F.col("a") > 0.5).cast("int")).withColumn("backorder_units", F.col("a") * 3)
    sizes = []
    fit = models._fit

    def watched(estimator, features, train):
        sizes.append([len(part) for part in train.rdd.glom().collect()])
        return fit(estimator, features, train)

    monkeypatch.setattr(models, "_fit", watched)
    for limit in (10_000, 100):
        monkeypatch.setattr(models, "FIT_ROWS", limit)
        models.forest_backorder(frame, ["a", "b"], trees=2, depth=2)
        models.gbt_backorder(frame, ["a", "b"], iterations=1, depth=2)
        models.magnitude_regression(frame, ["a", "b"], boosted=True)
    assert sizes[:3] == [[720]] * 3
    assert all(sum(s) == 720 and len(s) == 8 and max(s) < 200 for s in sizes[3:])


def test_stage_tables_keep_few_rows_in_a_file(spark, monkeypatch):
    monkeypatch.setattr(workspace, "FILE_ROWS", 100)
    kept = workspace.Workspace(spark, "few-rows")
    table = kept.table("t", lambda: spark.range(0, 950, 1, 1).select((F.col("id") % 2).alias("x")))
    per_file = [r[0] for r in table.groupBy(F.input_file_name()).count().select("count").collect()]
    assert sum(per_file) == 950 and max(per_file) <= 100
    kept.close()


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}


def test_written_tables_give_the_space_of_their_shuffles_back(spark, tmp_path):
    def dealt():
        return spark.range(0, 20_000, 1, 4).repartition(4, "id")

    kept = workspace.Workspace(spark, "no-shuffles")
    writes = (lambda: kept.table("t", dealt), lambda: sinks.write_table(dealt(), str(tmp_path / "t"), "csv"))
    for write in writes:
        before, until = shuffle_files(spark), time.time() + 20
        write()
        while shuffle_files(spark) - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffle_files(spark) - before
        assert spark.conf.get(workspace.CLEANUP) == "false"
    assert kept.table("t").count() == 20_000 and spark.read.csv(str(tmp_path / "t"), header=True).count() == 20_000
    kept.close()


def test_round_trip_by_csv_is_compressed(spark, tmp_path, rows):
    d = registry.Dataset(spark, "/root/testdata/sf0.001")
    found = registry.csv_roundtrip(d)
    files = [f for f in os.listdir(d.workspace.file_path("csv_roundtrip")) if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert found.count() == registry.order_fulfillment(d).count()
    d.workspace.close()


def test_tree_fits_on_written_rows_are_cut_by_files_without_a_shuffle(spark, monkeypatch):
    random.seed(4)
    monkeypatch.setattr(workspace, "FILE_ROWS", 50)
    monkeypatch.setattr(models, "FIT_ROWS", 60)
    data = [(f"k{i}", random.random(), random.random(), i % 5 == 0) for i in range(900)]
    frame = spark.createDataFrame(data, "k string, a double, b double, is_test boolean").coalesce(1)
    frame = frame.withColumn(LABEL, (F.col("a") > 0.5).cast("int"))
    kept = workspace.Workspace(spark, "fit-pieces")
    seen, fit = [], models._fit

    def watched(estimator, features, train):
        seen.append(([len(part) for part in train.rdd.glom().collect()], plan_of(train)))
        return fit(estimator, features, train)

    monkeypatch.setattr(models, "_fit", watched)
    models.gbt_backorder(kept.table("rows", lambda: frame), ["a", "b"], iterations=1, depth=2)
    sizes, plan = seen[0]
    assert sum(sizes) == 720 and len(sizes) >= 12 and max(sizes) <= 100
    assert "hashpartitioning(_place" not in plan
    assert spark.conf.get(models.LEAST_PIECES, None) is None
    kept.close()
