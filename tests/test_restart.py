"""A run that was cut off goes on where it stopped; extracts merge into a clean table; columns that drift."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_sources import clean_folder, write  # noqa: F401

from orderwake.functions import range_table
from orderwake.functions.keys import within_range
from orderwake.operators import latest_image
from orderwake.plans import forecast, pipeline
from orderwake.sources import ChangeLogTable, File, fingerprints, read_extracts, read_tables, read_typed, sinks, typed, write_table
from orderwake.sources.change_log import BUCKET

DAY = dt.date(2024, 4, 30)


def run(spark, source, target, **how):
    return pipeline.run(spark, source, str(target), DAY, resume=True, **how)


def test_a_run_goes_on_where_it_was_cut_off(spark, tmp_path, clean_folder, monkeypatch):  # noqa: F811
    whole = pipeline.run(spark, clean_folder, str(tmp_path / "whole"), DAY)
    target = tmp_path / "out"

    def lost(*_):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patched:
        patched.setattr(pipeline, "weeks_of_coverage", lost)
        with pytest.raises(RuntimeError):
            run(spark, clean_folder, target)
    finished = sorted(os.listdir(target / "_finished"))
    assert "master_purchase.json" in finished and "master_woc.json" not in finished
    # A stage that was cut off while it was written: some of its files are there, but no word that it is finished.
    (target / "master_woc").mkdir()
    (target / "master_woc" / "part-0.parquet").write_bytes(b"half")
    again = run(spark, clean_folder, target)
    assert set(again.reused) == {"master_order_fulfillment", "master_inventory_material", "master_purchase", "master_order_fulfillment_brd", "shipment_history"}
    assert again.rows == whole.rows
    for name in whole.rows:
        assert sorted(map(tuple, again.load(name).collect()), key=repr) == sorted(map(tuple, whole.load(name).collect()), key=repr)
    assert run(spark, clean_folder, target).reused == list(whole.rows)


def test_only_what_follows_from_a_change_is_built_anew(spark, tmp_path, clean_folder):  # noqa: F811
    target = tmp_path / "out"
    run(spark, clean_folder, target, target_format="csv")
    with open(f"{clean_folder}/material_stock.csv", "a") as stock:
        stock.write("100,M1,P1,2,5\n")
    again = run(spark, clean_folder, target, target_format="csv")
    assert set(again.reused) == {"master_order_fulfillment", "master_purchase", "shipment_history"}
    assert again.rows["master_inventory_material"] == 4
    other_day = pipeline.run(spark, clean_folder, str(target), DAY + dt.timedelta(1), resume=True, target_format="csv")
    assert "master_order_fulfillment_brd" not in other_day.reused and "master_inventory_material" in other_day.reused


def test_metrics_come_from_orders_that_are_not_read_back(spark, tmp_path, clean_folder, rows, monkeypatch):  # noqa: F811
    given, made, save = [], pipeline.order_backorder_metrics, pipeline.Stages.save

    def watched(orders, *more):
        given.append(orders.inputFiles())
        return made(orders, *more)

    def cut_off(stages, tables):
        if "master_order_fulfillment" in tables:
            raise RuntimeError("the driver is gone")
        return save(stages, tables)

    monkeypatch.setattr(pipeline, "order_backorder_metrics", watched)
    target = tmp_path / "out"
    with monkeypatch.context() as patched:
        patched.setattr(pipeline.Stages, "save", cut_off)
        with pytest.raises(RuntimeError):
            run(spark, clean_folder, target)
    again = run(spark, clean_folder, target)
    assert again.reused == ["master_inventory_material", "master_order_fulfillment_brd"]
    assert list(again.rows)[0] == "master_order_fulfillment"
    orders = pipeline.order_fulfillment(read_tables(spark, clean_folder))
    written = again.load("master_order_fulfillment")
    assert written.dtypes == orders.dtypes and rows(written) == rows(orders)
    # A day later the orders are there already.
    later = pipeline.run(spark, clean_folder, str(target), DAY + dt.timedelta(1), resume=True)
    assert "master_order_fulfillment" in later.reused and "master_order_fulfillment_brd" not in later.reused
    from_orders = [any("master_order_fulfillment" in f for f in files) for files in given]
    assert from_orders == [False, True]


def test_compressed_tables_have_few_rows_in_a_file(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_ROWS", 100)
    df = spark.range(0, 250, 1, 1).select(F.col("id").cast("string").alias("k"), F.concat(F.lit('a "b", '), "id").alias("v"))
    assert write_table(df, str(tmp_path / "t"), "csv", compressed=True) == 250
    files = [f for f in os.listdir(tmp_path / "t") if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    assert rows(read_typed(spark, str(tmp_path / "t"), df.schema)) == rows(df)
    assert write_table(df, str(tmp_path / "p")) == 250
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(tmp_path / "p"))


def test_small_documents(spark, tmp_path):
    file = File(spark, str(tmp_path / "a" / "x.json"))
    assert file.load() is None
    file.save({"n": 1})
    file.save({"n": 2})
    assert file.load() == {"n": 2}
    os.rename(tmp_path / "a" / "x.json", tmp_path / "a" / "x.json.new")  # cut off between the last two steps
    assert file.load() == {"n": 2}
    (tmp_path / "a" / "y.json").write_text('{"n"')
    assert File(spark, str(tmp_path / "a" / "y.json")).load() is None


def test_fingerprints_tell_changed_files(spark, tmp_path):
    write(tmp_path / "t.csv", "part-0", "a\n1\n")
    write(tmp_path, "u.csv", "b\n")
    first = fingerprints(spark, str(tmp_path))
    assert set(first) == {"t.csv", "u.csv"} and fingerprints(spark, str(tmp_path)) == first
    write(tmp_path / "t.csv", "part-1", "a\n2\n")
    second = fingerprints(spark, str(tmp_path))
    assert second["t.csv"] != first["t.csv"] and second["u.csv"] == first["u.csv"]


def test_typed_reads_by_name(spark, tmp_path, rows):
    schema = T.StructType.fromDDL("id string, amount double, at timestamp_ntz, n int, ok boolean")
    values = [("1", 0.1, dt.datetime(2024, 5, 1, 2, 3, 4), 7, True), ('a "b", c', None, None, None, False), (None, -1e300, None, -1, None)]
    df = spark.createDataFrame(values, schema)
    write_table(df.select(*reversed(df.columns)), str(tmp_path / "t"), "csv")
    assert rows(read_typed(spark, str(tmp_path / "t"), schema)) == rows(df)
    with pytest.raises(ValueError, match="amount"):
        typed(df.drop("amount"), schema)
    text = spark.createDataFrame([("x", "1x", "no", "2.5", "maybe")], ["id", "amount", "at", "n", "ok"])
    assert rows(typed(text, schema)) == [("x", None, None, None, None)]


def test_extracts_with_drifting_columns_are_one_table(spark, tmp_path, rows):
    write(tmp_path, "a.csv", "k,v\n1,x\n2,\n")
    write(tmp_path, "b.csv", "v,k,more\ny,3,z\n")
    write(tmp_path, "c.csv", 'k,v\n4,"say ""hi"", you"\n')
    found = read_extracts(spark, [str(tmp_path / f"{n}.csv") for n in "abc"])
    assert rows(found, "k", "v", "more") == [("1", "x", None), ("2", None, None), ("3", "y", "z"), ("4", 'say "hi", you', None)]
    with pytest.raises(FileNotFoundError):
        read_extracts(spark, [])


LOG = "k string, record_timestamp timestamp_ntz, is_deleted boolean, v int"


def image(k, day, gone, v):
    return (k, dt.datetime(2024, 1, day), gone, v)


def test_extracts_merge_in_any_order(spark, tmp_path, rows):
    images = [image(str(i % 40), 1 + (i * 7) % 28, i % 5 == 0, i) for i in range(300)]
    log = spark.createDataFrame(images, LOG)
    expected = rows(latest_image(log, ["k"]))
    parts = [spark.createDataFrame(images[i::3], LOG) for i in range(3)]
    for n, order in enumerate(((0, 1, 2), (2, 0, 1))):
        table = ChangeLogTable(spark, str(tmp_path / f"t{n}"), ["k"], buckets=8)
        for i in order:
            table.merge(parts[i].select(*reversed(parts[i].columns)) if i == 1 else parts[i])
        table.clean()
        assert rows(ChangeLogTable(spark, str(tmp_path / f"t{n}"), ["k"]).load(), *log.columns) == expected


def test_an_older_image_does_not_bring_a_deleted_row_back(spark, tmp_path, rows):
    table = ChangeLogTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    with pytest.raises(FileNotFoundError):
        table.load()
    table.merge(spark.createDataFrame([image("a", 9, True, 1), image("b", 2, False, 2)], LOG))
    table.merge(spark.createDataFrame([image("a", 3, False, 3), image("b", 1, False, 4)], LOG))
    assert rows(table.load(), "k", "v") == [("b", 2)]
    table.merge(spark.createDataFrame([], LOG))
    table.merge(spark.createDataFrame([image("a", 10, False, 5)], LOG))
    assert rows(table.load(), "k", "v") == [("a", 5), ("b", 2)]


def test_only_buckets_with_new_keys_are_rewritten(spark, tmp_path):
    folder = tmp_path / "t"
    table = ChangeLogTable(spark, str(folder), ["k"], buckets=16)
    table.merge(spark.createDataFrame([image(str(i), 1, False, i) for i in range(200)], LOG))
    before = dict(table.state["versions"])
    touched = table.merge(spark.createDataFrame([image("7", 2, False, -1)], LOG))
    assert len(touched) == 1 and len(before) == 16
    assert {b for b, v in table.state["versions"].items() if v == 2} == {str(touched[0])}
    assert os.listdir(folder / "v2") and f"{BUCKET}={touched[0]}" in os.listdir(folder / "v1")
    table.clean()
    assert f"{BUCKET}={touched[0]}" not in os.listdir(folder / "v1")
    assert table.load().filter("k = '7'").first()["v"] == -1 and table.load().count() == 200


def test_a_merge_that_was_cut_off_changes_nothing(spark, tmp_path, rows, monkeypatch):
    table = ChangeLogTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    table.merge(spark.createDataFrame([image("a", 1, False, 1)], LOG))
    late = spark.createDataFrame([image("a", 2, False, 2), image("c", 2, False, 3)], LOG)
    with monkeypatch.context() as patched:
        patched.setattr(File, "save", lambda *_: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            table.merge(late)
    again = ChangeLogTable(spark, str(tmp_path / "t"), ["k"])
    assert rows(again.load(), "k", "v") == [("a", 1)]
    again.merge(late)
    assert rows(again.load(), "k", "v") == [("a", 2), ("c", 3)]


def test_columns_that_come_later_are_empty_in_older_images(spark, tmp_path, rows):
    table = ChangeLogTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    table.merge(spark.createDataFrame([image("a", 1, False, 1), image("b", 1, False, 2)], LOG))
    table.merge(spark.createDataFrame([("a", dt.datetime(2024, 1, 2), "new", "7")], "k string, record_timestamp timestamp_ntz, extra string, v string"))
    assert rows(table.load(), "k", "v", "extra", "is_deleted") == [("a", 7, "new", None), ("b", 2, None, False)]


def test_thousands_of_ranges_do_not_lengthen_the_plan(spark, rows):
    numbers = spark.createDataFrame([(n,) for n in (0, 99, 100, 104, 105, 199, 200, 10**9, 49_900, 49_904, 49_905, None)], "n bigint")

    def folded(count):
        ranges = spark.range(1, count + 1).select((F.col("id") * 100).alias("first"), F.lit(5).alias("size"))
        return numbers.withColumn("r", range_table(ranges)).select("n", within_range(F.col("n"), F.col("r")).alias("f"))

    expected = {n: None if n is None else n % 100 if 100 <= n < 500_000 and n % 100 < 5 else n for (n,) in map(tuple, numbers.collect())}
    assert {r.n: r.f for r in folded(4_999).collect()} == expected
    lengths = [len(folded(n)._jdf.queryExecution().optimizedPlan().toString()) for n in (3, 4_999)]
    assert abs(lengths[0] - lengths[1]) < 50
    none = numbers.withColumn("r", range_table(spark.range(0).select(F.col("id").alias("first"), F.col("id").alias("size"))))
    assert all(r.n == r.f for r in none.select("n", within_range(F.col("n"), F.col("r")).alias("f")).collect())


def test_ranges_from_a_table_match_references(spark, rows):
    from orderwake.plans.masters import delivery_totals

    ranges = spark.createDataFrame([(7_000_000_000, 1000), (80_000, 50)], "first bigint, size bigint")
    items = spark.createDataFrame(
        [("1", "7000000051", "10", 2.0), ("1", "80001", "010", 3.0), ("1", "80051", "10", 4.0), ("1", "x", "10", 9.0)],
        "client_id string, reference_document_number string, reference_item_number string, delivery_quantity double",
    ).withColumn("quantity_delivered", F.col("delivery_quantity"))
    assert rows(delivery_totals(items, ranges), "_doc", "_item", "total_delivery_quantity") == [("1", "10", 3.0), ("51", "10", 2.0), ("80051", "10", 4.0)]


def test_calendar_weeks_without_shipments_count_as_zero(spark, rows):
    weeks = [("1", "M", "P", "2024-01-01", 12.0), ("1", "M", "P", "2024-01-22", 4.0), ("1", "N", "P", "2024-03-04", 5.0), ("1", "M", "", "2024-01-01", 7.0)]
    shipments = spark.createDataFrame(weeks, "client_id string, material_number string, plant_code string, shipment_week string, quantity_shipped double")
    found = forecast.calendar_demand(shipments, window_weeks=3)
    assert rows(found.withColumn("shipment_week", F.col("shipment_week").cast("string")), "material_number", "shipment_week", "quantity_shipped", "roll_mean") == [
        ("M", "2024-01-01", 12.0, 12.0), ("M", "2024-01-08", 0.0, 6.0), ("M", "2024-01-15", 0.0, 4.0), ("M", "2024-01-22", 4.0, 4.0 / 3), ("N", "2024-03-04", 5.0, 5.0),
    ]
