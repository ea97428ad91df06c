"""One row of each group of near copies stays in the pipeline, whatever the ids."""

from conftest import DATA

import corpus_pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
A, B, C, D = (" ".join(f"{name}{i}" for i in range(40)) for name in ("apple", "birch", "cedar", "date"))


def survivors(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], SCHEMA).repartition(5)
    found = corpus_pipeline.near_duplicates(spark, docs, DATA)
    assert found.schema == docs.schema
    return sorted(((r.doc_id, r.text, r.source) for r in found.collect()), key=str)


def test_one_row_of_each_group_with_repeated_ids(spark):
    # 1 leads the group of A twice; 2 leads that of B, and its other text is a copy of A.
    rows = [(1, A, "x"), (1, A, "x"), (1, A, "x"), (2, A, "x"), (2, B, "x"), (3, B, "x")]
    assert survivors(spark, rows) == [(1, A, "x"), (2, B, "x")]


def test_one_row_of_each_group_with_missing_ids(spark):
    rows = [(None, A, "x"), (7, A, "x"), (None, B, "x"), (None, B, "x"), (None, C, "x"), (9, D, "x"), (None, D, "y"), (9, C, "y")]
    assert survivors(spark, rows) == [(7, A, "x"), (9, C, "y"), (9, D, "x"), (None, B, "x")]


def test_survivor_of_a_shared_id_does_not_depend_on_the_order(spark):
    rows = [(1, A, source) for source in "abcdefgh"]
    assert survivors(spark, rows) == survivors(spark, rows[::-1])
    assert len(survivors(spark, rows)) == 1
