"""From raw documents to encoded training text: quality, repeated lines, near copies, benchmark passages, pieces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwake.llm.common import forget, table, written
from orderwake.llm.decontaminate import decontaminate
from orderwake.llm.line_dedup import line_dedup
from orderwake.llm.pieces import encode_and_decode
from orderwake.llm.quality_crf import fit_quality, keep_good, training_fold
from orderwake.llm.simhash import simhash_groups


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field, fitted on the labels of these documents, does not reject."""
    labels = table(spark, sf_dir, "labels").where(training_fold("doc_id"))
    return keep_good(docs, fit_quality(docs, labels), threshold=0.3)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share; n_chars, if there is one, follows the text.

    All other columns stay as they are, whatever their names.
    """
    others = F.struct(F.lit(True).alias("_"), *(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text"))).alias("others")
    kept = line_dedup(docs.select("doc_id", "text", others))
    new = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*(new.get(c, F.col("others")[c]).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id (rows without id: if the group has no other).

    Of rows that share this id the one with the smallest hash of its columns stays, of equal rows any one; maps,
    whose entries have no order, are left out of the hash. Rows get a number that is written with them, so each is
    told from its copies and a repeated task can't renumber them. All columns stay as they are, whatever their names.
    """
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64(*hashed).alias("hash"), F.monotonically_increasing_id().alias("number"))
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("others")
    rows = written(docs.select(place.alias("place"), others, "text"), "rows with places")
    groups = simhash_groups(rows, id_col="place", shingle=3, max_bits=2)
    first = groups.where(F.col("place") == F.col("component_id")).select(F.col("place.number").alias("first"))
    kept = rows.join(first.hint("shuffle_hash"), rows["place.number"] == first["first"], "left_semi")
    return kept.select(*(F.col("text") if c == "text" else F.col("others")[c].alias(c) for c in docs.columns))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and a digest of the text that they decode to."""
    return encode_and_decode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", repeated_lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("SentencePiece encoding and decoding", pieces),
]

#: SQL can't express the classifier; tests check the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written as Parquet and read again by the next.

    A stage's table is deleted as soon as the next one is written.
    """
    docs = table(spark, sf_dir, "documents")
    earlier = None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if earlier is not None:
            forget(earlier)
        earlier = docs
    return STAGES[-1][1](spark, docs, sf_dir)
