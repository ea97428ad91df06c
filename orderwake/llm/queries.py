"""The text operators as queries on the given tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwake.llm.common import table
from orderwake.llm.decontaminate import contamination
from orderwake.llm.fill_in_middle import digests, fill_in_middle, frame_store
from orderwake.llm.language_id import fit_languages, language_spans
from orderwake.llm.line_dedup import line_dedup
from orderwake.llm.manifest import folded, leaf_digest, manifest, siblings_digest
from orderwake.llm.pieces import encode_and_decode
from orderwake.llm.pii import find_pii, fit_pii
from orderwake.llm.quality_crf import fit_quality, quality_scores, training_fold
from orderwake.llm.quality_rules import quality_rules
from orderwake.llm.sharding import shard_table
from orderwake.llm.simhash import simhash_groups
from orderwake.llm.substring_dedup import substring_dedup
from orderwake.llm.token_counts import cleaned_token_counts


def remainder(id_col: str, folds: int) -> Column:
    """Fold of a row, by the checksum of its id as text."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after it is cleaned by edits."""
    return cleaned_token_counts(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels.where(training_fold("doc_id")))
    return quality_scores(docs, model, threshold=0.3).select("doc_id", (~training_fold("doc_id")).alias("held_out"), "score", "predicted")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and a digest of the text decoded from them."""
    return encode_and_decode(table(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=13).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_pii(docs, fit_pii(docs))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = fit_languages(docs.where(~held_out))
    return language_spans(docs, model, spans=False).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document among 16 shards, and its shard among 17."""
    return shard_table(table(spark, sf_dir, "documents"), 16).withColumn("law", F.lit("key"))


#: What a leaf of the manifest holds.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; of half of them the leaf is folded anew without line breaks."""
    unbroken = F.translate("text", "\n", "")
    tampered = F.when(remainder("doc_id", 2) == 0, leaf_digest([unbroken if c == "text" else F.col(c) for c in LEAF]))
    found = manifest(table(spark, sf_dir, "documents"), LEAF, carried={"tampered": tampered})
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("witness")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", siblings_digest(F.col("witness")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's training text."""
    return digests(fill_in_middle(frame_store(table(spark, sf_dir, "documents")), seed=42, rate=50, spm=80)).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (op1_token_counts, op2_quality_classifier, op3_line_dedup, op4_sentencepiece, op5_simhash_near_dedup, op6_quality_rules, op7_substring_dedup, op8_pii, op9_language_id, op10_decontamination, op11_sharding, op12_manifest, op13_fill_in_middle)
}
