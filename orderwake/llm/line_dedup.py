"""Drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwake.llm.common import SPACE, ascii_lower


def line_dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """Documents without the lines that `min_docs` or more documents share, with line counts.

    Lines are exploded with their position and keyed by a 128-bit hash of the stripped, ASCII-lower-cased
    line; keys of at least `min_chars` characters are counted over distinct documents; rows of keys that
    reach `min_docs` lose their place in all documents but the one with the largest id; each text is
    put together again from the places left. Only hashes and places are shuffled by line.

    Returns the columns of `docs` with the text replaced, and `n_lines`, `n_dropped` (long; columns of these
    names in the input are replaced). A null or empty text is one empty line and comes back as ''. Lines of
    a document without id are neither counted nor dropped. Rows that repeat an id count as one document and
    each loses the places found for that id. If all lines go, the text is ''.
    """
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    placed = (
        docs.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("doc"), F.posexplode(lines).alias("place", "line"))
        .select("doc", "place", ascii_lower(F.btrim("line", F.lit(SPACE))).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    shared = (
        placed.groupBy("h1", "h2")
        .agg(F.count_distinct("doc").alias("holders"), F.max("doc").alias("keeper"))
        .where(F.col("holders") >= min_docs)
        .select(F.col("h1").bitwiseXOR(F.col("h2")).alias("mixed"), "h2", "keeper")
    )
    # Joined on other columns than it is grouped on, both sides have an exchange, and Spark can split a hot line.
    dropped = (
        placed.select("doc", "place", F.col("h1").bitwiseXOR(F.col("h2")).alias("mixed"), "h2")
        .join(shared, ["mixed", "h2"])
        .where(F.col("doc") < F.col("keeper"))
        .groupBy("doc")
        .agg(F.collect_set("place").alias("dropped"))
    )
    others = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    # Inside a struct, columns of the input can't clash with those made here.
    whole = docs.select(F.struct(F.col(id_col).alias("id"), *(F.col(f"`{c}`") for c in others if c != id_col)).alias("row"), lines.alias("lines"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    gone = F.array_intersect(F.coalesce("dropped", F.array().cast("array<int>")), places)
    return (
        whole.join(dropped.hint("shuffle_hash"), F.col("row.id") == F.col("doc"), "left")
        .select("row", "lines", places.alias("places"), gone.alias("gone"))
        .select(
            *(F.col("row")["id" if c == id_col else c].alias(c) for c in others),
            F.array_join(F.transform(F.array_except("places", "gone"), lambda i: F.get("lines", i)), "\n").alias(text_col),
            F.size("lines").cast("long").alias("n_lines"),
            F.size("gone").cast("long").alias("n_dropped"),
        )
    )
