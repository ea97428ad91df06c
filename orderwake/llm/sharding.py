"""Documents to shards by jump consistent hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderwake.llm.numbering import numbered

#: Fixed values of jump consistent hashing: multiplier of its 64-bit generator, and the range of its 31-bit draws.
MULTIPLIER = 2862933555777941757
DRAWS = 2.0**31


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key.

    A key's generator names the shard counts at which the key moves into the newest shard. The last such move
    below `shards` decides, so there is no table, and one more shard only takes keys into itself.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    shard, ahead = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys))
    while len(moving):
        here = ahead[moving]
        shard[moving] = here
        drawn = state[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
        state[moving] = drawn
        ahead[moving] = ((here + 1) * (DRAWS / ((drawn >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return shard


def stable_key(column: Column) -> Column:
    """64 bits of the value's text, the same in every session; null counts as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit(""))), 1, 16), 16, -10).cast("bigint")


def with_shards(frame: DataFrame, key: str, counts: dict[str, int]) -> DataFrame:
    """The frame with one int column per entry of `counts`: the shard of the 64-bit `key` among so many shards.

    A column that already has such a name is replaced.
    """
    kept = [f for f in frame.schema.fields if f.name not in counts]
    schema = T.StructType([*kept, *(T.StructField(name, T.IntegerType(), False) for name in counts)])
    names, at = [f.name for f in kept], [f.name for f in kept].index(key)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(at).to_numpy(zero_copy_only=False).view(np.uint64)
            made = [pa.array(jump(keys, n).astype(np.int32)) for n in counts.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*names, *counts])

    return frame.select(*names).mapInArrow(place, schema)


def shard_table(docs: DataFrame, shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, `size`, `text_crc32`, `shard`, `slot` and `grown_shard` (the shard among one more) of every row.

    The id alone decides the shard. Slots number the rows of a shard from 0, by id (null first), checksum and
    size. The size is the text's UTF-8 bytes plus 1; a null text has none and the checksum of the empty text. Rows
    that repeat an id share its shard and have slots of their own; rows without id share one shard, too. Columns
    other than id and text are not read. An empty table gives no rows. The text is read once; what is sorted for
    the slots are its size and checksum.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        stable_key(F.col(id_col)).alias("key"),
    ).withColumnRenamed("size", "bytes")
    placed = with_shards(rows, "key", {"shard": shards, "grown_shard": shards + 1}).drop("key")
    return numbered(placed, "shard", ["id", "text_crc32", "bytes"]).select(
        F.col("id").alias(id_col), F.col("bytes").alias("size"), "text_crc32", "shard", F.col("place").alias("slot"), "grown_shard"
    )


def write_shards(docs: DataFrame, folder: str, shards: int = 16, *, id_col: str = "doc_id", files: int = 8) -> None:
    """All rows and columns as Parquet, one folder `shard=N` per shard, each of about `files` files.

    Rows are spread over the files of a shard by a hash of all their columns that can be hashed, and equal rows
    by their task, so one id that holds many rows is not written by one task unless the task read them all. A
    column named `shard` is refused.
    """
    if "shard" in docs.columns:
        raise ValueError("the table has a column named shard")
    plain = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    spread = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(files))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), stable_key(F.col(id_col)).alias("key"), spread.alias("spread"))
    placed = with_shards(keyed, "key", {"shard": shards})
    placed.repartition(shards * files, "shard", "spread").select("row.*", "shard").write.partitionBy("shard").parquet(folder)


def moved(docs: DataFrame, before: int, after: int, *, id_col: str = "doc_id") -> DataFrame:
    """`id`, `from_shard` and `to_shard` of the rows that change their shard when the number of shards changes."""
    keyed = docs.select(F.col(id_col).alias("id"), stable_key(F.col(id_col)).alias("key"))
    placed = with_shards(keyed, "key", {"from_shard": before, "to_shard": after})
    return placed.where("from_shard <> to_shard").drop("key")
