"""Left lookups that hold up when one key owns a large share of the rows.

`hot_keys` looks at the key columns with a frequent-items sketch and decides, per key, over how
many partitions its rows should be spread. `lookup_join` adds that spread to the join
key: rows of a hot key are dealt out over `n` salts and the matching right-hand rows are repeated
`n` times, so every row still meets every match exactly once. A key that the sketch misses is
merely not spread; the result never depends on it. Without hot keys the join is a plain one.

`lookup_in_place` does the same for two lookups whose keys have some columns in common, and deals out
the left side once for both.

Nothing is hinted here: whether a side is small enough to broadcast is left to Spark's size check. Where that check
comes too late, after the left side is shuffled, a caller measures its side with `row_bytes` and hints itself.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's bounds for the sketch: keys it returns, and candidates it follows per key.
MOST_RETURNED, MOST_TRACKED = 100_000, 1_000_000
# Candidates followed for each key that may be hot; at a fair share per partition there are as many
# hot keys as partitions at most.
TRACKED_PER_KEY = 16

# Share of the rows that the sketch looks at, and how often it must meet a key to call it hot. The
# sample only decides how widely a key is spread; every row takes part in the join.
LOOKED_AT = 0.05
LEAST_SEEN = 50

# A side that was measured is sent to all tasks up to this size.
BROADCAST_BYTES = 32 << 20

HotKeys = dict[int, int]  # hash of the key -> number of salts


def hot_keys(df: DataFrame, *, looked_at: float = LOOKED_AT, **keys: Sequence[str]) -> dict[str, HotKeys]:
    """Keys with more rows than a fair share of one shuffle partition, for each named key.

    A hot key gets twice its share of the partitions as salts, so all salts together stay below
    two per partition plus one per hot key. Only those few numbers reach the driver.
    """
    partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    returned, tracked = sketch_size(partitions)
    looked = df if looked_at >= 1 else df.sample(fraction=looked_at, seed=1)
    hashed = looked.select(*(_key_hash(columns).alias(name) for name, columns in keys.items()))
    sketch = hashed.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.expr(f"approx_top_k(`{name}`, {returned}, {tracked})").alias(f"top_{name}") for name in keys),
    ).first()
    limit = max(sketch["rows"] / partitions, LEAST_SEEN)
    return {
        name: {
            e["item"]: math.ceil(2 * partitions * e["count"] / sketch["rows"])
            for e in sketch[f"top_{name}"]
            if e["count"] > limit
        }
        for name in keys
    }


def sketch_size(partitions: int) -> tuple[int, int]:
    """Keys that the sketch returns and candidates that it follows, so that no key above 1 / partitions is missed."""
    returned = min(max(partitions, 2), MOST_RETURNED)
    return returned, min(max(returned * TRACKED_PER_KEY, 1 << 14), MOST_TRACKED)


def row_bytes(df: DataFrame) -> int:
    """Bytes of all rows: the texts, 8 for each column and 16 for each row. Runs the plan."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    size = sum(texts, F.lit(16 + 8 * len(df.columns))).cast("bigint")
    return df.agg(F.sum(size).alias("size")).first()["size"] or 0


def lookup_join(
    left: DataFrame,
    right: DataFrame | Sequence[DataFrame],
    on: Sequence[str],
    hot: HotKeys | None = None,
    spread_by: Sequence[str] = (),
    null_safe: bool = False,
    how: str = "left",
) -> DataFrame:
    """Join one or more right-hand tables on the same keys, keeping the left-hand key columns.

    Pass `hot` unless the key is unique on the left. A column that both sides carry is taken from
    the left. With `null_safe`, NULL keys match each other.
    """
    rights = [right] if isinstance(right, DataFrame) else list(right)
    if hot:
        left = left.withColumn("_salt", _dealt_salt(_salts(on, hot), spread_by))
    for side in rights:
        left = _equi_join(left, side, on, hot, null_safe, how)
    return left.drop("_salt") if hot else left


def lookup_in_place(
    left: DataFrame,
    facts: DataFrame,
    headers: DataFrame,
    home: Sequence[str],
    within: Sequence[str],
    header_key: Sequence[str],
    hot: HotKeys | None = None,
    hot_within: HotKeys | None = None,
    spread_by: Sequence[str] = (),
    repeats: Mapping[str, str] | None = None,
) -> DataFrame:
    """Left lookups in `facts` (by home and within) and `headers` (by header_key) behind one shuffle of the left side.

    All three have the `home` columns, which follow from header_key, and are partitioned by a hash of them. A join on
    more columns would partition by all of these, so facts, one row per key, are stacked on the left rows and handed
    on by a window; headers join by the hash, and their key is compared as a condition. Few headers may share a home.

    Rows of a `hot` home are spread by their `within` columns, and facts follow them without being repeated; headers
    are repeated per salt. If home and within together are hot as well (`hot_within`), left rows are spread by
    `spread_by` and the fact of that key is repeated. NULL keys find nothing.

    `repeats` names home or within columns, never NULL on the left, that mostly say the same as another left column (a
    home as one of header_key). Where they do, they are left out of the shuffle.
    """
    key = [*home, *within]
    repeats = repeats or {}
    every = F.sequence(F.lit(0), _salts(home, hot) - 1) if hot else F.array(F.lit(0))
    own = F.array(F.pmod(_key_hash(within), _salts(home, hot)).cast("int")) if hot else every
    left_own = fact_places = own
    if hot and hot_within:
        crowded = _salts(key, hot_within) > 1
        fact_places = F.when(crowded, every).otherwise(own)
        left_own = F.when(crowded, F.array(F.pmod(_key_hash(spread_by), _salts(home, hot)).cast("int"))).otherwise(own)

    def met(df: DataFrame, said: Mapping[str, str]) -> DataFrame:
        # The salts of one home give different hashes; homes that share a hash are told apart by the keys. Rows are sent
        # by the hash but do not carry it, since its eight bytes do not compress.
        whole = {c: F.coalesce(c, said[c]) if c in said else F.col(c) for c in key if c in df.columns}
        at = F.xxhash64(*(whole[c] for c in home)).bitwiseXOR(F.col("_salt"))
        return df.repartition(at).withColumn("_at", at).withColumns(whole).drop("_salt")

    def short(said: Mapping[str, str], columns: Sequence[str]) -> dict[str, Column]:
        return {c: F.when(~F.col(c).eqNullSafe(F.col(said[c])), F.col(c)) for c in columns if c in said}

    found = [c for c in facts.columns if c not in left.columns]
    known = facts.na.drop(subset=key).select(*key, *found).withColumns({"_salt": F.explode(fact_places), "_asks": F.lit(False)})
    asking = left.withColumns({"_salt": F.get(left_own, 0), "_asks": F.lit(True)}).withColumns(short(repeats, key))
    stacked = met(asking.unionByName(known, allowMissingColumns=True), repeats)
    same_key = Window.partitionBy("_at", *key)
    answered = stacked.withColumns({c: F.max(c).over(same_key) for c in found}).filter("_asks").drop("_asks")

    named = [F.col(c).alias(f"_r_{c}") for c in header_key]
    told = [c for c in headers.columns if c not in answered.columns]
    said = {c: f"_r_{k}" for c, k in repeats.items() if c in home and k in header_key}
    headers = headers.select(*home, *named, *told).withColumn("_salt", F.explode(every)).withColumns(short(said, home))
    headers = met(headers, said).select(F.col("_at").alias("_r_at"), *(f"_r_{c}" for c in header_key), *told)
    condition = F.col("_at") == F.col("_r_at")
    for c in header_key:
        # Equality in two halves, which Spark does not take for one more column to partition by.
        condition &= (F.col(c) <= F.col(f"_r_{c}")) & (F.col(c) >= F.col(f"_r_{c}"))
    return answered.join(headers, condition, "left").drop("_at", "_r_at", *(f"_r_{c}" for c in header_key))


def _equi_join(left, right, on, hot, null_safe, how) -> DataFrame:
    for name in on:
        if left.schema[name].dataType != right.schema[name].dataType:
            raise TypeError(f"join key {name} has different types on the two sides")
    payload = [c for c in right.columns if c not in left.columns]
    columns = [*(F.col(c).alias(f"_r_{c}") for c in on), *payload]
    keys = [(c, f"_r_{c}") for c in on]
    if hot:
        columns.append(F.explode(F.sequence(F.lit(0), _salts(on, hot) - 1)).alias("_r_salt"))
        keys.append(("_salt", "_r_salt"))
    right = right.select(*columns)
    condition = F.lit(True)
    for l, r in keys:
        condition &= F.col(l).eqNullSafe(F.col(r)) if null_safe else F.col(l) == F.col(r)
    return left.join(right, condition, how).drop(*(r for _, r in keys))


def _key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*(F.col(c) for c in columns))


def _salts(on: Sequence[str], hot: HotKeys) -> Column:
    table = F.create_map(*(F.lit(part).cast(kind) for pair in hot.items() for part, kind in zip(pair, ("bigint", "int"))))
    return F.coalesce(F.try_element_at(table, _key_hash(on)), F.lit(1))


def _dealt_salt(salts: Column, spread_by: Sequence[str]) -> Column:
    # The salt must come out the same when a lost task is run again, so it is a function of the
    # row and of the number of its partition, never random. The partition number spreads copies.
    deal = F.xxhash64(F.spark_partition_id(), *(F.col(c) for c in spread_by))
    return F.pmod(deal, salts).cast("int")
