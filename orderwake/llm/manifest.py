"""A Merkle manifest of a dataset: digests of rows, subtrees per source, one root, and a witness for each row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderwake.llm.common import durable
from orderwake.llm.numbering import numbered

ARITY = 3
#: Levels of a block: ARITY ** HEIGHT consecutive nodes are one aligned subtree, built by one task.
HEIGHT = 8

STEP = T.StructType([T.StructField("left", T.StringType(), False), T.StructField("right", T.StringType(), False)])
WITNESS = T.ArrayType(STEP, False)


def joined_digest(parts: list[str]) -> str:
    """Digest of digests, as hex text."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class _Subtree:
    """A finished subtree in a run that is still open, with the siblings that its leaves have seen so far."""

    __slots__ = ("digest", "first", "last", "left", "right")

    def __init__(self, digest: str, first: int, last: int, left: list[str]):
        self.digest, self.first, self.last, self.left, self.right = digest, first, last, left, []


class OpenTree:
    """A tree that grows by appended nodes, with the witness of each.

    A run is up to `arity` neighbouring subtrees of one level. Each subtree that joins an open run takes the
    digests before it as left siblings, and is attached as a right sibling to those before it. A full run becomes
    a subtree of the next level; the step of its members is then final and extends the witnesses of their leaves.
    An appended node may itself be the root of a block that another task has built.
    """

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.runs: list[list[_Subtree]] = [[]]
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, digest: str) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._attach(0, digest, at, at + 1)

    def _attach(self, level: int, digest: str, first: int, last: int) -> None:
        while level >= len(self.runs):
            self.runs.append([])
        run = self.runs[level]
        for earlier in run:
            earlier.right.append(digest)
        run.append(_Subtree(digest, first, last, [s.digest for s in run]))
        if len(run) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        for subtree in run:
            step = ("".join(subtree.left), "".join(subtree.right))
            for witness in self.witnesses[subtree.first : subtree.last]:
                witness.append(step)
        self._attach(level + 1, joined_digest([s.digest for s in run]), run[0].first, run[-1].last)

    def close(self, height: int | None = None) -> str:
        """End all open runs and give the root: of `height` levels, or, without it, once a single node remains."""
        level = 0
        while level < height if height is not None else len(self.runs[level]) != 1 or any(self.runs[level + 1 :]):
            if self.runs[level]:
                self._complete(level)
            level += 1
        return self.runs[level][0].digest


def leaf_digest(columns: list[Column]) -> Column:
    """Digest of values, each as its number of UTF-8 bytes, a colon and its text; null is a hyphen."""
    texts = [c.cast("string") for c in columns]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that follows from a leaf and the siblings of its witness."""
    return F.aggregate(witness, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def siblings_digest(witness: Column) -> Column:
    """Digest of all siblings of a witness, from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _whole_blocks(batches: Iterator[pa.RecordBatch], starts: str) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows of whole blocks and where each begins; `starts` marks the first row of a block."""
    open_rows: list[pa.RecordBatch] = []
    for batch in batches:
        begins = pc.indices_nonzero(batch.column(starts)).to_pylist()
        if begins:
            done = [*open_rows, batch.slice(0, begins[-1])]
            rows = pa.Table.from_batches(done).combine_chunks()
            if rows.num_rows:
                yield rows, pc.indices_nonzero(rows.column(starts)).to_pylist()
            open_rows = []
            batch = batch.slice(begins[-1])
        open_rows.append(batch)
    if open_rows:
        rows = pa.Table.from_batches(open_rows).combine_chunks()
        if rows.num_rows:
            yield rows, pc.indices_nonzero(rows.column(starts)).to_pylist()


def _in_blocks(nodes: DataFrame, capacity: int) -> DataFrame:
    """Nodes with the number of their block; `tall` tells that the group has more blocks than one."""
    return nodes.withColumn("block", F.floor(F.col("place") / capacity)).withColumn("tall", F.col("size") > capacity)


def _block_roots(nodes: DataFrame, height: int) -> DataFrame:
    """`grp`, `place`, `size` and `digest` of the roots of all blocks, the nodes of the next tree."""
    capacity = ARITY**height
    schema = T.StructType([nodes.schema["grp"], *(T.StructField(n, T.LongType()) for n in ("place", "size")), nodes.schema["digest"]])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begins in _whole_blocks(batches, "starts"):
            digests, tall = rows.column("digest").to_pylist(), rows.column("tall").to_pylist()
            roots = []
            for a, b in zip(begins, [*begins[1:], len(digests)]):
                tree = OpenTree()
                for digest in digests[a:b]:
                    tree.append(digest)
                roots.append(tree.close(height if tall[a] else None))
            first = rows.take(pa.array(begins))
            yield from pa.table(
                {"grp": first.column("grp"), "place": first.column("block"), "size": first.column("blocks"), "digest": pa.array(roots, pa.string())}
            ).to_batches()

    rows = _in_blocks(nodes, capacity).select(
        "grp", "block", "place", "digest", "tall", (F.col("place") % capacity == 0).alias("starts"), F.ceil(F.col("size") / capacity).alias("blocks")
    )
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "place").mapInArrow(build, schema)


def _witnesses(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """The nodes' `grp`, `place`, `digest` and `row` with `witness` up to the root, and `roots` as given by `above`.

    `above` has `grp`, `place`, `witness` and `roots` of the blocks' roots; each is laid before the nodes of its
    block, and the tree of the block, built anew, is extended by its witness.
    """
    capacity = ARITY**height
    blocks = _in_blocks(nodes, capacity).select("grp", "block", "place", "digest", "tall", "row").withColumn("upper", F.lit(None).cast(WITNESS))
    blocks = blocks.withColumn("roots", F.lit(None).cast(above.schema["roots"].dataType))
    heads = above.select("grp", F.col("place").alias("block"), F.lit(-1).cast("bigint").alias("place"), F.col("witness").alias("upper"), "roots")
    rows = blocks.unionByName(heads, allowMissingColumns=True).withColumn("starts", F.col("place") < 0)
    schema = T.StructType([nodes.schema["grp"], nodes.schema["place"], nodes.schema["digest"], nodes.schema["row"],
                           T.StructField("witness", WITNESS), above.schema["roots"]])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begins in _whole_blocks(batches, "starts"):
            digests, tall = rows.column("digest").to_pylist(), rows.column("tall").to_pylist()
            uppers = rows.column("upper").take(pa.array(begins)).to_pylist()
            left, right, ends, kept, source = [], [], [0], [], []
            for a, b, upper in zip(begins, [*begins[1:], len(digests)], uppers):
                tree = OpenTree()
                for digest in digests[a + 1 : b]:
                    tree.append(digest)
                tree.close(height if tall[a + 1] else None)
                high = [(step["left"], step["right"]) for step in upper]
                for witness in tree.witnesses:
                    for before, after in [*witness, *high]:
                        left.append(before)
                        right.append(after)
                    ends.append(len(left))
                kept.extend(range(a + 1, b))
                source.extend([a] * (b - a - 1))
            steps = pa.StructArray.from_arrays(
                [pa.array(left, pa.string()), pa.array(right, pa.string())], fields=[pa.field("left", pa.string(), False), pa.field("right", pa.string(), False)]
            )
            own = rows.take(pa.array(kept))
            witness = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)
            yield from pa.table(
                {"grp": own.column("grp"), "place": own.column("place"), "digest": own.column("digest"), "row": own.column("row"),
                 "witness": witness, "roots": rows.column("roots").take(pa.array(source))}
            ).to_batches()

    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "place").mapInArrow(build, schema)


def _levels(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The nodes, then the block roots of each round, down to one node per group."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    levels = [nodes]
    while True:
        levels.append(durable(_block_roots(levels[-1], height)))
        most = -(-most // ARITY**height)
        if most <= 1:
            return levels


def _descend(levels: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """Witnesses of the first level's nodes, given those of the last level's."""
    for i in reversed(range(len(levels) - 1)):
        nodes = levels[i] if "row" in levels[i].columns else levels[i].withColumn("row", F.lit(True))
        above = _witnesses(nodes, above, height)
        above = durable(above) if i else above
    return above


def manifest(
    docs: DataFrame,
    fields: list[str],
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    carried: dict[str, Column] | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """`id`, `leaf`, `subroot`, `root` and `witness` of every row, and the columns that `carried` names.

    A leaf is the digest of `fields`. The leaves of a source ascend by id (null first, equal ids by digest); every
    three consecutive nodes become a node of the next level until one remains, the subroot. Subroots, ordered by
    source (null first), become the root likewise. A witness is an array of steps (`left`, `right`: the joined
    digests of the siblings on either side) from the leaf to the root; a source with one row adds none of its own.

    Rows are sorted by source and id over all tasks and numbered; aligned blocks of 3 ** `height` consecutive
    nodes are appended one by one to open trees, and the blocks' roots are appended to trees of their own, until
    each source has one node. Then each block is built again below the witness of its root. So a source may hold
    any share of the rows, and there may be any number of sources: no task holds more than some blocks.

    Repeated rows are leaves of their own, with the same digest. Names of the input's columns don't matter, and
    columns that aren't named here are not read. An empty table gives no rows.
    """
    carried = carried or {}
    leaves = docs.select(
        F.col(source_col).alias("grp"), F.col(id_col).alias("id"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
        F.struct(F.col(id_col).alias("id"), *(c.alias(n) for n, c in carried.items())).alias("row"),
    )
    leaves = numbered(leaves, "grp", ["id", "digest"]).drop("id")
    leaves = durable(leaves)
    levels = _levels(leaves, height)
    subroots = numbered(levels[-1].select(F.lit(0).alias("all"), "grp", "digest"), "all", ["grp"])
    subroots = subroots.select(F.col("all").alias("grp"), "place", "size", "digest", F.struct(F.col("grp").alias("source")).alias("row"))
    top = _levels(subroots, height)
    summit = top[-1].select("grp", "place", F.array().cast(WITNESS).alias("witness"), F.struct(F.col("digest").alias("root")).alias("roots"))
    sources = _descend(top, summit, height).select(
        F.col("row.source").alias("grp"), F.lit(0).cast("bigint").alias("place"), "witness", F.struct("roots.root", F.col("digest").alias("subroot")).alias("roots")
    )
    found = _descend(levels, durable(sources), height)
    return found.select(
        F.col("row.id").alias(id_col), F.col("digest").alias("leaf"), "roots.subroot", "roots.root", "witness", *(F.col(f"row.{n}").alias(n) for n in carried)
    )
