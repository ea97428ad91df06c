"""Near-duplicate documents by SimHash fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwake.llm.common import durable, map_texts
from orderwake.llm.components import connected_components

BITS = 64
#: Fingerprints compared in one group; larger buckets are cut into blocks, and pairs of blocks are groups.
BLOCK = 4096
#: 64-lane words compared with one fingerprint each that are held at a time.
ITEMS = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles, as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    size = min(shingle, len(words))
    stops = (starts + lengths)[size - 1 :].tolist()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    counts, n = np.zeros(BITS, np.int64), len(stops)
    begins = starts.tolist()
    for at in range(0, n, 1 << 16):
        part = [digest(joined[a:b], 42) for a, b in zip(begins[at : at + (1 << 16)], stops[at : at + (1 << 16)])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """`doc`, `fingerprint` (the 64 bits as a signed long) of each row; null and empty texts have 0."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, shingle) for t in piece.column(1).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([piece.column(0), pa.array(found)], ["doc", "fingerprint"])

    pairs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    return map_texts(pairs, "text", work, f"doc {kind}, fingerprint bigint")


class _Forest:
    """Union-find over array positions, many links at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[nodes]
            if (up == nodes).all():
                return nodes
            nodes = up


def linked(groups: list[np.ndarray], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions, in the groups laid end to end, of pairs within `radius` bits; both ends in one group.

    Bit planes are stored vertically: word w of plane p holds bit p of 64 fingerprints. One fingerprint is
    compared with 64 others by an exclusive or per plane, and their distances are kept in carry-save counters.
    Lanes beyond the radius are marked; words all of whose lanes are beyond it are abandoned.
    """
    sizes = np.array([len(g) for g in groups])
    words = -(-sizes // 64)
    first_word = np.concatenate(([0], np.cumsum(words)))
    first = np.concatenate(([0], np.cumsum(sizes)))
    values = np.concatenate(groups).view(np.uint64)
    group = np.repeat(np.arange(len(groups)), sizes)
    lane = np.arange(len(values)) - first[group]  # within the group
    laid = np.zeros(first_word[-1] * 64, np.uint64)
    place = first_word[group] * 64 + lane
    laid[place] = values
    origin = np.full(len(laid), -1)
    origin[place] = np.arange(len(values))
    bits = np.unpackbits(laid.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    del bits
    everyone = np.packbits(origin >= 0, bitorder="little").view("<u8")
    todo = words[group] - lane // 64  # words from the fingerprint's own on
    ends = np.cumsum(todo)
    width = int(radius + 1).bit_length()
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for start in range(0, int(ends[-1]), ITEMS):
        item = np.arange(start, min(start + ITEMS, int(ends[-1])))
        ref = np.searchsorted(ends, item, side="right")
        word = first_word[group[ref]] + lane[ref] // 64 + (item - (ends[ref] - todo[ref]))
        own = values[ref]
        counters = [np.zeros(len(item), np.uint64) for _ in range(width)]
        beyond = ~everyone[word]
        for plane in range(BITS):
            bit = (own >> np.uint64(plane)) & np.uint64(1)
            carry = planes[plane][word] ^ (full * bit)
            for k in range(width):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            beyond |= carry
            if plane % 8 == 7:
                beyond |= _above(counters, radius)
                alive = np.flatnonzero(beyond != full)
                if len(alive) < 0.7 * len(ref):
                    ref, word, own, beyond = ref[alive], word[alive], own[alive], beyond[alive]
                    counters = [c[alive] for c in counters]
                    if not len(ref):
                        break
        if len(ref):
            near = np.unpackbits((~beyond).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, column = np.nonzero(near)
            a, b = ref[row], origin[word[row] * 64 + column]
            yield a[a < b], b[a < b]


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is larger than the radius."""
    more, same = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same &= counters[k]
        else:
            more |= same & counters[k]
            same &= ~counters[k]
    return more


def near_links(prints: DataFrame, *, max_bits: int = 2) -> DataFrame:
    """Links `a`, `b` between distinct fingerprints within `max_bits`, thinned to a forest within each bucket.

    The 64 bits are cut into max_bits + 2 bands; fingerprints within the radius agree in two bands at least,
    so each pair of bands is a bucket key and no link is missed. A bucket of more than BLOCK fingerprints is
    cut into blocks by a hash, and its pairs of blocks are compared in separate groups.
    """
    bands = max_bits + 2
    edges = [BITS * i // bands for i in range(bands + 1)]
    value = F.col("fingerprint")
    cut = [F.shiftrightunsigned(value, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges, edges[1:])]
    keys = [F.struct(F.lit(i).alias("pair"), cut[x].alias("x"), cut[y].alias("y")) for i, (x, y) in enumerate(combinations(range(bands), 2))]
    keyed = prints.select("fingerprint", F.explode(F.array(*keys)).alias("key")).select("fingerprint", "key.*")
    sizes = keyed.groupBy("pair", "x", "y").count().where(F.col("count") > 1)
    # Joined on other columns than it is grouped on, both sides have an exchange that Spark can split.
    mixed = F.col("x").bitwiseXOR(F.col("y")).alias("mixed")
    sizes, keyed = sizes.select("pair", "x", mixed, "count"), keyed.select("*", mixed)
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    placed = keyed.join(sizes, ["pair", "x", "mixed"]).select(
        "pair", "x", "y", "fingerprint", blocks.alias("blocks"), F.pmod(F.xxhash64("fingerprint"), blocks).cast("int").alias("own")
    )
    dealt = placed.select(
        "pair", "x", "y", "fingerprint", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))).alias("block")
    )
    groups = dealt.groupBy("pair", "x", "y", "block").agg(F.collect_list("fingerprint").alias("members")).where(F.size("members") > 1).select("members")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            at = 0
            while at < len(lists):  # so many groups that their members fill about one block
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + 2 * BLOCK, side="right")) - 1)
                members = [flat[offsets[i] : offsets[i + 1]] for i in range(at, min(to, len(lists)))]
                at = to
                together = np.concatenate(members)
                forest = _Forest(len(together))
                for a, b in linked(members, max_bits):
                    forest.link(a, b)
                roots = forest.roots(np.arange(len(together)))
                child = np.flatnonzero(roots != np.arange(len(together)))
                yield pa.RecordBatch.from_arrays([pa.array(together[roots[child]]), pa.array(together[child])], ["a", "b"])

    return groups.mapInArrow(compare, "a bigint, b bigint").distinct()


def simhash_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """Id, `fingerprint` (16 hex digits) and `component_id` (smallest id reachable by links) of every row.

    Fingerprints are computed once and written to the checkpoint folder; equal ones collapse before they are
    compared, so copies cost nothing. Null and empty texts have fingerprint zero and link like any other. A row
    without id gets a component by its text; the component's id is null only if no member has an id. Rows
    that repeat an id are documents of their own that share it. An empty table gives no rows.
    """
    prints = durable(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    distinct = prints.groupBy("fingerprint").agg(F.min("doc").alias("least"))
    roots = connected_components(near_links(distinct.select("fingerprint"), max_bits=max_bits))
    rooted = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    # Joined as structs, which the minima are not grouped on: the fingerprints of a large component can be split.
    components = rooted.groupBy("root").agg(F.min("least").alias("component_id")).select(F.struct("root").alias("whole"), "component_id")
    named = rooted.join(components, F.struct(rooted.root) == components.whole).select(F.col("fingerprint").alias("print"), "component_id")
    return prints.join(named, F.col("fingerprint") == F.col("print")).select(
        F.col("doc").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
