"""Remove passages that an earlier document holds as well."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwake.llm.common import SPACE_CLASS, portions

#: Two odd factors for polynomial hashes of byte ranges modulo 2 ** 64.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: Bytes of texts that are hashed at a time.
AT_ONCE = 2_000_000
#: Stands for a missing id: behind all others.
NO_ID = (1 << 63) - 1
_POWERS: dict[int, np.ndarray] = {}


def _powers(factor: int, n: int) -> np.ndarray:
    known = _POWERS.get(factor)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 21), factor, np.uint64)
        steps[0] = 1
        known = _POWERS[factor] = np.multiply.accumulate(steps)
    return known[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def planes(values: np.ndarray) -> bytes:
    """First the lowest byte of each value, then the second and so on, so that small values compress well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


@dataclass
class WordRuns:
    """The words of several texts, with prefix hashes over their bytes."""

    starts: np.ndarray
    ends: np.ndarray
    per_text: np.ndarray
    owner: np.ndarray  # text of each word
    place: np.ndarray  # of each word in its text
    data: np.ndarray

    def windows(self, size: int) -> np.ndarray:
        """First words of all runs of `size` words within a text."""
        left = self.per_text[self.owner] - self.place
        return np.flatnonzero(left >= size)

    def hashes(self, first: np.ndarray, size: int, factor: int) -> np.ndarray:
        """Of the runs that begin with the words `first`: words with one space between, whatever is before them."""
        n = len(self.data) + 1
        upto = np.zeros(n, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(factor, n - 1), out=upto[1:])
        begin = self.starts[first]
        inverse = _powers(pow(factor, -1, 1 << 64), n)
        return _mixed((upto[self.ends[first + size - 1]] - upto[begin]) * inverse[begin])


def word_runs(texts: list[str | None]) -> tuple[WordRuns, list[list[bytes]]]:
    words = [(t or "").encode().split() for t in texts]
    per_text = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"\n".join(b" ".join(own) for own in words if own), np.uint8)
    gaps = np.flatnonzero((data == 32) | (data == 10))
    n = int(per_text.sum())
    starts = np.concatenate(([0], gaps + 1)) if n else np.zeros(0, np.int64)
    ends = np.concatenate((gaps, [len(data)])) if n else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(words)), per_text)
    place = np.arange(n) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return WordRuns(starts, ends, per_text, owner, place, data), words


#: Rows that travel: hashes to a group by hash (`dest` names the groups of their documents), or results to the group
#: of their documents.
TRAVEL = pa.schema([("key", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("many", pa.binary()), ("at", pa.binary()), ("dest", pa.binary()), ("doc", pa.binary()), ("place", pa.binary())])
TRAVEL_SQL = "key int, low binary, high binary, many binary, at binary, dest binary, doc binary, place binary"
RESULT = pa.schema([("key", pa.int32()), ("doc", pa.binary()), ("place", pa.binary())])
RESULT_SQL = "key int, doc binary, place binary"


def _slices(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of equal sorted keys: key, from, to."""
    first = np.flatnonzero(np.diff(keys, prepend=-1)) if len(keys) else keys
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
        yield int(keys[a]), a, b


def results(dest: np.ndarray, doc: np.ndarray, place: np.ndarray) -> list[tuple[int, bytes, bytes]]:
    """(group of the documents, documents, places)."""
    order = np.lexsort((place, doc, dest))
    doc, place = doc[order], place[order]
    return [(k, planes(np.diff(doc[a:b], prepend=0)), planes(place[a:b])) for k, a, b in _slices(dest[order])]


def _travelling(found: list[tuple[int, bytes, bytes]]) -> list[tuple]:
    """Results as rows of TRAVEL."""
    return [(k, None, None, None, None, None, d, p) for k, d, p in found]


def probe_rows(dests: np.ndarray, ids: np.ndarray, runs: WordRuns, block: int, groups: int) -> list[tuple]:
    """Rows of TRAVEL for the rolling windows of some texts, and for the reference blocks among them.

    A hash is sent once, with a mark if several of these texts hold it. Blocks with such a hash are known to be
    repeated and go to their documents at once; the others go with their hash.
    """
    first = runs.windows(block)
    if not len(first):
        return []
    h = runs.hashes(first, block, FACTORS[0])
    key = ((h >> np.uint64(32)) % np.uint64(groups)) << np.uint64(32) | (h & np.uint64(0xFFFFFFFF))
    order = np.argsort(key, kind="stable")
    key, first = key[order], first[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    owner = runs.owner[first]
    many = np.minimum.reduceat(owner, at) != np.maximum.reduceat(owner, at)
    blocks = np.flatnonzero(runs.place[first] % block == 0)
    known = many[group[blocks]]
    dest, doc, place = dests[owner[blocks]], ids[owner[blocks]], (runs.place[first[blocks]] // block).astype(np.uint64)
    rows = _travelling(results(dest[known], doc[known], place[known]))
    group, dest, doc, place = group[blocks][~known], dest[~known], doc[~known], place[~known].astype(np.uint32)
    values = key[at]
    cuts = np.searchsorted(group, np.arange(len(values) + 1))
    for k, a, b in _slices((values >> np.uint64(32)).astype(np.int64)):
        low = (values[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        x, y = cuts[a], cuts[b]
        rows.append((k, planes(np.diff(low, prepend=np.uint32(0))), None, np.packbits(many[a:b]).tobytes(), planes(np.diff(group[x:y] - a, prepend=0).astype(np.uint32)), planes(dest[x:y]), planes(doc[x:y]), planes(place[x:y])))
    return rows


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _passed_on(rows: list[dict]) -> list[tuple]:
    """Results that only travel through the group by hash that has the number of their own group, as one row."""
    rows = [r for r in rows if r["low"] is None]
    doc, place = _gathered(rows)
    return results(np.full(len(doc), rows[0]["key"], np.int32), doc, place) if rows else []


def hit_blocks(table: pa.Table) -> pa.Table:
    """Blocks whose hash a window of another document has; documents differ if they come in different rows."""
    rows = table.to_pylist()
    done = _passed_on(rows)
    rows = [r for r in rows if r["low"] is not None]
    if rows:
        lows = [np.cumsum(from_planes(r["low"], "<u4"), dtype=np.uint32) for r in rows]
        low = np.concatenate(lows)
        many = np.concatenate([np.unpackbits(np.frombuffer(r["many"], np.uint8), count=len(x)) for r, x in zip(rows, lows)]).astype(bool)
        order = np.argsort(low, kind="stable")
        same = low[order][1:] == low[order][:-1]
        repeated = np.zeros(len(low), bool)
        repeated[1:] = same
        repeated[:-1] |= same
        hit = np.zeros(len(low), bool)
        hit[order] = repeated
        hit |= many
        base = np.cumsum([0, *map(len, lows)])
        at = np.concatenate([np.cumsum(from_planes(r["at"], "<u4")).astype(np.int64) + b for r, b in zip(rows, base)])
        dest = np.concatenate([from_planes(r["dest"], "<i4") for r in rows])
        doc = np.concatenate([from_planes(r["doc"], "<i8") for r in rows])
        place = np.concatenate([from_planes(r["place"], "<u4") for r in rows])
        found = hit[at]
        done += results(dest[found], doc[found], place[found].astype(np.uint64))
    return _table(done, RESULT)


def _gathered(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Documents and places of result rows, sorted by document."""
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = np.concatenate([np.cumsum(from_planes(r["doc"], "<i8")) for r in rows])
    place = np.concatenate([from_planes(r["place"], "<u8") for r in rows])
    order = np.lexsort((place, doc))
    return doc[order], place[order]


def _numbered(ids: np.ndarray, texts: list[str | None]) -> np.ndarray:
    """0 for the first row of an id, 1 for the second ... in the order of their texts."""
    number, last = np.zeros(len(ids), np.uint64), None
    if len(np.unique(ids)) == len(ids):
        return number
    for i in sorted(range(len(ids)), key=lambda i: (ids[i], texts[i] or "")):
        number[i] = number[last] + np.uint64(1) if last is not None and ids[last] == ids[i] else 0
        last = i
    return number


def _ids(table: pa.Table) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in table.column("doc").to_pylist()], np.int64)


def candidate_rows(docs: pa.Table, hits: pa.Table, window: int, block: int, groups: int) -> list[tuple]:
    """Rows of TRAVEL for the windows around hit blocks of a group's documents.

    Of windows with one hash only those of the smallest id are sent; the others are known to be repeated.
    """
    doc, place = _gathered(hits.to_pylist())
    ids, texts = _ids(docs), docs.column("text").to_pylist()
    own_key = np.asarray(docs.column("key")[:1], np.int32)
    kept = np.flatnonzero(np.isin(ids, doc))
    number, found, start, size = _numbered(ids, texts), [], 0, 0
    for end, i in enumerate(kept.tolist(), 1):  # texts of bounded size at a time
        size += len((texts[i] or "").encode())
        if size >= AT_ONCE or end == len(kept):
            own = kept[start:end]
            found.append(_windows_at_hits(ids[own], [texts[j] for j in own], number[own], doc, place, window, block))
            start, size = end, 0
    if not sum(len(x[0]) for x in found):
        return []
    h1, h2, doc, place = (np.concatenate(x) for x in zip(*found))
    key = (h1 >> np.uint64(32)) % np.uint64(groups)
    order = np.lexsort((place, doc, h2, h1, key))
    key, h1, h2, doc, place = key[order], h1[order], h2[order], doc[order], place[order]
    later = doc > _least(h1, h2, doc)
    rows = _travelling(results(np.repeat(own_key, later.sum()), doc[later], place[later]))
    h1, h2, doc, place, key = (x[~later] for x in (h1, h2, doc, place, key))
    rows += [(k, h1[a:b].tobytes(), h2[a:b].tobytes(), None, None, planes(own_key), planes(doc[a:b]), planes(place[a:b])) for k, a, b in _slices(key.astype(np.int64))]
    return rows


def _windows_at_hits(
    ids: np.ndarray, texts: list[str | None], number: np.ndarray, doc: np.ndarray, place: np.ndarray, window: int, block: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes, document and place of the windows that hold a hit block; `doc`, `place` are the hits."""
    runs, _ = word_runs(texts)
    per_blocks = runs.per_text // block + 1
    base = np.cumsum(per_blocks) - per_blocks
    hit = np.zeros(int(per_blocks.sum()) + 1, bool)
    lo, hi = np.searchsorted(doc, ids, "left"), np.searchsorted(doc, ids, "right")
    for i in range(len(ids)):
        own = place[lo[i] : hi[i]].astype(np.int64)
        hit[base[i] + own[own < per_blocks[i]]] = True
    first = runs.windows(window)
    owner = runs.owner[first]
    # A window holds just one whole block of its text's grid; if it is repeated elsewhere, so is that block.
    grid = -(-runs.place[first] // block)
    first = first[hit[base[owner] + grid]]
    h1, h2 = runs.hashes(first, window, FACTORS[0]), runs.hashes(first, window, FACTORS[1])
    owner = runs.owner[first]
    return h1, h2, ids[owner], number[owner] << np.uint64(32) | runs.place[first].astype(np.uint64)


def _least(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For rows sorted by hash, the smallest document of each row's hash."""
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    at = np.flatnonzero(new)
    return np.minimum.reduceat(doc, at)[np.cumsum(new) - 1] if len(at) else doc


def repeated_windows(table: pa.Table) -> pa.Table:
    """Windows whose hash a smaller id has as well; the windows of a row are of documents of one group."""
    rows = table.to_pylist()
    done = _passed_on(rows)
    rows = [r for r in rows if r["low"] is not None]
    if rows:
        h1 = np.concatenate([np.frombuffer(r["low"], "<u8") for r in rows])
        h2 = np.concatenate([np.frombuffer(r["high"], "<u8") for r in rows])
        dest = np.concatenate([np.repeat(from_planes(r["dest"], "<i4"), len(r["low"]) // 8) for r in rows])
        doc = np.concatenate([from_planes(r["doc"], "<i8") for r in rows])
        place = np.concatenate([from_planes(r["place"], "<u8") for r in rows])
        order = np.lexsort((h2, h1))
        dest, doc, place = dest[order], doc[order], place[order]
        later = doc > _least(h1[order], h2[order], doc)
        done += results(dest[later], doc[later], place[later])
    return _table(done, RESULT)


def without_repeats(docs: pa.Table, repeats: pa.Table, window: int) -> pa.Table:
    """Texts without the words that repeated windows cover."""
    doc, place = _gathered(repeats.to_pylist())
    ids, texts = _ids(docs), docs.column("text").to_pylist()
    number = _numbered(ids, texts)
    lo, hi = np.searchsorted(doc, ids, "left"), np.searchsorted(doc, ids, "right")
    kept, n_words, n_removed = [], [], []
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        own = place[lo[i] : hi[i]]
        own = own[own >> np.uint64(32) == number[i]] & np.uint64(0xFFFFFFFF)
        n_words.append(len(words))
        if len(own):
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, own.astype(np.int64), 1)
            np.add.at(change, np.minimum(own.astype(np.int64) + window, len(words)), -1)
            keep = np.cumsum(change)[:-1] == 0
            words = [w for w, k in zip(words, keep.tolist()) if k]
        n_removed.append(n_words[-1] - len(words))
        kept.append(b" ".join(words).decode())
    return pa.table({"doc": docs.column("doc"), "text": pa.array(kept, pa.string()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())})


def dealt_out(rows: DataFrame, groups: int) -> DataFrame:
    """Rows with the group (`key`) that works on their text.

    Nothing has to reach a row without words, so it may go anywhere; all others go where id and text say.
    """
    worded = F.col("text").rlike(f"[^{SPACE_CLASS}]")
    place = F.when(worded, F.xxhash64("doc", "text")).otherwise(F.xxhash64(F.spark_partition_id()))
    return rows.select(F.pmod(place, F.lit(groups).cast("bigint")).cast("int").alias("key"), "doc", "text")


def substring_dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 13, group_bytes: int = 8_000_000
) -> DataFrame:
    """Id, `text` (kept words, one space between), `n_words`, `n_removed` (long) of each row.

    A word goes if it lies in a window of `window` words that also begins in a row with a smaller id.
    Non-overlapping reference blocks of each text, (window + 1) / 2 words long, are indexed by hash and probed
    with every rolling window of that length of all texts: any repeated window holds one whole block. Around
    blocks that another text has, the hit is extended: windows are compared by two hashes of 64 bits each (of
    which some bits also choose the group), not by their words, and adjoining repeated windows make up maximal repeats. Hashes travel
    packed and once for each piece of input, so that a passage of many documents sends few rows to its group;
    the texts are dealt out once, for both passes over them.

    Groups, of texts as of hashes, follow the bytes of all texts: `group_bytes` of text in each on average, but never
    fewer groups than shuffle partitions. So a group's size and the share of blocks that seem repeated by their 32 bits
    within a group don't grow with the table. Texts are dealt by a hash of id and text, hence neither rows without id
    nor rows with one id meet in one group, unless their texts are equal too; rows without words stay spread as they
    come.

    Ids must be whole numbers. Rows without id count as behind all others; rows with equal ids don't remove
    each other's words. Null and empty texts have no words and come back as ''.
    """
    block = (window + 1) // 2
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // group_bytes))
    dealt = dealt_out(rows, groups)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in portions(batches, "text", AT_ONCE):
            runs, _ = word_runs(piece.column("text").to_pylist())
            found = _table(probe_rows(np.asarray(piece.column("key"), np.int32), _ids(piece), runs, block, groups), TRAVEL)
            yield from found.to_batches()

    hits = dealt.mapInArrow(probe, TRAVEL_SQL).groupBy("key").applyInArrow(hit_blocks, RESULT_SQL)
    candidates = dealt.groupBy("key").cogroup(hits.groupBy("key")).applyInArrow(lambda d, h: _table(candidate_rows(d, h, window, block, groups), TRAVEL), TRAVEL_SQL)
    repeats = candidates.groupBy("key").applyInArrow(repeated_windows, RESULT_SQL)
    return (
        dealt.groupBy("key")
        .cogroup(repeats.groupBy("key"))
        .applyInArrow(lambda d, r: without_repeats(d, r, window), "doc bigint, text string, n_words bigint, n_removed bigint")
        .select(F.col("doc").cast(docs.schema[id_col].dataType).alias(id_col), F.col("text").alias("text"), "n_words", "n_removed")
    )
