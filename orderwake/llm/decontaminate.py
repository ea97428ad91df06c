"""Find benchmark passages in documents, allowing a few edits."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwake.llm.common import hold_batches, portions

#: Edits allowed per character of a test item.
ERROR_RATE = 0.08
#: Characters of test items that one pass over the documents looks for.
BLOCK_CHARS = 4_000_000
_GAPS = re.compile(r"[\W_]+")


def normalised(text: str | None) -> str:
    """Lower case, with one space for each run of anything but letters and digits, and a space at each end."""
    return f" {_GAPS.sub(' ', (text or '').lower()).strip()} "


def edit_budget(item: str, error_rate: float) -> int:
    return int(len(item) * error_rate)


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item in budget + 1 pieces with their offsets; with at most `budget` edits one of them is intact."""
    cut = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:])]


def best_distance(item: str, masks: dict[str, int], text: str) -> int:
    """Smallest edit distance between the item and any substring of the text, by bit-parallel columns."""
    m = len(item)
    every, top = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = every, 0, m
    best = m
    for c in text:
        same = masks.get(c, 0)
        vertical = same | down
        same = (((same & up) + up) ^ up) | same
        rise = down | ~(same | up) & every
        fall = up & same
        if rise & top:
            distance += 1
        elif fall & top:
            distance -= 1
            if distance < best:
                best = distance
        rise = rise << 1 & every
        up = (fall << 1 & every) | ~(vertical | rise) & every
        down = rise & vertical
    return best


class ItemBlock:
    """Test items of bounded total length, ready to be searched for."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float):
        self.items = items
        self.budgets = [edit_budget(text, error_rate) for _, text in items]
        self.masks: list[dict[str, int]] = []
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(items):
            masks: dict[str, int] = {}
            for at, c in enumerate(text):
                masks[c] = masks.get(c, 0) | 1 << at
            self.masks.append(masks)
            for offset, piece in pieces(text, self.budgets[i]):
                found.setdefault(piece, []).append((i, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, places)
        self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[object, int]]:
        """(item id, distance) of each item found in the normalised text."""
        regions: dict[int, list[list[int]]] = {}
        for end, places in self.automaton.iter(text):
            for i, upto in places:
                budget, length = self.budgets[i], len(self.items[i][1])
                start = end + 1 - upto
                lo, hi = max(0, start - budget), start + length + budget
                own = regions.setdefault(i, [])
                if own and lo <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(own[-1][0], lo), max(own[-1][1], hi)
                else:
                    own.append([lo, hi])
        for i, spans in sorted(regions.items()):
            name, item = self.items[i]
            best = min(0 if item in (part := text[lo:hi]) else best_distance(item, self.masks[i], part) for lo, hi in spans)
            if best <= self.budgets[i]:
                yield name, best


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, error_rate: float, most_chars: int) -> Iterator[ItemBlock]:
    """The test items in blocks of at most `most_chars` characters (or one item), read one after the other."""
    block: list[tuple[object, str]] = []
    size = 0
    for row in benchmark.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        text = normalised(row[1])
        if text.isspace():
            continue
        if block and size + len(text) > most_chars:
            yield ItemBlock(block, error_rate)
            block, size = [], 0
        block.append((row[0], text))
        size += len(text)
    if block:
        yield ItemBlock(block, error_rate)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Document id, item id and `distance` (smallest number of edits) for each test item found in a document.

    Both texts are lower-cased and reduced to words. An item of m characters may differ in error_rate * m
    edits; it is cut into one piece more than that, all pieces are looked up in one pass over each document,
    and every region around a hit is verified. Items are processed in blocks of bounded size, each against
    all documents. Null, empty and wordless items and texts match nothing; items too short for one edit must
    occur as whole words. Repeated documents or items give one row for each pair of ids.
    """
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    context = docs.sparkSession.sparkContext
    hold_batches(docs.sparkSession)

    def search(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = ItemBlock(*block.value)
            for piece in portions(batches, "text"):
                rows = [(doc, *match) for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()) if text for match in items.matches(normalised(text))]
                if rows:
                    kinds = [piece.schema.field(0).type, None, pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], ["doc", "item", "distance"])

        return texts.mapInArrow(run, f"doc {id_type}, item {item_type}, distance int")

    found = None
    for items in item_blocks(benchmark, item_id_col, item_text_col, error_rate, block_chars):
        part = search(context.broadcast((items.items, error_rate)))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"doc {id_type}, item {item_type}, distance int")
    return found.groupBy(F.col("doc").alias(id_col), F.col("item").alias(item_id_col)).agg(F.min("distance").alias("distance"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of `docs` whose text holds no test item (as in `contamination`); all columns stay as they are."""
    context, schema = docs.sparkSession.sparkContext, docs.schema
    hold_batches(docs.sparkSession)

    def without(frame: DataFrame, block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = ItemBlock(*block.value)
            for piece in portions(batches, text_col):
                texts = piece.column(text_col).to_pylist()
                yield piece.filter(pa.array([not text or next(items.matches(normalised(text)), None) is None for text in texts], pa.bool_()))

        return frame.mapInArrow(run, schema)

    for items in item_blocks(benchmark, item_id_col, item_text_col, error_rate, block_chars):
        docs = without(docs, context.broadcast((items.items, error_rate)))
    return docs
