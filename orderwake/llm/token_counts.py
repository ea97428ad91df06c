"""Token counts that follow edits without encoding whole documents again."""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwake.llm.common import map_texts

#: What splits text before the merges of the rank file.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANKS = "byte_bpe_50k.tiktoken"
#: Characters beyond its end that may decide where a pre-token ends.
REACH = 2
EDITS = "array<struct<at:int,cut:int,put:string>>"


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


class PretokenCounter(dict):
    """Tokens of a pre-token; remembers up to `most` of them."""

    def __init__(self, path: str, most: int = 200_000):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(PRETOKEN).findall
        self.most = most

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n

    def leaves(self, text: str) -> tuple[list[int], list[int]]:
        found = self.split(text)
        return list(map(len, found)), [self[p] for p in found]


@lru_cache(maxsize=2)
def counter(path: str) -> PretokenCounter:
    return PretokenCounter(path)


class PretokenTree:
    """Segment tree over the pre-tokens of a text: each node has the characters and tokens below it.

    A slot holds the pre-tokens that took the place of one leaf. An edit encodes from the slot that holds the
    character REACH + 1 places before it up to the first new boundary behind it that is also an old one; from
    there on the old pre-tokens hold. Sums on the paths above the touched slots are updated.
    """

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, counts: PretokenCounter):
        self.counts, self.encoded = counts, 0
        n = max(1, len(chars))
        self.width = width = 1 << (n - 1).bit_length()
        levels = np.zeros((2, 2 * width), np.int64)
        levels[0, width : width + len(chars)], levels[1, width : width + len(tokens)] = chars, tokens
        at = width
        while at > 1:
            levels[:, at // 2 : at] = levels[:, at : 2 * at : 2] + levels[:, at + 1 : 2 * at : 2]
            at //= 2
        self.chars, self.tokens = levels[0].tolist(), levels[1].tolist()
        self.text, self.offsets = text, np.concatenate(([0], np.cumsum(chars, dtype=np.int64))).tolist()
        self.changed: dict[int, tuple[str, list[int], list[int]]] = {}
        self.n = n

    def _slot(self, slot: int) -> str:
        if slot in self.changed:
            return self.changed[slot][0]
        return self.text[self.offsets[slot] : self.offsets[slot + 1]] if slot + 1 < len(self.offsets) else ""

    def _find(self, place: int) -> tuple[int, int]:
        """Slot that holds the character, and where it starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def _put(self, slot: int, text: str, chars: list[int], tokens: list[int]) -> None:
        self.changed[slot] = (text, chars, tokens)
        node = slot + self.width
        self.chars[node], self.tokens[node] = len(text), sum(tokens)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, at: int, cut: int, put: str) -> None:
        """Replace `cut` characters from `at` on; both are held within the text."""
        length = self.chars[1]
        at = min(max(at, 0), length)
        cut = min(max(cut, 0), length - at)
        first, start = self._find(max(0, min(at - REACH - 1, length - 1))) if length else (0, 0)
        old, slot, bounds = [], first, {}
        reach = start  # old place up to which slots have been gathered
        want = at + cut + 32
        while True:
            while slot < self.n and reach < want:
                if slot > first:
                    bounds[reach] = slot
                part = self._slot(slot)
                old.append(part)
                reach += len(part)
                slot += 1
            if slot == self.n:
                reach = length
            near = "".join(old)
            old = [near]
            fresh = near[: at - start] + put + near[at - start + cut :]
            found = self.counts.split(fresh)
            shift, place, stop = len(put) - cut, 0, None
            for k, piece in enumerate(found):
                if place >= at - start + len(put) and place + start - shift in bounds:
                    stop = (k, bounds[place + start - shift])
                    break
                place += len(piece)
                if reach < length and place + REACH > len(fresh):
                    break
            if stop is None and reach >= length:
                stop = (len(found), self.n)
            if stop is not None:
                break
            want = reach + 2 * (reach - start) + 32
        pieces = found[: stop[0]]
        tokens = [self.counts[p] for p in pieces]
        self.encoded += len(pieces)
        for slot in range(first + 1, stop[1]):
            if self.chars[slot + self.width]:
                self._put(slot, "", [], [])
        if stop[1] > first:
            self._put(first, "".join(pieces), list(map(len, pieces)), tokens)

    def state(self, leaf_chars: np.ndarray, leaf_tokens: np.ndarray) -> tuple[str, list[int], list[int]]:
        """Text and leaves after the edits."""
        texts, chars, tokens = [], [], []
        for slot in range(self.n):
            if slot in self.changed:
                text, c, t = self.changed[slot]
                texts.append(text)
                chars += c
                tokens += t
            elif slot < len(leaf_chars):
                texts.append(self._slot(slot))
                chars.append(int(leaf_chars[slot]))
                tokens.append(int(leaf_tokens[slot]))
        return "".join(texts), chars, tokens


def after_edits(text: str, edits: list[dict], leaves: tuple[np.ndarray, np.ndarray], counts: PretokenCounter) -> tuple[PretokenTree, str, list[int], list[int]]:
    """The tree after all edits in order, with the text and leaves that it then stands for."""
    tree = PretokenTree(text, *leaves, counts)
    for e in edits:
        tree.edit(e["at"] or 0, e["cut"] or 0, e["put"] or "")
    return tree, *tree.state(*leaves)


def _packed(values: list[int]) -> bytes:
    return np.array(values, "<i4").tobytes()


def token_trees(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", edits_col: str | None = None, ranks: str | None = None) -> DataFrame:
    """State per row: `doc`, `text`, `leaf_chars`, `leaf_tokens` (packed 32-bit numbers), `n_tokens`.

    With `edits_col` the edits are carried along as `edits`. A null text counts as empty: no leaf, no token.
    """
    path, kind = ranks or default_ranks(), docs.schema[id_col].dataType.simpleString()
    edits = F.col(edits_col) if edits_col else F.lit(None)
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), edits.cast(EDITS).alias("edits"))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        leaves = [counter(path).leaves(t) for t in piece.column(1).to_pylist()]
        packed = [pa.array([_packed(x[k]) for x in leaves], pa.binary()) for k in (0, 1)]
        totals = pa.array([sum(x[1]) for x in leaves], pa.int64())
        return pa.RecordBatch.from_arrays([*piece.columns, *packed, totals], ["doc", "text", "edits", "leaf_chars", "leaf_tokens", "n_tokens"])

    return map_texts(rows, "text", work, f"doc {kind}, text string, edits {EDITS}, leaf_chars binary, leaf_tokens binary, n_tokens bigint")


def recount(trees: DataFrame, *, ranks: str | None = None) -> DataFrame:
    """The state of `token_trees` after each row's `edits`, with `n_before`, `n_edits` and `n_encoded`.

    `edits` lists (at, cut, put) in code points; each refers to the text that the edits before it have left.
    Places beyond the text are held at its ends; null numbers count as 0, a null `put` as empty, null edits
    and null lists as none. `n_encoded` counts the pre-tokens that were encoded again.
    """
    path, kind = ranks or default_ranks(), trees.schema["doc"].dataType.simpleString()

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        doc, texts, edits, chars, tokens, before = (piece.column(i) for i in range(6))
        made = []
        for text, own, c, t, n in zip(texts.to_pylist(), edits.to_pylist(), chars.to_pylist(), tokens.to_pylist(), before.to_pylist()):
            own = [e for e in own or [] if e]
            if not own:
                made.append((text, c, t, n, n, 0, 0))
                continue
            tree, changed, c, t = after_edits(text, own, (np.frombuffer(c, "<i4"), np.frombuffer(t, "<i4")), counter(path))
            made.append((changed, _packed(c), _packed(t), tree.tokens[1], n, len(own), tree.encoded))
        kinds = [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(x, k) for x, k in zip(zip(*made), kinds)]
        return pa.RecordBatch.from_arrays([doc, *columns], ["doc", "text", "leaf_chars", "leaf_tokens", "n_tokens", "n_before", "n_edits", "n_encoded"])

    return map_texts(
        trees.select("doc", "text", "edits", "leaf_chars", "leaf_tokens", "n_tokens"),
        "text",
        work,
        f"doc {kind}, text string, leaf_chars binary, leaf_tokens binary, n_tokens bigint, n_before bigint, n_edits bigint, n_encoded bigint",
    )


_NUMBER = re.compile(r"[0-9]+")


def cleaning_edits(text: str | None) -> list[dict]:
    """Edits that cut lines equal to an earlier one and write each run of digits as one 0, last place first."""
    edits, seen, start = [], set(), 0
    for line in (text or "").split("\n"):
        if line in seen and line:
            edits.append({"at": start - 1, "cut": len(line) + 1, "put": ""})
        else:
            seen.add(line)
            edits += [{"at": start + m.start(), "cut": m.end() - m.start(), "put": "0"} for m in _NUMBER.finditer(line)]
        start += len(line) + 1
    return edits[::-1]


def cleaned_token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """Id, `n_before`, `n_tokens`, `n_edits`, `n_encoded` (long) and `edited_sha256` of each row after its cleaning edits.

    Trees, edits and counts are made in one pass; no state travels. A null text counts as empty.
    """
    path, kind = ranks or default_ranks(), docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        counts, made = counter(path), []
        for text in piece.column(1).to_pylist():
            text = text or ""
            leaves = tuple(np.array(x, "<i4") for x in counts.leaves(text))
            before, edits = int(leaves[1].sum()), cleaning_edits(text)
            tokens, encoded = before, 0
            if edits:
                tree, text, _, _ = after_edits(text, edits, leaves, counts)
                tokens, encoded = tree.tokens[1], tree.encoded
            made.append((before, tokens, len(edits), encoded, hashlib.sha256(text.encode()).hexdigest()))
        kinds = [pa.int64()] * 4 + [pa.string()]
        columns = [pa.array(x, k) for x, k in zip(zip(*made), kinds)]
        return pa.RecordBatch.from_arrays([piece.column(0), *columns], [id_col, "n_before", "n_tokens", "n_edits", "n_encoded", "edited_sha256"])

    return map_texts(rows, "text", work, f"`{id_col}` {kind}, n_before bigint, n_tokens bigint, n_edits bigint, n_encoded bigint, edited_sha256 string")
