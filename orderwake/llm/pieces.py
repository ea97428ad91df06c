"""Encode texts into the pieces of a SentencePiece vocabulary by a shared-prefix Viterbi search, and decode them."""

from __future__ import annotations

import gc
import hashlib
import re
from collections import defaultdict
from functools import cached_property, lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwake.llm.common import map_texts

MODEL = "piece_bpe_32k.model"
#: How SentencePiece writes a space.
MARK = "▁"
#: What a character without piece scores below the worst piece.
UNKNOWN_PENALTY = 10.0
#: Words whose pieces a Python worker remembers from earlier batches.
REMEMBERED = 250_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Vocabulary:
    """Pieces with scores. Words are marked by a leading space here, which stands for MARK."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.raw: list[bytes] = []
        self.byte_ids = [0] * 256
        self.unknown = model.unk_id()
        self.scored: list[tuple[str, float, int]] = []
        for i in ids:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                text = piece.replace(MARK, " ")
                self.raw.append(text.encode())
                self.scored.append((text, model.get_score(i), i))
        self.has_bytes = any(model.is_byte(i) for i in ids)
        self.unknown_score = min(score for _, score, _ in self.scored) - UNKNOWN_PENALTY
        self.remembered: dict[str, tuple[int, ...]] = {}

    @cached_property
    def backwards(self) -> dict[str, list]:
        """Pieces by their characters from last to first: character -> [further characters, score, id or -1]."""
        root: dict[str, list] = {}
        for text, score, i in self.scored:
            further, node = root, []
            for c in reversed(text):
                node = further.setdefault(c, [{}, 0.0, -1])
                further = node[0]
            node[1:] = [score, i]
        gc.freeze()  # its many small tables stay; the garbage collector need not walk them again and again
        return root

    def spelled(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode()] if self.has_bytes else [self.unknown]

    def segment(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of the best-scoring pieces of each of the sorted, distinct words.

        The words form a trie that is walked depth first: `best` and `back` hold the forward scores along the
        path from the root, and a word reuses those of the prefix it shares with the word before it. Of equal
        scores the longer last piece wins.
        """
        root, worst = self.backwards, self.unknown_score
        best, back = [0.0], [(0, -1)]
        found: list[tuple[int, ...]] = []
        previous = ""
        for word in words:
            shared, most = 0, min(len(previous), len(word))
            while shared < most and previous[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, start, last = best[end - 1] + worst, end - 1, -1
                further = root
                for at in range(end - 1, -1, -1):
                    node = further.get(word[at])
                    if node is None:
                        break
                    further, score, piece = node
                    if piece >= 0:
                        score += best[at]
                        if score >= top:
                            top, start, last = score, at, piece
                best.append(top)
                back.append((start, last))
            ids: list[int] = []
            end = len(word)
            while end:
                at, piece_id = back[end]
                if piece_id >= 0:
                    ids.append(piece_id)
                else:
                    ids.extend(reversed(self.spelled(word[at:end])))
                end = at
            ids.reverse()
            found.append(tuple(ids))
            previous = word
        return found


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: No piece holds a space after another character, so these parts of a text can be segmented alone.
_WORD = re.compile(r" +[^ ]*")


def marked_words(text: str) -> list[str]:
    """Words with the spaces before them; a space is put in front of the text."""
    return _WORD.findall(" " + text.replace(MARK, " ")) if text else []


def encode_batch(texts: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts end to end, the number of ids and of words of each text."""
    number: defaultdict[str, int] = defaultdict(count().__next__)  # distinct words, numbered as they come
    found = []
    for text in texts:  # the words of one text at a time: most are copies of few
        words = marked_words(text or "")
        found.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    known = vocab.remembered
    new = sorted(number.keys() - known.keys())
    made = dict(zip(new, vocab.segment(new)))
    pieces = [made[w] if w in made else known[w] for w in number]
    room = max(0, REMEMBERED - len(known))
    known.update(zip(new[:room], map(made.__getitem__, new)))
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    flat = np.fromiter(chain.from_iterable(pieces), np.int32, int(sizes.sum()))
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
    per_text = np.fromiter(map(len, found), np.int64, len(found))
    order = np.concatenate([np.zeros(0, np.int64), *found])
    del number, found, made, pieces
    counts = sizes[order]
    ends = np.cumsum(counts)
    ids = flat[np.repeat(first[order] - (ends - counts), counts) + np.arange(int(counts.sum()))]
    upto = np.concatenate(([0], ends))
    text_ends = np.cumsum(per_text)
    return ids, upto[text_ends] - upto[text_ends - per_text], per_text


def encode_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """Id, `pieces` (array of ids) and `n_words` (marked words) of each row.

    The pieces of a text are those with the largest sum of scores, as SentencePiece's unigram rule has it; a
    character without piece is spelled in bytes. Distinct marked words of a batch are segmented once. A null
    or empty text has no pieces. U+2581 counts as a space.
    """
    path, kind = model or default_model(), docs.schema[id_col].dataType.simpleString()

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        ids, sizes, n_words = encode_batch(piece.column(1).to_pylist(), vocabulary(path))
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([piece.column(0), lists, pa.array(n_words)], [id_col, "pieces", "n_words"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_texts(rows, "text", work, f"`{id_col}` {kind}, pieces array<int>, n_words bigint")


def decode(ids: list[int], vocab: Vocabulary) -> str:
    text = b"".join([vocab.raw[i] for i in ids]).decode(errors="replace")
    return text[1:] if text.startswith(" ") else text


def decode_pieces(encoded: DataFrame, *, pieces_col: str = "pieces", text_col: str = "text", model: str | None = None) -> DataFrame:
    """All columns and `text_col`, the text that the pieces spell. Null pieces give '', bytes that are no UTF-8 U+FFFD."""
    path = model or default_model()
    schema = encoded.schema
    names = [c for c in encoded.columns if c != text_col]

    def run(batches):
        for batch in batches:
            vocab = vocabulary(path)
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [decode(ids or [], vocab) for ids in part.column(pieces_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(texts, pa.string())], [*names, text_col])

    from pyspark.sql.types import StringType, StructField, StructType

    return encoded.mapInArrow(run, StructType([*(schema[c] for c in names), StructField(text_col, StringType())]))


def encode_and_decode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """Id, `n_words`, `n_pieces`, `pieces`, and `decoded_sha256` of the text that the pieces spell, in one pass."""
    path, kind = model or default_model(), docs.schema[id_col].dataType.simpleString()

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        vocab = vocabulary(path)
        ids, sizes, n_words = encode_batch(piece.column(1).to_pylist(), vocab)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
        spelled = (decode(ids[a:b].tolist(), vocab) for a, b in zip(offsets.tolist(), offsets[1:].tolist()))
        digests = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in spelled], pa.string())
        columns = [piece.column(0), pa.array(n_words), pa.array(sizes.astype(np.int32)), lists, digests]
        return pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "n_pieces", "pieces", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_texts(rows, "text", work, f"`{id_col}` {kind}, n_words bigint, n_pieces int, pieces array<int>, decoded_sha256 string")
