"""Languages of texts, also of parts of mixed texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwake.llm.chars import code_points, letters, lower, positions
from orderwake.llm.common import fair_share, map_texts

#: First code points of script ranges, in order; a range ends where the next begins. Fixed values (Unicode blocks).
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"),
    (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"),
    (0xA800, "other"), (0xAB30, "latin"), (0xAB70, "other"), (0xAC00, "hangul"), (0xD800, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x323B0, "other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_RANGES))
_STARTS = np.array([start for start, _ in SCRIPT_RANGES])
_NUMBERS = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])

#: Bins of the hashed character trigrams.
BINS = 1 << 16
#: Labelled documents that the model is fitted on at most.
FIT_DOCS = 8_000
#: What a change of language between two words costs, in natural logarithms of likelihood.
SWITCH = 12.0
#: Share of a language's letters that a script must have for its words to be candidates.
SCRIPT_SHARE = 0.001
UNDETERMINED = "und"


@dataclass
class Words:
    """Words of many texts: runs of letters of one script."""

    script: np.ndarray
    start: np.ndarray  # within the text
    size: np.ndarray  # letters
    per_text: np.ndarray
    first_letter: np.ndarray  # into trigrams
    trigrams: np.ndarray  # bin of each letter with its neighbours in the word


def split_words(texts: list[str]) -> Words:
    codes, offsets = code_points(texts)
    at = np.flatnonzero(letters()[codes])
    if not len(at):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(len(texts), np.int64), none, none)
    found = lower()[codes[at]].astype(np.uint64)
    script = _NUMBERS[np.searchsorted(_STARTS, found, side="right") - 1]
    text = np.searchsorted(offsets, at, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(script) != 0) | (np.diff(text) != 0)
    last = np.append(new[1:], True)
    before = np.where(new, 0, np.concatenate(([0], found[:-1]))).astype(np.uint64)
    after = np.where(last, 0, np.append(found[1:], 0)).astype(np.uint64)
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (found * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (after * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    trigrams = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64)
    first = np.flatnonzero(new)
    owner = text[first]
    return Words(script[first], at[first] - offsets[owner], np.diff(np.append(first, len(at))), np.bincount(owner, minlength=len(texts)), first, trigrams)


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # per trigram bin and language, log probability
    candidates: np.ndarray  # per script and language, whether words of the script may be in it

    def word_scores(self, words: Words) -> np.ndarray:
        """Per word and language; a word of a script that no language has tells nothing."""
        summed = np.add.reduceat(self.scores[words.trigrams], words.first_letter, axis=0)
        allowed = self.candidates[words.script]
        summed[~allowed] = -1e9
        summed[~allowed.any(axis=1)] = 0
        return summed

    def label(self, words: Words, switch: float) -> np.ndarray:
        """Language of each word, by a Viterbi search over each text that runs for all texts at once."""
        if not len(words.script):
            return np.zeros(0, np.int64)
        scores = self.word_scores(words)
        starts = np.cumsum(words.per_text) - words.per_text
        order, running = positions(words.per_text)
        starts = starts[order]
        came = np.zeros(scores.shape, np.int8 if len(self.languages) < 128 else np.int32)
        stay = np.arange(len(self.languages))
        total = np.zeros((len(starts), len(self.languages)))
        for step, k in enumerate(running):
            now = starts[:k] + step
            if step:
                top = total[:k].argmax(axis=1)
                change = total[:k][np.arange(k), top] - switch
                moved = change[:, None] > total[:k]
                came[now] = np.where(moved, top[:, None], stay)
                total[:k] = np.where(moved, change[:, None], total[:k])
            total[:k] += scores[now]
        state = total.argmax(axis=1)
        labels = np.zeros(len(scores), np.int64)
        for step in range(len(running) - 1, -1, -1):
            k = running[step]
            now = starts[:k] + step
            labels[now] = state[:k]
            state[:k] = came[now, state[:k]] if step else state[:k]
        return labels


def fit_languages(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_docs: int = FIT_DOCS) -> LanguageModel:
    """Trigram probabilities and scripts per language, from at most `fit_docs` labelled rows.

    Of each language the rows with the smallest hashes of id and text are taken: the same number of each, or all
    if it has fewer, and at least one, so every language that occurs is learned, however rare. Rows that repeat
    language, id and text count once. Rows with a null language or text are not used.

    A sketch counts the rows of each language; from it follows a hash up to which about twice the wanted rows lie,
    and only those are ranked. Trigrams are counted in tasks. A language costs the driver three rows, the last one
    with at most BINS counters (512 kB, packed), and the model 256 kB.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(id_col, text_col).alias("rank"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    sizes = {r["lang"]: max(1, r["n"]) for r in rows.groupBy("lang").agg(F.approx_count_distinct("rank", 0.02).alias("n")).collect()}
    if not sizes:
        return LanguageModel([], np.zeros((BINS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    spark = labelled.sparkSession
    share = fair_share(Counter(min(n, fit_docs) for n in sizes.values()), fit_docs)
    below = [(lang, -(1 << 63) + min((1 << 64) - 1, (2 * share + 100) * (1 << 64) // n)) for lang, n in sizes.items()]
    ranked = rows.join(F.broadcast(spark.createDataFrame(below, "lang string, below bigint")), "lang").where(F.col("rank") <= F.col("below"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("rank"))
    smallest = ranked.select("lang", "rank").distinct().withColumn("place", place).where(F.col("place") <= share)
    last = spark.createDataFrame(smallest.groupBy("lang").agg(F.max("rank").alias("last")).collect(), "lang string, last bigint")

    def count(piece: pa.RecordBatch) -> pa.RecordBatch:
        names = np.array(piece.column(0).to_pylist(), object)
        words = split_words(piece.column(1).to_pylist())
        owner = np.repeat(np.arange(len(names)), words.per_text)
        found: list[tuple[str, int, int]] = []
        for name in sorted(set(names)):
            own = (names == name)[owner]
            letters_of = np.bincount(words.script[own], weights=words.size[own], minlength=len(SCRIPTS)).astype(int)
            grams = np.bincount(words.trigrams[np.repeat(own, words.size)], minlength=BINS)
            at = np.flatnonzero(grams)
            found += zip([name] * len(at), at.tolist(), grams[at].tolist())
            found += [(name, BINS + i, n) for i, n in enumerate(letters_of.tolist()) if n]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else ((), (), ()), (pa.string(), pa.int32(), pa.int64()))], ["lang", "bin", "n"])

    def pack(table: pa.Table) -> pa.Table:
        bins, n = (np.asarray(table.column(c).to_numpy(), "<i4") for c in ("bin", "n"))
        return pa.table({"lang": table.column("lang").slice(0, 1), "bins": pa.array([bins.tobytes()], pa.binary()), "n": pa.array([n.tobytes()], pa.binary())})

    used = rows.join(F.broadcast(last), "lang").where(F.col("rank") <= F.col("last")).dropDuplicates(["lang", "rank"]).select("lang", "text")
    counts = map_texts(used, "text", count, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").applyInArrow(pack, "lang string, bins binary, n binary").collect()
    packed.sort(key=lambda r: r["lang"])
    scores = np.zeros((BINS, len(packed)), np.float32)
    scripts = np.zeros((len(SCRIPTS), len(packed)), bool)
    for i, r in enumerate(packed):
        grams = np.zeros(BINS + len(SCRIPTS))
        grams[np.frombuffer(r["bins"], "<i4")] = np.frombuffer(r["n"], "<i4")
        scores[:, i] = np.log((grams[:BINS] + 0.5) / (grams[:BINS].sum() + 0.5 * BINS))
        scripts[:, i] = grams[BINS:] / max(grams[BINS:].sum(), 1) >= SCRIPT_SHARE
    return LanguageModel([r["lang"] for r in packed], scores, scripts)


def language_spans(
    docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH, spans: bool = True
) -> DataFrame:
    """Id, `lang_pred`, `score` and, if asked for, `spans` (start, end, lang; code points) of each row.

    Words are runs of letters of one script; their scripts narrow the languages, and a Viterbi search with a
    penalty for each change labels them. The text's language is the one with most letters (of equals the first by
    name), `score` its share of the letters. Null texts, texts without letters, and all texts if the model knows
    no language, get 'und', 0.0 and no spans.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shape = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value
        texts = [t or "" for t in piece.column(1).to_pylist()]
        n = len(known.languages)
        words = split_words(texts if n else [""] * len(texts))
        labels = known.label(words, switch)
        owner = np.repeat(np.arange(len(texts)), words.per_text)
        share = np.bincount(owner * n + labels, weights=words.size, minlength=len(texts) * n).reshape(len(texts), n) if n else np.zeros((len(texts), 1))
        total, best = share.sum(axis=1), share.argmax(axis=1)
        names = [known.languages[b] if t else UNDETERMINED for b, t in zip(best.tolist(), total.tolist())]
        score = np.where(total > 0, share.max(axis=1) / np.maximum(total, 1), 0.0)
        columns = [piece.column(0), pa.array(names), pa.array(score)]
        if spans:
            columns.append(pa.array(_spans(words, labels, owner, known.languages, len(texts)), shape))
        return pa.RecordBatch.from_arrays(columns, [id_col, "lang_pred", "score", "spans"][: len(columns)])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"`{id_col}` {kind}, lang_pred string, score double" + ", spans array<struct<start:int,end:int,lang:string>>" * spans
    return map_texts(rows, "text", work, schema)


def _spans(words: Words, labels: np.ndarray, owner: np.ndarray, languages: list[str], n: int) -> Iterator[list[dict]]:
    """Runs of words with one label, per text."""
    found: list[list[dict]] = [[] for _ in range(n)]
    if len(labels):
        new = np.ones(len(labels), bool)
        new[1:] = (np.diff(labels) != 0) | (np.diff(owner) != 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(labels)) - 1
        for a, b in zip(first.tolist(), last.tolist()):
            found[owner[a]].append({"start": int(words.start[a]), "end": int(words.start[b] + words.size[b]), "lang": languages[labels[a]]})
    return found
