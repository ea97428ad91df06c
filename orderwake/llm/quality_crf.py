"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderwake.llm.chars import code_points, letters, positions
from orderwake.llm.common import SPACE, fair_share, map_texts

#: Labelled documents that the model is fitted on at most.
FIT_DOCS = 4_000
#: Lines of a chain in the fit; a longer document is fitted as several chains (it is scored whole like any other).
FIT_LINES = 2_000
#: Lines that the model is fitted on at most. Beyond it the longest documents give a stretch of equal length each.
FIT_TOTAL = 400_000
#: Different texts of one labelled id that the model is fitted on at most.
FIT_REPEATS = 4
FIT_ROUNDS = 150
#: Weight of the squared weights against the mean log-likelihood of a line.
PENALTY = 1e-4

#: Classes of characters that are counted per line.
CLASSES = ("letter", "upper", "digit", "space", "symbol", "mark", "bar")
#: What is known of a line; each also enters for the line before and after.
FEATURES = (
    "length", "short", "letters", "upper", "digits", "symbols_per_word", "marks_per_word", "bars_per_word",
    "word_length", "distinct_words", "seen_before", "empty",
)


def _classes() -> np.ndarray:
    """For each code point, a bit for each of CLASSES."""
    table = np.zeros(0x110000, np.uint8)
    table[np.flatnonzero(letters())] |= 1
    upper = [i for i in np.flatnonzero(letters()).tolist() if chr(i).isupper()]
    for bit, members in ((2, upper), (4, range(48, 58)), (8, map(ord, SPACE)), (16, map(ord, "#*$%&<>")), (32, map(ord, "!?=\"'")), (64, [ord("|")])):
        table[list(members)] |= bit
    return table


_TABLE: list[np.ndarray] = []


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, line lengths, and lines per text; a null or empty text is one empty line."""
    if not _TABLE:
        _TABLE.append(_classes())
    split = [t.split("\n") for t in texts]
    lines = [line for own in split for line in own]
    per_text = np.fromiter(map(len, split), np.int64, len(split))
    codes, offsets = code_points(lines)
    bits = _TABLE[0][codes]
    del codes
    sums = []
    upto = np.zeros(len(bits) + 1, np.int32)  # an Arrow text has less than 2**31 bytes
    for bit in range(len(CLASSES)):
        np.cumsum(bits >> bit & 1, dtype=np.int32, out=upto[1:])
        sums.append(upto[offsets[1:]] - upto[offsets[:-1]])
    letter, upper, digit, space, symbol, mark, bar = (x.astype(float) for x in sums)
    n_words, distinct, seen = (np.zeros(len(lines)) for _ in range(3))
    i = 0
    for own in split:
        before: set[str] = set()
        for line in own:
            words = line.split()
            n_words[i], distinct[i] = len(words), len(set(words))
            if line in before:
                seen[i] = 1
            elif words:
                before.add(line)
            i += 1
    length = np.diff(offsets).astype(float)
    chars, words = np.maximum(length - space, 1), np.maximum(n_words, 1)
    features = np.stack(
        [
            np.log1p(length) / 5, length < 30, letter / chars, upper / np.maximum(letter, 1), digit / chars,
            np.minimum(symbol / words, 4), np.minimum(mark / words, 4), np.minimum(bar / words, 2),
            np.minimum((length - space) / words, 20) / 10, distinct / words, seen, n_words == 0,
        ],
        axis=1,
    )
    return features, length, per_text


def with_neighbours(features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Each line's features with those of the line before and after (zero at the ends, which are marked), and a one."""
    n, width = features.shape
    starts = np.cumsum(per_text) - per_text
    out = np.zeros((n, 3 * width + 3))
    out[:, :width] = features
    out[1:, width : 2 * width], out[:-1, 2 * width : 3 * width] = features[:-1], features[1:]
    out[starts, width : 2 * width] = 0
    out[starts + per_text - 1, 2 * width : 3 * width] = 0
    out[starts, -3], out[starts + per_text - 1, -2], out[:, -1] = 1, 1, 1
    return out


def forward_backward(emissions: np.ndarray, transitions: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of each line's label, expected counts of label pairs, and the log of the sum over all labellings.

    `emissions` has a score per line and label (bad, good); all texts advance together, line by line.
    """
    n = len(emissions)
    order, running = positions(per_text)
    starts = (np.cumsum(per_text) - per_text)[order]
    top = emissions.max(axis=1, keepdims=True)
    local, step_to = np.exp(emissions - top), np.exp(transitions)
    forward, scale = np.zeros((n, 2)), np.zeros(n)
    for step, k in enumerate(running):
        now = starts[:k] + step
        value = local[now] * (forward[now - 1] @ step_to if step else 1.0)
        scale[now] = value.sum(axis=1)
        forward[now] = value / scale[now][:, None]
    backward = np.ones((n, 2))
    pairs = np.zeros((2, 2))
    for step in range(len(running) - 2, -1, -1):
        k = running[step + 1]
        now = starts[:k] + step
        after = local[now + 1] * backward[now + 1] / scale[now + 1][:, None]
        backward[now] = after @ step_to.T
        pairs += (forward[now].T @ after) * step_to
    return forward * backward, pairs, float(np.log(scale).sum() + top.sum())


@dataclass
class LineField:
    """Weights of a fitted field; `weights` give the score of label good over bad."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, rows: np.ndarray) -> np.ndarray:
        good = ((rows - self.mean) / self.spread) @ self.weights
        return np.stack([np.zeros(len(good)), good], axis=1)

    def lines(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability that a line is good, for the lines of all texts, their lengths, and lines per text."""
        features, length, per_text = line_features(texts)
        marginals, _, _ = forward_backward(self.emissions(with_neighbours(features, per_text)), self.transitions, per_text)
        return marginals[:, 1], length, per_text

    def scores(self, texts: list[str]) -> np.ndarray:
        """Per text the mean probability that a line is good, weighted by line length plus one."""
        if not texts:
            return np.zeros(0)
        likely, length, per_text = self.lines(texts)
        owner = np.repeat(np.arange(len(texts)), per_text)
        weight = length + 1
        good = np.bincount(owner, weights=weight * likely, minlength=len(texts))
        return np.clip(good / np.bincount(owner, weights=weight, minlength=len(texts)), 0.0, 1.0)


def _chains(per_text: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the chains that texts of so many lines are cut into, and chains per text."""
    chains = -(-per_text // longest)
    sizes = np.full(chains.sum(), longest)
    sizes[np.cumsum(chains) - 1] = per_text - (chains - 1) * longest
    return sizes, chains


def fit_field(features: np.ndarray, per_text: np.ndarray, good: np.ndarray, rounds: int = FIT_ROUNDS, longest: int = FIT_LINES) -> LineField:
    """Maximise the likelihood of the labellings in which each line has its document's label.

    Texts of more than `longest` lines are cut into chains after their lines have met their neighbours, so all
    lines count; only the label pairs at the cuts do not.
    """
    rows = with_neighbours(features, per_text)
    per_text, chains = _chains(per_text, longest)
    good = np.repeat(good, chains)
    mean, spread = rows.mean(axis=0), rows.std(axis=0)
    mean[-1], spread[spread < 1e-9] = 0.0, 1.0
    rows = (rows - mean) / spread
    label = np.repeat(good.astype(float), per_text)
    inner = per_text - 1
    observed = np.diag([inner[good == 0].sum(), inner[good == 1].sum()]).astype(float)
    parameters = np.zeros(rows.shape[1] + 4)
    momentum, energy, n = np.zeros_like(parameters), np.zeros_like(parameters), len(rows)
    for step in range(1, rounds + 1):
        weights, transitions = parameters[:-4], parameters[-4:].reshape(2, 2)
        value = rows @ weights
        marginals, pairs, _ = forward_backward(np.stack([np.zeros(n), value], axis=1), transitions, per_text)
        slope = np.concatenate((rows.T @ (label - marginals[:, 1]), (observed - pairs).ravel())) / n - PENALTY * parameters
        momentum += 0.1 * (slope - momentum)
        energy += 0.01 * (slope**2 - energy)
        parameters = parameters + 0.1 * (momentum / (1 - 0.9**step)) / (np.sqrt(energy / (1 - 0.99**step)) + 1e-8)
    return LineField(mean, spread, parameters[:-4], parameters[-4:].reshape(2, 2))


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_docs: int = FIT_DOCS, fit_lines: int = FIT_LINES, fit_total: int = FIT_TOTAL
) -> LineField:
    """Fit on the at most `fit_docs` labelled documents whose ids have the smallest hashes.

    Line features are made in tasks; only they reach the driver. Rows with a null id or label are not used. Long
    documents are fitted as chains of `fit_lines` lines. If the documents have more than `fit_total` lines, the
    longest give a stretch of equal length each, so that none is left out; its place is chosen by a hash. Of an id
    that repeats, at most FIT_REPEATS different texts are used, so the driver gets features of at most
    `fit_docs` * FIT_REPEATS texts. With no row or one label only, every text scores the same.
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("labelled"))
        .agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("labelled"))
        .limit(fit_docs)
    )
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash")).join(
        F.broadcast(chosen), F.col("doc") == F.col("labelled")
    )
    # An id may repeat without bound: a few of its texts are enough, each once.
    place = F.row_number().over(Window.partitionBy("doc").orderBy("hash"))
    few = rows.select("doc", "hash").distinct().withColumn("place", place).where(F.col("place") <= FIT_REPEATS)
    few = few.select(F.col("doc").alias("few_doc"), F.col("hash").alias("few_hash"))  # FIT_REPEATS rows per chosen id at most
    rows = rows.join(F.broadcast(few), (F.col("doc") == F.col("few_doc")) & (F.col("hash") == F.col("few_hash"))).dropDuplicates(["doc", "hash"])

    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1))
    share = fair_share({r["n"]: r["count"] for r in rows.groupBy(n_lines.alias("n")).count().collect()}, fit_total)

    def measure(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in piece.column(1).to_pylist()]
        features, _, per_text = line_features(texts)
        starts = np.cumsum(per_text) - per_text
        packed = []
        for text, start, n in zip(texts, starts.tolist(), per_text.tolist()):
            skipped = zlib.crc32(text.encode("utf-8", "surrogatepass")) % (n - share + 1) if n > share else 0
            packed.append(features[start + skipped : start + skipped + min(n, share)].astype("<f4").tobytes())
        return pa.RecordBatch.from_arrays([piece.column(0), pa.array(packed, pa.binary()), piece.column(2)], ["doc", "features", "label"])

    kind = docs.schema[id_col].dataType.simpleString()
    measured = map_texts(rows.select("doc", "text", "label"), "text", measure, f"doc {kind}, features binary, label int").collect()
    measured.sort(key=lambda r: (r["doc"], r["features"]))
    good = np.array([r["label"] for r in measured], int)
    width = len(FEATURES)
    if len(set(good.tolist())) < 2:
        even = np.zeros(3 * width + 3)
        even[-1] = 0.0 if not len(good) else (4.0 if good[0] else -4.0)
        return LineField(np.zeros_like(even), np.ones_like(even), even, np.zeros((2, 2)))
    features = [np.frombuffer(r["features"], "<f4").reshape(-1, width).astype(float) for r in measured]
    return fit_field(np.concatenate(features), np.array([len(f) for f in features]), good, longest=fit_lines)


def quality_scores(docs: DataFrame, model: LineField, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Id, `score` (0 to 1) and `predicted` (1 from `threshold` on) of each row; a null text is scored as empty."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.scores([t or "" for t in piece.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([piece.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))], [id_col, "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_texts(rows, "text", work, f"`{id_col}` {kind}, score double, predicted int")


def line_labels(docs: DataFrame, model: LineField, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Id, `line_scores` (probability that the line is good) and `line_labels` (1 from `threshold` on) of each row.

    Both are arrays with an entry for each line, in order; a null or empty text is one empty line.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        likely, _, per_text = shared.value.lines([t or "" for t in piece.column(1).to_pylist()])
        offsets = pa.array(np.concatenate(([0], np.cumsum(per_text))), pa.int32())
        scores, labels = (pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (likely, (likely >= threshold).astype(np.int32)))
        return pa.RecordBatch.from_arrays([piece.column(0), scores, labels], [id_col, "line_scores", "line_labels"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_texts(rows, "text", work, f"`{id_col}` {kind}, line_scores array<double>, line_labels array<int>")


def keep_good(docs: DataFrame, model: LineField, *, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows whose text scores at least `threshold`; all columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.scores([t or "" for t in piece.column(text_col).to_pylist()])
        return piece.filter(pa.array(found >= threshold))

    return map_texts(docs, text_col, work, docs.schema)


def training_fold(id_col: str | Column) -> Column:
    """Rows that labels may be learned from: those whose id's checksum is not divisible by 5."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(column.cast("string")) % 5 != 0
