"""Personal data in texts: fixed rules, and spans that a trained tagger adds."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwake.llm.common import map_texts
from orderwake.llm.pii_model import FORBIDDEN, PADDING, TAGS, Tagger, fit_tagger, symbols
from orderwake.llm.pii_rules import KINDS, base_spans

#: Characters of a window, and between the starts of two.
WINDOW, STRIDE = 96, 64
#: Documents that the tagger's windows are taken from, about, and windows that it is fitted on at most.
FIT_DOCS = 20_000
FIT_WINDOWS = 1_600
#: Steps of the fit, however few windows there are, and windows in each.
FIT_STEPS, FIT_BATCH = 400, 48
#: Mean probability of its tags from which on a span is added.
SURE = 0.9
#: Every span holds a digit, or the @ of an address, so a window without either can't hold the core of one.
_CORE = re.compile(r"[0-9@]")
_NEEDED = {"email": re.compile("@"), "ip": re.compile("[0-9]"), "card": re.compile("[0-9]"), "phone": re.compile("[0-9]")}
#: Windows tagged at a time.
BATCH = 512


def window_starts(text: str) -> list[int]:
    """Starts of the windows, of those laid over the whole text, that hold a digit or an @."""
    starts: list[int] = []
    match = _CORE.search(text)
    while match:
        at = match.start()
        last = at // STRIDE
        first = max(0, (at - WINDOW) // STRIDE + 1, starts[-1] // STRIDE + 1 if starts else 0)
        starts += [i * STRIDE for i in range(first, last + 1)]
        match = _CORE.search(text, (last + 1) * STRIDE)
    return starts


def tag_spans(length: int, spans: dict[str, list[tuple[int, int]]]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, name in enumerate(KINDS):
        for start, end in spans[name]:
            if not tags[start:end].any():
                tags[start], tags[start + 1 : end] = 1 + 2 * kind, 2 + 2 * kind
    return tags


def _window(values: np.ndarray, start: int, fill: int) -> np.ndarray:
    part = values[start : start + WINDOW]
    return np.concatenate((part, np.full(WINDOW - len(part), fill)))


def varied(x: np.ndarray, tags: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Windows with other letters outside spans and in addresses, and other digits in addresses and telephone numbers.

    Neither changes what the rules say of a window, so few labelled spans make many. Digits of cards and IP
    addresses are kept, since the rules look at their values.
    """
    out, email, phone = x.copy(), (tags == 1) | (tags == 2), (tags == 7) | (tags == 8)
    some = rng.random(x.shape) < np.where(email | phone, 0.7, 0.3)
    for low, size, where in ((ord("a") - 32, 26, email | (tags == 0)), (ord("A") - 32, 26, email | (tags == 0)), (ord("0") - 32, 10, email | phone)):
        swap = some & where & (x >= low) & (x < low + size)
        out[swap] = low + rng.integers(0, size, int(swap.sum()))
    return out


def with_neighbours(starts: list[int], length: int) -> list[int]:
    """The windows and those before and after each, as far as the text reaches."""
    near = {n for s in starts for n in (s - STRIDE, s, s + STRIDE)}
    return sorted(n for n in near if 0 <= n < length)


def fit_pii(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = FIT_DOCS, fit_windows: int = FIT_WINDOWS, hidden: int = 24, steps: int = FIT_STEPS
) -> Tagger | None:
    """Fit the tagger on windows labelled by the base rules; None if there is no labelled span.

    About `fit_docs` rows are chosen by a hash of id and text, or all if there are fewer. Their windows are cut in
    tasks; the ones with the smallest hashes, each once, reach the driver: an eighth of `fit_windows` for
    each kind of span, and as many without a span as there are with one.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]"))
    share = fit_docs / max(docs.count(), 1)
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("doc", "text"), F.lit(1 << 32)) < int(share * (1 << 32)))

    def cut(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text in piece.column(1).to_pylist():
            if text:
                codes, tags = symbols(text), tag_spans(len(text), base_spans(text))
                for start in window_starts(text):
                    own = _window(tags, start, 0)
                    kinds = sorted({(t - 1) // 2 for t in own.tolist() if t})
                    found.append((_window(codes, start, PADDING).astype(np.uint8).tobytes(), own.astype(np.uint8).tobytes(), kinds or [-1]))
        columns = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.binary(), pa.list_(pa.int32())))], ["codes", "tags", "kinds"])

    windows = map_texts(rows, "text", cut, "codes binary, tags binary, kinds array<int>").withColumn("rank", F.xxhash64("codes", "tags")).distinct()
    # The windows of some fit_docs documents are few enough to be ranked kind by kind.
    place = F.row_number().over(Window.partitionBy("kind").orderBy("rank", "codes"))
    ranked = windows.select("codes", "tags", "rank", F.explode("kinds").alias("kind")).withColumn("place", place)
    most = fit_windows // (2 * len(KINDS))
    taken = ranked.where(F.col("place") <= F.when(F.col("kind") < 0, fit_windows // 2).otherwise(most)).collect()
    labelled = {(bytes(r["codes"]), bytes(r["tags"])) for r in taken if r["kind"] >= 0}
    if not labelled:
        return None
    plain = sorted((r["place"], bytes(r["codes"]), bytes(r["tags"])) for r in taken if r["kind"] < 0)[: len(labelled)]
    chosen = sorted(labelled) + [(codes, tags) for _, codes, tags in plain]
    x = np.stack([np.frombuffer(codes, np.uint8) for codes, _ in chosen]).astype(np.int64)
    tags = np.stack([np.frombuffer(own, np.uint8) for _, own in chosen]).astype(np.int64)
    return fit_tagger(x, tags, hidden=hidden, batch=FIT_BATCH, steps=steps, vary=varied)


def _regions(starts: list[int], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """Stretches of text that overlapping windows cover, with their windows."""
    own: list[int] = []
    for start in starts:
        if own and start > own[-1] + WINDOW - 1:
            yield own[0], min(own[-1] + WINDOW, length), own
            own = []
        own.append(start)
    if own:
        yield own[0], min(own[-1] + WINDOW, length), own


#: Share of a window's character in the mean: its distance from the window's edge.
_WEIGHT = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(float)


def _likely(codes: np.ndarray, windows: list[int], model: Tagger) -> Iterator[tuple[int, np.ndarray]]:
    """Windows of one text with the tag probabilities of their characters, BATCH at a time."""
    for at in range(0, len(windows), BATCH):
        own = windows[at : at + BATCH]
        found, _, _ = model.marginals(model.emissions(np.stack([_window(codes, s, PADDING) for s in own]).astype(np.int64)))
        yield from zip(own, found)


class _Path:
    """The best path over a stretch that is handed in piece by piece.

    As soon as all paths that may still win have a place in common, what lies before it is settled. Only the open end
    and the span that reaches into it are kept, however long the stretch is.
    """

    def __init__(self, moves: np.ndarray, first: int):
        self.moves, self.at, self.total = moves, first, None
        self.came: list[np.ndarray] = []
        self.share: list[np.ndarray] = []
        self.span: list | None = None  # kind, start, end and summed probability of the span that is not ended yet

    def add(self, share: np.ndarray) -> list[tuple[str, int, int, float]]:
        """Take the tag probabilities of further characters; give the spans that are settled."""
        scores = np.log(share)
        for t in range(len(scores)):
            if self.total is None:
                self.total = scores[0].copy()
                self.total[2::2] += FORBIDDEN
                self.came.append(np.zeros(TAGS, np.int8))
            else:
                step = self.total[:, None] + self.moves
                came = step.argmax(axis=0)
                self.total = step[came, np.arange(TAGS)] + scores[t]
                self.came.append(came.astype(np.int8))
            self.share.append(share[t])
        self.total -= self.total.max()
        state = np.arange(TAGS)
        for t in range(len(self.came) - 1, 0, -1):
            if (state == state[0]).all():
                return self._settle(t, int(state[0]), t)
            state = self.came[t][state]
        return []

    def close(self) -> list[tuple[str, int, int, float]]:
        found = self._settle(len(self.came) - 1, int(self.total.argmax()), len(self.came)) if self.came else []
        return found + self._ended()

    def _settle(self, last: int, state: int, upto: int) -> list[tuple[str, int, int, float]]:
        """Go back from `state` at the place `last` and hand on the `upto` places from the beginning."""
        path = [state]
        for t in range(last, 0, -1):
            path.append(int(self.came[t][path[-1]]))
        found = []
        for t, tag in enumerate(path[::-1][:upto]):
            sure = float(self.share[t][tag])
            if tag and tag % 2 == 0 and self.span:
                self.span[2], self.span[3] = self.at + t + 1, self.span[3] + sure
                continue
            found += self._ended()
            if tag % 2:
                self.span = [KINDS[(tag - 1) // 2], self.at + t, self.at + t + 1, sure]
        self.came, self.share, self.at = self.came[upto:], self.share[upto:], self.at + upto
        return found

    def _ended(self) -> list[tuple[str, int, int, float]]:
        if not self.span:
            return []
        kind, start, end, sure = self.span
        self.span = None
        return [(kind, start, end, sure / (end - start))]


def _path_spans(path: np.ndarray, share: np.ndarray, offset: int) -> list[tuple[str, int, int, float]]:
    found = []
    for start in np.flatnonzero(path % 2 == 1).tolist():
        end = start + 1
        while end < len(path) and path[end] == path[start] + 1:
            end += 1
        sure = float(share[np.arange(start, end), path[start:end]].mean())
        found.append((KINDS[(int(path[start]) - 1) // 2], offset + start, offset + end, sure))
    return found


def _best_paths(stretches: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """The best path over each of several stretches of tag probabilities, character by character for all at once."""
    order = sorted(range(len(stretches)), key=lambda i: -len(stretches[i]))
    sizes = np.array([len(stretches[i]) for i in order])
    steps = int(sizes[0])
    scores = np.zeros((steps, len(order), TAGS))
    for row, i in enumerate(order):
        scores[: sizes[row], row] = np.log(stretches[i])
    running = [int(np.searchsorted(-sizes, -t, "left")) for t in range(steps)]  # stretches longer than t
    came = np.zeros((steps, len(order), TAGS), np.int8)
    total = scores[0].copy()
    total[:, 2::2] += FORBIDDEN
    for t in range(1, steps):
        k = running[t]
        step = total[:k, :, None] + moves
        best = step.argmax(axis=1)
        came[t, :k] = best
        total[:k] = np.take_along_axis(step, best[:, None, :], axis=1)[:, 0] + scores[t, :k]
    state = total.argmax(axis=1)
    paths = np.zeros((steps, len(order)), np.int64)
    for t in range(steps - 1, -1, -1):
        k = running[t]
        paths[t, :k] = state[:k]
        if t:
            state[:k] = came[t, np.arange(k), state[:k]]
    result: list[np.ndarray] = [np.zeros(0, np.int64)] * len(order)
    for row, i in enumerate(order):
        result[i] = paths[: sizes[row], row]
    return result


def _long_stretch(codes: np.ndarray, lo: int, hi: int, windows: list[int], model: Tagger, moves: np.ndarray) -> Iterator[tuple[str, int, int, float]]:
    """Spans of a stretch of many windows; only the windows at hand and the open end of the path are kept."""
    path, sums, at = _Path(moves, lo), np.full((WINDOW, TAGS), 1e-9), lo
    for start, likely in _likely(codes, windows, model):
        if start > at:  # no later window reaches the characters before this one
            done = sums[: start - at]
            yield from path.add(done / done.sum(axis=1, keepdims=True))
            sums = np.concatenate((sums[start - at :], np.full((start - at, TAGS), 1e-9)))
            at = start
        n = min(WINDOW, hi - start)
        sums[:n] += likely[:n] * _WEIGHT[:n, None]
    done = sums[: hi - at]
    yield from path.add(done / done.sum(axis=1, keepdims=True))
    yield from path.close()


def tagged_spans(texts: list[str], model: Tagger) -> list[list[tuple[str, int, int, float]]]:
    """Per text the spans (kind, start, end, probability) that the tagger finds.

    Windows with a digit or an @ and their neighbours are decoded to tag probabilities; where windows overlap these
    are averaged, weighted by the distance from the window's edge, and one best path over the whole stretch settles
    the spans. Stretches are decoded together until their windows fill a batch, longer ones window by window.
    """
    moves = model.moves().astype(float)
    moves[moves > FORBIDDEN / 2] = 0.0
    result: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    waiting: list[tuple[int, int, np.ndarray, list[int]]] = []

    def settle() -> None:
        x = np.stack([_window(codes, s, PADDING) for _, _, codes, starts in waiting for s in starts]).astype(np.int64)
        found = np.concatenate([model.marginals(model.emissions(x[i : i + BATCH]))[0] for i in range(0, len(x), BATCH)])
        shares, at = [], 0
        for _, _, codes, starts in waiting:
            sums = np.full((len(codes), TAGS), 1e-9)
            for s in starts:
                n = min(WINDOW, len(codes) - s)
                sums[s : s + n] += found[at, :n] * _WEIGHT[:n, None]
                at += 1
            shares.append(sums / sums.sum(axis=1, keepdims=True))
        for (text, lo, _, _), share, path in zip(waiting, shares, _best_paths(shares, moves)):
            result[text] += _path_spans(path, share, lo)
        waiting.clear()

    n = 0
    for i, text in enumerate(texts):
        starts = with_neighbours(window_starts(text), len(text))
        if not starts:
            continue
        codes = symbols(text).astype(np.uint8)
        for lo, hi, windows in _regions(starts, len(text)):
            if len(windows) > BATCH // 4:
                result[i] += _long_stretch(codes, lo, hi, windows, model, moves)
                continue
            waiting.append((i, lo, codes[lo:hi].copy(), [s - lo for s in windows]))
            n += len(windows)
            if n >= BATCH:
                settle()
                n = 0
    if waiting:
        settle()
    return [sorted(own, key=lambda span: span[1]) for own in result]


def added_spans(text: str, base: dict[str, list[tuple[int, int]]], found: list[tuple[str, int, int, float]], sure: float) -> dict[str, list[tuple[int, int]]]:
    """Of the tagger's spans, in order, those that are likely enough, hold what their kind must hold, and touch no base span."""
    taken = sorted(s for spans in base.values() for s in spans)
    added: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    at, reach = 0, 0  # base spans that begin before the span's end, and how far they reach
    for kind, start, end, probability in found:
        while at < len(taken) and taken[at][0] < end:
            reach = max(reach, taken[at][1])
            at += 1
        if probability >= sure and reach <= start and _NEEDED[kind].search(text, start, end):
            added[kind].append((start, end))
    return added


def listed(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in KINDS for start, end in sorted(spans[kind]))


def find_pii(docs: DataFrame, model: Tagger | None, *, id_col: str = "doc_id", text_col: str = "text", sure: float = SURE) -> DataFrame:
    """Id, `n_email`, `n_ip`, `n_card`, `n_phone` (base spans), `base_sha256`, `spans` (base and added) of each row.

    Spans are kind:start:end in code points, by kind, then start, joined by commas. A null text is empty and
    has no spans; without a model only the base rules work. Rows that repeat are rows of the result each. Very long
    texts are tagged window by window. Columns other than id and text are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in piece.column(1).to_pylist()]
        none: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        base = [base_spans(t) if _CORE.search(t) else none for t in texts]
        found = tagged_spans(texts, shared.value) if shared.value else [[] for _ in texts]
        every = []
        for text, own, more in zip(texts, base, found):
            added = added_spans(text, own, more, sure) if more else none
            every.append(listed({k: own[k] + added[k] for k in KINDS}))
        columns = [pa.array([len(own[k]) for own in base], pa.int64()) for k in KINDS]
        digests = pa.array([hashlib.sha256(listed(own).encode()).hexdigest() for own in base])
        return pa.RecordBatch.from_arrays([piece.column(0), *columns, digests, pa.array(every)], [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_texts(rows, "text", work, f"`{id_col}` {kind}, {counts}, base_sha256 string, spans string")
