"""Character-level bidirectional LSTM with a CRF on top, in numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from orderwake.llm.pii_rules import KINDS

#: Outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
#: Printable ASCII characters have symbols of their own; then come white space, other letters, everything else, padding.
SYMBOLS = 95 + 4
PADDING = SYMBOLS - 1
FORBIDDEN = -1e4


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out = np.where((codes >= 32) & (codes < 127), codes - 32, 97)
    out[(codes >= 9) & (codes <= 13)] = 95
    out[codes >= 0xC0] = 96
    return out


def allowed_moves() -> np.ndarray:
    """FORBIDDEN for a move to the inside of a kind from anything but that kind, else 0."""
    moves = np.zeros((TAGS, TAGS))
    for kind in range(len(KINDS)):
        moves[:, 2 + 2 * kind] = FORBIDDEN
        moves[1 + 2 * kind : 3 + 2 * kind, 2 + 2 * kind] = 0
    return moves


class Tagger:
    """Parameters by name. Both directions run side by side: the first axis of `table` (inputs and bias) and `recur`.

    Gates are in, forget, out, new. The second direction reads the text from its end.
    """

    def __init__(self, hidden: int, seed: int = 0, kind: type = np.float64):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p: dict[str, np.ndarray] = {
            "table": rng.normal(0, 0.3, (2, SYMBOLS, 4 * hidden)),
            "recur": rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, 4 * hidden)),
            "out": rng.normal(0, 0.3, (2 * hidden, TAGS)),
            "bias": np.zeros(TAGS),
            "moves": np.zeros((TAGS, TAGS)),
        }
        self.p["table"][:, :, hidden : 2 * hidden] += 1.0
        self.p = {name: value.astype(kind) for name, value in self.p.items()}

    def _run(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, list]:
        """Hidden states (time, batch, 2 * hidden) in text order, the symbols as each direction reads them, and what
        the way back needs."""
        h, (n, steps) = self.hidden, x.shape
        table = self.p["table"].reshape(2 * SYMBOLS, 4 * h)
        read = np.stack((x.T, x.T[::-1] + SYMBOLS), axis=1)  # (time, direction, batch)
        # A logistic gate is a stretched and shifted hyperbolic tangent.
        scale = np.full(4 * h, 0.5, table.dtype)
        scale[3 * h :] = 1.0
        shift = 1.0 - scale
        shift[3 * h :] = 0.0
        state, cell = np.zeros((2, n, h), table.dtype), np.zeros((2, n, h), table.dtype)
        out, kept = np.empty((steps, 2, n, h), table.dtype), []
        for t in range(steps):
            gates = np.matmul(state, self.p["recur"])
            gates += table[read[t]]
            gates *= scale
            np.tanh(gates, out=gates)
            gates *= scale
            gates += shift
            before, was = cell, state
            cell = gates[..., h : 2 * h] * cell + gates[..., :h] * gates[..., 3 * h :]
            bent = np.tanh(cell)
            state = gates[..., 2 * h : 3 * h] * bent
            out[t] = state
            if keep:
                kept.append((gates, before, bent, was))
        return np.concatenate((out[:, 0], out[::-1, 1]), axis=2), read, kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Scores (batch, time, tag)."""
        return np.swapaxes(self._run(x)[0] @ self.p["out"] + self.p["bias"], 0, 1)

    def moves(self) -> np.ndarray:
        return self.p["moves"] + allowed_moves()

    def marginals(self, emissions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of tags (batch, time, tag), expected moves, and the log partition of each sequence.

        The sums run over likelihoods that are scaled to one in each step; the scales make up the partition.
        """
        n, steps, _ = emissions.shape
        top = emissions.max(axis=2, keepdims=True)
        likely = np.ascontiguousarray(np.swapaxes(np.exp(emissions - top), 0, 1).astype(float))  # (time, batch, tag)
        moves = np.exp(self.moves().astype(float))
        ahead, back, scale = np.empty_like(likely), np.ones_like(likely), np.empty((steps, n, 1))
        likely[0, :, 2::2] = 0.0  # a window that begins inside a span is read as beginning outside
        for t in range(steps):
            own = likely[t] if not t else (ahead[t - 1] @ moves) * likely[t]
            scale[t] = np.maximum(own.sum(axis=1, keepdims=True), 1e-300)
            ahead[t] = own / scale[t]
        for t in range(steps - 2, -1, -1):
            back[t] = ((likely[t + 1] * back[t + 1]) @ moves.T) / scale[t + 1]
        after = (likely[1:] * back[1:] / scale[1:]).reshape(-1, TAGS)
        pairs = (ahead[:-1].reshape(-1, TAGS).T @ after) * moves
        total = np.log(scale).sum(axis=(0, 2)) + top.sum(axis=(1, 2))
        return np.swapaxes(ahead * back, 0, 1), pairs, total

    def slopes(self, x: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log-likelihood of the tags."""
        h, n = self.hidden, len(x)
        both, read, kept = self._run(x, keep=True)
        emissions = np.swapaxes(both @ self.p["out"] + self.p["bias"], 0, 1)
        expected, pairs, _ = self.marginals(emissions)
        seen = np.zeros((TAGS, TAGS))
        np.add.at(seen, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        miss = (np.swapaxes(np.eye(TAGS)[tags] - expected, 0, 1) / n).astype(both.dtype)
        flat = miss.reshape(-1, TAGS)
        g = {"out": both.reshape(-1, 2 * h).T @ flat, "bias": flat.sum(axis=0), "moves": (seen - pairs) / n}
        down = miss @ self.p["out"].T
        down = np.stack((down[:, :, :h], down[::-1, :, h:]), axis=1)  # as each direction reads
        recur = self.p["recur"]
        g_recur, into = np.zeros_like(recur), np.empty((len(kept), 2, n, 4 * h), both.dtype)
        d_state, d_cell = np.zeros((2, n, h), both.dtype), np.zeros((2, n, h), both.dtype)
        turned = np.swapaxes(recur, 1, 2)
        for t in range(len(kept) - 1, -1, -1):
            gates, before, bent, was = kept[t]
            d_state = d_state + down[t]
            i, f, o, new = gates[..., :h], gates[..., h : 2 * h], gates[..., 2 * h : 3 * h], gates[..., 3 * h :]
            d_cell = d_cell + d_state * o * (1 - bent**2)
            d_gates = into[t]
            d_gates[..., :h] = d_cell * new * i * (1 - i)
            d_gates[..., h : 2 * h] = d_cell * before * f * (1 - f)
            d_gates[..., 2 * h : 3 * h] = d_state * bent * o * (1 - o)
            d_gates[..., 3 * h :] = d_cell * i * (1 - new**2)
            g_recur += np.matmul(np.swapaxes(was, 1, 2), d_gates)
            d_state, d_cell = np.matmul(d_gates, turned), d_cell * f
        # Rows of one symbol are summed by sorting them.
        symbol, rows = read.ravel(), into.reshape(-1, 4 * h)
        order = np.argsort(symbol, kind="stable")
        present, first = np.unique(symbol[order], return_index=True)
        g_table = np.zeros((2 * SYMBOLS, 4 * h), both.dtype)
        g_table[present] = np.add.reduceat(rows[order], first, axis=0)
        return g | {"table": g_table.reshape(2, SYMBOLS, 4 * h), "recur": g_recur}


def fit_tagger(x: np.ndarray, tags: np.ndarray, *, hidden: int = 24, epochs: int = 12, batch: int = 64, rate: float = 0.02, seed: int = 0, steps: int | None = None, vary: Callable | None = None) -> Tagger:
    """Fit by Adam on windows (n, time) of symbols and tags; the same input gives the same model.

    `vary` (symbols, tags, random generator) may give other symbols with the same tags in place of a batch's own.

    The fit takes `steps` batches, if given, however few windows there are, else `epochs` rounds over all.
    """
    model = Tagger(hidden, seed, np.float32)
    rng = np.random.default_rng(seed)
    momentum = {k: np.zeros_like(v) for k, v in model.p.items()}
    energy = {k: np.zeros_like(v) for k, v in model.p.items()}
    steps = steps or max(1, epochs * -(-len(x) // batch))
    waiting = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        while len(waiting) < min(batch, len(x)):
            waiting = np.concatenate((waiting, rng.permutation(len(x))))
        own, waiting = waiting[:batch], waiting[batch:]
        now = rate * min(1.0, 1.2 * (1 - step / (steps + 1)))
        shown = vary(x[own], tags[own], rng) if vary else x[own]
        for k, g in model.slopes(shown, tags[own]).items():
            g = np.clip(g, -5, 5).astype(np.float32)
            momentum[k] = 0.9 * momentum[k] + 0.1 * g
            energy[k] = 0.99 * energy[k] + 0.01 * g**2
            model.p[k] = model.p[k] + now * (momentum[k] / (1 - 0.9**step)) / (np.sqrt(energy[k] / (1 - 0.99**step)) + 1e-8)
    return model
