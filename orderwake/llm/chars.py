"""Characters of many texts as one numpy array."""

from __future__ import annotations

from functools import lru_cache

import numpy as np


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts end to end, and the offset of each text (one more than texts)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, "<u4"), np.concatenate(([0], np.cumsum(sizes)))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)


@lru_cache(maxsize=1)
def lower() -> np.ndarray:
    """For each code point, its lower-case form if that is a single one, else itself."""
    table = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(letters()).tolist():
        small = chr(i).lower()
        if len(small) == 1:
            table[i] = ord(small)
    return table


def positions(sizes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """For sequences laid end to end: their order by falling size, and per step the sequences (by rank) still running.

    Step t of the sequence with rank r is at its start + t; ranks below the t-th count are running.
    """
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order]
    steps = int(falling[0]) if len(falling) else 0
    running = np.searchsorted(-falling, -np.arange(steps), side="left")
    return order, running
