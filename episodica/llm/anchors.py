"""Content-chosen positions of byte texts: every 200-byte string holds one, and equal strings hold it at the same place."""

from __future__ import annotations

import numpy as np

from episodica.llm.words import U, byte_hashes, stretch_hashes

LENGTH, HEAD = 200, 64
REACH = LENGTH - HEAD + 1  # heads that lie inside a string of LENGTH bytes


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``: minima of runs of 1, 2, 4 ... are combined, two of them cover the rest."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors_of(running: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the text at [low, high) of a block: positions, hashes of their heads, and where each one's strings begin.

    A string of LENGTH bytes is anchored at the leftmost of its heads with the least hash.  The strings of one anchor
    start at consecutive places; ``begins`` holds the first of each anchor and, at its end, the number of strings
    (all relative to ``low``).
    """
    n = high - low - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(1, np.int64)
    starts = np.arange(low, high - HEAD + 1)
    heads = stretch_hashes(running, starts, starts + HEAD)
    # the place in the low bits makes the leftmost of equal heads the least
    keyed = (heads & ~U(0xFFFFFFFF)) | np.arange(len(heads), dtype=np.uint64)
    place = (sliding_minimum(keyed, REACH) & U(0xFFFFFFFF)).astype(np.int64)
    begins = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    at = place[begins]
    return at, heads[at], np.append(begins, n)
