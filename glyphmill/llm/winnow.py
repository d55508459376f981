"""Anchors: a sparse choice of positions by content alone, so that equal windows have equal anchors.

Of the q-grams inside each window those with the smallest hash are chosen.  Two equal windows choose the same places
in them, whatever surrounds them.  So whether a window repeats can be asked of its anchors only: about 2 / (w + 1) of
all positions, w being the number of q-grams in a window.
"""

from __future__ import annotations

import numpy as np

from glyphmill.llm.common import mix, powers

BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(BASE, -1, 1 << 64)


def sliding(x: np.ndarray, w: int, op: np.ufunc) -> np.ndarray:
    """op over each run of w items."""
    size = 1
    while size * 2 <= w:
        x = op(x[:-size], x[size:])
        size *= 2
    return op(x[: len(x) - (w - size)], x[w - size :]) if size < w else x


def anchors(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions whose hash is the smallest in some run of w; ties are all taken."""
    if len(grams) < w:
        return np.zeros(0, np.int64)
    least = sliding(grams, w, np.minimum)
    pad = np.zeros(w - 1, np.uint64)
    return np.flatnonzero(sliding(np.concatenate([pad, least, pad]), w, np.maximum) == grams)


_kept: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers, kept from call to call up to 4 million of them."""
    if base not in _kept or len(_kept[base]) < n:
        out = powers(base, max(n, 1 << 16))
        if n > 1 << 22:
            return out
        _kept[base] = out
    return _kept[base][:n]


class Prefix:
    """Hashes of any stretch of a sequence of 64-bit items, equal for equal content."""

    def __init__(self, items: np.ndarray):
        n = len(items)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(items * _powers(BASE, n), dtype=np.uint64, out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))
