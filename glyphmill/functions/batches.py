"""Batches of rows in Python workers, and the memory that they take."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what this process has freed to the system.  A worker that waits for its next task would keep it, while the
    workers of other stages need it."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def parts(batches: Iterator[pd.DataFrame], text: str, most: int = 1 << 21) -> Iterator[pd.DataFrame]:
    """The batches again in parts of about `most` characters, so that long texts don't add up in memory; what they took is
    given back at the end."""
    for b in batches:
        at, total = 0, 0
        for i, t in enumerate(b[text]):
            n = len(t) if isinstance(t, str) else 0
            if total and total + n > most:
                yield b.iloc[at:i].reset_index(drop=True)
                at, total = i, 0
            total += n
        yield b.iloc[at:].reset_index(drop=True)
    b = None
    give_back()
