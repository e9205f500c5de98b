"""Content-defined chunks of bytes: cut where a rolling hash of the last bytes says so.

Equal passages of different documents are cut alike, apart from their first and last chunk.
"""

from __future__ import annotations

import numpy as np

from quarterdeck.llm.shingles import BASE, U, mix

WINDOW, AVERAGE, LEAST, MOST = 24, 256, 64, 4096
SLAB = 1 << 20
_UP = np.cumprod(np.full(SLAB + WINDOW + 1, U(BASE)))
_DOWN = np.cumprod(np.full(SLAB + WINDOW + 1, U(pow(BASE, -1, 1 << 64))))


def _marks(raw: np.ndarray, start: int, end: int) -> np.ndarray:
    """Positions in (start, end] before which the rolling hash asks for a cut."""
    low = max(0, start - WINDOW)
    part = raw[low:end]
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + U(1)) * _UP[:len(part)], out=sums[1:])
    if len(part) < WINDOW:
        return np.empty(0, np.int64)
    rolled = mix((sums[WINDOW:] - sums[:-WINDOW]) * _DOWN[:len(part) - WINDOW + 1])
    at = np.flatnonzero((rolled & U(AVERAGE - 1)) == 0) + WINDOW + low
    return at[at > start]


def cuts(text: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text; no cut is inside a character."""
    if not text:
        return []
    raw = np.frombuffer(text, np.uint8)
    marks: list[int] = []
    for start in range(0, len(raw), SLAB):
        at = _marks(raw, start, min(len(raw), start + SLAB))
        at = at[at < len(raw)]
        marks += at[(raw[at] & 0xC0) != 0x80].tolist()
    ends, last = [], 0
    for mark in [*marks, len(raw)]:
        while mark - last > MOST:
            end = last + MOST
            while (raw[end] & 0xC0) == 0x80:
                end -= 1
            ends.append(end)
            last = end
        if mark - last >= LEAST or mark == len(raw):
            if mark > last:
                ends.append(mark)
            last = mark
    return ends
