"""Sets of word shingles as sorted arrays of 64-bit hashes, computed for many texts at once.

Words are runs of bytes other than space and 09-0D, with A-Z lowered. A word's hash is a polynomial
of its bytes modulo 2^64 (from running sums over the whole block), mixed; a shingle's hash mixes
the hashes of ``size`` words in a row (``SIZE`` and at most that). Texts of fewer words have one shingle,
the whole sequence.
"""

from __future__ import annotations

import numpy as np

SIZE, BLOCK = 5, 1 << 20
U = np.uint64
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += U(32)
#: One odd factor for each place in a shingle, and one for its number of words.
PLACES = [U(pow(BASE, 2 * i + 3, 1 << 64)) for i in range(SIZE + 1)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of the public splitmix64 generator."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_powers: list[np.ndarray] = []


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        grown = max(n, 2 * BLOCK)
        _powers[:] = [np.cumprod(np.full(grown, U(b))) for b in (BASE, pow(BASE, -1, 1 << 64))]
    return _powers[0], _powers[1]


def word_hashes(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a block of bytes."""
    raw = np.frombuffer(block, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~SPACE[raw]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _powers_to(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((LOWER[raw] + U(1)) * up[:len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return starts, mix(hashes + (ends - starts).astype(np.uint64) * PLACES[-1])


def _of_words(words: np.ndarray, size: int) -> np.ndarray:
    if len(words) < size:
        return np.unique(mix((words * np.array(PLACES[:len(words)], np.uint64)).sum(keepdims=True)
                             + U(len(words)))) if len(words) else np.empty(0, np.uint64)
    n = len(words) - size + 1
    total = words[:n] * PLACES[0]
    for i in range(1, size):
        total += words[i:i + n] * PLACES[i]
    return np.unique(mix(total))


def _long(text: bytes, size: int) -> np.ndarray:
    parts, start = [], 0
    while start < len(text):
        end = start + BLOCK
        while end < len(text) and not SPACE[text[end]]:
            end += 1
        parts.append(word_hashes(text[start:end])[1])
        start = end
    return _of_words(np.concatenate(parts), size)


def shingle_sets(texts: list[bytes], words: int = SIZE) -> list[np.ndarray]:
    """The set of each text, ascending; shingles of ``words`` words."""
    found: list[np.ndarray] = []
    now: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if not now:
            return
        starts, hashes = word_hashes(b" ".join(now))
        at = np.cumsum([0, *(len(t) + 1 for t in now)])
        cuts = np.searchsorted(starts, at)
        found.extend(_of_words(hashes[a:b], words) for a, b in zip(cuts[:-1], cuts[1:]))
        now.clear()
        size = 0

    for text in texts:
        if len(text) > BLOCK:
            flush()
            found.append(_long(text, words))
            continue
        now.append(text)
        size += len(text)
        if size > BLOCK:
            flush()
    flush()
    return found


def linked(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    """100 * size of the intersection >= percent * size of the union; empty sets are never linked."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
