"""Sum-of-squares online packing of documents into sequences of at most ``WINDOW`` tokens.

Every partition is a stream of its own. ``level[h]`` counts the open windows that are filled to h.
A document longer than a window is cut into full windows and a rest. The rest goes to the level
that makes the sum of the squared counts smallest; putting it to level 0 opens a window. When the
stream ends, or ``OPEN`` windows are open, the open windows are run together: their pieces are
cut anew so that every window but the last is full. What is left at the very end is cut into
sequences whose lengths are powers of two, which need no padding.

A task holds the ids of its open windows only (at most ``OPEN`` windows). Nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import arrow_map, utf8
from quarterdeck.llm.word_tokens import WordTokens

WINDOW, OPEN = 4096, 2048
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
#: doc_id, start in its document, ids, ids of the document
Piece = tuple[int | None, int, bytes, int]


class Packer:
    """``add`` documents, then ``finish``; both return complete sequences, lists of pieces."""

    def __init__(self, window: int = WINDOW, most_open: int = OPEN) -> None:
        self.window, self.most_open = window, most_open
        self.level = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = {}
        self.n_open = 0

    def add(self, doc_id: int | None, ids: bytes) -> list[list[Piece]]:
        total, done, start = len(ids) // 4, [], 0
        while total - start >= self.window:
            done.append([(doc_id, start, ids[4 * start:4 * (start + self.window)], total)])
            start += self.window
        if start < total:
            done += self._place((doc_id, start, ids[4 * start:], total))
        return done

    def _place(self, piece: Piece) -> list[list[Piece]]:
        size = len(piece[2]) // 4
        at = self.best(size)
        if at:
            windows = self.open[at]
            window = windows.pop()
            if not windows:
                del self.open[at]
            self.level[at] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        if at + size == self.window:
            return [window]
        self.open.setdefault(at + size, []).append(window)
        self.level[at + size] += 1
        self.n_open += 1
        return self._run_together(last=False) if self.n_open >= self.most_open else []

    def best(self, size: int) -> int:
        """The level from 0 to window - size with the least sum of squares after the placing;
        of equal ones the fullest."""
        n = self.level
        used = np.flatnonzero(n[:self.window - size + 1])  # level 0 holds no open window
        if not len(used):
            return 0
        cost = 2 * (n[used + size] - n[used]) + 2
        if used[-1] + size == self.window:
            cost[-1] = 1 - 2 * n[used[-1]]  # a full window is not counted
        at = len(cost) - 1 - int(np.argmin(cost[::-1]))
        return int(used[at]) if cost[at] <= 2 * n[size] + 1 else 0  # a new window leaves no level

    def _run_together(self, last: bool) -> list[list[Piece]]:
        pieces = [p for h in sorted(self.open, reverse=True) for w in self.open[h] for p in w]
        self.open, self.n_open, self.level[:] = {}, 0, 0
        done, now, room = [], [], self.window
        left = sum(len(p[2]) for p in pieces) // 4
        for doc_id, start, ids, total in pieces:
            while ids:
                if last and not now and left < self.window:
                    room = 1 << (left.bit_length() - 1)  # the largest power of two that is left
                n = min(room, len(ids) // 4)
                now.append((doc_id, start, ids[:4 * n], total))
                ids, start, room, left = ids[4 * n:], start + n, room - n, left - n
                if not room:
                    done.append(now)
                    now, room = [], self.window
        if now:
            filled = sum(len(p[2]) for p in now) // 4
            self.open, self.n_open = {filled: [now]}, 1
            self.level[filled] = 1
        return done

    def finish(self) -> list[list[Piece]]:
        return self._run_together(last=True)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 2) -> DataFrame:
    """The pieces of all documents and their places; a null text is an empty one.

    A sequence is named by its partition and number, so a task that runs again names it the same.
    Rows with equal or null doc_id are packed like any others.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        packer, tokens = Packer(window), WordTokens.at(tokenizer)
        number = TaskContext.get().partitionId() << 36

        def rows(sequences: list[list[Piece]]) -> dict:
            nonlocal number
            out = {name.split()[0]: [] for name in PIECES.split(", ")}
            for sequence in sequences:
                offset = 0
                for doc_id, start, ids, total in sequence:
                    for name, value in zip(out, (doc_id, start, len(ids) // 4, zlib.crc32(ids),
                                                 total, number, offset)):
                        out[name].append(value)
                    offset += len(ids) // 4
                number += 1
            return out

        for batch in batches:
            done = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["utf8"]):
                done += packer.add(doc_id, tokens.encode(text.as_py()) + tail)
                if len(done) >= 2000:
                    yield rows(done)
                    done = []
            yield rows(done)
        yield rows(packer.finish())

    return arrow_map(docs.select(F.col("doc_id"), utf8().alias("utf8")), run, PIECES)
