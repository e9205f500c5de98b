"""Byte-level BPE of whole texts with reuse of content-defined chunks, and decoding.

1. Texts are cut by a rolling hash (``chunks``); Spark counts the chunks' hashes.
2. Of the chunks that occur more than once, those that save most are encoded once, by one task
   each, into a store of at most ``STORE_BYTES`` of text, which goes to all tasks.
3. A text is put together from stored chunks and from the stretches between them, encoded where they
   stand. Where two parts meet, the last tokens of one and the first of the other may be wrong. A
   join is repaired by encoding anew from the last sure place before it to the first one after it,
   going over as many parts as it takes.

A sure place is one where a visible ASCII character is followed by a space: no pre-token of the
vocabulary's pattern reaches over it and none depends on what stands on its other side, so tokens
on both sides agree with those of the whole text.

Chunks beyond the store's bound are encoded where they occur; results do not depend on it. Texts
that hold a special token's string are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.chunks import cuts
from quarterdeck.llm.common import arrow_map, utf8
from quarterdeck.llm.word_tokens import load
from quarterdeck.session import written

STORE_BYTES = 8 << 20
SURE, SURE_BACKWARDS = re.compile(rb"[!-~] "), re.compile(rb" [!-~]")
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class ByteBpe:
    """Encodes stretches and decodes ids; ``path`` is the tokenizers file, ``ranks`` the same
    vocabulary for tiktoken, which is the faster encoder of plain text."""

    _open: dict[str, ByteBpe] = {}

    def __init__(self, path: str, ranks: str, pattern: str) -> None:
        import base64

        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.whole = load(path)
        self.fast = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=table,
                                      special_tokens={})
        self.special = {t.content.encode(): i for i, t in
                        self.whole.get_added_tokens_decoder().items()}
        words = {i: b for b, i in table.items()} | {i: b for b, i in self.special.items()}
        self.words = [words.get(i, b"") for i in range(max(words) + 1)]
        self.sizes = np.array([len(w) for w in self.words], np.int64)

    @classmethod
    def at(cls, path: str, ranks: str, pattern: str) -> ByteBpe:
        return cls._open.get(path) or cls._open.setdefault(path, cls(path, ranks, pattern))

    def plain(self, text: bytes) -> np.ndarray:
        return np.asarray(self.fast.encode_to_numpy(text.decode(), disallowed_special=()), np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The decoded text in UTF-8; bytes that are no UTF-8 become the replacement character."""
        raw = b"".join(map(self.words.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").encode()

    def encode(self, text: bytes, store: dict[int, np.ndarray]) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
        parts: list[tuple[int, int, np.ndarray | None]] = []
        start = 0
        if store:
            for end in cuts(text):
                ids = store.get(xxhash.xxh3_64_intdigest(text[start:end]))
                if ids is None and parts and parts[-1][2] is None:
                    parts[-1] = (parts[-1][0], end, None)
                else:
                    parts.append((start, end, ids))
                start = end
        if len(parts) <= 1:
            return self.plain(text) if not parts or parts[0][2] is None else parts[0][2]
        return self._joined(text, parts)

    def _joined(self, text: bytes, parts: list[tuple[int, int, np.ndarray | None]]) -> np.ndarray:
        """Sure tokens of each part, and the text between them encoded anew."""
        done: list[np.ndarray] = []
        open_from = 0  # everything before it is encoded
        for k, (start, end, ids) in enumerate(parts):
            first = start if k == 0 else self._first_sure(text, start, end)
            last = end if k == len(parts) - 1 else self._last_sure(text, start, end)
            if first is None or last is None or first >= last:
                continue  # the repair goes over this part
            if ids is None:
                ids = self.plain(text[start:end])
            ends = np.cumsum(self.sizes[ids]) + start
            a = int(np.searchsorted(ends, first, "right")) if first > start else 0
            b = int(np.searchsorted(ends, last, "right")) if last < end else len(ids)
            agree = (a == 0 or ends[a - 1] == first) and (b == len(ids) or ends[b - 1] == last)
            if not agree:
                continue
            if open_from < first:
                done.append(self.plain(text[open_from:first]))
            done.append(ids[a:b])
            open_from = last
        if open_from < len(text):
            done.append(self.plain(text[open_from:]))
        return np.concatenate(done)

    @staticmethod
    def _first_sure(text: bytes, start: int, end: int) -> int | None:
        found = SURE.search(text, start, end)
        return found.start() + 1 if found else None

    @staticmethod
    def _last_sure(text: bytes, start: int, end: int) -> int | None:
        found = SURE_BACKWARDS.search(text[start:end][::-1])
        return end - found.start() - 1 if found else None


def shared_chunks(texts: DataFrame) -> DataFrame:
    """Hash, size and number of the chunks that occur more than once, the most saving ones that
    together stay below the bound (cut at a power of two of the saving)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            hashes, sizes = [], []
            for value in batch["utf8"]:
                text, start = value.as_py(), 0
                for end in cuts(text):
                    hashes.append(xxhash.xxh3_64_intdigest(text[start:end]))
                    sizes.append(end - start)
                    start = end
            yield {"hash": np.array(hashes, np.uint64).view(np.int64), "size": sizes}

    counted = (arrow_map(texts, run, "hash long, size long").groupBy("hash")
               .agg(F.first("size").alias("size"), F.count("*").alias("n")).where("n > 1")
               .withColumn("bits", F.floor(F.log2(F.col("size") * (F.col("n") - 1))).cast("int")))
    counted = written(counted, "shared-chunks")
    least, total = 0, 0
    for bits, size in sorted(map(tuple, counted.groupBy("bits").agg(F.sum("size")).collect()),
                             reverse=True):
        total += size
        if total > STORE_BYTES:
            least = bits + 1
            break
    return counted.where(F.col("bits") >= least)


def chunk_store(texts: DataFrame, path: str, ranks: str, pattern: str) -> dict[int, np.ndarray]:
    """Ids of the chosen shared chunks by hash; each chunk is encoded by one task, once."""
    chosen = {r["hash"] for r in shared_chunks(texts).select("hash").collect()}
    if not chosen:
        return {}
    given = texts.sparkSession.sparkContext.broadcast(chosen)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        met: set[int] = set()
        for batch in batches:
            out = {"hash": [], "chunk": []}
            for value in batch["utf8"]:
                text, start = value.as_py(), 0
                for end in cuts(text):
                    chunk = text[start:end]
                    start, key = end, xxhash.xxh3_64_intdigest(chunk)
                    key -= (key >> 63) << 64
                    if key in given.value and key not in met:
                        met.add(key)
                        out["hash"].append(key)
                        out["chunk"].append(chunk)
            yield out

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = ByteBpe.at(path, ranks, pattern)
        for batch in batches:
            yield {"hash": batch["hash"],
                   "ids": [bpe.plain(c.as_py()).tobytes() for c in batch["chunk"]]}

    once = arrow_map(texts, pick, "hash long, chunk binary").groupBy("hash").agg(
        F.first("chunk").alias("chunk"))
    rows = arrow_map(once, encode, "hash long, ids binary").collect()
    return {r["hash"] % (1 << 64): np.frombuffer(r["ids"], np.uint32) for r in rows}


def round_trip(docs: DataFrame, path: str, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text; a null text is empty."""
    texts = docs.select(utf8().alias("utf8"))
    given = docs.sparkSession.sparkContext.broadcast(chunk_store(texts, path, ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe, store = ByteBpe.at(path, ranks, pattern), given.value
        for batch in batches:
            n, own, decoded = [], [], []
            for text in batch["utf8"]:
                ids = bpe.encode(text.as_py(), store)
                n.append(len(ids))
                own.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield {"doc_id": batch["doc_id"], "n_tokens": n, "ids_sha256": own,
                   "decoded_sha256": decoded}

    return arrow_map(docs.select("doc_id", utf8().alias("utf8")), run, DIGEST)
