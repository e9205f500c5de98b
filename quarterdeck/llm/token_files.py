"""Token files: independent zstandard frames, a document directory and a trailing seek table.

A file holds the ids of its documents, one after another, as little-endian unsigned 32-bit
integers. Every ``FRAME_IDS`` ids make a frame that is compressed alone. Two skippable frames
follow: the directory (zstandard-compressed columns doc_id int64, known int8, start int64, count
int64) and the seek table of the zstandard seekable format, with compressed size, size and the low
32 bits of XXH64 of each frame, the directory included as the last entry. Any zstandard
decoder can read the frames; a reader that wants some documents reads the end of the file, then
only the frames that hold them.

Files are written by the tasks that hold the documents, in ascending doc_id order over the files
(null ids first, equal ids by text hash), under a name of the attempt and then renamed, so a task
that runs again after a lost executor puts the same file in the same place.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import arrow_map, utf8
from quarterdeck.llm.word_tokens import WordTokens
from quarterdeck.session import fresh_path, written

FRAME_IDS = 1 << 16
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed values of the zstandard seekable format
MANIFEST = "part int, file string, n_docs long, n_ids long"


class TokenFileWriter:
    def __init__(self, out) -> None:
        self.out, self.packer = out, zstandard.ZstdCompressor(level=3)
        self.rest, self.n_ids, self.frames = bytearray(), 0, []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.rest += ids
        while len(self.rest) >= 4 * FRAME_IDS:
            self._frame(bytes(self.rest[:4 * FRAME_IDS]))
            del self.rest[:4 * FRAME_IDS]

    def _frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.rest:
            self._frame(bytes(self.rest))
        counts = np.array(self.counts, "<i8")
        starts = np.cumsum(counts) - counts
        plain = b"".join([
            np.array([i or 0 for i in self.doc_ids], "<i8").tobytes(),
            np.array([i is not None for i in self.doc_ids], "<i1").tobytes(),
            starts.astype("<i8").tobytes(), counts.tobytes()])
        packed = self.packer.compress(plain)
        self.out.write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        self.frames.append((8 + len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        seek = b"".join(struct.pack("<III", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(seek) + len(foot)) + seek + foot)


class TokenFile:
    """Random access to the documents of one file; a wrong checksum raises ValueError."""

    def __init__(self, source) -> None:
        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        size = source.size()
        count, _, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("not a seekable token file")
        raw = self._read(size - 9 - 12 * count, 12 * count)
        table = np.frombuffer(raw, "<u4").reshape(-1, 3).astype(np.int64)
        self.at = np.cumsum(table[:, 0]) - table[:, 0]
        self.table = table
        plain = self._unpack(self._read(self.at[-1] + 8, table[-1, 0] - 8), table[-1])
        n = len(plain) // 25
        known = np.frombuffer(plain, "<i1", n, 8 * n)
        self.doc_ids = [i if k else None for i, k in
                        zip(np.frombuffer(plain, "<i8", n).tolist(), known.tolist())]
        self.starts = np.frombuffer(plain, "<i8", n, 9 * n)
        self.counts = np.frombuffer(plain, "<i8", n, 17 * n)
        self._last: tuple[int, bytes] = (-1, b"")

    def _read(self, start: int, length: int) -> bytes:
        self.source.seek(int(start))
        return self.source.read(int(length))

    def _unpack(self, packed: bytes, entry) -> bytes:
        plain = self.unpacker.decompress(packed, max_output_size=int(entry[1]))
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != entry[2]:
            raise ValueError("checksum of a frame differs")
        return plain

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            self._last = (k, self._unpack(self._read(self.at[k], self.table[k, 0]), self.table[k]))
        return self._last[1]

    def ids(self, place: int) -> bytes:
        """The ids of the document at this place of the directory, from its frames alone."""
        start, end = int(self.starts[place]), int(self.starts[place] + self.counts[place])
        parts = []
        while start < end:
            k = start // FRAME_IDS
            stop = min(end, (k + 1) * FRAME_IDS)
            parts.append(self.frame(k)[4 * (start - k * FRAME_IDS):4 * (stop - k * FRAME_IDS)])
            start = stop
        return b"".join(parts)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2) -> DataFrame:
    """Encode every text, append ``end_id`` and write the files; returns the manifest, part by part.

    A null text is an empty one (its only id is ``end_id``). Documents move once, as text, to
    ranges of doc_id; nothing but a row per file leaves the tasks.
    """
    tail = np.array([end_id], "<u4").tobytes()
    placed = (docs.select(F.col("doc_id"), utf8().alias("utf8"))
              .withColumn("tie", F.xxhash64("utf8")))
    ranged = placed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, writer, tokens = TaskContext.get().partitionId(), None, WordTokens.at(tokenizer)
        fs, root = pa.fs.FileSystem.from_uri(folder)
        attempt, name = f"{root}/_{uuid.uuid4().hex}", f"part-{part:06d}.tok.zst"
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["utf8"]):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(attempt)
                    writer = TokenFileWriter(out)
                writer.add(doc_id, tokens.encode(text.as_py()) + tail)
        if writer is not None:
            writer.close()
            out.close()
            fs.move(attempt, f"{root}/{name}")
            yield {"part": [part], "file": [name], "n_docs": [len(writer.doc_ids)],
                   "n_ids": [writer.n_ids]}

    return written(arrow_map(ranged.select("doc_id", "utf8"), write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32. The driver sees one row per file, to add up where each begins."""
    import zlib

    spark, before, files = manifest.sparkSession, 0, []
    for row in sorted(manifest.collect()):
        files.append((row["file"], before))
        before += row["n_ids"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist()):
                with fs.open_input_file(f"{root}/{file}") as source:
                    opened = TokenFile(source)
                    crcs = [zlib.crc32(opened.ids(i)) for i in range(len(opened.doc_ids))]
                yield {"doc_id": opened.doc_ids, "start": base + opened.starts,
                       "n_tokens": opened.counts, "ids_crc32": crcs}

    listed = spark.createDataFrame(files, "file string, base long").repartition(len(files))
    return arrow_map(listed, read, schema)


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents to files below the shared folder and give what reading them back says."""
    folder = fresh_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, tokenizer, folder), folder)
