"""Word-wise encoding, token files and packing against the plain library."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from quarterdeck.llm.common import DOCUMENT, table
from quarterdeck.llm.packing import Packer, pack
from quarterdeck.llm.token_files import TokenFile, TokenFileWriter, token_files
from quarterdeck.llm.word_tokens import WordTokens, load

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
ODD = ["", " ", "\n\n", "It's, the END. <|endoftext|> x<|startoftext|>y", "a\x1cb\x85c d e",
       "Ünïcode—dash, “quoted.” ...,, 12.50 x.,", "Ḱ Kelvin İstanbul ΣΑΣ", "x" * 5000,
       "don't've'll 's 'S", "é ́a ,́ 日本語。テスト", "a, b,c.. d., e.’ f’.", "\t\x0b tab"]


@pytest.fixture(scope="module")
def plain():
    found = load(PATH)
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def test_words_equal_whole_texts(plain, spark):
    tokens = WordTokens(PATH)
    texts = ODD + [r[0] for r in table(spark, SF, "documents").select("text").collect()]
    for text in texts:
        assert np.frombuffer(tokens.encode((text or "").encode()), "<u4").tolist() == plain(text)


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(10_000 + i, t, None, None, 0) for i, t in enumerate(ODD)]
    odd += [(None, "no id", "en", "s", 1), (5, None, None, None, None), (5, "again", "", "", 0),
            (5, "again", "", "", 0)]
    base = table(spark, SF, "documents")
    return base.unionByName(spark.createDataFrame(odd, DOCUMENT)).selectExpr(
        "*", "'clash' as start", "1 as utf8", "2 as ids_crc32", "3 as tie")


def expected(docs, plain):
    rows = [(r.doc_id, plain(r.text) + [2]) for r in docs.select("doc_id", "text").collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_token_files_give_back_all_documents(spark, docs, plain):
    found = token_files(docs, PATH).collect()
    meant = expected(docs, plain)
    found.sort(key=lambda r: r.start)
    assert [r.doc_id for r in found] == [d for d, _ in meant]
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens
    digest = lambda d, ids: (d is not None, d or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == \
        sorted(digest(*m) for m in meant)
    assert token_files(docs.limit(0), PATH).count() == 0


def test_one_document_needs_its_frames_only():
    sink = pa.BufferOutputStream()
    writer = TokenFileWriter(sink)
    rows = [(i, np.arange(i * 1000, dtype="<u4").tobytes()) for i in range(300)] + [(None, b"")]
    for row in rows:
        writer.add(*row)
    writer.close()
    data = bytearray(sink.getvalue().to_pybytes())
    opened = TokenFile(pa.BufferReader(bytes(data)))
    assert opened.doc_ids == [d for d, _ in rows]
    read = []
    whole = opened.frame
    opened.frame = lambda k: read.append(k) or whole(k)
    for place in (299, 0, 150, 300):
        assert opened.ids(place) == rows[place][1]
    assert len(set(read)) < len(opened.table) / 10
    data[20] ^= 1
    with pytest.raises(Exception):
        TokenFile(pa.BufferReader(bytes(data))).frame(0)


def best_by_trial(level, size, window):
    def after(h):
        n = level.copy()
        n[h] -= h > 0
        n[h + size] += h + size < window
        return int((n[1:] ** 2).sum())
    options = [h for h in range(window - size + 1) if h == 0 or level[h]]
    return min(options, key=lambda h: (after(h), -h))


def test_level_has_least_sum_of_squares():
    rng, packer = np.random.default_rng(3), Packer(50, 10_000)
    for i in range(400):
        size = int(rng.integers(1, 51))
        assert packer.best(size) == best_by_trial(packer.level, size, 50)
        packer.add(i, bytes(4 * size))


@pytest.mark.parametrize("most_open", [3, 10_000])
def test_packer_keeps_every_id_once(most_open):
    rng, packer, docs, done = np.random.default_rng(5), Packer(64, most_open), {}, []
    for i in range(500):
        docs[i] = rng.integers(0, 99, rng.integers(1, 200)).astype("<u4").tobytes()
        done += packer.add(i, docs[i])
        assert packer.n_open < most_open
    done += packer.finish()
    sizes = [sum(len(p[2]) for p in s) // 4 for s in done]
    assert all(n == 64 or (n < 64 and n & (n - 1) == 0) for n in sizes)
    back = {}
    for d, start, ids, total in sorted((p for s in done for p in s), key=lambda p: p[:2]):
        assert len(back.get(d, b"")) == 4 * start and total == len(docs[d]) // 4
        back[d] = back.get(d, b"") + ids
    assert back == docs


def test_pack(spark, docs, plain):
    rows = pack(docs, PATH).collect()
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in expected(docs, plain))
    by_sequence = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by_sequence.get(r.sequence_id, 0)
        by_sequence[r.sequence_id] = r.offset + r.length
    assert all(n == 4096 or n & (n - 1) == 0 for n in by_sequence.values())
    meant = {d: ids for d, ids in expected(docs, plain) if d not in (None, 5)}
    for r in rows:
        if r.doc_id in meant:
            cut = np.array(meant[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
            assert zlib.crc32(cut) == r.ids_crc32 and len(meant[r.doc_id]) == r.doc_tokens
    assert pack(docs.limit(0), PATH).count() == 0
