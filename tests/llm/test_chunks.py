"""Chunks and their joins against the tokenizers library on whole texts."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import xxhash

from quarterdeck.llm.chunk_bpe import ByteBpe, round_trip
from quarterdeck.llm.chunks import MOST, cuts
from quarterdeck.llm.common import DOCUMENT, table

SF = "/root/testdata/sf0.001"
PATH, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
ODD = ["", None, " ", "   a  b \n\n c", "x<|endoftext|>y " * 50, "日本語" * 3000, "a" * 20_000,
       " " * 5000 + "b", "don't we'll 've " * 200, " a   b c " * 300, "é" * 10_000,
       "1234567890" * 500, "word́ " * 400]


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(PATH, RANKS, public_tokenizers.PATTERN)


def meant(bpe, text):
    ids = bpe.whole.encode(text or "", add_special_tokens=False).ids
    back = bpe.whole.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_cuts_follow_the_content():
    rng = random.Random(1)
    words = " ".join(f"w{rng.randrange(5000)}é" for _ in range(3000)).encode()
    for text in [words, *((t or "").encode() for t in ODD)]:
        ends = cuts(text)
        assert ends == sorted(set(ends)) and (ends[-1:] or [0]) == [len(text)]
        assert all(b - a <= MOST for a, b in zip([0, *ends], ends))
        for a, b in zip([0, *ends], ends):
            text[a:b].decode()
    moved = cuts("Another début. ".encode() * 3 + words)
    assert len({e - 48 for e in moved} & set(cuts(words))) > 0.9 * len(cuts(words))


def test_any_store_gives_exact_ids(bpe):
    rng = random.Random(2)
    texts = [(t or "").encode() for t in ODD]
    texts += [" ".join(rng.choice(["the", "thé,", "x1", "\n", "", "it's", "…", "ab" * rng.randrange(9)])
                       for _ in range(2000)).encode() for _ in range(6)]
    for text in texts:
        ends = cuts(text)
        store = {xxhash.xxh3_64_intdigest(text[a:b]): bpe.plain(text[a:b])
                 for a, b in zip([0, *ends], ends) if rng.random() < 0.6}
        ids = bpe.whole.encode(text.decode(), add_special_tokens=False).ids
        assert bpe.encode(text, store).tolist() == ids
        assert bpe.decode(np.array(ids, np.uint32)).decode() == bpe.whole.decode(
            ids, skip_special_tokens=False)
    cut = bpe.plain("é日".encode())[:1]
    assert bpe.decode(cut).decode() == bpe.whole.decode(cut.tolist(), skip_special_tokens=False)


def test_round_trip(spark, bpe):
    odd = [(10_000 + i, t, None, None, 0) for i, t in enumerate(ODD)] + [(None, "x", "", "", 0)] * 2
    docs = table(spark, SF, "documents").unionByName(spark.createDataFrame(odd, DOCUMENT)).selectExpr(
        "*", "1 as hash", "2 as utf8")
    args = PATH, RANKS, public_tokenizers.PATTERN
    found = sorted(map(tuple, round_trip(docs, *args).collect()), key=str)
    assert found == sorted(((r.doc_id, *meant(bpe, r.text)) for r in docs.collect()), key=str)
    assert round_trip(docs.limit(0), *args).count() == 0
