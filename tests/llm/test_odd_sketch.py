"""Samples, sketches and near duplicates against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from quarterdeck.llm.common import DOCUMENT, table
from quarterdeck.llm.odd_sketch import SAMPLES, _Chunk, buckets, most, near_duplicates, samples, sketches
from quarterdeck.llm.shingles import linked, shingle_sets

SF = "/root/testdata/sf0.001"


def brute_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i:i + 2]) for i in range(len(words) - 1)} or ({tuple(words)} if words else set())


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)):
                if 100 * len(a & b) >= 80 * len(a | b):
                    root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(sets[i]), least.get(top(i)), least.get(top(i)) == d)
                   for i, (d, _) in enumerate(rows)), key=str)


def test_sizes_of_sets():
    texts = ["", " \t\n", "A b", "a B", "a", "a b c a b c", "x " * 700_000, "y" * 2_000_000]
    assert [len(s) for s in shingle_sets([t.encode() for t in texts], 2)] == [len(brute_set(t)) for t in texts]


def pair(rng, shared, each):
    """Two sets of shared + each tokens with ``shared`` of them in common."""
    all_ = np.unique(rng.integers(0, 2**63, shared + 2 * each, dtype=np.uint64))
    both, rest = all_[::1][:shared], all_[shared:]
    rng.shuffle(all_)
    both, rest = all_[:shared], all_[shared:]
    return np.sort(np.concatenate([both, rest[:each]])), np.sort(np.concatenate([both, rest[each:]]))


@pytest.mark.parametrize("shared, each", [(4, 0), (8, 1), (80, 10), (800, 100), (80_000, 10_000)])
def test_links_meet_in_a_bucket_and_stay_below_the_count(shared, each):
    rng = np.random.default_rng(shared)
    for _ in range(3 if shared > 1000 else 60):
        a, b = pair(rng, shared, each)
        found = samples([a, b])
        assert (buckets(found)[0] == buckets(found)[1]).any()
        x, y = sketches(found)
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= most()


def test_sketches_tell_unlike_sets():
    rng = np.random.default_rng(5)
    for _ in range(60):
        a, b = pair(rng, 60, 40)
        x, y = sketches(samples([a, b]))
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) > most()
    assert samples([a]).shape == (1, SAMPLES) and most(1.0) < most(0.9) < most()


def test_samples_do_not_depend_on_the_block():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 70_000, 3, 200_000, 5)]
    alone = np.concatenate([samples([s]) for s in sets])
    assert (samples(sets) == alone).all()


def test_a_part_of_a_group_finds_its_first_link():
    rng = np.random.default_rng(7)
    sets = [np.unique(rng.integers(0, 300, 200).astype(np.uint64)) for _ in range(40)]
    chunk = _Chunk([b"%d" % i for i in range(40)], sets)
    for _ in range(40):
        own = sets[rng.integers(40)]
        own = np.unique(np.append(own[rng.random(len(own)) > 0.12], rng.integers(0, 900, 12).astype(np.uint64)))
        meant = [i for i, s in enumerate(sets) if linked(s, own, 80)]
        assert chunk.linked(own) == (b"%d" % meant[0] if meant else None)
    assert chunk.linked(np.array([10**6], np.uint64)) is None


def family(rng, size):
    words, out = [f"w{rng.randrange(400)}" for _ in range(120)], []
    for _ in range(size):
        words = list(words)
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(400)}"
        out.append(" ".join(words[:rng.randrange(95, 121)]))
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(9)
    line = " ".join(f"common{i}" for i in range(30))
    texts = ["", None, " \n", "one", "One", "one two", "a b c d e f", "a b c d e f a", "x" * 90_000]
    texts += [t for _ in range(5) for t in family(rng, 40)]
    texts += [line + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 30)))
              for _ in range(150)]
    texts += [line] * 40 + [line + f" end{i}" for i in range(40)]
    rows = [(10_000 + i, t, None, None, 0) for i, t in enumerate(texts)]
    rows += [(None, "one two", "en", "s", 1), (10_005, "one two", "en", "s", 1), (None, "alone here", "", "", 0)]
    docs = table(spark, SF, "documents").unionByName(spark.createDataFrame(rows, DOCUMENT)).selectExpr(
        "*", "1 as class", "2 as n", "'z' as row", "3 as bucket", "4 as kept")
    found = sorted(map(tuple, near_duplicates(docs).collect()), key=str)
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert near_duplicates(docs.limit(0)).count() == 0
    assert near_duplicates(docs.where("text is null")).where("kept").count() == 1
