"""Shingle sets, links and components against brute force."""

from __future__ import annotations

import random
import re

import pytest

from quarterdeck.llm.common import DOCUMENT, table
from quarterdeck.llm.components import components
from quarterdeck.llm.ngram_join import join_report, one_of_each
from quarterdeck.llm.shingles import shingle_sets

SF = "/root/testdata/sf0.001"


def brute_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


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
            if a and b and 100 * min(len(a), len(b)) >= 75 * max(len(a), len(b)):
                if 100 * len(a & b) >= 75 * len(a | b):
                    root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(sets[i]), least.get(top(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_sizes_of_sets():
    texts = ["", " \t\n", "A b", "a B", "a\x1cb c\x85d", "É é", "one two three four", "a b c d e f",
             "A B C D E F A B C D E F", "x " * 3_000_000, "y" * 3_000_000]
    sets = shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(brute_set(t)) for t in texts]
    assert (sets[2] == sets[3]).all()
    many = shingle_sets([t.encode() for t in texts * 3])
    assert all((a == b).all() for a, b in zip(many, sets * 3))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 140)] + [(1, x) for x in range(2, 60)]
    links += [(500 + i, 500 + rng.randrange(i)) for i in range(1, 50)] + [(7, 7), (2, 1)]
    rng.shuffle(links)
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {c for n, c in found.items() if 100 <= n <= 140} == {100}
    assert {c for n, c in found.items() if n < 60} == {1}
    assert {c for n, c in found.items() if n >= 500} == {500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def chain(rng):
    """A family that drifts: each text changes a few words of the one before it."""
    words = [f"w{rng.randrange(400)}" for _ in range(120)]
    out = []
    for _ in range(30):
        words = list(words)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(400)}"
        out.append(" ".join(words[:rng.randrange(100, 121)]))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    line = " ".join(f"common{i}" for i in range(30))
    texts = ["", None, " \n", "one two", "One  TWO", "a b c d", "a b c d e", "a b c d e f", "x" * 90_000]
    texts += [t for _ in range(4) for t in chain(rng)]
    texts += [line + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 40)))
              for _ in range(150)]
    texts += [line] * 40 + [line + f" end{i}" for i in range(40)]
    rows = [(10_000 + i, t, None, None, 0) for i, t in enumerate(texts)]
    rows += [(None, "one two", "en", "s", 1), (10_003, "one two", "en", "s", 1), (999_999, "other", "", "", 0)]
    return table(spark, SF, "documents").unionByName(spark.createDataFrame(rows, DOCUMENT)).selectExpr(
        "*", "1 as class", "2 as n", "'z' as row")


def test_join_equals_brute_force(docs):
    found = sorted(map(tuple, join_report(docs).collect()), key=str)
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert join_report(docs.limit(0)).count() == 0


def test_one_of_each_stays(docs):
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    meant = brute(list(dict.fromkeys(rows)))
    empty = sum(n == 0 for _, n, _ in meant)
    assert kept.count() == len({c for _, n, c in meant if n}) + empty
    assert one_of_each(docs.limit(0)).count() == 0
