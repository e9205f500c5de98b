"""The manifest against a plain recursion over all rows."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from quarterdeck.llm.common import DOCUMENT, table
from quarterdeck.llm.merkle import manifest

SF = "/root/testdata/sf0.001"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    fields = (doc_id, source, lang, n_chars if n_chars is None else n_chars + more, text)
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def root_and_proofs(nodes):
    """The root, and for each node the siblings on its way: (sibling or None, whether it is left)."""
    if len(nodes) <= 1:
        return nodes[0], [[]]
    upper = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    root, rest = root_and_proofs(upper)
    own = [(nodes[i ^ 1] if i ^ 1 < len(nodes) else None, bool(i & 1)) for i in range(len(nodes))]
    return root, [[own[i], *rest[i // 2]] for i in range(len(nodes))]


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    if not order:
        return []
    subs = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[lang] = root_and_proofs([leaf(r) for r in trees[lang]])
    root, tops = root_and_proofs([subs[lang][0] for lang in order])
    out = []
    for lang, top in zip(order, tops):
        for row, own in zip(trees[lang], subs[lang][1]):
            path = own + top
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            now = leaf(row, 1 if tampered else 0)
            for sibling, left in path:
                now = h(now) if sibling is None else h(sibling, now) if left else h(now, sibling)
            out.append((row[0], leaf(row), subs[lang][0], root, h(*(s for s, _ in path if s)),
                        now, now == root))
    return sorted(out, key=str)


def found(docs, height):
    return sorted(map(tuple, manifest(docs, height).collect()), key=str)


@pytest.fixture(scope="module")
def rows(spark):
    given = [tuple(r) for r in table(spark, SF, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]
    odd = [(10_000, None, None, None, None), (10_001, "", "", "", 0), (None, "x", "en", "s", 1),
           (None, "x", "en", "s", 1), (7, "again", "en", "s", 5), (7, "again", "en", "s", 5),
           (10_002, "é" * 200_000, "zz", "é", 2), (-5, "minus", None, "s", None),
           (9_007_199_254_740_993, "large", "é", "s", 3)]
    return given + odd


@pytest.mark.parametrize("height", [1, 3])
def test_manifest_equals_recursion(spark, rows, height):
    docs = spark.createDataFrame(rows, DOCUMENT).repartition(5).selectExpr(
        "*", "1 as tree", "'z' as place", "2 as n", "'q' as hash")
    out = found(docs, height)
    assert out == brute(rows)
    assert any(not r[-1] for r in out) and any(r[-1] for r in out)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    one = [(i, f"text {i}", "en", "s", i) for i in range(n)]
    assert found(spark.createDataFrame(one, DOCUMENT), 2) == brute(one)
    many = [(i, f"text {i}", f"lang{i}", "s", i) for i in range(n)]
    assert found(spark.createDataFrame(many, DOCUMENT), 2) == brute(many)
