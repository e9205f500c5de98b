"""Both vector searches against brute force, on the table and on crowded or broken rows."""

from __future__ import annotations

import numpy as np
import pytest

from quarterdeck.llm.common import table
from quarterdeck.llm.cross_polytope import hadamard, nearest
from quarterdeck.llm.multi_index import search, sign_codes

SF = "/root/testdata/sf0.001"


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 64))
    y = hadamard(x)
    assert np.allclose((y * y).sum(1), (x * x).sum(1)) and np.allclose(hadamard(y), x)
    assert np.allclose(hadamard(np.eye(2)), np.array([[1, 1], [1, -1]]) / np.sqrt(2))


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    base = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    width = len(base[0][1])
    same = [float(x) for x in rng.normal(size=width)]
    rows = base + [(100_000 + i, same) for i in range(300)]
    nan, inf = float("nan"), float("inf")
    rows += [(200_000, None), (200_020, []), (200_040, [0.0] * width), (200_060, [nan] * width),
             (200_080, [inf] + [0.0] * (width - 1)), (None, same), (200_100, [None] * width)]
    rows += [(300_000 + i, [3 * x for x in base[i][1]]) for i in range(0, 200)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 as class", "'x' as vec", "2 as code")


def usable(rows):
    out = {}
    for r in rows:
        v = r.embedding
        if r.vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            out[r.vec_id] = np.array(v, float)
    return out


def test_recall_and_exact_scores(vectors):
    rows = usable(vectors.collect())
    ids = np.array(sorted(rows))
    matrix = np.array([rows[i] for i in ids])
    found = {}
    for r in nearest(vectors, "vec_id % 20 = 0").orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    queries = [i for i in ids if i % 20 == 0]
    assert sorted(found) == queries
    hits = 0
    for q in queries:
        scores = matrix @ rows[q]
        best = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:20]
        assert [r for r, _, _ in found[q]] == list(range(1, 21))
        assert all(abs(s - rows[v] @ rows[q]) < 1e-9 for _, v, s in found[q])
        assert [(-s, v) for _, v, s in found[q]] == sorted((-s, v) for _, v, s in found[q])
        least = scores[best[-1]] - 1e-9
        hits += sum(s >= least for _, _, s in found[q]) / 20
    assert hits / len(queries) >= 0.9
    crowd = [v for _, v, _ in found[100_000]]
    assert crowd == [*range(100_001, 100_021)] or len(set(crowd)) == 20
    assert nearest(vectors.limit(0), "vec_id % 20 = 0").count() == 0


def test_codes_are_searched_exactly(vectors, spark):
    codes = sign_codes(vectors)
    rows = dict(map(tuple, codes.collect()))
    assert set(rows) == set(usable(vectors.collect()))
    meant = []
    for q in rows:
        if q % 50 == 0:
            near = sorted((bin((rows[q] ^ c) & (1 << 64) - 1).count("1"), v)
                          for v, c in rows.items() if v != q)
            meant += [(q, i + 1, v, d) for i, (d, v) in enumerate(near[:10])]
    assert sorted(map(tuple, search(codes, "vec_id % 50 = 0").collect())) == sorted(meant)
    few = codes.where("vec_id in (0, 50, 51)")
    assert search(few, "vec_id % 50 = 0").count() == 4
    assert search(codes.limit(0), "vec_id % 50 = 0").count() == 0
