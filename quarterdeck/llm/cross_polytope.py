"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are rotated pseudo-randomly (three rounds of random signs and a fast Hadamard transform) and
assigned to the nearest signed axis, the largest coordinate in absolute value. ``HASHES`` such
axes make a bucket of one of ``TABLES`` tables. Queries look into their own bucket and, by
multiprobe, into those whose axes come next; everything found is ranked by the exact inner
product in double precision.

Since the measure is the inner product, candidates are put into bands of similar length (within a
factor ``BAND``), and get one more coordinate that gives all of a band the length of its longest;
queries get zero there and look into every band. Nearest in angle is then largest in product.

Equal vectors are one class, of which only the k + 1 smallest vec_ids can be among the k nearest.
Buckets are cut into parts of about ``PART`` classes by a salt, and a query visits every part of a
bucket, so a crowded bucket is many cells and no candidate is left out. Every cell gives at most
k + 1 rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import arrow_map
from quarterdeck.llm.vectors import least_of_each, usable
from quarterdeck.session import written

TABLES, HASHES, PROBES, PART, SEED, BAND = 16, 1, 16, 2048, 7, 1.5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    x, h = x.copy(), 1
    n = x.shape[1]
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(-1, n)
        h *= 2
    return x / np.sqrt(n)


def rotations(vectors: np.ndarray, table: int) -> list[np.ndarray]:
    """The HASHES pseudo-rotations of these unit vectors that belong to a table."""
    width = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    padded = np.zeros((len(vectors), width))
    padded[:, :vectors.shape[1]] = vectors
    out = []
    for k in range(HASHES):
        rng, turned = np.random.default_rng((SEED, table, k)), padded
        for _ in range(3):
            turned = hadamard(turned * rng.choice((-1.0, 1.0), width))
        out.append(turned)
    return out


def buckets(vectors: np.ndarray, table: int, probes: int = 1) -> np.ndarray:
    """The best ``probes`` buckets of each vector, best first: those with the largest sum of signed
    coordinates along their axes."""
    turned = rotations(vectors, table)
    width = turned[0].shape[1]
    # Twice the absolute value tells apart an axis and its opposite: signed values side by side.
    signed = [np.concatenate([t, -t], axis=1) for t in turned]
    few = min(2 * width, probes)
    axes = [np.argpartition(-s, few - 1, axis=1)[:, :few] for s in signed]
    sums = np.take_along_axis(signed[0], axes[0], 1)
    names = axes[0].astype(np.int64)
    for s, a in zip(signed[1:], axes[1:]):
        sums = (sums[:, :, None] + np.take_along_axis(s, a, 1)[:, None, :]).reshape(len(s), -1)
        names = (names[:, :, None] * 2 * width + a[:, None, :]).reshape(len(s), -1)
    best = np.argsort(-sums, axis=1, kind="stable")[:, :probes]
    return np.take_along_axis(names, best, 1)


def _rows(batch: pa.RecordBatch, name: str = "vec") -> np.ndarray:
    column = batch[name]
    return column.flatten().to_numpy().reshape(len(column), -1)


def _cells(vectors: DataFrame, longest: dict[int, float], query: bool) -> DataFrame:
    """class, vec, table and bucket: one row for each bucket that a vector is put into. Every band
    of lengths has tables of its own, and queries look into all of them."""
    probes = PROBES if query else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            vec, bands = _rows(batch), batch["band"].to_numpy()
            size = np.sqrt((vec * vec).sum(axis=1))
            for band, most in longest.items():
                own = np.arange(len(vec)) if query else np.flatnonzero(bands == band)
                if not len(own):
                    continue
                rest = np.zeros(len(own)) if query else np.sqrt(
                    np.maximum(0, most ** 2 - size[own] ** 2))
                unit = np.column_stack([vec[own], rest])
                unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
                for table in range(TABLES):
                    found = buckets(unit, table, probes)
                    again = pa.array(np.repeat(own, found.shape[1]))
                    yield {"class": batch["class"].take(again),
                           "table": [band * TABLES + table] * found.size,
                           "bucket": found.ravel(), "vec": batch["vec"].take(again)}

    return arrow_map(vectors.select("class", "vec", "band"), run,
                     "class long, table int, bucket long, vec array<double>")


def _search(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(q, class, score): the k best of each cell for each query that visits it."""
    sizes = written(index.groupBy("table", "bucket").agg(F.ceil(F.count("*") / PART).alias("parts")),
                    "bucket-sizes")
    put = (index.join(sizes, ["table", "bucket"])
           .withColumn("part", F.pmod(F.xxhash64("class"), "parts").cast("int"))
           .select("table", "bucket", "part", "class", "vec"))
    visits = (asked.join(sizes, ["table", "bucket"])
              .withColumn("part", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
              .select("table", "bucket", "part", "class", "vec"))
    both = (put.withColumn("side", F.lit(0)).unionByName(visits.withColumn("side", F.lit(1)))
            .repartition("table", "bucket", "part")
            .sortWithinPartitions("table", "bucket", "part", "side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cell, held, names = None, [], []
        block = names_block = None
        for batch in batches:
            if not len(batch):
                continue
            vec, ids = _rows(batch), batch["class"].to_numpy()
            keys = np.column_stack([batch[c].to_numpy() for c in ("table", "bucket", "part")])
            side = batch["side"].to_numpy()
            new = np.any(np.diff(keys, axis=0) != 0, axis=1) | (np.diff(side) != 0)
            cuts = [0, *(np.flatnonzero(new) + 1), len(batch)]
            q, found, scores = [], [], []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if tuple(keys[a]) != cell:
                    cell, held, names, block = tuple(keys[a]), [], [], None
                if side[a] == 0:
                    held.append(vec[a:b])
                    names.append(ids[a:b])
                    block = None
                elif held:
                    if block is None:
                        block, names_block = np.concatenate(held), np.concatenate(names)
                    for start in range(a, b, 256):
                        part = vec[start:min(b, start + 256)]
                        product = np.zeros((len(part), len(block)))
                        for d in range(part.shape[1]):  # one order of adding, whatever the block
                            product += part[:, d, None] * block[None, :, d]
                        few = min(k, len(block))
                        best = np.argpartition(-product, few - 1, axis=1)[:, :few]
                        worst = np.take_along_axis(product, best, 1).min(axis=1)
                        at, to = np.nonzero(product >= worst[:, None])  # all that tie at the end
                        q.append(ids[start + at])
                        found.append(names_block[to])
                        scores.append(product[at, to])
            join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
            yield {"q": join(q, np.int64), "class": join(found, np.int64),
                   "score": join(scores, np.float64)}

    return arrow_map(both, run, "q long, class long, score double")


def nearest(df: DataFrame, queries: str, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``queries`` (an SQL condition on vec_id)
    selects, the k nearest of the other rows found. Ties go to the smaller vec_id.

    Vectors of another width than the most frequent one take no part.
    """
    rows = usable(df).withColumn("class", F.xxhash64("vec")).withColumn("width", F.size("vec"))
    width = rows.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if width is None:
        return df.sparkSession.createDataFrame([], schema)
    rows = written(rows.where(F.col("width") == width["width"]).drop("width"), "vectors")
    size = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    classes = written(rows.groupBy("class").agg(F.first("vec").alias("vec")).withColumn(
        "band", F.floor(F.log(size) / F.log(F.lit(BAND)) + 0.5).cast("int")), "classes")
    longest = dict(map(tuple, classes.groupBy("band").agg(F.max(size)).collect()))
    asking = rows.where(queries).select("class").distinct()
    index = _cells(classes, longest, query=False)
    asked = _cells(classes.join(asking, "class"), longest, query=True)
    found = written(_search(index, asked, k + 1), "near-classes")
    best = (found.groupBy("q", "class").agg(F.max("score").alias("score")))
    members = least_of_each(rows.select("class", "vec_id"), "class", k + 1)
    place = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = (best.join(members, "class").withColumn("place", F.row_number().over(place))
           .where(F.col("place") <= k + 1).drop("place"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (rows.where(queries).select(F.col("vec_id").alias("query_id"), F.col("class").alias("q"))
            .join(top, "q").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
