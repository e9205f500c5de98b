"""Exact top-k search of binary codes by incremental multi-index hashing.

A code of ``BITS`` bits is cut into m segments. If two codes differ in fewer than m * (r + 1) bits,
some segment differs in at most r (pigeonhole). Round r looks up, in the index of each segment, all
values at distance exactly r from the query's segment; after it, all codes nearer than
m * (r + 1) have been met. A query is done once its k-th verified distance is below that.

Rows with equal codes are one entry, for which only the k + 1 smallest ids can be among the k
nearest. When a round would look up more values in a segment than there are codes, the queries left
are compared with all codes, in blocks, which is exact too. All of it is DataFrame
operations on the JVM.
"""

from __future__ import annotations

from math import comb, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.vectors import least_of_each, usable
from quarterdeck.session import written

BITS, BLOCK = 64, 4096


def sign_codes(df: DataFrame) -> DataFrame:
    """vec_id and code: bit i is set where component i (of the first 64) is positive or zero."""
    bits = [F.when(F.get("vec", F.lit(i)) >= 0, F.lit(1 << i if i < 63 else -(1 << 63)).cast("long"))
            .otherwise(F.lit(0).cast("long")) for i in range(BITS)]
    code = bits[0]
    for bit in bits[1:]:
        code = code.bitwiseOR(bit)
    return usable(df).select("vec_id", code.alias("code"))


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The k nearest entries of each query code; each task cuts its rows to k before they move."""
    place = Window.partitionBy("q").orderBy("distance", "vec_id")
    return (rows.withColumn("place", F.row_number().over(place))
            .where(F.col("place") <= k).drop("place"))


def search(codes: DataFrame, queries: str, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, distance: for each row of ``codes`` (vec_id, code) that ``queries``
    selects, the k other rows of least Hamming distance, ties to the smaller vec_id."""
    codes = written(codes.distinct(), "codes")
    entries = written(least_of_each(codes, "code", k + 1), "entries")
    n = entries.select("code").distinct().count()
    schema = "query_id long, rank int, vec_id long, distance int"
    if not n:
        return codes.sparkSession.createDataFrame([], schema)
    most = entries.count()
    segments = max(1, round(BITS / max(4, log2(n + 1))))
    cuts = [BITS * i // segments for i in range(segments + 1)]
    widths = [b - a for a, b in zip(cuts[:-1], cuts[1:])]

    def segment(code: Column, i: int) -> Column:
        return F.shiftrightunsigned(code, cuts[i]).bitwiseAND(F.lit((1 << widths[i]) - 1))

    asked = codes.where(queries).select(F.col("code").alias("q")).distinct()
    placed = entries.select("vec_id", "code", F.posexplode(
        F.array(*[segment(F.col("code"), i) for i in range(segments)])).alias("segment", "part"))
    left, best, done = written(asked, "asked"), None, []
    for r in range(max(widths) + 1):
        if left.isEmpty():
            break
        if max(comb(w, r) for w in widths) > n:
            done.append(_best(_all(entries, left), k + 1))
            break
        parts = F.array(*[F.struct(segment(F.col("q"), i).alias("part"), F.lit(w).alias("width"))
                          for i, w in enumerate(widths)])
        probes = _flipped(left.select("q", F.posexplode(parts).alias("segment", "own"))
                          .select("q", "segment", "own.part", "own.width"), r)
        # Spark takes exploded rows for as few as there were before, so it is told not to broadcast them.
        met = (placed.join(probes.hint("merge"), ["segment", "part"])
               .select("q", "vec_id", _distance(F.col("q"), F.col("code")).alias("distance")).distinct())
        if best is not None:
            met = met.unionByName(best.join(left, "q")).distinct()
        best = written(_best(met, k + 1), "best")
        covered = written(best.groupBy("q").agg(
            F.count("*").alias("n"), F.max("distance").alias("d")).where(
            (F.col("n") >= min(k + 1, most)) & (F.col("d") < segments * (r + 1))).select("q"),
            "covered")
        done.append(best.join(covered, "q"))
        left = written(left.join(covered, "q", "left_anti"), "left")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    place = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return (codes.where(queries).select(F.col("vec_id").alias("query_id"), F.col("code").alias("q"))
            .join(whole, "q").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "distance"))


def _flipped(probes: DataFrame, r: int) -> DataFrame:
    """(q, segment, part) with each r bits of ``part`` flipped: one after the other, each above the last."""
    rows = probes.where(F.col("width") >= r).withColumn("next", F.lit(0))
    for i in range(r):
        rows = rows.select("q", "segment", "part", "width", F.explode(F.sequence(
            "next", F.col("width") - F.lit(r - i))).alias("bit")).select(
            "q", "segment", F.col("part").bitwiseXOR(F.expr("shiftleft(1L, bit)")).alias("part"), "width",
            (F.col("bit") + 1).alias("next"))
    return rows.select("q", "segment", "part")


def _all(entries: DataFrame, left: DataFrame) -> DataFrame:
    """The distance of every entry to each query that is left, block by block of the entries."""
    n = max(1, entries.count() // BLOCK)
    blocks = entries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n)))
    visits = left.withColumn("block", F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    return visits.join(blocks, "block").select(
        "q", "vec_id", _distance(F.col("q"), F.col("code")).alias("distance"))
