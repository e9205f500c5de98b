"""Exact Jaccard join of word-shingle sets by a token-group matrix.

Two texts link when their sets of 5-word shingles have a Jaccard similarity of 0.75 or more.

1. Texts with equal sets form a class; one text stands for it.
2. Partition: classes with an equal min-hash and similar size are compared with the smallest of
   them, the pivot. The links found so put similar classes into groups (components).
3. Matrix: for each token (shingle), the groups that hold it in some member's prefix. Tokens have one
   order, frequent ones last; the prefix of a set of n tokens is its first n//4 + 1.
4. Bound: let the first token that two sets share, of n and m >= n tokens, be at places i and j
   (from 0). They share at most n - i and m - j tokens and, to link, need 3(n + m)/7. So m must be at
   most (4n - 7i)/3, n at most (4m - 7j)/3, and the smaller set asks with its first n//7 + 1 tokens
   only. Two groups that share a token and cannot satisfy this by any of their sizes stay closed; the
   others are opened and their members held to it one by one.
5. Where many classes share a token, a few of them speak for it: the others are compared with these
   first. Groups linked so are joined, in ``SPOKEN`` turns, and are not opened to each other. Then
   all the pairs left are compared. All links give the components.

No link is lost: two classes are compared unless they are already in one group or provably too far
apart. Group members are not compared pair by pair. Comparing is done in cells of one pivot and at
most about ``CELL`` texts, so a large group is many cells.

The order of tokens only steers the work. How often each token occurs is counted over all documents
(by 32 bits and more of its hash); at most ``MOST_FREQUENT`` frequent ones go through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import arrow_map, utf8
from quarterdeck.llm.components import components
from quarterdeck.llm.shingles import linked, mix, shingle_sets
from quarterdeck.session import written

ROUNDS, CELL, FREQUENT, MOST_FREQUENT, STRETCH = 4, 64, 8, 400_000, 2_000_000
SPOKEN, HEADS = 2, 8  # turns, and classes in each of them, that speak for a token
STEPS = 16  # ranks of frequent tokens to a doubling of their counts
SETS = "row long, doc_id long, n long, class long, " + ", ".join(
    f"key{r} long" for r in range(ROUNDS)) + ", prefix binary"


def _row() -> Column:
    """Names a row by its doc_id and text; rows equal in both have one name."""
    return F.xxhash64("doc_id", utf8())


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _dealt(place: np.ndarray, buckets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The buckets that occur in ``place`` and, for each, where."""
    order = np.argsort(place, kind="stable")
    ends = np.searchsorted(place[order], np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(ends))
    return used, [order[ends[k]:ends[k + 1]] for k in used]


def _frequent(docs: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """How many bits of a token are dropped, the codes of frequent tokens, ascending, and their
    ranks, ``STEPS`` to a doubling of the count. Tokens travel as blocks of 32 bits, the bucket's bits
    left out."""
    split = max(10, (_partitions(docs) - 1).bit_length())
    drop = 32 - split

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[np.ndarray] = []

        def blocks() -> dict:
            codes = np.concatenate(held) >> np.uint64(drop)
            held.clear()
            used, places = _dealt((codes & np.uint64((1 << split) - 1)).astype(np.int64), 1 << split)
            rest = (codes >> np.uint64(split)).astype(np.uint32)
            return {"bucket": used, "codes": [rest[p].tobytes() for p in places]}

        for batch in batches:
            held += shingle_sets([t.as_py() for t in batch["utf8"]])
            if sum(map(len, held)) > STRETCH:
                yield blocks()
        if held:
            yield blocks()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, codes in zip(batch["bucket"].to_pylist(), batch["codes"]):
                held.setdefault(bucket, []).append(codes.as_py())
        for bucket, parts in held.items():
            codes, n = np.unique(np.frombuffer(b"".join(parts), np.uint32), return_counts=True)
            often = n >= FREQUENT
            yield {"code": (codes[often].astype(np.int64) << split) + bucket,
                   "rank": (STEPS * np.log2(n[often])).astype(np.int32)}

    blocks = arrow_map(docs.select(utf8().alias("utf8")), deal, "bucket int, codes binary")
    found = written(arrow_map(blocks.repartition(_partitions(docs), "bucket"), count,
                              "code long, rank int"), "frequent")
    least, total = 0, 0
    for rank, rows in sorted(map(tuple, found.groupBy("rank").count().collect()), reverse=True):
        total += rows
        if total > MOST_FREQUENT:
            least = rank + 1
            break
    rows = found.where(F.col("rank") >= least).collect()
    codes = np.array([r["code"] for r in rows], np.uint64)
    order = np.argsort(codes)
    return drop, codes[order], np.array([r["rank"] for r in rows], np.int16)[order]


def _prefix(tokens: np.ndarray, drop: int, frequent: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    wanted = len(tokens) // 4 + 1
    if len(frequent):
        codes = tokens >> np.uint64(drop)
        at = np.minimum(np.searchsorted(frequent, codes), len(frequent) - 1)
        rank = np.where(frequent[at] == codes, ranks[at], 0)
        if rank.any():
            return tokens[np.lexsort((tokens, rank))[:wanted]]
    return tokens[:wanted]


def shingled(docs: DataFrame) -> DataFrame:
    """Row, doc_id, number of shingles, class, min-hashes and prefix of every document."""
    given = docs.sparkSession.sparkContext.broadcast(_frequent(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        order = given.value
        for batch in batches:
            sets = shingle_sets([t.as_py() for t in batch["utf8"]])
            out = {"row": batch["row"], "doc_id": batch["doc_id"], "n": [len(s) for s in sets]}
            out["class"] = [_signed(xxhash.xxh3_64_intdigest(s.tobytes())) if len(s) else None
                            for s in sets]
            for r in range(ROUNDS):
                salt = np.uint64(xxhash.xxh3_64_intdigest(b"%d" % r))
                out[f"key{r}"] = [int(mix(s ^ salt).min().view(np.int64)) if len(s) else None
                                  for s in sets]
            out["prefix"] = [_prefix(s, *order).tobytes() if len(s) else None for s in sets]
            yield out

    rows = docs.select(_row().alias("row"), "doc_id", utf8().alias("utf8"))
    return written(arrow_map(rows, run, SETS), "shingled")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fits(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= 75 * F.greatest(n, m)


def _pivots(classes: DataFrame) -> DataFrame:
    """Pairs (a, b): a class and the smallest class with the same min-hash in its band of sizes
    (a factor 4/3 wide, at another place in each round)."""
    keys = (classes.select("class", "n", F.posexplode(
        F.array(*[f"key{r}" for r in range(ROUNDS)])).alias("round", "key"))
        .withColumn("band", F.floor(F.log("n") / F.log(F.lit(4 / 3)) + F.col("round") / ROUNDS)))
    pivots = (keys.groupBy("round", "key", "band")
              .agg(F.min(F.struct("n", "class")).alias("pivot"), F.count("*").alias("rows"))
              .where("rows > 1"))
    return (keys.join(pivots, ["round", "key", "band"])
            .where((F.col("class") != F.col("pivot.class")) & _fits(F.col("n"), F.col("pivot.n")))
            .select(F.col("class").alias("a"), F.col("pivot.class").alias("b")).distinct())


def _compare(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, told by the texts of their classes.

    Each b and its a's make cells; the texts go to the cells and one set is held at a time.
    """
    pairs = written(pairs, "pairs")
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / CELL).alias("cells"))
    placed = pairs.join(sizes, "b").withColumn("cell", F.pmod(F.xxhash64("a"), "cells"))
    members = placed.select("b", "cell", F.col("a").alias("class"), F.lit(1).alias("part"))
    heads = sizes.select("b", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"),
                         F.col("b").alias("class"), F.lit(0).alias("part"))
    wanted = (members.unionByName(heads)
              .join(classes.select("class", F.col("first_row").alias("row")), "class"))
    texts = docs.select(_row().alias("row"), utf8().alias("utf8"))
    cells = (texts.join(wanted, "row").select("b", "cell", "part", "class", "utf8")
             .repartition("b", "cell").sortWithinPartitions("b", "cell", "part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        head, pivot = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            sets = shingle_sets([t.as_py() for t in batch["utf8"]])
            keys = zip(*(batch[c].to_pylist() for c in ("b", "cell", "part", "class")))
            for (own, cell, part, other), tokens in zip(keys, sets):
                if part == 0:
                    head, pivot = (own, cell), tokens
                elif (own, cell) == head and linked(pivot, tokens):
                    a.append(other)
                    b.append(own)
            yield {"a": a, "b": b}

    return arrow_map(cells, run, "a long, b long").distinct()


def _postings(sets: DataFrame) -> DataFrame:
    """(token, class, n, reach) of prefix tokens that more than one class has, where ``reach`` is the
    most tokens of a set that may share this one first. Tokens travel in blocks by bucket."""
    buckets = _partitions(sets)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            parts = [np.frombuffer(p.as_py(), np.uint64) for p in batch["prefix"]]
            if not parts:
                continue
            sizes = [len(p) for p in parts]
            tokens = np.concatenate(parts)
            owners = np.repeat(batch["class"].to_numpy(), sizes)
            lengths = np.repeat(batch["n"].to_numpy().astype(np.int32), sizes)
            places = np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])
            used, at = _dealt((tokens % np.uint64(buckets)).astype(np.int64), buckets)
            yield {"bucket": used} | {name: [column[p].tobytes() for p in at] for name, column in
                                      zip(names, (tokens, owners, lengths, places))}

    names = ("tokens", "owners", "lengths", "places")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        blocks = [b for b in batches if len(b)]
        if not blocks:
            return
        tokens, owners, lengths, places = (
            np.frombuffer(b"".join(x.as_py() for b in blocks for x in b[name]), kind)
            for name, kind in zip(names, (np.uint64, np.int64, np.int32, np.int32)))
        order = np.lexsort((owners, tokens))
        tokens, owners, lengths, places = (
            x[order] for x in (tokens, owners, lengths, places))
        kept = np.append(True, (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1]))
        tokens, owners, lengths, places = (x[kept] for x in (tokens, owners, lengths, places))
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        several = np.diff(np.append(first, len(tokens)))
        asked = np.add.reduceat((7 * places <= lengths).astype(np.int64), first) > 0
        shared = np.flatnonzero(np.repeat((several > 1) & asked, several))
        for start in range(0, max(1, len(shared)), 100_000):
            some = shared[start:start + 100_000]
            yield {"token": tokens[some].view(np.int64), "class": owners[some], "n": lengths[some],
                   "reach": (4 * lengths[some] - 7 * places[some]) // 3}

    dealt = arrow_map(sets.where("n > 0").select("class", "n", "prefix"), deal,
                      "bucket int, tokens binary, owners binary, lengths binary, places binary")
    return arrow_map(dealt.repartition(buckets, "bucket"), meet,
                     "token long, class long, n long, reach long")


def _placed(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """The postings with the group of each class; a class without links is its own group."""
    return written(
        postings.join(groups.select(F.col("node").alias("class"), "component"), "class", "left")
        .withColumn("group", F.coalesce("component", "class")).drop("component"), "postings")


def _matrix(known: DataFrame) -> DataFrame:
    """(token, x, y) where groups x and y both hold the token, x asks, and some members may link;
    with a member of each. Sizes are compared with the class as a tie-break, as members are."""
    sized = F.struct("n", "class")
    asking = known.where("n <= reach").groupBy("token", F.col("group").alias("x")).agg(
        F.min(sized).alias("x_low"), F.max("reach").alias("x_reach"))
    held = known.groupBy("token", F.col("group").alias("y")).agg(
        F.min(sized).alias("y_low"), F.max(sized).alias("y_high"), F.max("reach").alias("y_reach"))
    return asking.join(held, "token").where(
        "x <> y AND y_low.n <= x_reach AND x_low.n <= y_reach AND x_low < y_high")


def _spokesmen(known: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of classes of different groups: b is one of ``HEADS`` classes, drawn anew in each
    turn, that speak for a token and a band of sizes, and a another class there. Tokens with few
    classes need none; all they open is compared later."""
    draw = F.xxhash64(F.lit(turn), "class")
    banded = known.withColumn("band", F.floor(
        F.log("n") / F.log(F.lit(4 / 3)) + F.lit(turn / SPOKEN)))
    heads = (banded.groupBy("token", "band", F.pmod(draw, F.lit(HEADS)).alias("slot"))
             .agg(F.min(F.struct(draw.alias("draw"), "class", "n", "reach", "group")).alias("head"),
                  F.count("*").alias("rows"))
             .groupBy("token", "band")
             .agg(F.collect_list("head").alias("heads"), F.sum("rows").alias("rows"))
             .where(F.col("rows") > HEADS).select("token", "band", F.explode("heads").alias("head")))
    return (banded.join(heads, ["token", "band"])
            .where("`group` <> head.group AND n <= head.reach AND head.n <= reach")
            .select(F.col("class").alias("a"), F.col("head.class").alias("b")).distinct())


def _opened(known: DataFrame) -> DataFrame:
    """Pairs (a, b) still to compare, a the smaller one: classes of different groups that may link."""
    askers = known.where("n <= reach").select(
        "token", F.col("group").alias("x"), F.col("class").alias("a"), F.col("n").alias("a_n"),
        F.col("reach").alias("a_reach"))
    members = known.select("token", F.col("group").alias("y"), F.col("class").alias("b"),
                           F.col("n").alias("b_n"), F.col("reach").alias("b_reach"))
    return (_matrix(known).select("token", "x", "y").join(askers, ["token", "x"])
            .join(members, ["token", "y"])
            .where("b_n <= a_reach AND a_n <= b_reach AND (a_n < b_n OR a_n = b_n AND a < b)")
            .select("a", "b").distinct())


def _joined(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """The components of groups and more links."""
    return components(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
                      .unionByName(pairs))


def components_of(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_shingles, component (a class, null without shingles) of every document.

    Null and wordless texts have no shingles and no links. Repeated rows are in one class.
    """
    docs = docs.select("doc_id", "text")
    sets = shingled(docs)
    classes = written(
        sets.where("n > 0").groupBy("class")
        .agg(F.first("n").alias("n"), F.min("row").alias("first_row"),
             *[F.first(f"key{r}").alias(f"key{r}") for r in range(ROUNDS)]), "classes")
    near = written(_compare(_pivots(classes), classes, docs), "near")
    groups = components(near)
    postings = written(_postings(sets), "postings")
    for turn in range(SPOKEN):
        pairs = _spokesmen(_placed(postings, groups), turn)
        groups = _joined(groups, _compare(pairs, classes, docs))
    whole = _joined(groups, _compare(_opened(_placed(postings, groups)), classes, docs))
    return (sets.select("row", "doc_id", F.col("n").alias("n_shingles"), "class")
            .join(whole.select(F.col("node").alias("class"), "component"), "class", "left")
            .select("row", "doc_id", "n_shingles", F.coalesce("component", "class")
                    .alias("component")))


def join_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id that links reach, its own included."""
    found = written(components_of(docs), "components")
    least = (found.where(F.col("component").isNotNull()).groupBy("component")
             .agg(F.min("doc_id").alias("least")))
    return found.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component stays, the one of the smallest doc_id; documents without
    shingles all stay. Rows equal in doc_id and text count as one document."""
    found = components_of(docs)
    kept = found.where(F.col("component").isNotNull()).groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("kept")
    ).select(F.col("kept.row").alias("kept_row"))
    kept = kept.unionByName(found.where(F.col("component").isNull())
                            .select(F.col("row").alias("kept_row")).distinct())
    return (docs.withColumn("kept_row", _row()).join(kept, "kept_row")
            .dropDuplicates(["kept_row"]).select(*[F.col(f"`{c}`") for c in docs.columns]))
