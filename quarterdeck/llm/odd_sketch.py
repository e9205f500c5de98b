"""Near duplicates by MinHash bands, verified by odd sketches and confirmed on full sets.

Two texts link when their sets of 2-word shingles have a Jaccard similarity of 0.8 or more.

1. Texts with equal sets (by a 128-bit digest) form a class; one text stands for it.
2. A class has ``SAMPLES`` MinHash samples. Each band of ``ROWS`` of the first ones is a bucket; a link at
   the threshold is in no common bucket with a chance of 3e-8.
3. The samples, each with its number, are folded into an odd sketch of ``BITS`` bits: a bit says whether
   an odd number of samples fell on it. Samples that two sets share cancel out in the XOR of their
   sketches, so its population count estimates how many they do not share, the better the fewer
   these are. A pair of one bucket is a candidate if sizes allow a link and that count is at most ``most()``,
   which a link at the threshold exceeds with a chance of 2e-8.
4. Candidates are confirmed on the full sets of both texts.
5. A few turns go first: each class is compared with one class, the one of ``HEADS`` heads of each of its
   buckets that its sketch is nearest to. Linked classes are one group and need no more comparing. Then
   all candidate pairs of classes of different groups are compared: in each bucket the classes outside its
   largest group with each other, and each of them with that group as a whole, whose sets are held
   together in parts. All links give the components.

Heads are drawn anew in each turn, so groups of any size come together in some turns of at most one
comparison for each class. Sketches are compared inside the joins on buckets, which give candidates
only; comparing texts is done in cells of one class and about ``CELL`` texts, or of a part of a group.

Nulls: null and wordless texts have no shingles and no links. Repeated rows are in one class, each gives a
row. A null doc_id is no component_id unless its component has no other. Columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

import math
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

WORDS, PERCENT = 2, 80
BANDS, ROWS, SAMPLES, BITS = 44, 5, 440, 1024
SIGMAS = 5.5
TURNS, HEADS, CELL, STRETCH = 2, 8, 64, 1 << 16
CHUNK, CHUNK_TOKENS = 256, 1 << 20  # sets of a group, and their tokens, held together
U = np.uint64
FACTORS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)) | U(1)
SETS = "row binary, doc_id long, n long, class binary, buckets array<long>, sketch array<long>"


def most(share: float = PERCENT / 100) -> int:
    """The bits of the XOR of two sketches that sets of this similarity stay below, by ``SIGMAS`` standard
    deviations: those of the samples they do not share (binomial), and of m balls thrown into BITS bins
    of which the odd ones are counted."""
    m = 2 * SAMPLES * (1 - share)
    one, two = (1 - 2 / BITS) ** m, (1 - 4 / BITS) ** m
    mean = BITS * (1 - one) / 2
    parity = BITS * (1 - two) / 4 + BITS ** 2 * (two - one ** 2) / 4
    spread = (2 * one) ** 2 * SAMPLES * share * (1 - share)
    return math.ceil(mean + SIGMAS * math.sqrt(parity + spread))


def samples(sets: list[np.ndarray]) -> np.ndarray:
    """The MinHash samples of non-empty sets, a row for each; about ``STRETCH`` tokens at a time."""
    out = np.empty((len(sets), SAMPLES), np.uint64)
    start = 0
    while start < len(sets):
        end, size = start, 0
        while end < len(sets) and (end == start or size < STRETCH):
            size += len(sets[end])
            end += 1
        tokens = np.concatenate(sets[start:end])
        at = np.cumsum([0, *(len(s) for s in sets[start:end - 1])])
        product = np.empty_like(tokens)
        for i, factor in enumerate(FACTORS):
            np.multiply(tokens, factor, out=product)
            out[start:end, i] = np.minimum.reduceat(product, at)
        start = end
    return out


def buckets(found: np.ndarray) -> np.ndarray:
    """One key for each band."""
    first = found[:, :BANDS * ROWS].reshape(len(found), BANDS, ROWS)
    bands = (first * FACTORS[:ROWS]).sum(axis=2, dtype=np.uint64)
    return mix(bands + np.arange(BANDS, dtype=np.uint64) * FACTORS[-1])


def sketches(found: np.ndarray) -> np.ndarray:
    """The odd sketch of each row of samples, as words of 64 bits."""
    bit = mix(found + FACTORS) % U(BITS)
    at = bit.astype(np.int64) + BITS * np.arange(len(found))[:, None]
    odd = (np.bincount(at.ravel(), minlength=BITS * len(found)) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(found), BITS), axis=1).view(np.int64)


def _row() -> Column:
    """Names a row by its doc_id and text; rows equal in both have one name."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).cast("binary"),
                                  F.lit(":").cast("binary"), utf8())))


def described(docs: DataFrame) -> DataFrame:
    """Row, doc_id, size, class, buckets and sketch of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            sets = shingle_sets([t.as_py() for t in batch["utf8"]], WORDS)
            full = [s for s in sets if len(s)]
            found = samples(full)
            keys, bits = iter(buckets(found).view(np.int64).tolist()), iter(sketches(found).tolist())
            yield {"row": batch["row"], "doc_id": batch["doc_id"], "n": [len(s) for s in sets],
                   "class": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                   "buckets": [next(keys) if len(s) else None for s in sets],
                   "sketch": [next(bits) if len(s) else None for s in sets]}

    rows = docs.select(_row().alias("row"), "doc_id", utf8().alias("utf8"))
    return written(arrow_map(rows, run, SETS), "described")


def _differ(a: str, b: str) -> Column:
    """The bits in which the sketches of two entries differ."""
    return sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i]))
                for i in range(BITS // 64)), F.lit(0))


def _may_link(a: str, b: str) -> Column:
    """What sizes and sketches of two entries allow."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 * F.least(x, y) >= PERCENT * F.greatest(x, y)) & (_differ(a, b) <= most())


def _postings(classes: DataFrame) -> DataFrame:
    """(bucket, class, n, sketch) for the buckets of more than one class."""
    rows = classes.select("class", F.explode("buckets").alias("bucket"))
    several = rows.groupBy("bucket").agg(F.count("*").alias("classes")).where("classes > 1")
    return written(rows.join(several.select("bucket"), "bucket")
                   .join(classes.select("class", "n", "sketch"), "class"), "postings")


def _apart(postings: DataFrame, groups: DataFrame | None) -> DataFrame:
    """(bucket, entry of class, n, sketch and group) for the buckets whose classes are not all in one
    group yet; a class without links is its own group."""
    if groups is None:
        placed = postings.withColumn("group", F.col("class"))
    else:
        known = groups.select(F.col("node").alias("class"), F.col("component").alias("group"))
        placed = postings.join(known, "class", "left").withColumn("group", F.coalesce("group", "class"))
    open_ = (placed.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high"))
             .where("low <> high").select("bucket"))
    return written(placed.join(open_, "bucket").select(
        "bucket", F.struct("class", "n", "sketch", "group").alias("entry")), "apart")


def _nearest_heads(apart: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b): each class and the nearest head of its buckets, of another group, if one may link."""
    draw = F.xxhash64(F.lit(turn), "entry.class")
    heads = (apart.groupBy("bucket", F.pmod(draw, F.lit(HEADS)).alias("slot"))
             .agg(F.min(F.struct(draw.alias("draw"), "entry")).alias("first"))
             .select("bucket", F.col("first.entry").alias("head")))
    return (apart.join(heads, "bucket")
            .where((F.col("entry.group") != F.col("head.group")) & _may_link("entry", "head"))
            .groupBy(F.col("entry.class").alias("a"))
            .agg(F.min(F.struct(_differ("entry", "head").alias("differ"),
                                F.col("head.class").alias("b"))).alias("near"))
            .select("a", F.col("near.b").alias("b")))


def _candidates(apart: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is left to compare: pairs (a, b) of classes of different groups outside the largest group of a
    bucket they share, and (a, group) for a class that may link with some class of that group."""
    sizes = apart.groupBy("bucket", F.col("entry.group").alias("group")).agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max_by("group", F.struct("n", "group")).alias("main"))
    placed = apart.join(main, "bucket")
    rest = placed.where(F.col("entry.group") != F.col("main"))
    one, other = (rest.select("bucket", "main", F.col("entry").alias(name)) for name in ("one", "other"))
    within = one.join(other.drop("main"), "bucket").where(
        (F.col("one.group") < F.col("other.group")) & _may_link("one", "other"))
    inside = placed.where(F.col("entry.group") == F.col("main")).select(
        F.col("bucket").alias("own"), F.col("entry").alias("inner"))
    facing = one.join(inside, (F.col("bucket") == F.col("own")) & _may_link("one", "inner"), "left_semi")
    return (within.select(F.col("one.class").alias("a"), F.col("other.class").alias("b")).distinct(),
            facing.select(F.col("one.class").alias("a"), F.col("main").alias("group")).distinct())


class _Chunk:
    """Some members of a group, their tokens in one order, each with its owner."""

    def __init__(self, names: list[bytes], sets: list[np.ndarray]) -> None:
        self.names, self.sizes = names, np.array([len(s) for s in sets])
        tokens, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owners = tokens[order], owners[order]

    def linked(self, tokens: np.ndarray) -> bytes | None:
        """The first member that this set is linked with."""
        low = np.searchsorted(self.tokens, tokens, "left")
        met = np.searchsorted(self.tokens, tokens, "right") - low
        at = np.repeat(low - np.append(0, np.cumsum(met)[:-1]), met) + np.arange(met.sum())
        both = np.bincount(self.owners[at], minlength=len(self.names))
        found = np.flatnonzero(100 * both >= PERCENT * (self.sizes + len(tokens) - both))
        return self.names[found[0]] if len(found) else None


def _joining(facing: DataFrame, groups: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) of classes to members of the groups they face, told on full sets: one for each part
    of a group suffices, as its members are linked already. A group's members are dealt to parts of about
    ``CHUNK`` sets, each held as one, and the classes that face the group come by one after the other."""
    facing = written(facing, "facing")
    known = groups.select(F.col("node").alias("class"), F.col("component").alias("group"))
    members = written(classes.select("class", "row", "n").join(known, "class", "left")
                      .withColumn("group", F.coalesce("group", "class"))
                      .join(facing.select("group").distinct(), "group", "left_semi"), "members")
    parts = members.groupBy("group").agg(F.ceil(F.greatest(
        F.count("*") / CHUNK, F.sum("n") / CHUNK_TOKENS)).alias("parts"))
    held = members.join(parts, "group").select(
        "group", F.pmod(F.xxhash64("class"), "parts").alias("part"), F.lit(0).alias("turn"), "class", "row")
    asking = (facing.withColumnRenamed("a", "class").join(parts, "group")
              .join(classes.select("class", "row"), "class")
              .select("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                      F.lit(1).alias("turn"), "class", "row"))
    texts = docs.select(_row().alias("row"), utf8().alias("utf8"))
    cells = (texts.join(held.unionByName(asking), "row").select("group", "part", "turn", "class", "utf8")
             .repartition("group", "part").sortWithinPartitions("group", "part", "turn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key, names, sets, chunk = None, [], [], None
        for batch in batches:
            a, b = [], []
            found = shingle_sets([t.as_py() for t in batch["utf8"]], WORDS)
            keys = zip(*(batch[c].to_pylist() for c in ("group", "part", "turn", "class")))
            for (group, part, turn, own), tokens in zip(keys, found):
                if (group, part) != key:
                    key, names, sets, chunk = (group, part), [], [], None
                if turn == 0:
                    names.append(own)
                    sets.append(tokens)
                    continue
                if chunk is None and names:
                    chunk, sets = _Chunk(names, sets), []
                other = chunk.linked(tokens) if chunk else None
                if other is not None:
                    a.append(own)
                    b.append(other)
            yield {"a": a, "b": b}

    return arrow_map(cells, run, "a binary, b binary").distinct()


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are linked. Each b and some of its a's are a cell; their texts
    go there, and one set beside that of b is held at a time."""
    pairs = written(pairs, "pairs")
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / CELL).alias("cells"))
    placed = pairs.join(sizes, "b").withColumn("cell", F.pmod(F.xxhash64("a"), "cells"))
    members = placed.select("b", "cell", F.col("a").alias("class"), F.lit(1).alias("part"))
    heads = sizes.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell"),
                         F.col("b").alias("class"), F.lit(0).alias("part"))
    wanted = members.unionByName(heads).join(classes.select("class", "row"), "class")
    texts = docs.select(_row().alias("row"), utf8().alias("utf8"))
    cells = (texts.join(wanted, "row").select("b", "cell", "part", "class", "utf8")
             .repartition("b", "cell").sortWithinPartitions("b", "cell", "part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        head, held = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            sets = shingle_sets([t.as_py() for t in batch["utf8"]], WORDS)
            keys = zip(*(batch[c].to_pylist() for c in ("b", "cell", "part", "class")))
            for (own, cell, part, other), tokens in zip(keys, sets):
                if part == 0:
                    head, held = (own, cell), tokens
                elif (own, cell) == head and linked(held, tokens, PERCENT):
                    a.append(other)
                    b.append(own)
            yield {"a": a, "b": b}

    return arrow_map(cells, run, "a binary, b binary").distinct()


def _joined(groups: DataFrame | None, pairs: DataFrame) -> DataFrame:
    """The components of groups and more links."""
    if groups is not None:
        pairs = pairs.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return components(pairs)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach, its own included) and
    kept (whether that is its own) of every document."""
    docs = docs.select("doc_id", "text")
    sets = described(docs)
    classes = written(
        sets.where("n > 0").groupBy("class")
        .agg(F.first("n").alias("n"), F.min("row").alias("row"), F.min("doc_id").alias("doc_id"),
             F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch")), "classes")
    postings, groups = _postings(classes), None
    for turn in range(TURNS):
        pairs = _nearest_heads(_apart(postings, groups), turn)
        groups = written(_joined(groups, _confirmed(pairs, classes, docs)), "groups")
    pairs, facing = _candidates(_apart(postings, groups))
    whole = _joined(groups, _confirmed(pairs, classes, docs).unionByName(
        _joining(facing, groups, classes, docs)))
    named = written(classes.select("class", "doc_id").join(
        whole.select(F.col("node").alias("class"), "component"), "class", "left")
        .withColumn("component", F.coalesce("component", "class")), "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("least"))
    of_class = named.join(least, "component").select("class", "least")
    return (sets.select("doc_id", F.col("n").alias("n_shingles"), "class").join(of_class, "class", "left")
            .select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
