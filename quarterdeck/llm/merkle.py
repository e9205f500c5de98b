"""Merkle manifest of a dataset: leaves, subroots by language, one root, and a proof for each row.

``H`` is the lowercase hex SHA-256 of its inputs put together. A row's leaf is H of its doc_id, source,
lang, n_chars and text. Leaves of a language ascend by doc_id; every two nodes in a row (the last run
may be one node) become their H until one is left, the subroot. Subroots, ordered by language, give
the root in the same way.

Cogrouped subtree exchange: a tree is cut into superblocks of 2^``height`` nodes in a row.

1. Up: each superblock is reduced to its top node in one group; tops are the nodes of the next round.
   A round divides the nodes of a tree by 2^``height``, and ends when every tree has one node.
2. The subroots are the nodes of one more tree, taken up in the same way.
3. Down: the nodes of a superblock are cogrouped with the one row of outer nodes that it needs, the
   siblings of its top on the way to the root. One ``applyInPandas`` reduces the superblock again,
   joins the inner and outer parts of each proof and folds each leaf up to the root.

A task holds one superblock at a time, whatever the size of a language. The driver sees one number a
round, the size of the largest tree. Texts are hashed where they are read and do not move.

Nulls: a null field counts as ``-``; a null lang is a tree of its own, the first; rows of a null doc_id
come first in their tree and are never tampered with. Rows of one doc_id are ordered by leaf and each
is a leaf of its own. A table without rows has no root and gives no rows. Columns other than those of
documents are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import COLUMNS, only
from quarterdeck.session import written

HEIGHT = 8  # levels of a superblock
TAMPERED = 7  # rows whose crc32 of the doc_id this divides
PATH = "path array<string>"
REPORT = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def node(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def climb(hashes: list[str], n: int, height: int) -> list[list[str]]:
    """The levels of a superblock from its nodes to its top, for a tree of ``n`` nodes: a tree of
    one superblock ends at its only node, a larger one goes ``height`` levels up."""
    levels = [hashes]
    for _ in range(min(height, (n - 1).bit_length())):
        below = levels[-1]
        levels.append([node(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def siblings(levels: list[list[str]], place: int) -> list[str]:
    """What a node meets on its way up: ``L`` or ``R`` and the sibling on that side, or nothing."""
    path = []
    for level in levels[:-1]:
        beside = place ^ 1
        path.append(f"{'L' if place & 1 else 'R'}{level[beside]}" if beside < len(level) else "")
        place >>= 1
    return path


def fold_up(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for step in path:
        leaf = (node(step[1:], leaf) if step[:1] == "L" else node(leaf, step[1:]))
    return leaf


def leaf_of(changed: bool = False) -> Column:
    """The leaf of a row; ``changed``: with n_chars one larger."""
    def field(name: str) -> Column:
        value = F.col(f"`{name}`")
        if changed and name == "n_chars":
            value = value + 1
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]), 256)


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with place, counted from 0 along ``order`` in each tree, and n, the nodes of the tree.

    Rows are sorted across partitions, so a tree of any share of the rows is spread; what is counted
    in a window is one row for each partition and tree in it.
    """
    ranged = written(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                     .withColumn("at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("at", 33).alias("part")
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy(part, "tree").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
              .withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
              .withColumn("n", F.sum("rows").over(Window.partitionBy("tree"))))
    return (ranged.withColumn("part", part).join(starts, ["part", "tree"])
            .withColumn("place", F.col("at") - F.col("first") + F.col("before"))
            .drop("at", "part", "first", "rows", "before"))


def _block(height: int) -> Column:
    return F.shiftright("place", height).alias("block")


def _tops(nodes: DataFrame, height: int) -> DataFrame:
    """The top of each superblock, as nodes of the next round."""
    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        n = int(rows["n"].iloc[0])
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "n": [-(-n >> height)],
                             "hash": climb(rows["hash"].tolist(), n, height)[-1]})

    return (nodes.select("tree", "place", "n", "hash").groupBy("tree", _block(height))
            .applyInPandas(top, "tree string, place long, n long, hash string"))


def _rounds(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The nodes, the tops of their superblocks, and so on until each tree has one node."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rounds.append(written(_tops(rounds[-1], height), "tops"))
    return rounds


def _outer(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """The siblings of each node up to the root, from those of the top of its superblock."""
    def join(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        levels = climb(rows["hash"].tolist(), int(rows["n"].iloc[0]), height)
        rest = list(outer["path"].iloc[0])
        return pd.DataFrame({
            "tree": key[0], "place": rows["place"], "subroot": outer["subroot"].iloc[0],
            "root": outer["root"].iloc[0],
            "path": [siblings(levels, i) + rest for i in range(len(rows))]})

    return written(nodes.select("tree", "place", "n", "hash").groupBy("tree", _block(height))
                   .cogroup(above.groupBy("tree", F.col("place").alias("block")))
                   .applyInPandas(join, f"tree string, place long, subroot string, root string, {PATH}"),
                   "outer")


def _folded(leaves: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """The last exchange: proofs and folded roots of the leaves, superblock by superblock."""
    def finish(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        given = rows["hash"].tolist()
        levels, rest = climb(given, int(rows["n"].iloc[0]), height), list(outer["path"].iloc[0])
        paths = [siblings(levels, i) + rest for i in range(len(rows))]
        return pd.DataFrame({
            "doc_id": rows["doc_id"], "leaf": given, "subroot": outer["subroot"].iloc[0],
            "root": outer["root"].iloc[0],
            "proof_sha256": [node(*(step[1:] for step in path)) for path in paths],
            "folded_root": [fold_up(own, path) for own, path in zip(rows["claimed"], paths)]})

    return (leaves.groupBy("tree", _block(height))
            .cogroup(above.groupBy("tree", F.col("place").alias("block")))
            .applyInPandas(finish, REPORT))


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``folded_root`` is what the siblings of the dataset as it is and the leaf of the row as it is
    claimed to be give: where ``TAMPERED`` divides the crc32 of the doc_id, n_chars is claimed one larger.
    """
    docs = only(docs, *COLUMNS)
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    claimed = F.when((crc % TAMPERED == 0) & F.col("n_chars").isNotNull(), leaf_of(changed=True))
    leaves = written(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("id"), leaf_of().alias("hash"), claimed.alias("claimed")),
        "leaves")
    placed = written(
        _placed(leaves, "id", "hash").withColumn("claimed", F.coalesce("claimed", "hash"))
        .withColumn("doc_id", F.col("id").cast("string")).drop("id"), "placed")
    rounds = _rounds(placed, height)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    named = written(_placed(subroots, "name"), "subroots")
    tops = _rounds(named, height)
    above = tops[-1].select("tree", "place", F.col("hash").alias("subroot"), F.col("hash").alias("root"),
                            F.array().cast("array<string>").alias("path"))
    for nodes in reversed(tops[:-1]):
        above = _outer(nodes, above, height)
    above = above.join(named.select("place", "name", "hash"), "place").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), F.col("hash").alias("subroot"),
        "root", "path")
    for nodes in reversed(rounds[1:-1]):
        above = _outer(nodes, above, height)
    return _folded(placed, above, height).select(
        F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256",
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
