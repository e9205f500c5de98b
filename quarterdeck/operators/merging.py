"""Joins and set operations between sources. No side is hinted for broadcast by hope: a
dimension is broadcast only when Spark finds it below ``spark.sql.autoBroadcastJoinThreshold``,
and is otherwise sort-merge joined with adaptive skew splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.names import (
    ENTITY, KEY, MISSING_INDUSTRY, MISSING_SECTOR, STATEMENT_ITEMS,
)
from quarterdeck.functions.periods import fiscal_ordinal


def keep_one(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    ``row_number() = 1`` lets Spark cut every map task down to one row per key before the
    shuffle, so a key with very many copies costs no more than any other.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__place", F.row_number().over(w)).where("__place = 1").drop("__place")


def except_key(df: DataFrame, other: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return df.join(other.select(*key), list(key), "left_anti")


def union_by_name(*parts: DataFrame) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def fill_from_archive(primary: DataFrame, archive: DataFrame,
                      key: Sequence[str] = KEY) -> DataFrame:
    """The primary rows plus the archive rows whose key the primary source lacks.

    Both sources go through one exchange by entity, in which the primary row of a key comes
    first; later windows over the entity's quarters find their rows in place and in order, so a
    whole feature table is shuffled once. Each source has one row per key.
    """
    rows = union_by_name(primary.withColumn("__source", F.lit(0)),
                         archive.withColumn("__source", F.lit(1)))
    return keep_one(rows.repartition(ENTITY), key, [F.col("__source")]).drop("__source")


def symbol_union(known: DataFrame, requested: DataFrame) -> DataFrame:
    symbols = [df.select(F.upper(F.col(ENTITY).cast("string")).alias(ENTITY))
               for df in (known, requested)]
    return symbols[0].union(symbols[1]).distinct()


def add_dimension(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Left join the entity's sector and industry; absent ones get a name of their own."""
    info = keep_one(dimension.select(ENTITY, "Sector", "Industry"), [ENTITY],
                    [F.col("Sector"), F.col("Industry")])
    return (df.join(info, ENTITY, "left")
              .fillna({"Sector": MISSING_SECTOR, "Industry": MISSING_INDUSTRY}))


def statements_to_panel(*statements: DataFrame, items: Sequence[str] = STATEMENT_ITEMS,
                        repair: bool = False) -> DataFrame:
    """Long statements (entity, date, item, value) -> one row per entity and fiscal quarter with
    one column per wanted item; of several statements in a quarter the newest stays.

    ``repair`` first moves one of two statements that fell into the same quarter next to a gap.
    """
    wide = (union_by_name(*statements)
            .where(F.col("item").isin(*items))
            .groupBy(ENTITY, "date")
            .agg(*[F.max(F.when(F.col("item") == i, F.col("value"))).alias(i) for i in items]))
    if repair:
        labelled = repair_labels(wide, "date")
    else:
        labelled = wide.withColumn("q_ord", fiscal_ordinal(F.col("date")))
    return keep_one(labelled, KEY, [F.col("date").desc()])


def repair_labels(df: DataFrame, date_column: str = "date") -> DataFrame:
    """Fiscal quarter of each statement date, with drifted period ends put right.

    In an otherwise consecutive run two statements can fall into one quarter while a quarter
    beside them stays empty (1 3 3 4, 1 1 3 4, 2 2 3 4, 1 2 3 3). The one that borders the gap
    moves into it. At the border of the run the side without a neighbour is the gap. One error
    per neighbourhood is assumed; a pair with no gap beside it, or standing alone, is left.
    """
    raw = fiscal_ordinal(F.col(date_column))
    w = Window.partitionBy(ENTITY).orderBy(date_column)
    q = F.col("__raw")
    before, before2 = F.lag(q, 1).over(w), F.lag(q, 2).over(w)
    after, after2 = F.lead(q, 1).over(w), F.lead(q, 2).over(w)
    first_of_pair = q.eqNullSafe(after) & ~q.eqNullSafe(before)
    second_of_pair = q.eqNullSafe(before) & ~q.eqNullSafe(after)
    back = first_of_pair & ((before == q - 2) | (before.isNull() & (after2 == q + 1)))
    forward = second_of_pair & (
        ((after == q + 2) & ~before2.eqNullSafe(q - 2)) | (after.isNull() & (before2 == q - 1)))
    move = F.when(back, -1).when(forward, 1).otherwise(0)
    return df.withColumn("__raw", raw).withColumn("q_ord", q + move).drop("__raw")
