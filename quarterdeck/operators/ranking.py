"""Top rows and how cash is shared among them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.names import ENTITY, Q_ORD

SALTS = (256, 16)  # sub-groups of a quarter, round by round


def top_n(df: DataFrame, n: int, score: str) -> DataFrame:
    """The ``n`` best rows of all, ties by entity."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(ENTITY)).limit(n)


def top_n_per_quarter(df: DataFrame, n: int, score: str) -> DataFrame:
    """The ``n`` best scored rows of every quarter with their rank.

    All entities of a quarter form one group, so no task may receive it whole: rounds over fewer and
    fewer salted sub-groups cut it down first, whatever n is.
    """
    rows = df.where(F.col(score).isNotNull())
    order = [F.col(score).desc(), F.col(ENTITY)]
    for salts in SALTS:
        salt = F.pmod(F.xxhash64(ENTITY), F.lit(salts))
        rows = (rows.withColumn("rank", F.row_number().over(
            Window.partitionBy(Q_ORD, salt).orderBy(*order))).where(F.col("rank") <= n))
    ranked = rows.withColumn("rank", F.row_number().over(
        Window.partitionBy(Q_ORD).orderBy(*order)))
    return ranked.where(F.col("rank") <= n)


def _equal(rank: Column, n: Column) -> Column:
    return F.lit(1.0) / n


def _term(k: Column) -> Column:
    """The k-th Fibonacci number, folded up from 0 and 1 for any k."""
    return F.aggregate(
        F.sequence(F.lit(1).cast("long"), k.cast("long")),
        F.struct(F.lit(0.0).alias("now"), F.lit(1.0).alias("next")),
        lambda pair, _: F.struct(pair["next"].alias("now"),
                                 (pair["now"] + pair["next"]).alias("next")),
        lambda pair: pair["now"])


def _fibonacci(rank: Column, n: Column) -> Column:
    return _term(n - rank + 1) / (_term(n + 2) - 1)  # the first n terms add up to this


ALLOCATIONS: dict[str, Callable[[Column, Column], Column]] = {
    "equal": _equal,
    "fibonacci": _fibonacci,
}


def add_weights(picks: DataFrame, allocation: str = "equal") -> DataFrame:
    """Share of a quarter's cash for each of its ranked picks, however many they are; the best
    pick of the Fibonacci scheme gets the largest term."""
    if allocation.lower() not in ALLOCATIONS:
        raise ValueError(f"unknown allocation {allocation!r}")
    count = F.count(F.lit(1)).over(Window.partitionBy(Q_ORD))
    share = ALLOCATIONS[allocation.lower()](F.col("rank"), F.col("__n"))
    return picks.withColumn("__n", count).withColumn("weight", share).drop("__n")
