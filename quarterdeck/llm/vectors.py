"""Vectors of the embeddings table: which take part, and equal ones as one class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def usable(df: DataFrame, name: str = "embedding") -> DataFrame:
    """vec_id and vec (doubles) of the rows whose vector is not null, empty or zero and has no null,
    NaN or infinite component. Rows with a null vec_id take no part either."""
    vec = F.col(f"`{name}`").cast("array<double>")

    def good(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return (df.select("vec_id", vec.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.forall("vec", good)
                   & F.exists("vec", lambda x: x != 0)))


def least_of_each(df: DataFrame, by: str, n: int, order: str = "vec_id") -> DataFrame:
    """The n rows of least ``order`` for each ``by``, in two rounds so that one large group is
    cut down in ``SALTS`` parts first."""
    salted = df.withColumn("salt", F.pmod(F.xxhash64(order), F.lit(SALTS)))
    first = Window.partitionBy(by, "salt").orderBy(order)
    last = Window.partitionBy(by).orderBy(order)
    return (salted.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n)
            .withColumn("place", F.row_number().over(last)).where(F.col("place") <= n)
            .drop("salt", "place"))
