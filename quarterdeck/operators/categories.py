"""Categories of text columns as tables: numbers in sorted order, mean targets, sparse 0/1 vectors.

A table has one row for each column and value, so a column may have any number of values: they are
found, numbered and joined by Spark, and only one row per column reaches the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quarterdeck.functions.ratios import quoted
from quarterdeck.session import written

CODES, MEANS, SLOTS = "codes", "means", "slots"
SLOT_VECTOR = "__slots"
#: Rows of the overall mean that are added to each category, so that a rare one is not its own target.
PRIOR_ROWS = 10
_VECTOR = StructType([StructField("v", VectorUDT())])
_VECTOR_PARTS = "v struct<type: byte, size: int, indices: array<int>, values: array<double>>"


def code_name(column: str) -> str:
    return f"__code_{column}"


def unpivoted(df: DataFrame, columns: Sequence[str], *kept: str) -> DataFrame:
    """(column, value) of all these columns, in one reading, with the columns ``kept`` beside them."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value"))
                      for c in columns])
    return df.select(*[F.col(quoted(c)) for c in kept], F.inline(pairs))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value): the distinct values of each column, a missing one included."""
    return unpivoted(df, columns).distinct()


def sorted_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): the values of each column, numbered from 0 in sorted order, a missing
    one not among them. All columns take one aggregation and one range partitioning, which is written
    down, because one that is computed again after a lost executor may cut elsewhere."""
    values = unpivoted(df, columns).where("value IS NOT NULL").distinct()
    ranged = written(values.repartitionByRange("column", "value")
                     .withColumn("part", F.spark_partition_id()), "values")
    before = (Window.partitionBy("column").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (ranged.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n"))
               .select("column", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    place = F.row_number().over(Window.partitionBy("part", "column").orderBy("value"))
    return (ranged.join(F.broadcast(offsets), ["column", "part"])
            .select("column", "value", (F.col("offset") + place - 1).cast("int").alias("code")))


def mean_targets(df: DataFrame, columns: Sequence[str], target: str,
                 prior_rows: float = PRIOR_ROWS) -> DataFrame:
    """(column, value, number): the mean target of the rows of each value, a missing one included,
    drawn to the mean of all rows as if ``prior_rows`` more rows had it. A tree that cuts this number cuts
    the categories in the order of their means, the best order for a squared error."""
    sums = unpivoted(df, columns, target).groupBy("column", "value").agg(
        F.sum(quoted(target)).alias("sum"), F.count(quoted(target)).alias("n"))
    whole = sums.groupBy("column").agg((F.sum("sum") / F.sum("n")).alias("prior"))
    number = (F.col("sum") + prior_rows * F.col("prior")) / (F.col("n") + prior_rows)
    return sums.join(F.broadcast(whole), "column").select("column", "value", number.alias("number"))


def joined(df: DataFrame, table: DataFrame, columns: Sequence[str], number: str, default: Column,
           ) -> DataFrame:
    """``df`` with ``code_name(c)`` for each column: its value's ``number`` in the table, or the default.
    Each table part is joined by value; whether it is broadcast is left to Spark's size check."""
    for c in columns:
        own = table.where(F.col("column") == c).select(
            F.col("value").alias("__value"), F.col(number).cast("double").alias("__number"))
        df = (df.join(own, F.col(quoted(c)).cast("string").eqNullSafe(F.col("__value")), "left")
              .withColumn(code_name(c), F.coalesce("__number", default)).drop("__value", "__number"))
    return df


def sparse_vector(size: Column, indices: Column) -> Column:
    """A vector of 1.0 at these ascending places, made without leaving the JVM."""
    ones = F.transform(indices, lambda _: F.lit(1.0))
    parts = F.struct(F.lit(0).cast("byte").alias("type"), size.cast("int").alias("size"),
                     indices.alias("indices"), ones.alias("values"))
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), _VECTOR)["v"]


def places(vector: str) -> Column:
    """The ascending places of a sparse vector's entries."""
    return F.from_json(F.to_json(F.struct(F.col(vector).alias("v"))), _VECTOR_PARTS)["v"]["indices"]


@dataclass
class Encoder:
    """How the text columns of a frame become numbers, as learnt from training rows.

    ``codes``: the place in sorted order, -1 for a missing or new value. ``means``: the mean target, that of
    all rows for a new value. ``slots``: one sparse vector of all columns, with a place for a missing value
    (if there was one) and for each value but the first; a new value has none.
    """

    kind: str
    columns: list[str]
    table: DataFrame | None = None
    default: float = -1.0
    missing: dict[str, bool] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def inputs(self) -> list[str]:
        if not self.columns:
            return []
        return [SLOT_VECTOR] if self.kind == SLOTS else [code_name(c) for c in self.columns]

    def first_slots(self) -> tuple[dict[str, int], int]:
        """The first place of each column and the number of all places."""
        at, first = 0, {}
        for c in self.columns:
            first[c] = at
            at += self.missing[c] + max(0, self.counts[c] - 1)
        return first, at

    def slots(self) -> DataFrame:
        """(slot, column, value) of the vector; a null value is the missing one."""
        spark = self.table.sparkSession
        first, _ = self.first_slots()
        of = spark.createDataFrame([(c, first[c], self.missing[c]) for c in self.columns],
                                   "column string, first int, missing boolean")
        known = self.table.where("code > 0").join(F.broadcast(of), "column").select(
            (F.col("first") + F.col("missing").cast("int") + F.col("code") - 1).alias("slot"),
            "column", "value")
        return known.unionByName(of.where("missing").select(
            F.col("first").alias("slot"), "column", F.lit(None).cast("string").alias("value")))

    def names(self) -> list[str]:
        """A name for each number of the inputs; as many reach the driver as the model has weights."""
        if not self.columns or self.kind != SLOTS:
            return self.inputs
        rows = self.slots().orderBy("slot").collect()
        return [f"{r['column']}_{'nan' if r['value'] is None else r['value']}" for r in rows]

    def add(self, df: DataFrame) -> DataFrame:
        """The frame with the inputs."""
        if not self.columns:
            return df
        if self.kind != SLOTS:
            number = "code" if self.kind == CODES else "number"
            return joined(df, self.table, self.columns, number, F.lit(self.default))
        df = joined(df, self.table, self.columns, "code", F.lit(-1.0))
        first, size = self.first_slots()
        slot = [F.when(F.col(quoted(c)).isNull(), F.lit(first[c] if self.missing[c] else None))
                .when(F.col(quoted(code_name(c))) > 0,
                      F.col(quoted(code_name(c))).cast("int") + (first[c] + self.missing[c] - 1))
                for c in self.columns]
        vector = sparse_vector(F.lit(size), F.array_compact(F.array(*[s.cast("int") for s in slot])))
        return df.withColumn(SLOT_VECTOR, vector).drop(*map(code_name, self.columns))

    def save(self, path: str) -> None:
        meta = json.dumps({"kind": self.kind, "columns": self.columns, "default": self.default,
                           "missing": self.missing, "counts": self.counts})
        spark = SparkSession.active()
        if self.columns:
            self.table.write.mode("overwrite").parquet(f"{path}/table")
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(
            f"{path}/meta")


def load_encoder(spark: SparkSession, path: str) -> Encoder:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return Encoder(table=spark.read.parquet(f"{path}/table") if meta["columns"] else None, **meta)


def fit_encoder(df: DataFrame, columns: Sequence[str], kind: str, target: str = "") -> Encoder:
    """Learn the tables of these columns; they are written down once."""
    columns = list(columns)
    if not columns:
        return Encoder(kind, [])
    if kind == MEANS:
        prior = df.agg(F.avg(quoted(target))).first()[0]
        return Encoder(kind, columns, written(mean_targets(df, columns, target), "means"), prior or 0.0)
    table = written(sorted_codes(df, columns), "codes")
    found = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
    missing = {}
    if kind == SLOTS:
        empty = df.agg(*[F.max(F.col(quoted(c)).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
        missing = dict(zip(columns, map(bool, empty.first())))
    return Encoder(kind, columns, table, -1.0, missing, {c: found.get(c, 0) for c in columns})


def one_hot_vectors(df: DataFrame, columns: Sequence[str], output: str = "categories",
                    ) -> tuple[DataFrame, DataFrame]:
    """(``df`` with one sparse 0/1 vector in place of these columns, (slot, column, value) of its places)."""
    encoder = fit_encoder(df, columns, SLOTS)
    return (encoder.add(df).withColumnRenamed(SLOT_VECTOR, output).drop(*columns), encoder.slots())
