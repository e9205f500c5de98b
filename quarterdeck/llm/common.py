"""Shared small parts: the document columns, Arrow maps and the registry of this package's queries."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = [field.split()[0] for field in DOCUMENT.split(", ")]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Python workers learn where this package lies, for a session that was
    started elsewhere; on a cluster it is installed or sent with the job."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, by exact name; others, whatever they are called, are left behind."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def utf8(column: str = "text") -> Column:
    """The text as UTF-8 bytes, a null text as no bytes."""
    return F.coalesce(F.col(f"`{column}`"), F.lit("")).cast("binary")


def fold(doc_id: str, folds: int) -> Column:
    """The fold of a document: crc32 of its id written as text, modulo ``folds``."""
    return F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % folds


#: How each module lets go of what it keeps in a process from task to task.
STORES: dict[str, Callable[[], None]] = {}


def let_go(but: str) -> None:
    """A process that starts on another module's work frees what earlier work has left in it, and Arrow
    gives back what it keeps for later batches."""
    for module, forget in STORES.items():
        if module != but:
            forget()
    pa.default_memory_pool().release_unused()


def arrow_map(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
              schema: str) -> DataFrame:
    """``df.mapInArrow`` for a function that yields column dictionaries."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(rows.__module__)
        for columns in rows(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def with_columns(df: DataFrame, added: str) -> StructType:
    """The schema of ``df`` followed by these columns."""
    return StructType([*df.schema.fields, *StructType.fromDDL(added).fields])
