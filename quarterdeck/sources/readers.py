"""Readers for stored tables, archive files and the entity dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarterdeck.functions.cells import entity_from_path
from quarterdeck.session import written
from quarterdeck.sources.schemas import ARCHIVE_SCHEMA

FILE_NAME_PATTERN = r"_([^_/]+)\.csv$"
SPARE = 64


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def entities(df: DataFrame) -> DataFrame:
    return df.select("entity").distinct()


def read_archive(spark: SparkSession, folder: str, schema: StructType = ARCHIVE_SCHEMA,
                 entity_pattern: str = FILE_NAME_PATTERN, missing: str = "None") -> DataFrame:
    """All CSV files below a folder. The first, unnamed column is a row number and is dropped; the
    entity is part of the path; ``missing`` stands for no value.

    Each file's columns are found by the names in its header, whatever their order; the lines are read
    once and written to few files, where the headers, one row a file, are joined to the rows by path. No cell is lost: a whole number may be written as
    ``5.0`` or ``1e9``; any other cell that does not fit its column's type, a file that lacks a
    column or a header, and one whose name does not hold an entity, end the read. Columns that
    ``schema`` does not name are left out; up to ``SPARE`` of them are read over.
    """
    places = [f"_c{i}" for i in range(len(schema) + 1 + SPARE)]
    lines = (spark.read.schema(StructType([StructField(c, StringType()) for c in places]))
             .option("nullValue", missing).option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").csv(folder)
             # The path is URL-encoded, in which a plus sign stands for itself.
             .select(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"),
                                            F.lit("%2B"))).alias("path"),
                     F.col("_c0").alias("row"), F.array(*places[1:]).alias("cells")))
    is_header = F.col("row").try_cast("long").isNull() & F.coalesce(
        F.array_contains("cells", schema.fields[0].name), F.lit(False))
    # Cells behind the last one are null, as those behind the end of an array are.
    width = F.coalesce(F.array_max(F.transform("cells", lambda c, i: F.when(c.isNotNull(), i + 1))), F.lit(0))
    lines = written(lines.select("path", is_header.alias("is_header"), F.slice(
        "cells", F.lit(1), width).alias("cells")).hint("rebalance"), "lines")
    # Where each column lies is looked up once a file, not in each row.
    headers = lines.where("is_header").select("path", F.array(
        *[F.array_position("cells", f.name).cast("int") for f in schema.fields]).alias("at"))
    rows = lines.where("NOT is_header").join(headers, "path", "left")
    found = rows.select("path", *[_named(f.name, i).alias(f.name) for i, f in enumerate(schema.fields)])
    entity = entity_from_path(F.col("path"), entity_pattern)
    named = F.when(entity != "", entity).otherwise(
        F.raise_error(F.concat(F.lit("no entity in the file name "), F.col("path"))))
    return found.select(named.alias("entity"),
                        *[_cell(f.name, f.dataType.simpleString()).alias(f.name)
                          for f in schema.fields])


def _named(name: str, number: int) -> Column:
    """The cell below this name of the file's header, the ``number``-th column asked for."""
    at = F.get("at", F.lit(number))
    absent = F.raise_error(F.concat(F.lit(f"no column {name} in "), F.col("path")))
    return F.when(at > 0, F.get("cells", at - 1)).otherwise(absent)


def _cell(name: str, kind: str) -> Column:
    """The text as its type; a whole number also in a notation with a point or an exponent."""
    text = F.trim(F.col(name))
    value = text.try_cast(kind)
    if kind in ("bigint", "int"):
        number = text.try_cast("decimal(38,10)")
        number = F.coalesce(number, text.try_cast("double").try_cast("decimal(38,10)"))
        value = F.when(number == F.floor(number), number.try_cast(kind))
    wrong = F.raise_error(F.concat(F.lit(f"{name} is not a {kind}: "), text))
    return F.when(F.col(name).isNull(), None).otherwise(F.coalesce(value, wrong))


# Dimension file columns.
DIMENSION_NAMES = {"tickerSymbol": "entity", "sector": "Sector", "industry": "Industry"}


def read_dimension(spark: SparkSession, path: str,
                   names: Mapping[str, str] = DIMENSION_NAMES) -> DataFrame:
    return (spark.read.option("header", True).csv(path)
            .select(*[F.col(old).alias(new) for old, new in names.items()]))
