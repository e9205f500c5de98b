"""Row filters. Bounds are plain comparisons on stored columns, so they reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.names import ENTITY, Q_ORD
from quarterdeck.functions.periods import fiscal_ordinal_value


def between_dates(df: DataFrame, start: date, end: date, column: str = "date") -> DataFrame:
    """``start <= column < end``."""
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def between_quarters(df: DataFrame, start: int, end: int) -> DataFrame:
    """``start <= q_ord < end``; a stored year column gets bounds of its own so that partitions
    are pruned."""
    keep = (F.col(Q_ORD) >= start) & (F.col(Q_ORD) < end)
    if "fy" in df.columns:
        keep &= F.col("fy").between(start // 4, (end - 1) // 4)
    return df.where(keep)


def between_quarters_of(df: DataFrame, start: date, end: date) -> DataFrame:
    """Rows from the fiscal quarter of ``start`` up to, and without, that of ``end``."""
    return between_quarters(df, fiscal_ordinal_value(start), fiscal_ordinal_value(end))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is missing."""
    return df.dropna(subset=list(columns))


def keep_columns(df: DataFrame, columns: Sequence[str], dropna: bool = True) -> DataFrame:
    """Keep the given columns and, by default, only complete rows."""
    kept = df.select(*columns)
    return kept.dropna(subset=list(columns)) if dropna else kept


def keep_known(df: DataFrame, known: Sequence[str]) -> DataFrame:
    wanted = set(known)
    return df.select(*[c for c in df.columns if c in wanted])


def nonzero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which a column is 0; a missing value is not 0 and stays."""
    keep = F.lit(True)
    for c in columns:
        keep &= (F.col(c) != 0) | F.col(c).isNull()
    return df.where(keep)


def split_symbols(df: DataFrame, symbols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of the listed symbols, all other rows)."""
    listed = F.col(ENTITY).isin(*symbols)
    return df.where(listed), df.where(~listed)


def fresh_entities(df: DataFrame, today: date, max_age_days: int = 365,
                   column: str = "date") -> DataFrame:
    """Rows of the entities whose newest date is at most ``max_age_days`` old."""
    newest = df.groupBy(ENTITY).agg(F.max(column).alias("newest"))
    fresh = newest.where(F.col("newest") >= F.date_sub(F.lit(today), max_age_days))
    return df.join(fresh, ENTITY, "left_semi")


def split_labelled(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a target, prediction candidates without the target column)."""
    return (df.where(F.col(target).isNotNull()),
            df.where(F.col(target).isNull()).drop(target))
