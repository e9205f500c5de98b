"""Corrections of stored history when a stock split arrives; all entities in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.names import ENTITY, KEY, Q_ORD
from quarterdeck.operators.merging import except_key

# What a split divides and multiplies, in the panel and in the archive.
PANEL_DIVIDED = ("PriceAvg", "PriceHigh", "PriceLow", "PriceEoQ", "DividendPerShare")
PANEL_MULTIPLIED = ("IssuanceOfStock", "RepurchaseOfStock", "CommonStock")
ARCHIVE_DIVIDED = ("Price", "PriceHigh", "PriceLow", "DividendPerShare")
ARCHIVE_MULTIPLIED = ("SharesSplitAdjusted", "SplitFactor")


def batch_split_factors(batch: DataFrame, table: DataFrame) -> DataFrame:
    """(entity, factor, split_quarter) over the batch rows that are new to the table: product of
    their splits and the earliest quarter with one. Factors of 1 change nothing and are left
    out."""
    new = except_key(batch, table, KEY).where(F.col("Split").isNotNull())
    return (new.groupBy(ENTITY)
            .agg(F.product("Split").alias("factor"), F.min(Q_ORD).alias("split_quarter"))
            .where(F.col("factor") != 1))


def _apply(df: DataFrame, factor, divided: Sequence[str], multiplied: Sequence[str]):
    changes = {c: F.col(c) / factor for c in divided if c in df.columns}
    changes.update({c: F.col(c) * factor for c in multiplied if c in df.columns})
    return df.withColumns(changes)


def adjust_panel(panel: DataFrame, factors: DataFrame) -> DataFrame:
    """Rows strictly before the split's quarter are put into post-split terms."""
    factor = F.when(F.col(Q_ORD) < F.col("split_quarter"), F.col("factor")).otherwise(1.0)
    joined = panel.join(factors, ENTITY, "left")
    return _apply(joined, factor, PANEL_DIVIDED, PANEL_MULTIPLIED).select(*panel.columns)


def adjust_archive(archive: DataFrame, factors: DataFrame) -> DataFrame:
    """Every archive row of the entity is put into post-split terms."""
    joined = archive.join(factors.select(ENTITY, "factor"), ENTITY, "left")
    factor = F.coalesce(F.col("factor"), F.lit(1.0))
    return _apply(joined, factor, ARCHIVE_DIVIDED, ARCHIVE_MULTIPLIED).select(*archive.columns)


def adjust_by_later_splits(panel: DataFrame, split: str = "Split") -> DataFrame:
    """Each row by the product of all splits in later quarters of its entity."""
    later = (Window.partitionBy(ENTITY).orderBy(F.col(Q_ORD).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    factor = F.coalesce(F.product(F.coalesce(F.col(split), F.lit(1.0))).over(later), F.lit(1.0))
    with_factor = panel.withColumn("SplitFactor", factor)
    return _apply(with_factor, F.col("SplitFactor"), PANEL_DIVIDED, PANEL_MULTIPLIED)
