"""Quarterly facts from raw events, incremental loads and the first build."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.names import ENTITY, GRADE_SCORES, KEY, Q_ORD, STATEMENT_ITEMS
from quarterdeck.functions.periods import fiscal_ordinal, fiscal_year
from quarterdeck.operators.filters import fresh_entities, split_symbols
from quarterdeck.operators.merging import repair_labels, union_by_name
from quarterdeck.operators.rollups import price_rollup, splits_per_quarter
from quarterdeck.operators.splits import (
    ARCHIVE_MULTIPLIED, adjust_archive, adjust_panel, batch_split_factors)
from quarterdeck.operators.timeline import daily_events, quarters_of_events
from quarterdeck.session import fresh_path, written
from quarterdeck.sources.readers import FILE_NAME_PATTERN, read_archive
from quarterdeck.sources.schemas import ARCHIVE_KEY, duplicate_keys
from quarterdeck.sources.tables import (
    append_table, finish, merge_rows, part_of_rows, replace_in_place, replace_table, stored,
    update_column_table)


def quarterly_facts(statements: Sequence[DataFrame], dividends: DataFrame, splits: DataFrame,
                    prices: DataFrame, recommendations: DataFrame, end: date,
                    earnings: DataFrame | None = None, market_caps: DataFrame | None = None,
                    scores: Mapping[str, int] = GRADE_SCORES) -> DataFrame:
    """One row per entity and fiscal quarter from all raw sources, for all entities at once.

    All sources lie on one time axis per entity (``operators/timeline``), so entities are hashed to
    their places once, and nothing is joined. ``earnings`` is (entity, q_ord, Earnings), ``market_caps``
    (entity, MarketCap).
    """
    daily = daily_events(statements, dividends, splits, prices, recommendations, end, STATEMENT_ITEMS,
                         scores)
    for given in (earnings, market_caps):
        if given is not None:
            daily = daily.unionByName(given, allowMissingColumns=True)
    return quarters_of_events(daily, end).withColumn("fy", fiscal_year(F.col(Q_ORD)))


def index_price_history(prices: DataFrame, splits: DataFrame, start: date,
                        end: date) -> DataFrame:
    """Price rollup of index symbols with fiscal quarter and split."""
    windows = price_rollup(prices, start, end).withColumn("quarter_end", F.col("date"))
    return (splits_per_quarter(windows, splits).drop("quarter_end")
            .withColumn(Q_ORD, fiscal_ordinal(F.col("date"))))


def collect_batch(statements: Sequence[DataFrame], dividends: DataFrame, splits: DataFrame,
                  prices: DataFrame, recommendations: DataFrame, symbols: Sequence[str],
                  start: date, end: date, scores: Mapping[str, int] = GRADE_SCORES) -> DataFrame:
    """One batch of quarterly facts: companies from all raw sources, index symbols, which have
    no statements, from prices since ``start``."""
    index_prices, company_prices = split_symbols(prices, symbols)
    companies = quarterly_facts(statements, dividends, splits, company_prices, recommendations,
                                end, scores=scores)
    indices = index_price_history(index_prices, splits, start, end).withColumn(
        "fy", fiscal_year(F.col(Q_ORD)))
    return union_by_name(companies, indices)


def incremental_load(table: DataFrame, archive: DataFrame, batch: DataFrame, today: date,
                     backfill_splits: bool = True, max_age_days: int = 365,
                     ) -> tuple[DataFrame, DataFrame]:
    """(new panel, new archive) after a batch of quarterly facts.

    Entities whose newest batch row is too old are skipped. Splits found in rows new to the table
    put the older history into post-split terms, then batch rows replace or extend the table.
    """
    fresh = fresh_entities(batch, today, max_age_days)
    if backfill_splits:
        factors = batch_split_factors(fresh, table)
        table, archive = adjust_panel(table, factors), adjust_archive(archive, factors)
    return merge_rows(table, fresh), archive


def dividend_updates(dividends: DataFrame, since: date) -> DataFrame:
    """(entity, date, q_ord, DividendPerShare) of the dividends after ``since``, the highest of a day, each
    in its fiscal quarter as an entity's other dividends put it right (``repair_labels``): a drifted one
    does not replace its neighbour's."""
    daily = (dividends.where(F.col("date") > F.lit(since)).groupBy(ENTITY, "date")
             .agg(F.max("dividend").alias("DividendPerShare")))
    return repair_labels(daily, "date")


def load_dividends(dividends: DataFrame, panel_path: str, since: date) -> None:
    """Write them into the stored panel; only parts with a row they meet are replaced."""
    update_column_table(dividend_updates(dividends, since), panel_path, "DividendPerShare")


def load_tables(spark: SparkSession, panel_path: str, archive_path: str, batch: DataFrame,
                today: date, backfill_splits: bool = True) -> tuple[str, str]:
    """Run an incremental load from stored tables into new folders and return their paths; the
    old tables stay as they are, so a failed load can simply be run again."""
    panel, archive = incremental_load(stored(spark, panel_path), stored(spark, archive_path),
                                      written(batch, "batch"), today, backfill_splits)
    new_panel, new_archive = fresh_path(spark, "panel"), fresh_path(spark, "archive")
    append_table(panel, new_panel)
    append_table(archive, new_archive)
    return new_panel, new_archive


def load_in_place(spark: SparkSession, panel_path: str, archive_path: str, batch: DataFrame,
                  today: date, backfill_splits: bool = True, max_age_days: int = 365) -> None:
    """The same load into the stored tables as they are. Of the panel only the parts are replaced that
    the batch lies in or whose history a split puts into other terms, of the archive only those of
    entities with a split: without one it is not written. Both tables change or, after a failure, still
    do at the next load, before anything else."""
    finish(spark, panel_path)
    fresh = written(fresh_entities(batch, today, max_age_days)
                    .withColumn("fy", fiscal_year(F.col(Q_ORD))), "fresh")
    if fresh.isEmpty():
        return
    if not duplicate_keys(fresh, KEY).isEmpty():
        raise ValueError(f"a key of {list(KEY)} is in the batch more than once")
    place = fresh.select(ENTITY, "fy")
    changed = []
    if backfill_splits:
        factors = written(batch_split_factors(fresh, part_of_rows(place, panel_path)), "factors")
        split = stored(spark, panel_path).select(ENTITY, Q_ORD, "fy").join(factors, ENTITY)
        place = place.unionByName(split.where(F.col(Q_ORD) < F.col("split_quarter")).select(ENTITY, "fy"))
        panel = adjust_panel(part_of_rows(place, panel_path), factors)
        if not factors.isEmpty():
            old = stored(spark, archive_path).select(ENTITY, "fy").join(factors, ENTITY, "left_semi")
            changed.append((adjust_archive(part_of_rows(old, archive_path), factors), archive_path))
    else:
        panel = part_of_rows(place, panel_path)
    replace_in_place(panel_path, [(merge_rows(panel, fresh), panel_path), *changed])


def build_archive(spark: SparkSession, csv_folder: str, path: str,
                  entity_pattern: str = FILE_NAME_PATTERN) -> DataFrame:
    """First build of the archive table from its CSV files, partitioned by fiscal year. Built again
    it is the same; a key that occurs twice ends the build before the table is touched. What a later
    split multiplies is stored as a double, which also holds fractions."""
    rows = read_archive(spark, csv_folder, entity_pattern=entity_pattern)
    rows = rows.withColumns({c: F.col(c).cast("double") for c in ARCHIVE_MULTIPLIED})
    rows = written(rows.withColumn("fy", fiscal_year(fiscal_ordinal(F.col("QuarterEnd")))),
                   "archive")
    twice = duplicate_keys(rows, ARCHIVE_KEY).first()
    if twice is not None:
        raise ValueError(f"{twice.asDict()}: more than one row of a key of {list(ARCHIVE_KEY)}")
    replace_table(rows, path)
    return stored(spark, path)
