"""From stored tables to the feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.cells import mean_of_json
from quarterdeck.functions.names import (
    ARCHIVE_TO_PANEL, CHANGE_COLUMNS, ENTITY, INDEX_CHANGE_COLUMNS, INDEX_COMPARED_COLUMNS, KEY,
    PLAIN_FEATURES, Q_ORD, QUARTER_PREFIX, VERSUS, YEAR_PREFIX,
)
from quarterdeck.functions.periods import fiscal_ordinal
from quarterdeck.functions.ratios import RATIOS, Formula, add_formulas
from quarterdeck.operators.changes import add_changes, add_index_comparison, add_target
from quarterdeck.operators.filters import (
    keep_known, nonzero, require, split_labelled, split_symbols,
)
from quarterdeck.operators.merging import add_dimension, fill_from_archive, keep_one
from quarterdeck.plans.settings import Settings
from quarterdeck.sources.schemas import PANEL_NUMBERS, PANEL_TEXT

# Columns a row must have.
PRICE_COLUMNS = ("date", "PriceAvg", "PriceHigh", "PriceLow")
PANEL_REQUIRED = (*PRICE_COLUMNS, "TotalRevenue", "Earnings", "MarketCap")
ARCHIVE_REQUIRED = ("Shares", "SharesSplitAdjusted", "FreeCashFlowPerShare", "Earnings",
                    "ShareholdersEquity", "Liabilities", "Price")
PANEL_COLUMNS = (*KEY, "date", *PANEL_NUMBERS, *PANEL_TEXT, "AvgRecommendationScore", "Volume")


def prepare_primary(facts: DataFrame, symbols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(company panel, index panel) of the primary source."""
    index_rows, companies = split_symbols(facts, symbols)
    panel = nonzero(require(companies, PANEL_REQUIRED), ["TotalRevenue", "Earnings", "MarketCap"])
    score = mean_of_json(F.col("AvgRecommendations"))
    return (panel.withColumn("AvgRecommendationScore", score),
            require(index_rows, PRICE_COLUMNS))


def derive_archive(archive: DataFrame) -> DataFrame:
    """Panel facts that the archive only has indirectly."""
    return archive.withColumns({
        "q_ord": fiscal_ordinal(F.col("QuarterEnd")),
        "date": F.col("QuarterEnd").cast("date"),
        "DividendsPaid": F.col("DividendPerShare") * F.col("Shares"),
        "OperatingIncome": F.col("FreeCashFlowPerShare") * F.col("Shares"),
        "MarketCap": F.col("SharesSplitAdjusted") * F.col("Price"),
        "ShortLongTermDebt": F.lit(0.0),
        "Ebit": F.col("Revenue") - F.col("CapitalExpenditures"),
        "NetIncome": F.col("Earnings"),
        "LongTermDebt": F.col("LongTermDebt").try_cast("long"),
    })


def prepare_archive(archive: DataFrame) -> DataFrame:
    """Archive rows as panel rows; of two quarter ends in one quarter the older stays."""
    kept = nonzero(require(archive, ARCHIVE_REQUIRED), ["Revenue", "Earnings"])
    named = derive_archive(kept).withColumnsRenamed(ARCHIVE_TO_PANEL)
    return keep_one(keep_known(named, PANEL_COLUMNS), KEY, [F.col("date")])


def engineer(panel: DataFrame, columns: Sequence[str],
             formulas: Mapping[str, Formula] = RATIOS) -> DataFrame:
    """Ratio columns, then quarter and year changes."""
    return add_changes(add_formulas(panel, formulas), columns)


def feature_names(columns: Sequence[str], symbols: Sequence[str]) -> list[str]:
    """The feature columns that are present, in a fixed order."""
    changes = [f"{p}{c}" for p in (QUARTER_PREFIX, YEAR_PREFIX)
               for c in (*CHANGE_COLUMNS, *RATIOS)]
    compared = [f"{c}{VERSUS}{s}" for c in INDEX_COMPARED_COLUMNS for s in symbols]
    wanted = dict.fromkeys([*changes, *RATIOS, *compared, *PLAIN_FEATURES])
    return [c for c in wanted if c in set(columns)]


def feature_table(facts: DataFrame, archive: DataFrame, dimension: DataFrame,
                  settings: Settings = Settings()) -> DataFrame:
    """Features, ``PriceAvg`` and target of every company quarter.

    ``facts`` is the primary panel with the index symbols among its entities, ``archive`` is in
    archive form. Change, target and dividend windows share one exchange by entity.
    """
    panel, index_panel = prepare_primary(facts, settings.market_indices)
    merged = add_dimension(fill_from_archive(panel, prepare_archive(archive)), dimension)
    filled = merged.fillna({"ShortLongTermDebt": 0.0, "DividendPerShare": 0.0})
    engineered = engineer(filled, CHANGE_COLUMNS)
    index_facts = engineer(index_panel, INDEX_CHANGE_COLUMNS,
                           {"Volatility": RATIOS["Volatility"]})
    compared = add_index_comparison(engineered, index_facts, settings.market_indices,
                                    INDEX_COMPARED_COLUMNS)
    features = feature_names(compared.columns, settings.market_indices)
    kept = compared.select(ENTITY, Q_ORD, "PriceAvg", "DividendPerShare", *features)
    return add_target(kept, settings.horizon, settings.include_dividends,
                      target=settings.target).drop("DividendPerShare")


def labelled_and_candidates(features: DataFrame,
                            settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(rows to learn from, rows to predict); only candidates keep the price."""
    labelled, candidates = split_labelled(features, settings.target)
    return labelled.drop("PriceAvg"), candidates
