"""Declared schemas and the key check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

# Columns of the stored panel and of the archive files, in file order.
PANEL_TEXT = ("AvgRecommendations",)
PANEL_NUMBERS = (
    "PriceAvg", "PriceHigh", "PriceLow", "PriceEoQ", "Split", "Ebit", "GrossProfit",
    "TotalRevenue", "ResearchDevelopment", "TotalOperatingExpenses", "IncomeBeforeTax",
    "IncomeTaxExpense", "OperatingIncome", "NetIncome", "DividendsPaid", "RepurchaseOfStock",
    "Depreciation", "IssuanceOfStock", "NetBorrowings", "Investments", "Cash", "CommonStock",
    "TotalAssets", "TotalLiab", "LongTermDebt", "TotalStockholderEquity", "Earnings",
    "ShortLongTermDebt", "MarketCap", "DividendPerShare",
)
ARCHIVE_COLUMNS = (
    ("QuarterEnd", "date"),
    ("Shares", "long"),
    ("SharesSplitAdjusted", "long"),
    ("SplitFactor", "double"),
    ("Assets", "long"),
    ("CurrentAssets", "long"),
    ("Liabilities", "long"),
    ("CurrentLiabilities", "long"),
    ("ShareholdersEquity", "long"),
    ("NonControllingInterest", "long"),
    ("PreferredEquity", "long"),
    ("GoodwillIntangibles", "long"),
    ("LongTermDebt", "string"),
    ("Revenue", "long"),
    ("Earnings", "long"),
    ("EarningsAvailableForCommonStockholders", "long"),
    ("EPS_basic", "double"),
    ("EPS_diluted", "double"),
    ("DividendPerShare", "double"),
    ("CashFromOperatingActivities", "long"),
    ("CashFromInvestingActivities", "long"),
    ("CashFromFinancingActivities", "long"),
    ("CashChangeDuringPeriod", "long"),
    ("CashAtEndOfPeriod", "long"),
    ("CapitalExpenditures", "long"),
    ("Price", "double"),
    ("PriceHigh", "double"),
    ("PriceLow", "double"),
    ("ROE", "double"),
    ("ROA", "double"),
    ("BookValueOfEquityPerShare", "double"),
    ("P_B_ratio", "double"),
    ("P_E_ratio", "double"),
    ("CumulativeDividendsPerShare", "double"),
    ("DividendPayoutRatio", "double"),
    ("LongTermDebtToEquityRatio", "double"),
    ("EquityToAssetsRatio", "double"),
    ("NetMargin", "double"),
    ("AssetTurnover", "double"),
    ("FreeCashFlowPerShare", "double"),
    ("CurrentRatio", "double"),
)

_TYPES = {"date": DateType(), "long": LongType(), "double": DoubleType(), "string": StringType()}

ARCHIVE_SCHEMA = StructType([StructField(n, _TYPES[t]) for n, t in ARCHIVE_COLUMNS])
ARCHIVE_KEY = ("entity", "QuarterEnd")


def panel_schema(entity_type=None) -> StructType:
    """Stored panel: key, end date, facts; ``fy`` is the partition column."""
    return StructType(
        [StructField("entity", entity_type or StringType(), False),
         StructField("q_ord", IntegerType(), False), StructField("date", DateType())]
        + [StructField(c, DoubleType()) for c in PANEL_NUMBERS]
        + [StructField(c, StringType()) for c in PANEL_TEXT]
        + [StructField("Volume", LongType()), StructField("fy", IntegerType(), False)])


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; empty for a valid table."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"))
