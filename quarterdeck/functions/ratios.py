"""Ratio columns. A formula is a name and a SQL expression (or a function that returns a Column),
so that user formulas stay inside generated code; a missing operand or a zero divisor gives
null."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Formula = str | Callable[[], Column]


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def ratio(top: str, bottom: str) -> str:
    """SQL text of ``top / bottom`` in doubles."""
    return f"try_divide(CAST({top} AS DOUBLE), CAST({bottom} AS DOUBLE))"


# The ten standard ratios by name.
RATIOS: dict[str, Formula] = {
    "Volatility": ratio("PriceHigh - PriceLow", "PriceAvg"),
    "AssetsToLiabilitiesRatio": ratio("TotalAssets", "TotalLiab"),
    "AvgPriceToEarningsRatio": ratio("PriceAvg", "Earnings"),
    "DebtToEquityRatio": ratio("LongTermDebt + ShortLongTermDebt", "TotalStockholderEquity"),
    "ReturnOnEquity": ratio("Earnings - DividendsPaid", "TotalStockholderEquity"),
    "PriceToBookRatio": ratio("TotalAssets - TotalLiab", "MarketCap"),
    "ProfitMargin": ratio("NetIncome", "TotalRevenue"),
    "RnDtoRevenue": ratio("ResearchDevelopment", "TotalRevenue"),
    "CashToRevenue": ratio("Cash", "TotalRevenue"),
    "ExpensesToRevenue": ratio("TotalOperatingExpenses", "TotalRevenue"),
}


def add_formulas(df: DataFrame, formulas: Mapping[str, Formula] = RATIOS) -> DataFrame:
    columns = {name: F.expr(f) if isinstance(f, str) else f() for name, f in formulas.items()}
    return df.withColumns(columns)
