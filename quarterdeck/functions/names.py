"""Names and values that must stay the same for results to be comparable."""

from __future__ import annotations

ENTITY = "entity"
Q_ORD = "q_ord"
KEY = (ENTITY, Q_ORD)
TARGET = "PredictedAppreciation"

# ---- fixed values: prefixes, fill values, index symbols -------------------------------------
QUARTER_PREFIX = "Q_Delta_"
YEAR_PREFIX = "YOY_Delta_"
VERSUS = "_vs_"
MISSING_SECTOR = "MissingSector"
MISSING_INDUSTRY = "MissingIndustry"
INDEX_SYMBOLS = ("^DJI", "VTSAX", "^IXIC", "^GSPC", "^RUT", "^NYA")
QUARTER_DAYS = 91

# ---- fixed values: facts whose change is a feature -------------------------------------------
CHANGE_COLUMNS = (
    "PriceAvg", "PriceHigh", "PriceLow", "PriceEoQ", "Ebit", "GrossProfit", "TotalRevenue",
    "ResearchDevelopment", "TotalOperatingExpenses", "IncomeBeforeTax", "IncomeTaxExpense",
    "OperatingIncome", "NetIncome", "DividendsPaid", "RepurchaseOfStock", "Depreciation",
    "IssuanceOfStock", "Cash", "CommonStock", "TotalAssets", "TotalLiab", "LongTermDebt",
    "ShortLongTermDebt", "TotalStockholderEquity", "Volume", "Earnings", "RnDtoRevenue",
    "CashToRevenue",
)
INDEX_CHANGE_COLUMNS = ("Volatility", "PriceAvg")
INDEX_COMPARED_COLUMNS = ("Q_Delta_PriceAvg", "YOY_Delta_PriceAvg", "Volatility")
PLAIN_FEATURES = ("Industry", "Ebit", "TotalStockholderEquity")
CATEGORICAL_COLUMNS = ("Sector", "Industry", "Quarter")

# ---- fixed values: statement items kept when statements are assembled ------------------------
STATEMENT_ITEMS = (
    "Cash", "CommonStock", "TotalAssets", "TotalLiab", "TotalStockholderEquity", "LongTermDebt",
    "Ebit", "GrossProfit", "TotalRevenue", "ResearchDevelopment", "TotalOperatingExpenses",
    "IncomeBeforeTax", "IncomeTaxExpense", "OperatingIncome",
    "NetIncome", "DividendsPaid", "RepurchaseOfStock", "Depreciation", "IssuanceOfStock",
    "NetBorrowings", "Investments",
)

# ---- fixed values: analyst grade -> score, any other grade scores 0 --------------------------
GRADE_SCORES = {
    "Buy": 1, "Outperform": 1, "Overweight": 1, "Sector Perform": 0, "Neutral": 0,
    "Sector Outperform": 1, "Hold": 0, "Market Perform": 0, "Strong Buy": 1, "Long-Term Buy": 1,
    "Sell": -1, "Market Outperform": 1, "Positive": 1, "Equal-Weight": 0, "Perform": 0,
    "Negative": -1, "Sector Weight": 0, "Reduce": -1, "Underweight": -1,
}

# ---- fixed values: archive column -> panel column --------------------------------------------
ARCHIVE_TO_PANEL = {
    "Assets": "TotalAssets",
    "Revenue": "TotalRevenue",
    "Liabilities": "TotalLiab",
    "LongTermDebt": "LongTermDebt",
    "ShareholdersEquity": "TotalStockholderEquity",
    "CashAtEndOfPeriod": "Cash",
    "Price": "PriceAvg",
    "PriceLow": "PriceLow",
    "PriceHigh": "PriceHigh",
    "SplitFactor": "Split",
    "SharesSplitAdjusted": "CommonStock",
    "Earnings": "Earnings",
}
