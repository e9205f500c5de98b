"""The same views in SQL, and a helper that puts the needed ones in front of a query."""

from __future__ import annotations

import re


def fiscal(day: str, shift: int = 7) -> str:
    moved = (f"(CASE WHEN day({day}) > 24 THEN {day} + INTERVAL {shift} DAY ELSE {day} END)"
             if shift else day)
    start = f"({moved} - INTERVAL 1 MONTH)"
    return f"CAST(year({start}) * 4 + quarter({start}) - 1 AS INTEGER)"


VIEWS = {
    "facts_sums": f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS entity, {fiscal('l_shipdate')} AS q_ord,
               count(*) AS n, max(CAST(l_shipdate AS DATE)) AS date, sum(l_quantity) AS qty,
               max(l_extendedprice) AS hi, min(l_extendedprice) AS lo,
               round(sum(l_extendedprice), 2) AS s_p,
               round(sum(l_extendedprice * l_discount), 4) AS s_pd,
               round(sum(l_extendedprice * l_tax), 4) AS s_pt,
               round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_tax END), 4) AS s_rt,
               round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS s_rp,
               round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END), 2) AS s_ap,
               round(sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END), 2) AS s_np,
               round(coalesce(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END), 0), 2) AS s_f
        FROM lineitem GROUP BY 1, 2""",
    "facts": """
        SELECT entity, q_ord, date, s_p / n AS "PriceAvg", hi AS "PriceHigh", lo AS "PriceLow",
               (hi + lo) / 2 AS "PriceEoQ", s_p - s_pt AS "Ebit", s_f - s_pd AS "GrossProfit",
               s_p - s_pd AS "TotalRevenue", s_rt AS "ResearchDevelopment",
               s_pt AS "TotalOperatingExpenses", s_p - s_pd - s_pt AS "IncomeBeforeTax",
               s_pt * 0.5::DOUBLE AS "IncomeTaxExpense", s_p - s_pd - s_pt AS "OperatingIncome",
               s_p - s_pd - s_pt * 1.5::DOUBLE AS "NetIncome", s_pd AS "DividendsPaid",
               s_rp AS "RepurchaseOfStock", s_np AS "Depreciation", s_ap AS "IssuanceOfStock",
               s_pt AS "NetBorrowings", s_pd - s_pt AS "Investments", s_f AS "Cash",
               qty * 10 AS "CommonStock", s_p AS "TotalAssets", s_pd + s_pt AS "TotalLiab",
               s_pt AS "LongTermDebt", s_rt AS "ShortLongTermDebt",
               s_p - s_pd - s_pt AS "TotalStockholderEquity", CAST(qty AS BIGINT) AS "Volume",
               s_f * 2 - s_p AS "Earnings", hi * qty AS "MarketCap",
               s_pd / qty AS "DividendPerShare",
               CASE WHEN n % 3 <> 0 THEN '{"a": ' || n || ', "b": 1}' END AS "AvgRecommendations"
        FROM facts_sums""",
    "gappy": """
        SELECT * REPLACE (CASE WHEN "PriceHigh" <= 103000 THEN "PriceAvg" END AS "PriceAvg")
        FROM facts WHERE "PriceLow" < 10000""",
    "market": f"""
        SELECT '^DJI' AS entity, {fiscal('l_shipdate')} AS q_ord,
               max(CAST(l_shipdate AS DATE)) AS date,
               round(sum(l_extendedprice), 2) / count(*) AS "PriceAvg",
               max(l_extendedprice) AS "PriceHigh", min(l_extendedprice) AS "PriceLow"
        FROM lineitem GROUP BY 1, 2""",
    "region_indices": f"""
        SELECT r_name AS entity, {fiscal('l_shipdate')} AS q_ord,
               max(CAST(l_shipdate AS DATE)) AS date,
               round(sum(l_extendedprice), 2) / count(*) AS "PriceAvg",
               max(l_extendedprice) AS "PriceHigh", min(l_extendedprice) AS "PriceLow"
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2""",
    "dimension": """
        SELECT CAST(s_suppkey AS VARCHAR) AS entity, r_name AS "Sector", n_name AS "Industry"
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal >= 0""",
    "archive_sums": """
        SELECT CAST(l_suppkey AS VARCHAR) AS entity,
               (year(l_shipdate) * 12 + month(l_shipdate) - 1) // 2 AS m,
               max(CAST(l_shipdate AS DATE)) AS "QuarterEnd", count(*) AS n,
               sum(l_quantity) AS qty, max(l_extendedprice) AS hi, min(l_extendedprice) AS lo,
               round(sum(l_extendedprice), 2) AS s_p,
               round(sum(l_extendedprice * l_tax), 4) AS s_pt,
               round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS s_rp,
               round(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END), 2) AS s_f
        FROM lineitem WHERE l_shipdate < DATE '2000-01-01' GROUP BY 1, 2""",
    "archive": """
        SELECT entity, "QuarterEnd", CAST(qty AS BIGINT) AS "Shares",
               CAST(qty * 2 AS BIGINT) AS "SharesSplitAdjusted", 2.0::DOUBLE AS "SplitFactor",
               CAST(floor(s_p) AS BIGINT) AS "Assets", CAST(floor(s_pt) AS BIGINT) AS "Liabilities",
               CAST(floor(s_p - s_pt) AS BIGINT) AS "ShareholdersEquity",
               CASE WHEN n = 1 THEN 'unknown' ELSE CAST(n AS VARCHAR) END AS "LongTermDebt",
               CAST(floor(s_rp) AS BIGINT) AS "Revenue", CAST(floor(s_f) AS BIGINT) AS "Earnings",
               s_pt / qty AS "DividendPerShare", CAST(floor(s_f) AS BIGINT) AS "CashAtEndOfPeriod",
               CAST(floor(s_pt) AS BIGINT) AS "CapitalExpenditures", s_p / n AS "Price",
               hi AS "PriceHigh", lo AS "PriceLow", s_f / qty AS "FreeCashFlowPerShare"
        FROM archive_sums""",
    "prices": """
        SELECT CAST(o_custkey AS VARCHAR) AS entity, CAST(o_orderdate AS DATE) AS date,
               max(o_totalprice) AS close, count(*) AS volume FROM orders GROUP BY 1, 2""",
    "supplier_prices": """
        SELECT CAST(l_suppkey AS VARCHAR) AS entity, CAST(l_shipdate AS DATE) AS date,
               max(l_extendedprice) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM lineitem GROUP BY 1, 2""",
    "market_prices": """
        SELECT '^DJI' AS entity, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS close,
               CAST(sum(l_quantity) AS BIGINT) AS volume FROM lineitem GROUP BY 1, 2""",
    "dividends": """
        SELECT CAST(l_suppkey AS VARCHAR) AS entity, CAST(l_shipdate AS DATE) AS date,
               l_discount AS dividend
        FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1""",
    "splits": """
        SELECT CAST(l_suppkey AS VARCHAR) AS entity, CAST(l_shipdate AS DATE) AS date,
               2.0::DOUBLE AS split
        FROM lineitem WHERE l_quantity = 50 AND l_discount >= 0.0999""",
    "quarter_ends": f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS entity, {fiscal('l_shipdate')} AS q_ord,
               max(CAST(l_shipdate AS DATE)) AS quarter_end FROM lineitem GROUP BY 1, 2""",
    "recommendations": """
        SELECT CAST(c_nationkey AS VARCHAR) AS entity, CAST(o_orderdate AS DATE) AS date,
               c_mktsegment || ' & CO' AS firm, o_orderpriority AS grade
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "supplier_ratings": """
        SELECT CAST(l_suppkey AS VARCHAR) AS entity, CAST(o_orderdate AS DATE) AS date,
               'Desk ' || l_linenumber || ' & CO' AS firm, o_orderpriority AS grade
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}


def with_views(body: str, **local: str) -> str:
    """``WITH`` the views that the body, or a view it uses, names. ``local`` adds views of the
    query's own."""
    views = {**VIEWS, **local}
    order: list[str] = []

    def need(sql: str):
        for name, text in views.items():
            if name not in order and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql, re.I):
                need(text)
                if name not in order:
                    order.append(name)

    need(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in order) + "\n" + body
