"""Panel-shaped views of the given tables.

Sums of money are rounded to the decimals they exactly have, so that the same number comes out
whatever order the rows were added in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarterdeck.functions.periods import fiscal_ordinal
from quarterdeck.session import spread

MARKET = "^DJI"
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as companies: one row per supplier and fiscal quarter of shipping."""
    flagged = "round(sum(CASE WHEN l_returnflag = '{}' THEN {} END), {})"
    price, taxed = "l_extendedprice", "l_extendedprice * l_tax"
    sums = (table(spark, sf_dir, "lineitem")
            .groupBy("l_suppkey", fiscal_ordinal(F.col("l_shipdate")).alias("q_ord"))
            .agg(*map(F.expr, (
                "count(*) AS n", "max(CAST(l_shipdate AS DATE)) AS date",
                "sum(l_quantity) AS qty", "max(l_extendedprice) AS hi",
                "min(l_extendedprice) AS lo", "round(sum(l_extendedprice), 2) AS s_p",
                "round(sum(l_extendedprice * l_discount), 4) AS s_pd",
                f"round(sum({taxed}), 4) AS s_pt",
                f"{flagged.format('R', taxed, 4)} AS s_rt",
                f"{flagged.format('R', price, 2)} AS s_rp",
                f"{flagged.format('A', price, 2)} AS s_ap",
                f"{flagged.format('N', price, 2)} AS s_np",
                "round(coalesce(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END), 0D),"
                " 2) AS s_f"))))
    return sums.selectExpr(
        "CAST(l_suppkey AS STRING) AS entity", "q_ord", "date", "s_p / n AS PriceAvg",
        "hi AS PriceHigh", "lo AS PriceLow", "(hi + lo) / 2 AS PriceEoQ", "s_p - s_pt AS Ebit",
        "s_f - s_pd AS GrossProfit", "s_p - s_pd AS TotalRevenue",
        "s_rt AS ResearchDevelopment", "s_pt AS TotalOperatingExpenses",
        "s_p - s_pd - s_pt AS IncomeBeforeTax", "s_pt * 0.5D AS IncomeTaxExpense",
        "s_p - s_pd - s_pt AS OperatingIncome", "s_p - s_pd - s_pt * 1.5D AS NetIncome",
        "s_pd AS DividendsPaid", "s_rp AS RepurchaseOfStock", "s_np AS Depreciation",
        "s_ap AS IssuanceOfStock", "s_pt AS NetBorrowings", "s_pd - s_pt AS Investments",
        "s_f AS Cash", "qty * 10 AS CommonStock", "s_p AS TotalAssets",
        "s_pd + s_pt AS TotalLiab", "s_pt AS LongTermDebt", "s_rt AS ShortLongTermDebt",
        "s_p - s_pd - s_pt AS TotalStockholderEquity", "CAST(qty AS BIGINT) AS Volume",
        "s_f * 2 - s_p AS Earnings", "hi * qty AS MarketCap", "s_pd / qty AS DividendPerShare",
        """CASE WHEN n % 3 <> 0 THEN concat('{"a": ', n, ', "b": 1}') END
            AS AvgRecommendations""")


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts without the quarters in which nothing cheap was shipped, and without a mean price
    where something dear was."""
    price = F.when(F.col("PriceHigh") <= 103000, F.col("PriceAvg"))
    return (facts(spark, sf_dir).where(F.col("PriceLow") < 10000).withColumn("PriceAvg", price))


def _index_rows(lines: DataFrame, entity: Column) -> DataFrame:
    p = F.col("l_extendedprice")
    return (lines.groupBy(entity.alias("entity"),
                          fiscal_ordinal(F.col("l_shipdate")).alias("q_ord"))
            .agg(F.max(F.col("l_shipdate").cast("date")).alias("date"),
                 (F.round(F.sum(p), 2) / F.count(F.lit(1))).alias("PriceAvg"),
                 F.max(p).alias("PriceHigh"), F.min(p).alias("PriceLow")))


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers together as one index."""
    return _index_rows(table(spark, sf_dir, "lineitem"), F.lit(MARKET))


def region_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index per region of the supplier."""
    homes = (table(spark, sf_dir, "supplier")
             .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
             .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
             .select("s_suppkey", "r_name"))
    lines = table(spark, sf_dir, "lineitem").join(homes, F.col("l_suppkey") == F.col("s_suppkey"))
    return _index_rows(lines, F.col("r_name"))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Industry and sector of the suppliers whose balance is not negative."""
    return (table(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
            .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("s_suppkey").cast("string").alias("entity"),
                    F.col("r_name").alias("Sector"), F.col("n_name").alias("Industry")))


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped before 2000 in archive form, one row per supplier and pair of months. Two
    pairs can end in one fiscal quarter."""
    ship = F.col("l_shipdate")
    sums = (table(spark, sf_dir, "lineitem").where(ship < F.lit("2000-01-01").cast("date"))
            .groupBy("l_suppkey", F.floor((F.year(ship) * 12 + F.month(ship) - 1) / 2).alias("m"))
            .agg(*map(F.expr, (
                "max(CAST(l_shipdate AS DATE)) AS QuarterEnd", "count(*) AS n",
                "sum(l_quantity) AS qty", "max(l_extendedprice) AS hi",
                "min(l_extendedprice) AS lo", "round(sum(l_extendedprice), 2) AS s_p",
                "round(sum(l_extendedprice * l_tax), 4) AS s_pt",
                "round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS s_rp",
                "round(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END), 2) AS s_f"))))
    return sums.selectExpr(
        "CAST(l_suppkey AS STRING) AS entity", "QuarterEnd", "CAST(qty AS BIGINT) AS Shares",
        "CAST(qty * 2 AS BIGINT) AS SharesSplitAdjusted", "2.0D AS SplitFactor",
        "floor(s_p) AS Assets", "floor(s_pt) AS Liabilities",
        "floor(s_p - s_pt) AS ShareholdersEquity",
        "CASE WHEN n = 1 THEN 'unknown' ELSE CAST(n AS STRING) END AS LongTermDebt",
        "floor(s_rp) AS Revenue", "floor(s_f) AS Earnings", "s_pt / qty AS DividendPerShare",
        "floor(s_f) AS CashAtEndOfPeriod", "floor(s_pt) AS CapitalExpenditures",
        "s_p / n AS Price", "hi AS PriceHigh", "lo AS PriceLow",
        "s_f / qty AS FreeCashFlowPerShare")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders as daily prices: highest total and number of orders of a day."""
    return (table(spark, sf_dir, "orders")
            .groupBy(F.col("o_custkey").cast("string").alias("entity"),
                     F.col("o_orderdate").cast("date").alias("date"))
            .agg(F.max("o_totalprice").alias("close"), F.count(F.lit(1)).alias("volume")))


def supplier_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped lines as daily prices of their supplier. Few lines share a day, so sums of parts would be
    as many as the lines: these go to their day at once, to places that grow with the table."""
    lines = table(spark, sf_dir, "lineitem")
    days = lines.select(F.col("l_suppkey").cast("string").alias("entity"),
                        F.col("l_shipdate").cast("date").alias("date"), "l_extendedprice", "l_quantity")
    return (spread(days, lines.count(), "entity", "date").groupBy("entity", "date")
            .agg(F.max("l_extendedprice").alias("close"),
                 F.sum("l_quantity").cast("long").alias("volume")))


def market_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shipped lines of a day as the daily price of one index."""
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_shipdate").cast("date").alias("date"))
            .agg(F.max("l_extendedprice").alias("close"),
                 F.sum("l_quantity").cast("long").alias("volume"))
            .select(F.lit(MARKET).alias("entity"), "date", "close", "volume"))


def _line_events(spark: SparkSession, sf_dir: str, keep: Column, value: Column) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(keep).select(
        F.col("l_suppkey").cast("string").alias("entity"),
        F.col("l_shipdate").cast("date").alias("date"), value)


def dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned first lines as dividend events."""
    return _line_events(spark, sf_dir,
                        (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1),
                        F.col("l_discount").alias("dividend"))


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest, most discounted lines as two-for-one splits."""
    return _line_events(spark, sf_dir,
                        (F.col("l_quantity") == 50) & (F.col("l_discount") >= 0.0999),
                        F.lit(2.0).alias("split"))


def quarter_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last shipping day of every supplier quarter."""
    return (table(spark, sf_dir, "lineitem")
            .groupBy("l_suppkey", fiscal_ordinal(F.col("l_shipdate")).alias("q_ord"))
            .agg(F.max(F.col("l_shipdate").cast("date")).alias("quarter_end"))
            .select(F.col("l_suppkey").cast("string").alias("entity"), "q_ord", "quarter_end"))


# Order priorities as grades; "4-NOT SPECIFIED" is unknown.
GRADES = {"1-URGENT": 1, "2-HIGH": 1, "3-MEDIUM": 0, "5-LOW": -1}


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ratings of the customer's nation by a firm per market segment."""
    return (table(spark, sf_dir, "orders")
            .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_nationkey").cast("string").alias("entity"),
                    F.col("o_orderdate").cast("date").alias("date"),
                    F.concat(F.col("c_mktsegment"), F.lit(" & CO")).alias("firm"),
                    F.col("o_orderpriority").alias("grade")))


def supplier_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities as ratings of a line's supplier by a firm per line number."""
    return (table(spark, sf_dir, "lineitem")
            .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("l_suppkey").cast("string").alias("entity"),
                    F.col("o_orderdate").cast("date").alias("date"),
                    F.concat(F.lit("Desk "), F.col("l_linenumber"), F.lit(" & CO")).alias("firm"),
                    F.col("o_orderpriority").alias("grade")))


def long_form(rows: DataFrame, items: list[str]) -> DataFrame:
    """Facts as a statement: one row per entity, date and item."""
    return (rows.select("entity", "date", *[F.col(i).cast("double") for i in items])
            .unpivot(["entity", "date"], items, "item", "value"))
