from datetime import date

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions.periods import ordinal, quarter_date
from quarterdeck.operators import merging
from quarterdeck.plans import features


def test_archive_fills_only_what_the_primary_lacks(spark):
    primary = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 20.0)],
                                    "entity string, q_ord int, x double")
    archive = spark.createDataFrame([("a", 2, 99.0, 1), ("a", 3, 30.0, 2), ("b", 2, 5.0, 3)],
                                    "entity string, q_ord int, x double, y int")
    rows = merging.fill_from_archive(primary, archive).orderBy("entity", "q_ord").collect()
    assert [tuple(r) for r in rows] == [("a", 1, 10.0, None), ("a", 2, 20.0, None),
                                        ("a", 3, 30.0, 2), ("b", 2, 5.0, 3)]


def test_one_row_per_key_with_a_hot_key(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").alias("v"))
    kept = merging.keep_one(df, ["k"], [F.col("v").desc()])
    best = df.groupBy("k").agg(F.max("v").alias("v"))
    assert kept.exceptAll(best).isEmpty() and kept.count() == best.count()


def test_dimension_gaps_get_names(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "entity string, q_ord int")
    dim = spark.createDataFrame([("a", "Tech", None), ("a", "Tech", None)],
                                "entity string, Sector string, Industry string")
    rows = {r.entity: (r.Sector, r.Industry) for r in merging.add_dimension(df, dim).collect()}
    assert rows == {"a": ("Tech", "MissingIndustry"), "b": ("MissingSector", "MissingIndustry")}


@pytest.mark.parametrize("seen, meant", [
    ([1, 3, 3, 4], [1, 2, 3, 4]),
    ([1, 1, 3, 4], [1, 2, 3, 4]),
    ([2, 2, 3, 4], [1, 2, 3, 4]),
    ([1, 2, 3, 3], [1, 2, 3, 4]),
    ([1, 2, 4, 4], [1, 2, 3, 4]),
    ([1, 3, 3, 5], [1, 2, 3, 5]),
    ([1, 2, 2, 3], [1, 2, 2, 3]),
    ([5, 5], [5, 5]),
    ([1, 2, 3, 4], [1, 2, 3, 4]),
    ([1, 2, 3, 5, 5, 6, 7], [1, 2, 3, 4, 5, 6, 7]),
])
def test_quarter_labels_are_repaired(spark, seen, meant):
    base = ordinal(2019, 4)
    rows = [("a", base + q, i) for i, q in enumerate(seen)]
    df = spark.createDataFrame(rows, "entity string, q int, i int").select(
        "entity", F.date_add(quarter_date(F.col("q")), F.col("i")).alias("date"))
    fixed = merging.repair_labels(df).orderBy("date").collect()
    assert [r.q_ord - base for r in fixed] == meant


def test_statements_become_rows(spark):
    schema = "entity string, date date, item string, value double"
    balance = spark.createDataFrame([("a", date(2020, 3, 31), "Cash", 1.0),
                                     ("a", date(2020, 4, 5), "Cash", 2.0),
                                     ("a", date(2020, 6, 30), "Other", 9.0),
                                     ("a", date(2020, 6, 30), "Cash", 3.0)], schema)
    income = spark.createDataFrame([("a", date(2020, 4, 5), "Ebit", 5.0)], schema)
    rows = merging.statements_to_panel(balance, income, items=["Cash", "Ebit"])
    found = {r.q_ord: (r.date, r.Cash, r.Ebit) for r in rows.collect()}
    assert found == {ordinal(2020, 1): (date(2020, 4, 5), 2.0, 5.0),
                     ordinal(2020, 2): (date(2020, 6, 30), 3.0, None)}


def test_archive_preparation_keeps_missing_revenue_and_the_older_quarter(spark):
    schema = ("entity string, QuarterEnd date, Shares long, SharesSplitAdjusted long, "
              "SplitFactor double, Assets long, Liabilities long, ShareholdersEquity long, "
              "LongTermDebt string, Revenue long, Earnings long, DividendPerShare double, "
              "CashAtEndOfPeriod long, CapitalExpenditures long, Price double, "
              "PriceHigh double, PriceLow double, FreeCashFlowPerShare double")

    def row(day, revenue, earnings=7, debt="12"):
        return ("a", day, 10, 20, 2.0, 100, 40, 60, debt, revenue, earnings, 0.5, 5, 3, 8.0, 9.0,
                7.0, 1.5)

    df = spark.createDataFrame(
        [row(date(2019, 3, 31), None, debt="?"), row(date(2019, 4, 2), 50),
         row(date(2019, 6, 30), 0), row(date(2019, 9, 30), 50, None),
         row(date(2019, 12, 31), 50)], schema)
    rows = {r.q_ord: r for r in features.prepare_archive(df).collect()}
    assert set(rows) == {ordinal(2019, 1), ordinal(2019, 4)}
    first, last = rows[ordinal(2019, 1)], rows[ordinal(2019, 4)]
    assert first.date == date(2019, 3, 31) and first.TotalRevenue is None
    assert first.LongTermDebt is None and last.LongTermDebt == 12
    assert (last.DividendsPaid, last.OperatingIncome, last.MarketCap, last.Ebit, last.NetIncome,
            last.CommonStock, last.ShortLongTermDebt) == (5.0, 15.0, 160.0, 47, 7, 20, 0.0)
