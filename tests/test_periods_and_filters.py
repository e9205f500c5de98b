from bisect import bisect_right
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions import cells, periods
from quarterdeck.functions.ratios import RATIOS, add_formulas
from quarterdeck.operators import filters


def quarter_starts(shift: int) -> list[date]:
    """First days of the fiscal quarters from the first one of 1989 on: the 25th of January, April, July
    and October, or, where days are not moved, the first day after that month."""
    starts = [date(1989 + i // 4, 1 + i % 4 * 3, 25) for i in range(50 * 4)]
    return starts if shift else [(day + timedelta(days=10)).replace(day=1) for day in starts]


@pytest.mark.parametrize("shift", [7, 0])
def test_fiscal_quarter_of_every_day(spark, shift):
    days = [date(1990, 1, 1) + timedelta(days=i) for i in range(41 * 365)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    rows = df.select("day", periods.fiscal_ordinal(F.col("day"), shift)).collect()
    first, starts = periods.ordinal(1989, 1), quarter_starts(shift)
    assert all(q == first + bisect_right(starts, day) - 1 for day, q in rows)
    assert all(q == periods.fiscal_ordinal_value(day, shift) for day, q in rows)


def test_quarter_arithmetic(spark):
    q = periods.ordinal(2020, 1)
    df = spark.createDataFrame([(q,)], "q int")
    c = F.col("q")
    row = df.select(periods.label(c), periods.label(c + 1), periods.label(c + 4),
                    periods.label(c - 1), periods.quarter_date(c), c + 1 > c,
                    periods.fiscal_year(c), periods.fiscal_quarter(c),
                    periods.parse_label(F.lit("3Q1999")), periods.parse_label(F.lit("5Q1999")),
                    periods.parse_label(F.lit("Q1999"))).first()
    assert tuple(row) == ("1Q2020", "2Q2020", "1Q2021", "4Q2019", date(2020, 3, 1), True, 2020, 1,
                          periods.ordinal(1999, 3), None, None)
    assert periods.parse_label_value("3q1999") == periods.ordinal(1999, 3)


def test_quarter_filter(panel):
    kept = filters.between_quarters(panel, periods.ordinal(2020, 2), periods.ordinal(2021, 2))
    found = {(r.entity, r.q_ord) for r in kept.collect()}
    assert found == {(e, periods.ordinal(2020, 2) + i) for e in ("A", "AAPL") for i in range(4)}


def test_quarter_filter_by_dates(panel):
    kept = filters.between_quarters_of(panel, date(2020, 4, 28), date(2021, 5, 1))
    found = {(r.entity, r.q_ord) for r in kept.collect()}
    assert found == {(e, periods.ordinal(2020, 2) + i) for e in ("A", "AAPL") for i in range(4)}


def test_quarter_filter_bounds_the_partition_column(spark):
    df = spark.createDataFrame([("a", periods.ordinal(y, q), y) for y in (2019, 2020, 2021)
                                for q in range(1, 5)], "entity string, q_ord int, fy int")
    for start, end in ((8077, 8085), (8080, 8084), (8079, 8080)):
        assert filters.between_quarters(df, start, end).count() == end - start


def test_row_filters(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", None, 2.0), ("c", 0.0, 3.0),
                                ("d", 4.0, None)], "entity string, x double, y double")
    assert {r[0] for r in filters.nonzero(df, ["x", "y"]).collect()} == {"b", "d"}
    assert {r[0] for r in filters.require(df, ["x", "y"]).collect()} == {"a", "c"}
    assert filters.keep_columns(df, ["x"]).collect() == [(1.0,), (0.0,), (4.0,)]
    assert filters.keep_columns(df, ["x"], dropna=False).count() == 4
    assert filters.keep_known(df, ["y", "z", "entity"]).columns == ["entity", "y"]
    listed, others = filters.split_symbols(df, ["a", "q"])
    assert listed.count() == 1 and others.count() == 3
    labelled, rest = filters.split_labelled(df, "x")
    assert labelled.count() == 3 and rest.columns == ["entity", "y"] and rest.count() == 1


def test_dates_are_half_open_and_freshness_counts_the_border(spark):
    df = spark.createDataFrame([("a", date(2020, 1, 1)), ("a", date(2020, 2, 1)),
                                ("b", date(2019, 2, 1)), ("c", date(2019, 1, 31))],
                               "entity string, date date")
    assert filters.between_dates(df, date(2019, 2, 1), date(2020, 2, 1)).count() == 2
    fresh = filters.fresh_entities(df, date(2020, 2, 1), 365)
    assert {r.entity for r in fresh.collect()} == {"a", "b"} and fresh.count() == 3


def test_ratios_have_no_infinity(spark):
    names = ["PriceHigh", "PriceLow", "PriceAvg", "TotalAssets", "TotalLiab", "Earnings",
             "LongTermDebt", "ShortLongTermDebt", "TotalStockholderEquity", "DividendsPaid",
             "MarketCap", "NetIncome", "TotalRevenue", "ResearchDevelopment", "Cash",
             "TotalOperatingExpenses"]
    rows = [tuple(float(i + 1) for i in range(len(names))), tuple(0.0 for _ in names)]
    df = add_formulas(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)))
    full, empty = df.select(*RATIOS).collect()
    value = dict(zip(names, rows[0]))
    assert full["Volatility"] == (value["PriceHigh"] - value["PriceLow"]) / value["PriceAvg"]
    assert full["DebtToEquityRatio"] == (
        value["LongTermDebt"] + value["ShortLongTermDebt"]) / value["TotalStockholderEquity"]
    assert all(v is None for v in empty)


def test_user_formula_may_be_text_or_function(panel):
    own = {"twice": "PriceAvg * 2", "half": lambda: F.col("PriceAvg") / 2}
    row = add_formulas(panel, own).first()
    assert row["twice"] == row["PriceAvg"] * 2 and row["half"] == row["PriceAvg"] / 2


def test_cells(spark):
    df = spark.createDataFrame(
        [('{"A": 1, "B": "0.5"}', "Strong Buy"), (None, "strong-buy"), ("nan", "Reduce"),
         ("{}", "made up"), ('{"A": -1}', None)], "cell string, grade string")
    rows = df.select(cells.mean_of_json(F.col("cell")), cells.grade_score(F.col("grade"))).collect()
    assert [tuple(r) for r in rows] == [(0.75, 1), (0.0, 1), (0.0, -1), (None, 0), (-1.0, 0)]
    assert cells.plain_name("Total_Assets (USD)") == "TotalAssetsUSD"
