import math

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions.names import TARGET
from quarterdeck.functions.periods import ordinal
from quarterdeck.operators.changes import add_changes, add_index_comparison, add_target


def test_changes_of_quarter_and_year(panel):
    done = add_changes(panel, ["PriceAvg", "Earnings"])
    assert done.count() == panel.count()
    rows = {(r.entity, r.q_ord): r for r in done.collect()}
    for entity in ("A", "AAPL"):
        now = rows[entity, ordinal(2021, 4)]
        for column in ("PriceAvg", "Earnings"):
            for prefix, n in (("Q_Delta_", 1), ("YOY_Delta_", 4)):
                before = rows[entity, ordinal(2021, 4) - n][column]
                assert math.isclose(now[prefix + column], (now[column] - before) / before,
                                    abs_tol=1e-12)
        assert rows[entity, ordinal(2020, 1)]["Q_Delta_PriceAvg"] is None
        assert rows[entity, ordinal(2020, 4)]["YOY_Delta_PriceAvg"] is None


def test_missing_values_fill_forward_and_zero_gives_null(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 1.0), ("a", 3, None), ("a", 4, 2.0), ("a", 5, 0.0),
         ("a", 6, 3.0)], "entity string, q_ord int, x double")
    rows = add_changes(df, ["x"], (1,)).orderBy("q_ord").collect()
    assert [r["Q_Delta_x"] for r in rows] == [None, None, 0.0, 1.0, -1.0, None]
    assert add_changes(df, ["x"], (1,), dropna=True).count() == 3


def test_rows_or_calendar(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 3, 2.0), ("a", 4, 4.0)],
                               "entity string, q_ord int, x double")
    by_row = add_changes(df, ["x"], (1,)).orderBy("q_ord").collect()
    by_date = add_changes(df, ["x"], (1,), calendar=True).orderBy("q_ord").collect()
    assert [r["Q_Delta_x"] for r in by_row] == [None, 1.0, 1.0]
    assert [r["Q_Delta_x"] for r in by_date] == [None, None, 1.0]


def test_comparison_with_an_index(panel, index_panel):
    done = add_index_comparison(panel, index_panel, ["DJI", "nowhere"], ["PriceAvg"])
    assert done.count() == panel.count()
    rows = {(r.entity, r.q_ord): r for r in done.collect()}
    index = {r.q_ord: r.PriceAvg for r in index_panel.collect()}
    for key in (("A", ordinal(2021, 4)), ("AAPL", ordinal(2021, 2))):
        assert rows[key]["PriceAvg_vs_DJI"] == rows[key]["PriceAvg"] / index[key[1]]
        assert rows[key]["PriceAvg_vs_nowhere"] is None
    assert add_index_comparison(panel, index_panel, ["nowhere"], ["PriceAvg"],
                                dropna=True).count() == 0


def test_target_one_quarter_out(panel):
    done = add_target(panel.withColumn("DividendPerShare", F.lit(0.0)), 1)
    assert set(done.columns) - set(panel.columns) == {"DividendPerShare", TARGET}
    for entity in ("A", "AAPL"):
        values = [r[TARGET] for r in
                  done.where(F.col("entity") == entity).orderBy("q_ord").collect()]
        assert values[:-1] == [2.0] * 7 and values[-1] is None


def test_target_four_quarters_out_with_dividends(panel):
    done = add_target(panel.withColumn("DividendPerShare", F.lit(1.0)), 4)
    for entity, least in (("A", 12), ("AAPL", 10)):
        values = [r[TARGET] for r in
                  done.where(F.col("entity") == entity).orderBy("q_ord").collect()]
        assert all(v > least for v in values[:-4]) and values[-4:] == [None] * 4


@pytest.mark.parametrize("calendar", [False, True])
def test_target_with_missing_price_or_zero_price(spark, calendar):
    df = spark.createDataFrame([("a", 1, 0.0, 1.0), ("a", 2, 4.0, None), ("a", 3, None, 1.0),
                                ("a", 4, 5.0, 1.0)],
                               "entity string, q_ord int, PriceAvg double, DividendPerShare double")
    values = [r[TARGET] for r in add_target(df, 2, calendar=calendar).orderBy("q_ord").collect()]
    assert values == [None, 50.0, None, None]
