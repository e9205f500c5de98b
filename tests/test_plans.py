"""The physical plans that the operators are built for."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions.names import KEY
from quarterdeck.operators import backtest, changes, filters, merging, ranking, rollups
from quarterdeck.session import written
from quarterdeck.sources import tables


def plan(df) -> str:
    """The plan as first made, without the rerun that adaptive execution may do."""
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, node: str) -> int:
    return len(re.findall(rf"[-+ *()\d]{node}\b", plan(df)))


@pytest.fixture(scope="module")
def facts(spark):
    df = spark.range(4000).select(
        F.concat(F.lit("e"), F.col("id") % 100).alias("entity"),
        F.floor(F.col("id") / 100).cast("int").alias("q_ord"),
        *[(F.col("id") * (i + 3) % 97).cast("double").alias(c) for i, c in enumerate(
            ["PriceAvg", "DividendPerShare", "a", "b", "c"])])
    return written(df, "facts")


def test_changes_and_target_share_one_exchange_and_one_sort(facts):
    done = changes.add_target(changes.add_changes(facts, ["PriceAvg", "a", "b", "c"]), 4)
    assert count(done, "Exchange") == 1 and count(done, "Sort") == 1


def test_sources_changes_and_target_share_one_exchange(facts):
    merged = merging.fill_from_archive(facts.where("q_ord > 20"), facts.where("q_ord < 30"))
    done = changes.add_target(changes.add_changes(merged, ["PriceAvg", "a"]), 4)
    assert count(done, "Exchange") == 1 and count(done, "Sort") == 1


def test_index_comparison_does_not_move_the_panel(facts):
    index = facts.where("entity = 'e1'").withColumn("entity", F.lit("X"))
    done = changes.add_index_comparison(facts, index, ["X"], ["a"])
    assert "BroadcastHashJoin" in plan(done)
    assert count(done, "Exchange hashpartitioning") == 1  # the index rows by quarter


def test_rows_per_key_are_cut_before_the_shuffle(facts):
    for df in (merging.keep_one(facts, ["entity"], [F.col("q_ord")]),
               ranking.top_n_per_quarter(facts, 7, "a")):
        text = plan(df)
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_one_plan_for_any_number_of_picks(facts):
    """Salted rounds for few and many rows a quarter, below and above Spark's own limit."""
    few, many = (re.sub(r"\d+", "", plan(ranking.top_n_per_quarter(facts, n, "a"))) for n in (7, 5000))
    nodes = [re.findall(r"(?<!\w)Window \[|Exchange hashpartitioning", text) for text in (few, many)]
    assert nodes[0] == nodes[1] and len(nodes[0]) == 6


def test_top_n_takes_ordered(facts):
    assert "TakeOrderedAndProject" in plan(ranking.top_n(facts, 5, "a"))


def test_filters_and_columns_reach_the_scan(facts):
    text = plan(filters.between_quarters(facts, 3, 9).select("entity", "a"))
    assert "GreaterThanOrEqual(q_ord,3)" in text and "LessThan(q_ord,9)" in text
    assert "ReadSchema: struct<entity:string,q_ord:int,a:double>" in text


def test_years_are_pruned(spark, facts):
    from quarterdeck.session import fresh_path
    path = fresh_path(spark, "by-year")
    tables.append_table(facts.withColumn("fy", F.floor(F.col("q_ord") / 4).cast("int")), path)
    kept = filters.between_quarters(tables.stored(spark, path), 9, 11)
    assert re.search(r"PartitionFilters: \[.*fy#\d+ >= 2", plan(kept))
    assert kept.count() == 200


def test_events_are_summed_before_they_move(spark):
    events = written(spark.range(1000).select(
        F.lit("hot").alias("entity"), F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 50)
                                                 .cast("int")).alias("date"),
        F.lit(1.0).alias("dividend")), "events")
    ends = spark.createDataFrame([("hot", date(2020, 3, 1))], "entity string, quarter_end date")
    done = rollups.dividends_per_quarter(ends, events)
    text = plan(done)
    assert "partial_sum(dividend" in text and "NestedLoop" not in text
    assert "CartesianProduct" not in text
    # By entity and day, then by entity; the sums per quarter need no third.
    assert count(done, "Exchange hashpartitioning") == 2
    assert done.first().DividendPerShare == 1000.0


def test_price_bounds_reach_the_scan(spark):
    prices = written(spark.createDataFrame(
        [("a", date(2020, 1, 1), 1.0, 1)], "entity string, date date, close double, volume long"),
        "prices")
    text = plan(rollups.price_rollup(prices, date(2020, 1, 1), date(2021, 1, 1)))
    assert "GreaterThanOrEqual(date,2020-01-01)" in text and "LessThan(date,2020-12-30)" in text
    assert count(rollups.price_rollup(prices, date(2020, 1, 1), date(2021, 1, 1)), "Sort") == 0


def test_prices_are_summed_before_they_meet_their_starts(spark):
    starts = spark.createDataFrame([("a", date(2020, 1, 1))], "entity string, start date")
    prices = written(spark.range(1000).select(
        F.lit("a").alias("entity"), F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 50)
                                               .cast("int")).alias("date"),
        F.lit(1.0).alias("close"), F.col("id").alias("volume")), "prices").hint("merge")
    text = plan(rollups.price_rollup_from(prices, starts, date(2021, 1, 1)))
    assert text.index("SortMergeJoin") < text.index("partial_sum(close")


def test_holdings_do_not_shuffle_the_panel(spark, facts):
    changed = facts.withColumn("Q_Delta_PriceAvg", F.col("a") / 100)
    picks = ranking.add_weights(written(
        ranking.top_n_per_quarter(facts.where("q_ord BETWEEN 5 AND 9"), 3, "a")
        .select(*KEY, "rank"), "picks"))
    cohorts = backtest.live_cohorts(picks, 5, 9)
    paths = backtest.holding_paths(picks, changed, cohorts, 4)
    above = plan(paths).split("ReadSchema: struct<entity:string,q_ord:int,a:double>")[0]
    nodes = re.findall(r"(BroadcastHashJoin|SortMergeJoin|Exchange hashpartitioning)", above)
    assert nodes[-1] == "BroadcastHashJoin"
