from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import rollups, splits
from quarterdeck.functions.names import QUARTER_DAYS

DAY = timedelta(days=1)
START = date(2020, 1, 1)


def test_price_windows(spark):
    rows = [("a", START, 1.0, 10), ("a", START + 90 * DAY, 3.0, 20), ("a", START + 91 * DAY, 9.0, 1),
            ("a", START + 182 * DAY, 5.0, 7), ("a", START + 273 * DAY, 6.0, 8)]
    prices = spark.createDataFrame(rows, "entity string, date date, close double, volume long")
    # The third window ends on the end day and does not count.
    done = rollups.price_rollup(prices, START, START + 273 * DAY).orderBy("date").collect()
    assert [(r.date, r.PriceAvg, r.PriceLow, r.PriceHigh, r.PriceEoQ, r.Volume) for r in done] == [
        (START + 91 * DAY, 2.0, 1.0, 3.0, 3.0, 20), (START + 182 * DAY, 9.0, 9.0, 9.0, 9.0, 1)]
    starts = spark.createDataFrame([("a", START + 91 * DAY)], "entity string, start date")
    own = rollups.price_rollup_from(prices, starts, START + 300 * DAY).orderBy("date").collect()
    assert [(r.date, r.PriceAvg) for r in own] == [(START + 182 * DAY, 9.0),
                                                   (START + 273 * DAY, 5.0)]


def test_ratings_by_firm(spark):
    rows = [("a", START, "Big Bank", "Buy"), ("a", START + DAY, "Big Bank", "Sell"),
            ("a", START + DAY, "Other", "strong buy"), ("a", START + 91 * DAY, "Other", "??"),
            ("a", START + 182 * DAY, "Other", "Buy")]
    recs = spark.createDataFrame(rows, "entity string, date date, firm string, grade string")
    end = START + 182 * DAY  # a window that ends on the end day counts
    done = rollups.recommendation_rollup(recs, START, end).orderBy("date").collect()
    assert [(r.date, r.AvgRecommendations) for r in done] == [
        (START + 91 * DAY, '{"BigBank":0.0,"Other":1.0}'), (end, '{"Other":0.0}')]
    wide = rollups.recommendation_rollup(recs, START, end, collapse=False,
                                         firms=["Big Bank", "Other"]).orderBy("date").collect()
    assert [(r.BigBank, r.Other) for r in wide] == [(0.0, 1.0), (None, 0.0)]
    with pytest.raises(ValueError):
        rollups.recommendation_rollup(recs, START, end, collapse=False)


def ends(spark, *days):
    return spark.createDataFrame([("a", d) for d in days], "entity string, quarter_end date")


def test_dividends_belong_to_the_next_quarter_end(spark):
    first, second = START, START + 100 * DAY
    days = [first - 91 * DAY, first - 90 * DAY, first - DAY, first, second - DAY, second]
    paid = spark.createDataFrame([("a", d, 1.0) for d in days],
                                 "entity string, date date, dividend double")
    third = second + 91 * DAY
    done = rollups.dividends_per_quarter(ends(spark, first, second, third), paid)
    found = {r.quarter_end: r.DividendPerShare for r in done.collect()}
    # 91 days before the oldest end is too early; an event on an end counts for the next one.
    assert found == {first: 2.0, second: 2.0, third: 1.0}
    newest = rollups.dividends_per_quarter(ends(spark, first), paid).first()
    assert newest.DividendPerShare == 2.0
    none = rollups.dividends_per_quarter(ends(spark, first), paid.where("false")).first()
    assert none.DividendPerShare == 0.0


def test_splits_strictly_inside_the_quarter(spark):
    days = [(START - 91 * DAY, 2.0), (START - 90 * DAY, 3.0), (START - DAY, 4.0), (START, 5.0)]
    events = spark.createDataFrame([("a", d, s) for d, s in days],
                                   "entity string, date date, split double")
    spine = ends(spark, START, START + 400 * DAY)
    last = {r.quarter_end: r.Split for r in rollups.splits_per_quarter(spine, events).collect()}
    assert last == {START: 4.0, START + 400 * DAY: None}
    every = rollups.splits_per_quarter(spine, events, "product").orderBy("quarter_end").first()
    assert every.Split == 12.0
    with pytest.raises(ValueError):
        rollups.splits_per_quarter(spine, events, "sum")


def test_quarters_of_events_equal_comparing_everything(spark):
    """One entity holds most events and many of its quarter ends are near each other."""
    def entity(i, share):
        return F.when(i % share > 0, "hot").otherwise(F.concat(F.lit("e"), i % 7))

    i = F.col("id")
    events = spark.range(4000).select(
        entity(i, 3).alias("entity"), F.date_add(F.lit(START), (i * 37 % 1500).cast("int"))
        .alias("date"), F.lit(1.0).alias("dividend"), (i % 3 + 1.0).alias("split"))
    spine = spark.range(200).select(
        entity(i, 2).alias("entity"),
        F.date_add(F.lit(START), (i * 11 % 1400).cast("int")).alias("quarter_end")).distinct()
    events_by, ends_by = {}, {}
    for r in events.collect():
        events_by.setdefault(r.entity, []).append((r.date, r.split))
    for r in spine.collect():
        ends_by.setdefault(r.entity, []).append(r.quarter_end)
    paid, last, every = {}, {}, {}
    for name, days in ends_by.items():
        days.sort()
        for day, previous in zip(days, [days[0] - 90 * DAY, *days]):
            mine = events_by.get(name, [])
            paid[name, day] = float(sum(previous <= d < day for d, _ in mine))
            near = [(d, s) for d, s in mine if day - 91 * DAY < d < day]
            last[name, day] = max(near)[1] if near else None
            product = 1.0
            for _, s in near:
                product *= s
            every[name, day] = product if near else None
    done = rollups.dividends_per_quarter(spine, events.select("entity", "date", "dividend"))
    assert {(r.entity, r.quarter_end): r.DividendPerShare for r in done.collect()} == paid
    parts = events.select("entity", "date", "split")
    for combine, meant in (("last", last), ("product", every)):
        done = rollups.splits_per_quarter(spine, parts, combine)
        found = {(r.entity, r.quarter_end): r.Split for r in done.collect()}
        assert set(found) == set(meant)
        for key, value in meant.items():
            assert found[key] == value or abs(found[key] / value - 1) < 1e-9


def test_latest_price(spark):
    rows = [("a", START, 1.0), ("a", START - DAY, 2.0), ("b", START - 6 * DAY, 3.0),
            ("c", START + DAY, 4.0)]
    prices = spark.createDataFrame(rows, "entity string, date date, close double")
    assert [tuple(r) for r in rollups.latest_price(prices, START).collect()] == [("a", 1.0)]


def test_ties_of_a_moment_go_to_the_highest(spark):
    rows = [("a", START + DAY, c, v) for c, v in ((3.0, 30), (5.0, 50), (4.0, 40))] + [("a", START, 9.0, 90)]
    prices = spark.createDataFrame(rows, "entity string, date date, close double, volume long")
    for part in (prices, prices.repartition(3), prices.orderBy("close")):
        window = rollups.price_rollup(part, START, START + 10 * DAY, 4).first()
        assert (window.PriceEoQ, window.Volume, window.PriceAvg) == (5.0, 50, 5.25)
        assert rollups.latest_price(part, START + DAY).first().CurrentPrice == 5.0
        plain = part.groupBy("entity").agg(*rollups.price_aggregates(F.col("date"))).first()
        assert (plain.PriceEoQ, plain.Volume) == (5.0, 50)


def test_windows_in_one_quarter_keep_the_later(spark):
    df = spark.createDataFrame([("a", date(2020, 2, 1), 1), ("a", date(2020, 4, 20), 2)],
                               "entity string, date date, x int")
    assert [r.x for r in rollups.label_windows(df).collect()] == [2]
    assert QUARTER_DAYS == 91


def split_panel(spark):
    rows = [("a", q, 8.0, 100.0, s) for q, s in ((1, None), (2, 2.0), (3, None), (4, 2.0))]
    return spark.createDataFrame(
        rows, "entity string, q_ord int, PriceAvg double, CommonStock double, Split double")


def test_batch_split_corrects_older_rows_only(spark):
    rows = split_panel(spark)
    factors = splits.batch_split_factors(rows, rows.where("q_ord < 2"))
    assert [tuple(r) for r in factors.collect()] == [("a", 4.0, 2)]
    done = splits.adjust_panel(rows, factors).orderBy("q_ord").collect()
    assert [(r.PriceAvg, r.CommonStock) for r in done] == [(2.0, 400.0)] + [(8.0, 100.0)] * 3
    # Rows already in the table bring no new split.
    assert splits.batch_split_factors(rows, rows).isEmpty()


def test_later_splits_multiply(spark):
    done = splits.adjust_by_later_splits(split_panel(spark)).orderBy("q_ord").collect()
    assert [r.SplitFactor for r in done] == [4.0, 2.0, 2.0, 1.0]
    assert [r.PriceAvg for r in done] == [2.0, 4.0, 4.0, 8.0]


def test_archive_split_touches_all_rows(spark):
    archive = spark.createDataFrame([("a", 8.0, 10, 1.0), ("b", 8.0, 10, 1.0)],
                                    "entity string, Price double, SharesSplitAdjusted long, "
                                    "SplitFactor double")
    factors = spark.createDataFrame([("a", 2.0, 5)],
                                    "entity string, factor double, split_quarter int")
    rows = {r.entity: tuple(r)[1:] for r in splits.adjust_archive(archive, factors).collect()}
    assert rows == {"a": (4.0, 20.0, 2.0), "b": (8.0, 10.0, 1.0)}


def test_supplier_prices_lie_in_places_that_grow_with_the_table(spark, tmp_path, monkeypatch):
    """More lines make more tasks, not larger ones; the rows stay the same."""
    from quarterdeck import session
    from workload import tables as views
    lines = [(k % 7, START + (k % 30) * DAY, float(k), 1.0) for k in range(200)]
    spark.createDataFrame(lines, "l_suppkey long, l_shipdate date, l_extendedprice double, "
                                 "l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    few = {tuple(r) for r in views.supplier_prices(spark, str(tmp_path)).collect()}
    monkeypatch.setattr(session, "ROWS_EACH", 10)
    many = views.supplier_prices(spark, str(tmp_path))
    assert many.rdd.getNumPartitions() == 20
    meant = {}
    for k, day, close, n in lines:
        high, volume = meant.get((str(k), day), (0.0, 0))
        meant[str(k), day] = max(high, close), volume + int(n)
    assert {tuple(r) for r in many.collect()} == few == {(*k, *v) for k, v in meant.items()}
