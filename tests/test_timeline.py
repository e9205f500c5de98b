"""Events of all kinds on one time axis against plain loops."""

from __future__ import annotations

import json
import random
from datetime import date, timedelta

import pytest

from quarterdeck.functions.periods import fiscal_ordinal_value
from quarterdeck.operators.timeline import daily_events, quarters_of_events
from quarterdeck.plans.loading import quarterly_facts
from quarterdeck.session import written

DAY, END = timedelta(days=1), date(2002, 6, 1)
ITEMS = ["Cash", "Ebit"]
SCORES = {"up": 1, "down": -1}


def made(rng):
    """Statements, dividends, splits, prices and ratings of a few entities, borders met on purpose."""
    start = date(2000, 1, 1)
    statements, dividends, splits, prices, ratings = [], [], [], [], []
    for name in ("a", "b", "hot", "late"):
        day = start + rng.randrange(60) * DAY
        ends = []
        for _ in range(rng.randrange(1, 9)):
            ends.append(day)
            statements += [(name, day, "Cash", float(rng.randrange(9))), (name, day, "other", 1.0)]
            if rng.random() < 0.7:
                statements.append((name, day, "Ebit", float(rng.randrange(9))))
            day += (91 + rng.choice([0, 0, 1, -1, 30, -60])) * DAY
        span = [start + i * DAY for i in range(-120, 900)]
        near = [e + k * DAY for e in ends for k in (-91, -90, -1, 0, 1)]
        for _ in range(60):
            dividends.append((name, rng.choice(near + span), float(rng.randrange(1, 5))))
        splits += [(name, rng.choice(near + span), float(rng.randrange(2, 4))) for _ in range(12)]
        prices += [(name, rng.choice(near + span), rng.randrange(1, 90) / 4, rng.randrange(99))
                   for _ in range(250)]
        ratings += [(name, rng.choice(near + span), rng.choice(["A B", "AB", "C", None]),
                     rng.choice(["up", "Down", "odd"])) for _ in range(80)]
    for rows in (dividends, splits, prices, ratings):
        rows.append(("unknown", start, *rows[0][2:]))
    return statements, dividends, splits, prices, ratings


def brute(statements, dividends, splits, prices, ratings):
    out = {}
    for name in {s[0] for s in statements}:
        newest = {}
        for n, day, item, _ in statements:
            if n == name and item in ITEMS:
                q = fiscal_ordinal_value(day, 7)
                newest[q] = max(newest.get(q, day), day)
        ends = sorted((day, q) for q, day in newest.items())
        first = ends[0][0] - 91 * DAY
        for i, (day, q) in enumerate(ends):
            since = ends[i - 1][0] if i else day - 90 * DAY
            near = {}
            for n, d, s in splits:
                if n == name and day - 91 * DAY < d < day:
                    near[d] = max(s, near.get(d, s))
            out[name, q] = {
                "date": day, **{c: max((v for n, d, k, v in statements if (n, d, k) == (name, day, c)),
                                       default=None) for c in ITEMS},
                "DividendPerShare": sum(v for n, d, v in dividends if n == name and since <= d < day),
                "Split": near[max(near)] if near else None,
                "prices": None, "scores": None}
        windows = {}
        for n, d, close, volume in prices:
            if n == name and first <= d < END:
                windows.setdefault((d - first).days // 91, []).append((d, close, volume))
        for k, rows in sorted(windows.items()):
            last = first + (k + 1) * 91 * DAY
            q = fiscal_ordinal_value(last, 7)
            if last < END and (name, q) in out:
                closes = [c for _, c, _ in rows]
                high = max((d, c) for d, c, _ in rows)[1]
                out[name, q]["prices"] = (sum(closes) / len(closes), min(closes), max(closes), high)
        marks = {}
        for n, d, firm, grade in ratings:
            if n == name and first <= d < END and firm is not None:
                own = marks.setdefault((d - first).days // 91, {}).setdefault(firm.replace(" ", ""), [])
                own.append(SCORES.get(grade.lower(), 0))
        for k, firms in sorted(marks.items()):
            last = first + (k + 1) * 91 * DAY
            q = fiscal_ordinal_value(last, 7)
            if last <= END and (name, q) in out:
                out[name, q]["scores"] = {f: sum(x) / len(x) for f, x in firms.items()}
    return out


def frames(spark, given):
    schemas = ("item string, value double", "dividend double", "split double", "close double, volume long",
               "firm string, grade string")
    return [written(spark.createDataFrame(rows, f"entity string, date date, {s}"), "events")
            for rows, s in zip(given, schemas)]


@pytest.mark.parametrize("seed", [1, 2])
def test_quarters_of_events_equal_plain_loops(spark, seed):
    given = made(random.Random(seed))
    statements, *others = frames(spark, given)
    daily = daily_events([statements], *others, END, ITEMS, SCORES)
    found = {}
    for r in quarters_of_events(daily, END, ITEMS).collect():
        prices = (r.PriceAvg, r.PriceLow, r.PriceHigh, r.PriceEoQ)
        found[r.entity, r.q_ord] = {
            "date": r.date, "Cash": r.Cash, "Ebit": r.Ebit, "DividendPerShare": r.DividendPerShare,
            "Split": r.Split, "prices": None if r.PriceLow is None else prices,
            "scores": r.AvgRecommendations and json.loads(r.AvgRecommendations)}
    meant = brute(*given)
    assert set(found) == set(meant)
    for key, row in meant.items():
        for name, value in row.items():
            near = value if name == "date" or value is None else pytest.approx(value)
            assert found[key][name] == near, (key, name)


def test_one_axis_needs_no_join_and_one_exchange_by_entity(spark):
    statements, *others = frames(spark, made(random.Random(3)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        earnings = written(spark.createDataFrame([("a", 8000, 1.0)], "entity string, q_ord int, Earnings double"),
                           "earnings")
        done = quarterly_facts([statements], *others, END, earnings=earnings, scores=SCORES)
        text = done._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" not in text
    # Ratings by firm and all events by day, both after partial sums; then every entity once.
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("Exchange hashpartitioning(entity") == 3 and "REPARTITION_BY_COL" in text
    assert {"Earnings", "AvgRecommendations", "fy"} <= set(done.columns)


def test_no_events(spark):
    statements, *others = frames(spark, ([],) * 5)
    assert quarters_of_events(daily_events([statements], *others, END, ITEMS, SCORES), END, ITEMS).isEmpty()


def test_daily_events_are_summed_by_hash(spark):
    """No list and no column for each item is carried by the rows of prices."""
    statements, *others = frames(spark, made(random.Random(4)))
    daily = daily_events([statements], *others, END, ITEMS, SCORES)
    text = daily._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text
    assert not set(ITEMS) & set(daily.columns)
