import math
import random

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions.periods import ordinal
from quarterdeck.operators import backtest, ranking

Q = ordinal(2020, 1)


def values(df) -> dict:
    return {r.label: r.value for r in df.collect()}


def all_picks(scored, *quarters):
    return ranking.top_n_per_quarter(scored.where(F.col("q_ord").isin(*quarters)), 5, "score")


def test_hold_one_quarter(scored):
    picks = all_picks(scored, Q)
    # Buying stops after the first quarter: the second has no picks.
    done = values(backtest.portfolio_values(picks, scored, Q, Q + 1, hold=1))
    assert done["1Q2020"] == 1000 and done["2Q2020"] == 1020


def test_hold_four_quarters(scored):
    picks = all_picks(scored, Q, Q + 1)
    done = values(backtest.portfolio_values(picks, scored, Q, Q + 2, hold=4))
    assert (done["1Q2020"], done["2Q2020"], done["3Q2020"]) == (1000, 1005, 1015.1)


def test_nothing_is_bought_when_the_end_is_not_after_the_start(scored):
    done = backtest.portfolio_values(all_picks(scored, Q), scored, Q, Q, cash=500.0)
    assert values(done) == {"1Q2020": 500.0, "2Q2020": 500.0}


def loop(picks, changes, start, end, hold, cash, allocation):
    """The same bookkeeping, one quarter after the other."""
    now, age, held, result = start, 0, {}, {start: cash}

    def pass_quarter(sell_all):
        nonlocal now, cash
        now += 1
        total = cash
        for key in list(held):
            entity, bought = key
            if (entity, now) in changes:
                change = changes[entity, now]
                held[key] *= math.nan if change is None else 1 + change
                total += held[key]
            else:
                held[key] = 0 * held[key] if math.isnan(held[key]) else 0.0
            if sell_all or bought + hold == now:
                cash += held.pop(key)
        result[now] = total

    while now < end:
        if age:
            pass_quarter(False)
        chosen = picks.get(now)
        if not chosen:
            break
        spent = cash * (1.0 if age >= hold else 1.0 / (hold - age))
        fib = [1, 1, 2, 3, 5, 8][:len(chosen)]
        for i, entity in enumerate(chosen):
            share = (1 / len(chosen) if allocation == "equal"
                     else fib[len(chosen) - 1 - i] / sum(fib))
            held[entity, now] = spent * share
        cash -= spent
        age += 1
    pass_quarter(True)
    return result


@pytest.mark.parametrize("seed", range(8))
def test_closed_form_equals_the_loop(spark, seed):
    rnd = random.Random(seed)
    entities, hold = "abcdef", rnd.randint(1, 5)
    start, end = 100, 100 + rnd.randint(2, 12)
    changes = {(e, q): round(rnd.uniform(-0.3, 0.4), 3) for e in entities
               for q in range(start, end + 7) if rnd.random() > 0.1}
    picks = {q: rnd.sample(entities, rnd.randint(1, 4)) for q in range(start, end + 1)}
    if seed % 3 == 1:
        picks.pop(rnd.randint(start, end))
    if seed % 4 == 3:
        changes[rnd.choice(list(changes))] = None
    allocation = ("equal", "fibonacci")[seed % 2]
    panel = spark.createDataFrame([(e, q, c) for (e, q), c in changes.items()],
                                  "entity string, q_ord int, Q_Delta_PriceAvg double")
    rows = spark.createDataFrame([(q, e, i + 1) for q, es in picks.items()
                                  for i, e in enumerate(es)],
                                 "q_ord int, entity string, rank int")
    done = {r.q_ord: r.value for r in backtest.portfolio_values(
        rows, panel, start, end, hold, 1000.0, allocation).collect()}
    meant = loop(picks, changes, start, end, hold, 1000.0, allocation)
    if start not in picks:
        meant = {start: 1000.0, start + 1: 1000.0}
    assert set(done) == set(meant)
    for q, value in meant.items():
        if math.isnan(value):
            assert done[q] is None
        else:
            assert abs(done[q] - value) < 0.011, (q, done, meant)


def test_weights(spark):
    picks = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "a", 1)],
                                  "q_ord int, entity string, rank int")
    done = {(r.q_ord, r["rank"]): r.weight
            for r in ranking.add_weights(picks, "Fibonacci").collect()}
    assert done == {(1, 1): 0.5, (1, 2): 0.25, (1, 3): 0.25, (2, 1): 1.0}
    with pytest.raises(ValueError):
        ranking.add_weights(picks, "random")


@pytest.mark.parametrize("n", [3, 40])
def test_top_of_a_crowded_quarter(spark, n):
    """Two thirds of the rows are in one quarter; many scores tie; some are missing."""
    df = spark.range(6000).select(
        F.format_string("%05d", "id").alias("entity"),
        F.when(F.col("id") % 3 > 0, 1).otherwise((F.col("id") % 5 + 2).cast("int")).alias("q_ord"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 7919 % 500).cast("double")).alias("score"))
    rows = df.where("score IS NOT NULL").collect()
    meant = set()
    for q in range(1, 7):
        best = sorted((r for r in rows if r.q_ord == q), key=lambda r: (-r.score, r.entity))
        meant |= {(q, r.entity, i + 1) for i, r in enumerate(best[:n])}
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "10")
    try:
        done = ranking.top_n_per_quarter(df, n, "score").collect()
    finally:
        spark.conf.set(limit, before)
    assert {(r.q_ord, r.entity, r["rank"]) for r in done} == meant
    assert [r.score for r in ranking.top_n(df, 2, "score").collect()] == [499.0, 499.0]


def test_fibonacci_weights_of_many_picks(spark):
    picks = spark.range(1, 51).selectExpr("1 AS q_ord", "CAST(id AS INT) AS rank")
    terms = [1, 1]
    while len(terms) < 50:
        terms.append(terms[-1] + terms[-2])
    found = {r.rank: r.weight for r in ranking.add_weights(picks, "fibonacci").collect()}
    assert found == {k + 1: terms[49 - k] / sum(terms) for k in range(50)}
