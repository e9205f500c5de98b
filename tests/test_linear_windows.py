"""Models of many windows from sums by quarter, against a fit of each window by itself."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterdeck import session
from quarterdeck.functions.names import TARGET
from quarterdeck.operators import encoding
from quarterdeck.operators.ranking import top_n_per_quarter
from quarterdeck.plans import linear_windows as sums, training, walk_forward as walk
from quarterdeck.plans.settings import Settings

SETTINGS = Settings(model="linear", horizon=2, training_quarters=6, n_to_buy=4)


@pytest.fixture(scope="module")
def features(spark):
    df = spark.range(1500).select(
        F.concat(F.lit("e"), F.col("id") % 75).alias("entity"),
        (F.floor(F.col("id") / 75) + 100).cast("int").alias("q_ord"),
        (F.col("id") * 37 % 101 / 10).alias("PriceAvg"),
        F.when(F.col("id") % 17 > 0, F.col("id") * 53 % 97 / 10).alias("x"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 31 % 13 + 100).alias("z z"),
        F.lit(3.0).alias("same"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("it's "), F.col("id") % 4)).alias("Industry"))
    target = F.when(F.col("q_ord") < 116, F.coalesce("x", F.lit(5.0)) * 3 + F.col("id") % 7)
    rows = df.withColumn("id", F.monotonically_increasing_id()).withColumn(TARGET, target).drop("id")
    return session.written(rows, "features")


@pytest.mark.parametrize("size", [0.0, 0.2, 0.55, 1.0])
def test_limits_of_all_windows_hold_out_the_same_rows(features, size):
    windows = {q: range(q - 6, q - 1) for q in range(103, 121)}
    hashes = features.select("q_ord", encoding.key_hash().alias("h"))
    limits = encoding.hold_out_limits(hashes, windows, size)
    for q in (103, 107, 119):
        rows = features.where(F.col("q_ord").isin(list(windows[q])))
        alone = encoding.hold_out(rows, size).where("held_out").select("entity", "q_ord")
        together = rows.where(encoding.key_hash() <= (limits[q] or "")).select("entity", "q_ord")
        assert alone.exceptAll(together).isEmpty() and together.exceptAll(alone).isEmpty()
    assert encoding.hold_out_limits(hashes.limit(0), windows, size) == dict.fromkeys(windows)


def test_models_equal_those_of_each_window(features):
    stored = session.written(features.withColumn(training.HASH, encoding.key_hash()), "stored")
    windows = {q: training.training_window(q, SETTINGS) for q in range(104, 118)}
    made, models = sums.linear_windows(stored.drop("PriceAvg"), windows, SETTINGS)
    found = {(r.entity, r.q_ord): r[TARGET] for r in sums.predict_windows(made.rows, models, TARGET).collect()}
    learnt = {r.window: r.rows for r in models.collect()}
    for q in (104, 109, 117):
        fitted = training.fit(features.drop("PriceAvg"), SETTINGS, q)
        own = training.training_rows(features, q, SETTINGS).count()
        assert learnt[q] == own - int(own * 0.2)
        rows = features.where(F.col("q_ord") == q)
        # Constant columns leave MLlib to an iterative solver, which stops near the solution.
        for r in training.predict(fitted.pipeline, rows.drop(TARGET)).collect():
            assert found[r.entity, q] == pytest.approx(r[TARGET], abs=0.1)
        limit = encoding.hold_out_limits(
            stored.where(F.col(TARGET).isNotNull()).select("q_ord", F.col(training.HASH).alias("h")),
            {q: windows[q]}, SETTINGS.test_size)[q]
        data = made.rows.where(F.col("q_ord").isin([*windows[q], q])).toPandas()
        train = data[data.q_ord.isin(windows[q]) & data[TARGET].notna() & (data[training.HASH] > limit)]
        matrix = lambda d: np.column_stack([np.ones(len(d)), np.array(d[sums.X].tolist())])
        solved = np.linalg.lstsq(matrix(train), train[TARGET].to_numpy(), rcond=1e-9)[0]
        now = data[data.q_ord == q]
        for entity, score in zip(now.entity, matrix(now) @ solved):
            assert found[entity, q] == pytest.approx(score, abs=1e-7)


def test_one_reading_and_no_fit_for_each_quarter(features, monkeypatch):
    """The picks of a linear walk-forward score as those of single fits do, without any fit."""
    alone = {}
    for q in (106, 107):
        fitted = training.fit(features.drop("PriceAvg"), SETTINGS, q)
        scored = training.predict(fitted.pipeline, features.where(F.col("q_ord") == q).drop(TARGET))
        best = top_n_per_quarter(scored.withColumn(TARGET, F.round(TARGET, 6)), 4, TARGET)
        alone |= {(q, r["rank"]): r[TARGET] for r in best.collect()}
    monkeypatch.setattr(walk, "fit_marked", None)
    picks = walk.walk_forward_picks(features, 106, 107, SETTINGS).collect()
    assert {(r.q_ord, r["rank"]): round(r[TARGET], 6) for r in picks} == pytest.approx(alone, abs=0.1)


def test_other_settings_fit_each_quarter(features):
    prepared = Settings(**{**SETTINGS.__dict__, "extract_outliers": True})
    assert sums.summable(SETTINGS) and not sums.summable(prepared)
    assert walk.walk_forward_picks(features, 106, 106, prepared).count() == 4


def test_unscaled_models_give_the_same_scores(features):
    stored = features.withColumn(training.HASH, encoding.key_hash()).select(
        "entity", "q_ord", "x", TARGET, training.HASH).where("x IS NOT NULL")
    made, models = sums.linear_windows(stored, {110: range(104, 109)}, SETTINGS)
    plain = sums.unscaled(models, made).first()
    scores = sums.predict_windows(made.rows.where("q_ord = 110"), models, TARGET).collect()
    given = {r.entity: r.x for r in stored.where("q_ord = 110").collect()}
    for r in scores:
        assert r[TARGET] == pytest.approx(plain.intercept + plain.coefficients[0] * given[r.entity])
    assert made.names == ["x"]
