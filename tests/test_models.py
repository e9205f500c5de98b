from datetime import date

import pytest
from pyspark.sql import functions as F

from quarterdeck import session
from quarterdeck.functions.names import TARGET
from quarterdeck.operators import encoding
from quarterdeck.plans import training, walk_forward as walk
from quarterdeck.plans.features import labelled_and_candidates
from quarterdeck.plans.settings import Settings
from workload import model_queries

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows, size", [(1000, 0.2), (997, 0.33), (3, 0.2), (10, 1.0), (200, 0.0)])
def test_hold_out_has_the_exact_size(spark, rows, size):
    df = spark.range(rows).select(F.col("id").cast("string").alias("entity"),
                                  (F.col("id") % 7).alias("q_ord"))
    marked = encoding.hold_out(df, size)
    train, test = encoding.split_hold_out(marked)
    assert (train.count(), test.count()) == (rows - int(rows * size), int(rows * size))
    again = encoding.hold_out(df.repartition(3), size)
    assert again.exceptAll(marked).isEmpty()


def test_hold_out_keeps_copies_together_and_share_mode_is_near(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.col("id").cast("string")).alias("entity"), F.lit(1).alias("q_ord"))
    marked = encoding.hold_out(df, 0.5)
    assert marked.groupBy("entity").agg(F.countDistinct("held_out").alias("n")) \
        .where("n > 1").isEmpty()
    loose = encoding.hold_out(spark.range(20000).select(
        F.col("id").alias("entity"), F.lit(1).alias("q_ord")), 0.2, exact=False)
    assert abs(loose.where("held_out").count() / 20000 - 0.2) < 0.02


def test_outliers_and_scale(spark):
    rows = [(float(i), 5.0, None) for i in range(20)] + [(1000.0, 5.0, None), (None, 5.0, None)]
    df = spark.createDataFrame(rows, "x double, same double, none double")
    moments = encoding.fit_moments(df, ["x", "same", "none"])
    kept = [r.x for r in encoding.drop_outliers(df, moments).collect()]
    assert None in kept and 1000.0 not in kept and len(kept) == 21
    scaled = encoding.scale(df.where("x < 100"), encoding.fit_moments(
        df.where("x < 100"), ["x", "same", "none"]))
    row = scaled.agg(F.avg("x"), F.stddev_pop("x"), F.max("same"), F.count("none")).first()
    assert abs(row[0]) < 1e-9 and abs(row[1] - 1) < 1e-9 and row[2] == 0 and row[3] == 0


def test_one_hot(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "k string")
    fitted = encoding.fit_categories(df, ["k"])
    assert fitted == {"k": [None, "a", "b", "c"]}
    done = encoding.one_hot(df, fitted, drop_original=False)
    assert done.columns == ["k", "k_nan", "k_b", "k_c"]
    assert {r.k: tuple(r)[1:] for r in done.collect()} == {
        "a": (0, 0, 0), "b": (0, 1, 0), "c": (0, 0, 1), None: (1, 0, 0)}
    unseen = spark.createDataFrame([("z",)], "k string")
    assert tuple(encoding.one_hot(unseen, fitted, drop_one=False).first()) == (0, 0, 0, 0)
    with pytest.raises(ValueError):
        encoding.fit_categories(df, ["k"], limit=3)


def test_codes_number_the_sorted_values(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).when(
        F.col("id") % 50 > 0, F.format_string("%05d", F.col("id") * 7919 % 3001)).alias("k"))
    codes = encoding.category_codes(df, "k")
    values = sorted(r.k for r in df.where("k IS NOT NULL").distinct().collect())
    assert sorted((r.code, r.value) for r in codes.collect()) == list(enumerate(values))
    done = encoding.encode(df, "k", codes)
    assert done.count() == 3000 and done.where("k = -1").count() == df.where("k IS NULL").count()


@pytest.fixture(scope="module")
def features(spark):
    """Target depends on x; some cells and categories are missing; the last year has no target."""
    df = spark.range(1200).select(
        F.concat(F.lit("e"), F.col("id") % 60).alias("entity"),
        (F.floor(F.col("id") / 60) + 100).cast("int").alias("q_ord"),
        (F.col("id") * 37 % 101 / 10).alias("PriceAvg"),
        F.when(F.col("id") % 17 > 0, F.col("id") * 53 % 97 / 10).alias("x"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 31 % 13).alias("z z"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("it's "), F.col("id") % 4)).alias("Industry"))
    target = F.when(F.col("q_ord") < 116, F.coalesce("x", F.lit(5.0)) * 3 + F.col("q_ord") % 3)
    return session.written(df.withColumn(TARGET, target), "features")


@pytest.mark.parametrize("settings", [
    Settings(model="linear"),
    Settings(model="linear", one_hot_encode=True, scale_numerics=True, extract_outliers=True),
    Settings(model="shallow_trees", n_estimators=8),
    Settings(model="boosted_trees", n_estimators=8, max_depth=3),
    Settings(model=training.linear),
], ids=["linear", "prepared", "shallow", "boosted", "own"])
def test_fit_save_and_predict(spark, features, settings):
    labelled, candidates = labelled_and_candidates(features)
    fitted = training.fit(labelled, settings)
    errors = fitted.metrics.first()
    assert 0 <= errors.mae < 6 and abs(errors.rmse ** 2 - errors.mse) < 1e-6
    assert fitted.errors.count() == fitted.scored.count() == int(labelled.count() * 0.2)
    importance = fitted.importance.collect()
    assert len(importance) == len(fitted.inputs)
    path = session.fresh_path(spark, "model")
    fitted.save(path)
    first = training.predict(fitted.pipeline, candidates)
    second = training.predict(training.load_pipeline(path), candidates)
    assert first.count() == candidates.count() and first.exceptAll(second).isEmpty()
    assert first.columns == ["entity", "q_ord", TARGET]


def test_purged_rows_do_not_look_past_the_quarter(features):
    rows = training.training_rows(features, 112, Settings(training_quarters=6))
    assert {r.q_ord for r in rows.select("q_ord").distinct().collect()} == {106, 107, 108}
    all_rows = training.training_rows(features, 112, Settings(training_quarters=6, purge=False))
    assert {r.q_ord for r in all_rows.select("q_ord").distinct().collect()} == set(range(106, 112))


def test_price_adjustment(spark):
    predictions = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 10.0), ("c", 1, 10.0)],
                                        f"entity string, q_ord int, {TARGET} double")
    candidates = spark.createDataFrame([("a", 1, 100.0), ("b", 1, 50.0), ("c", 1, 0.0)],
                                       "entity string, q_ord int, PriceAvg double")
    latest = spark.createDataFrame([("a", 104.0), ("c", 1.0)],
                                   "entity string, CurrentPrice double")
    done = training.adjust_for_price(predictions, candidates, latest)
    assert {r.entity: r[TARGET] for r in done.collect()} == {"a": 6.0, "b": 10.0, "c": 10.0}


def test_recommendation_and_walk_forward(spark, features):
    settings = Settings(model="linear", n_to_buy=3, horizon=2)
    prices = spark.createDataFrame([("e1", date(2020, 1, 1), 3.0)],
                                   "entity string, date date, close double")
    _, best = walk.recommend(features, prices, date(2020, 1, 2), 116, 120, settings)
    assert best.count() == 3
    picks = walk.walk_forward_picks(features, 105, 108, settings)
    rows = {(r.q_ord, r["rank"]): r.entity for r in picks.collect()}
    assert set(rows) == {(q, i) for q in range(105, 109) for i in (1, 2, 3)}
    again = walk.walk_forward_picks(features, 105, 108, settings)
    assert {(r.q_ord, r["rank"]): r.entity for r in again.collect()} == rows
    panel = features.select("entity", "q_ord", F.lit(0.1).alias("Q_Delta_PriceAvg"))
    done = walk.walk_forward(features, panel, 105, 108, settings)
    assert [r.value for r in done.orderBy("q_ord").collect()] == [
        1000.0, 1050.0, 1155.0, 1270.5, 1397.55]
    # Without rows to learn from nothing is bought.
    assert walk.walk_forward_picks(features, 100, 103, settings).isEmpty()


def test_trees_take_more_categories_than_the_default_bins(spark):
    rows = spark.range(400).selectExpr(
        "concat('e', id) AS entity", "8080 AS q_ord", "CAST(2020 AS INT) AS fy",
        "concat('industry ', id % 60) AS Industry", "CAST(id AS DOUBLE) AS x",
        "10.0D AS PriceAvg", "CAST(id % 60 AS DOUBLE) AS goal")
    settings = Settings(target="goal", model="shallow_trees", n_estimators=2, one_hot_encode=False)
    assert training.fit(rows, settings).scored.count() > 0


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", ["train_predict", "train_metrics", "feature_importance",
                                  "recommendation", "walk_forward"])
def test_model_queries_learn_from_the_whole_feature_table(spark, monkeypatch, name):
    """All columns, 100 trees of the default depth, all quarters that can be learnt from."""
    def stop(*args, **kw):
        raise Asked(*args)

    monkeypatch.setattr(model_queries.training, "fit", stop)
    monkeypatch.setattr(model_queries.walk, "recommend", stop)
    monkeypatch.setattr(model_queries.walk, "walk_forward", stop)
    with pytest.raises(Asked) as asked:
        getattr(model_queries, name)(spark, SMOKE)
    rows, settings = asked.value.args[0], asked.value.args[-1]
    whole = model_queries.feature_rows(spark, SMOKE)
    assert {*rows.columns, "PriceAvg"} == {*whole.columns}
    assert (settings.n_estimators, settings.max_depth) == (100, 5)
    assert settings.model == ("shallow_trees" if name == "train_metrics" else "boosted_trees")
    if name == "walk_forward":
        start, end = asked.value.args[2:4]
        known = {r.q_ord for r in rows.where(f"{settings.target} IS NOT NULL").collect()}
        assert start == min(known) + settings.horizon
        assert end == max(r.q_ord for r in rows.select("q_ord").collect()) > max(known)


@pytest.mark.parametrize("rows", [1, 3, 8])
def test_trees_learn_from_fewer_rows_than_categories(spark, rows):
    df = spark.createDataFrame([(f"e{i}", 100, f"kind {i}", float(i), float(i)) for i in range(rows)],
                               f"entity string, q_ord int, Industry string, x double, {TARGET} double")
    fitted = training.fit(df, Settings(n_estimators=2), stored=True)
    assert training.predict(fitted.pipeline, df.drop(TARGET)).count() == rows


def test_trees_make_their_vectors_once(spark):
    """Bins, split points and the two sides of the hold-out all come from the same kept vectors."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(i):
        made.add(1)
        return float(i * 37 % 101)

    rows = spark.range(300).select(
        F.concat(F.lit("e"), "id").alias("entity"), F.lit(100).alias("q_ord"),
        counted.asNondeterministic()("id").alias("x"), (F.col("id") % 7).cast("double").alias(TARGET))
    training.fit(rows, Settings(n_estimators=3, max_depth=2), stored=True)
    assert 300 <= made.value < 2 * 300


TREES = Settings(n_estimators=4, max_depth=3, n_to_buy=5, horizon=2)


def test_windows_share_one_number_vector(spark, features, monkeypatch):
    """Every window learns from numbers that were put into a vector once, and picks as from columns."""
    seen = []
    fit_marked = training.fit_marked

    def fit(rows, settings):
        fitted = fit_marked(rows, settings)
        seen.append((set(rows.columns), fitted.inputs))
        return fitted

    monkeypatch.setattr(walk, "fit_marked", fit)
    picks = {(r.q_ord, r["rank"]): (r.entity, r[TARGET])
             for r in walk.walk_forward_picks(features, 106, 109, TREES).collect()}
    monkeypatch.undo()
    expected = {}
    for quarter in range(106, 110):
        fitted = training.fit(features.drop("PriceAvg"), TREES, quarter)
        scored = training.predict(
            fitted.pipeline, features.where(F.col("q_ord") == quarter).drop(TARGET, "PriceAvg"))
        for r in walk.top_n_per_quarter(scored, 5, TARGET).collect():
            expected[r.q_ord, r["rank"]] = (r.entity, r[TARGET])
        assert all(inputs == fitted.inputs for _, inputs in seen)
    assert len(picks) == 20 and picks == expected
    assert len(seen) == 4
    for columns, _ in seen:
        assert training.NUMBERS in columns and not columns & {"x", "z z"}


def test_numbers_that_a_fit_changes_stay_columns(spark, features):
    for settings in (Settings(scale_numerics=True), Settings(extract_outliers=True),
                     Settings(model=training.linear)):
        assert training.with_number_vector(features, settings).columns == features.columns
    assert walk.walk_forward_picks(features, 106, 107, Settings(
        n_estimators=2, max_depth=2, n_to_buy=3, scale_numerics=True, one_hot_encode=True)).count() == 6


def test_nan_ends_only_the_windows_that_use_it(spark, features):
    bad = features.withColumn("x", F.when(F.col("q_ord") == 108, F.lit(float("nan"))).otherwise(F.col("x")))
    assert walk.walk_forward_picks(bad, 106, 107, TREES).count() == 10
    with pytest.raises(Exception, match="NaN"):
        walk.walk_forward_picks(bad, 108, 108, TREES).count()
