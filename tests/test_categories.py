"""Category tables, mean targets and sparse vectors against plain Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarterdeck import session
from quarterdeck.functions.names import TARGET
from quarterdeck.operators import categories
from quarterdeck.plans import training
from quarterdeck.plans.settings import Settings


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 > 0, F.lit("hot")).when(
            F.col("id") % 50 > 0, F.format_string("%05d", F.col("id") * 7919 % 3001)).alias("k"),
        F.concat(F.lit("it's `b` "), F.col("id") % 4).alias("a b"), F.lit(None).cast("string").alias("none"),
        (F.col("id") % 11).cast("double").alias("y"))
    return session.written(df, "rows")


def test_codes_of_all_columns(rows):
    found = categories.sorted_codes(rows, ["k", "a b", "none"]).collect()
    for c in ("k", "a b", "none"):
        values = sorted({r[c] for r in rows.select(F.col(f"`{c}`")).collect()} - {None})
        assert sorted((r.code, r.value) for r in found if r.column == c) == list(enumerate(values))
    assert categories.sorted_codes(rows.limit(0), ["k", "a b"]).isEmpty()


def test_mean_targets(rows):
    found = {(r.column, r.value): r.number for r in categories.mean_targets(rows, ["k", "none"], "y").collect()}
    given = rows.select("k", "y").collect()
    mean = sum(r.y for r in given) / len(given)
    of: dict = {}
    for r in given:
        of.setdefault(r.k, []).append(r.y)
    for value, ys in of.items():
        assert found["k", value] == pytest.approx((sum(ys) + 10 * mean) / (len(ys) + 10))
    assert set(found) == {("k", v) for v in of} | {("none", None)}


def test_vectors_have_a_place_for_each_value_but_the_first(spark, rows):
    columns = ["k", "a b", "none"]
    done, slots = categories.one_hot_vectors(rows, columns, "v")
    meaning = {r.slot: (r.column, r.value) for r in slots.collect()}
    first = {c: min((r[0] for r in rows.select(F.col(f"`{c}`")).distinct().collect() if r[0]), default=None)
             for c in columns}
    own = {r["id"]: {(c, r[c]) for c in columns if r[c] is None or r[c] != first[c]}
           for r in rows.select("id", "k", "`a b`", "none").collect()}
    found = {r["id"]: r.v for r in done.collect()}
    assert sorted(meaning) == list(range(len(meaning))) and done.columns == ["id", "y", "v"]
    for i, v in found.items():
        assert v.size == len(meaning) and list(v.values) == [1.0] * len(v.indices)
        assert {meaning[int(s)] for s in v.indices} == own[i] and list(v.indices) == sorted(v.indices)
    again = {r["id"]: r.places for r in done.select("id", categories.places("v").alias("places")).collect()}
    assert all(list(found[i].indices) == p for i, p in again.items())


@pytest.mark.parametrize("kind", [categories.CODES, categories.MEANS, categories.SLOTS])
def test_new_and_missing_values(spark, rows, kind):
    encoder = categories.fit_encoder(rows.where("k IS NOT NULL"), ["k"], kind, "y")
    new = spark.createDataFrame([("never seen",), (None,)], "k string")
    added = encoder.add(new).collect()
    if kind == categories.SLOTS:
        assert all(not len(r[categories.SLOT_VECTOR].indices) for r in added)
    else:
        assert {r[categories.code_name("k")] for r in added} == {encoder.default}
    path = session.fresh_path(spark, "encoder")
    encoder.save(path)
    loaded = categories.load_encoder(spark, path)
    assert loaded.inputs == encoder.inputs and loaded.names() == encoder.names()
    assert loaded.add(rows).exceptAll(encoder.add(rows)).isEmpty()
    assert categories.fit_encoder(rows, [], kind).add(rows).columns == rows.columns


@pytest.mark.parametrize("extra", [{}, {"numeric_encode_categories": True}], ids=["means", "codes"])
def test_trees_take_fifty_thousand_categories(spark, extra):
    """The target follows the category; nothing of the model grows with their number."""
    df = spark.range(100_000).selectExpr(
        "concat('e', id) AS entity", "8080 AS q_ord", "concat('kind ', lpad(id % 50000, 5, '0')) AS Industry",
        "10.0D AS PriceAvg", f"CAST(id % 50000 >= 25000 AS DOUBLE) * 10 AS {TARGET}")
    settings = Settings(model="shallow_trees", n_estimators=2, **extra)
    fitted = training.fit(df, settings)
    stages = fitted.pipeline.stages.stages
    assert len(fitted.inputs) == 1 and not any("Indexer" in type(s).__name__ for s in stages)
    assert stages[-1].getOrDefault("maxBins") == 32
    # A category has two rows; where both are held out, in one of five, the tree cannot know it.
    assert fitted.metrics.first().mae < 2.5


def test_one_hot_training_has_no_limit_on_categories(spark):
    df = spark.range(3000).selectExpr(
        "concat('e', id) AS entity", "8080 AS q_ord", "concat('kind ', id % 2500) AS Industry",
        "CAST(id % 7 AS DOUBLE) AS x", f"CAST(id % 7 AS DOUBLE) AS {TARGET}")
    fitted = training.fit(df, Settings(model="linear", one_hot_encode=True))
    assert len(fitted.inputs) == len(fitted.importance.collect()) > 1900
    assert any(name.startswith("Industry_kind ") for name in fitted.inputs)
