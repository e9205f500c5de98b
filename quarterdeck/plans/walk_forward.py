"""Recommendation and walk-forward back-test."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from itertools import takewhile

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from quarterdeck.functions.names import KEY, Q_ORD
from quarterdeck.functions.periods import fiscal_year
from quarterdeck.operators.backtest import portfolio_values
from quarterdeck.operators.encoding import hold_out_limits, key_hash
from quarterdeck.operators.filters import between_quarters
from quarterdeck.operators.ranking import top_n, top_n_per_quarter
from quarterdeck.operators.rollups import latest_price
from quarterdeck.plans.features import labelled_and_candidates
from quarterdeck.plans.linear_windows import linear_windows, predict_windows, summable
from quarterdeck.plans.settings import Settings
from quarterdeck.plans.training import (
    HASH, HELD_OUT, Fitted, adjust_for_price, fit, fit_marked, predict, training_rows, training_window,
    with_number_vector)
from quarterdeck.session import fresh_path, written


def recommend(features: DataFrame, prices: DataFrame, today: date, first_quarter: int,
              last_quarter: int, settings: Settings = Settings(),
              ) -> tuple[Fitted, DataFrame]:
    """(model, the best candidates of ``first_quarter <= q_ord < last_quarter``)."""
    labelled, candidates = labelled_and_candidates(written(features, "features"), settings)
    fitted = fit(labelled, settings, last_quarter, stored=True)
    recent = between_quarters(candidates, first_quarter, last_quarter)
    scored = predict(fitted.pipeline, recent, settings.target)
    if settings.adjust_for_current_price:
        scored = adjust_for_price(scored, recent, latest_price(prices, today), settings.target)
    return fitted, top_n(scored, settings.n_to_buy, settings.target)


def walk_forward_picks(features: DataFrame, start: int, end: int,
                       settings: Settings = Settings()) -> DataFrame:
    """Ranked picks of every quarter, each from a model that saw only the quarters before it.

    Features are written once, with the hash that chooses the rows to hold out; one histogram of it
    gives the limits of all windows. Linear models of all quarters come from sums by quarter, in one reading
    (``linear_windows``). Other models are fitted some at a time, as no quarter needs another's, each from
    its window of partitions, where the numbers that trees learn from are one vector already; the picks are written, so that they do not drag the model that made them
    through the rest of the run. Quarters end at the first one without training rows or candidates.
    """
    spark = features.sparkSession
    stored, picks = fresh_path(spark, "features"), fresh_path(spark, "picks")
    rows = (features.withColumn("fy", fiscal_year(F.col(Q_ORD))).withColumn(HASH, key_hash())
            .hint("rebalance", "fy"))
    with_number_vector(rows, settings).write.partitionBy("fy").parquet(stored)
    table = spark.read.parquet(stored).drop("PriceAvg")
    # One row per quarter says which quarters can be predicted and from which one can learn.
    known = {r[Q_ORD]: r["labelled"] for r in table.groupBy(Q_ORD).agg(
        F.count(settings.target).alias("labelled")).collect()}

    def possible(quarter: int) -> bool:
        return quarter in known and any(
            known.get(q) for q in training_window(quarter, settings))

    quarters = list(takewhile(possible, range(start, end + 1)))
    columns = [c for c in table.columns if c in KEY]
    schema = StructType([*table.select(*columns).schema.fields,
                         StructField(settings.target, DoubleType()),
                         StructField("rank", IntegerType())])
    if not quarters:
        return spark.createDataFrame([], schema)
    windows = {q: training_window(q, settings) for q in quarters}
    if summable(settings):
        made, models = linear_windows(table, windows, settings)
        scored = predict_windows(made.rows, models, settings.target)
        return written(top_n_per_quarter(scored, settings.n_to_buy, settings.target), "picks")
    labelled = table.where(F.col(settings.target).isNotNull())
    limits = hold_out_limits(labelled.select(Q_ORD, F.col(HASH).alias("h")), windows,
                             settings.test_size)

    def pick(quarter: int) -> None:
        limit = limits[quarter]
        rows = training_rows(table, quarter, settings)
        fitted = fit_marked(rows.withColumn(
            HELD_OUT, F.col(HASH) <= limit if limit else F.lit(False)), settings)
        candidates = between_quarters(table, quarter, quarter + 1).drop(settings.target)
        scored = predict(fitted.pipeline, candidates, settings.target)
        top_n_per_quarter(scored, settings.n_to_buy, settings.target).write.parquet(
            f"{picks}/bought={quarter}")

    with ThreadPoolExecutor(settings.parallelism) as pool:
        list(pool.map(inheritable_thread_target(spark)(pick), quarters))
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(picks)


def walk_forward(features: DataFrame, panel: DataFrame, start: int, end: int,
                 settings: Settings = Settings(), cash: float = 1000.0) -> DataFrame:
    """Portfolio value by quarter when every quarter's picks are bought and held."""
    picks = walk_forward_picks(features, start, end, settings)
    return portfolio_values(picks, panel, start, end, settings.horizon, cash,
                            settings.allocation)
