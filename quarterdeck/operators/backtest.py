"""Value over time of a portfolio that buys ranked picks every quarter and holds them.

Buying and selling with recycled cash has a closed form. With ``h`` quarters of holding and cash
``C``, cohort ``k`` spends ``C / h`` times the returns of the cohorts ``k - h``, ``k - 2h``, ...
(each one's sale pays for the next). The value at quarter ``q`` is the cash not yet spent,
``C * max(0, h - (q - start)) / h``, plus all live cohorts' values. So no quarter waits for the
one before it: everything is joins, running products and sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.names import ENTITY, Q_ORD
from quarterdeck.functions.periods import label
from quarterdeck.operators.membership import key_bitmap, may_contain
from quarterdeck.operators.ranking import add_weights
from quarterdeck.session import written

CHANGE = "Q_Delta_PriceAvg"


def live_cohorts(picks: DataFrame, start: int, end: int) -> DataFrame:
    """(cohort, bought, last): quarters from start up to the first without picks or the end.
    One row per quarter, so its windows are as small as the calendar."""
    spine = picks.sparkSession.range(start, end + 1).select(F.col("id").cast("int").alias("cohort"))
    bought = picks.select(F.col(Q_ORD).cast("int").alias("cohort")).distinct() \
                  .withColumn("bought", F.lit(True))
    every = Window.partitionBy(F.lit(1))
    marked = spine.join(bought, "cohort", "left").fillna({"bought": False})
    last = F.coalesce(F.min(F.when(~F.col("bought"), F.col("cohort"))).over(every), F.lit(end))
    return marked.withColumn("last", last).where(F.col("cohort") <= F.col("last"))


def holding_paths(weighted: DataFrame, panel: DataFrame, cohorts: DataFrame, hold: int,
                  change: str = CHANGE) -> DataFrame:
    """Growth factor of every pick at every age up to the sale.

    A quarter without a panel row makes a holding worthless for good; a row whose change is
    missing makes its value unknown (NaN until the end).
    """
    held = (weighted.select(F.col(Q_ORD).cast("int").alias("cohort"), ENTITY, "weight")
            .join(F.broadcast(cohorts.where("bought").select("cohort", "last")), "cohort")
            .withColumn("age", F.explode(F.sequence(
                F.lit(1), F.least(F.lit(hold), F.col("last") + 1 - F.col("cohort")))))
            .withColumn(Q_ORD, F.col("cohort") + F.col("age")))
    # A bitmap of one size cuts the panel to little more than the holdings before it moves.
    wanted = held.select(ENTITY, Q_ORD).distinct()
    rows = panel.select(ENTITY, F.col(Q_ORD).cast("int").alias(Q_ORD), F.col(change).alias("__change"))
    found = (may_contain(rows, key_bitmap(wanted, [ENTITY, Q_ORD]), [ENTITY, Q_ORD])
             .join(wanted, [ENTITY, Q_ORD])
             .withColumn("__factor", F.coalesce(1.0 + F.col("__change"), F.lit(float("nan")))))
    factor = F.coalesce(F.col("__factor"), F.lit(0.0))
    w = (Window.partitionBy("cohort", ENTITY).orderBy("age")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (held.join(found.select(ENTITY, Q_ORD, "__factor"), [ENTITY, Q_ORD], "left")
            .withColumn("growth", F.product(factor).over(w))
            .select("cohort", ENTITY, "weight", "age", "growth"))


def cohort_paths(paths: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Growth factor of whole cohorts; a last cohort without picks keeps its cash."""
    bought = paths.groupBy("cohort", "age").agg(
        F.sum(F.col("weight") * F.col("growth")).alias("growth"))
    idle = cohorts.where(~F.col("bought")).select(
        "cohort", F.lit(1).alias("age"), F.lit(1.0).alias("growth"))
    return bought.unionByName(idle)


def cohort_amounts(cohorts: DataFrame, growth: DataFrame, hold: int, cash: float) -> DataFrame:
    """Cash each cohort spends."""
    returns = growth.where(F.col("age") == hold).select("cohort", "growth")
    chain = (Window.partitionBy(F.col("cohort") % hold).orderBy("cohort")
             .rowsBetween(Window.unboundedPreceding, -1))
    earned = F.coalesce(F.product("growth").over(chain), F.lit(1.0))
    return (cohorts.join(returns, "cohort", "left")
            .select("cohort", (F.lit(cash / hold) * earned).alias("amount")))


def portfolio_values(picks: DataFrame, panel: DataFrame, start: int, end: int, hold: int = 4,
                     cash: float = 1000.0, allocation: str = "equal",
                     change: str = CHANGE) -> DataFrame:
    """(q_ord, label, value) from the first purchase to one quarter after the last.

    ``picks`` are ranked rows (q_ord, entity, rank), any number a quarter.
    """
    spark = picks.sparkSession
    if start >= end:
        idle = spark.range(start, start + 2).select(F.col("id").cast("int").alias(Q_ORD))
        return idle.select(Q_ORD, label(F.col(Q_ORD)).alias("label"),
                           F.lit(float(cash)).alias("value"))
    inside = picks.where(F.col(Q_ORD).between(start, end))
    # Picks and cohort growth are tiny but stem from the whole panel: each is computed once.
    weighted = written(add_weights(inside, allocation).select(
        Q_ORD, ENTITY, "weight"), "picks")
    cohorts = live_cohorts(weighted, start, end)
    paths = holding_paths(weighted, panel, cohorts, hold, change)
    growth = written(cohort_paths(paths, cohorts), "growth")
    amounts = cohort_amounts(cohorts, growth, hold, cash)
    held = (growth.join(amounts, "cohort")
            .groupBy((F.col("cohort") + F.col("age")).alias(Q_ORD))
            .agg(F.sum(F.col("amount") * F.col("growth")).alias("__held")))
    shown = cohorts.select(F.col("cohort").alias(Q_ORD)).union(
        cohorts.select((F.col("cohort") + 1).alias(Q_ORD))).distinct()
    unspent = F.greatest(F.lit(0), F.lit(hold + start) - F.col(Q_ORD)) * F.lit(cash / hold)
    total = F.round(unspent + F.coalesce(F.col("__held"), F.lit(0.0)), 2)
    return (shown.join(held, Q_ORD, "left")
            .select(Q_ORD, label(F.col(Q_ORD)).alias("label"),
                    F.nanvl(total, F.lit(None).cast("double")).alias("value")))
