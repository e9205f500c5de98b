"""All dated events of an entity on one time axis, summed to its fiscal quarters.

Statements, dividends, splits, prices and ratings are brought to one narrow row per entity, day and item,
price or firm first, so an entity with a third of all events is no hot key; then every entity's rows are
hashed to one place once, and labels, windows and quarters are all found there, without a join. Prices and
ratings need no more than the entity's first quarter end, by which they are summed to windows; only what is
left is sorted by day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.cells import grade_score, scores_to_json, without_blanks
from quarterdeck.functions.names import (
    ENTITY, GRADE_SCORES, KEY, Q_ORD, QUARTER_DAYS, STATEMENT_ITEMS)
from quarterdeck.functions.periods import fiscal_ordinal

_PRICES = ("PriceAvg", "PriceLow", "PriceHigh", "PriceEoQ", "Volume")
# Kinds of daily rows: statement items, dividends and splits; prices; ratings by firm.
_DAY, _PRICE, _RATING = range(3)


def daily_events(statements: Sequence[DataFrame], dividends: DataFrame, splits: DataFrame,
                 prices: DataFrame, ratings: DataFrame, end: date, items: Sequence[str],
                 scores: Mapping[str, int]) -> DataFrame:
    """One row per entity, day, kind and name, the item of a statement or the firm of a rating. Prices and
    ratings from ``end`` on do not count; of several prices of a day the highest is the last, of several
    splits the largest counts. A rating without a firm counts for none."""
    before_end = F.col("date") < F.lit(end)
    score = grade_score(F.col("grade"), scores)
    firms = (ratings.where(before_end & F.col("firm").isNotNull())
             .groupBy(ENTITY, "date", without_blanks(F.col("firm")).alias("name"))
             .agg(F.sum(score).cast("double").alias("sum"), F.count(score).alias("n"))
             .withColumn("kind", F.lit(_RATING)))
    day = [ENTITY, "date", F.lit(_DAY).alias("kind")]
    parts = [s.where(F.col("item").isin(*items)).select(*day, F.col("item").alias("name"), "value")
             for s in statements]
    priced = F.col("close").isNotNull() | F.col("volume").isNotNull()
    parts += [dividends.select(*day, "dividend"), splits.select(*day, "split"),
              prices.where(before_end & priced).select(
                  ENTITY, "date", F.lit(_PRICE).alias("kind"), "close", "volume")]
    events = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return events.groupBy(ENTITY, "date", "kind", "name").agg(
        F.max("value").alias("value"), F.sum("dividend").alias("dividend"),
        F.max("split").alias("factor"), F.sum("close").alias("sum"), F.count("close").alias("n"),
        F.min("close").alias("low"), F.max("close").alias("high"),
        F.max_by("volume", "close").alias("volume")).unionByName(firms, allowMissingColumns=True)


def _last_scores(marks: Column) -> Column:
    """The scores by firm of the last window of these (in, firm, score), as a JSON cell; null where there
    are none."""
    last = F.array_max(F.transform(marks, lambda m: m["in"]))
    own = F.filter(marks, lambda m: m["in"] == last)
    return F.when(F.size(marks) > 0, scores_to_json(
        F.transform(own, lambda m: F.struct(m["firm"].alias("firm"), m["score"].alias("score")))))


def quarters_of_events(daily: DataFrame, end: date, items: Sequence[str] = STATEMENT_ITEMS,
                       days: int = QUARTER_DAYS) -> DataFrame:
    """One row per entity and fiscal quarter that has a statement, from ``daily_events``.

    Of several statements in a quarter the newest counts; its date is the quarter's end. Dividends
    belong to the first end strictly after them, those of the oldest quarter reach back ``days`` - 1. A
    split counts if it lies less than ``days`` before an end. Windows of ``days`` count from ``days`` before
    the entity's first end; one belongs to the quarter of its last day, the later of two. Price windows end
    before ``end``, rating windows may end on it. Rows with Q_ORD given (no day) are joined to their
    quarter, rows with neither to all of the entity's.
    """
    extra = [c for c in daily.columns if c in ("Earnings", "MarketCap")]
    given = F.col(Q_ORD) if Q_ORD in daily.columns else F.lit(None).cast("int")
    is_day, is_price, is_rating = (F.col("kind") == kind for kind in (_DAY, _PRICE, _RATING))
    entity = Window.partitionBy(ENTITY)
    # Labels ascend with days: the first end is the last day of the first label.
    label = F.when(is_day & F.col("name").isNotNull(), fiscal_ordinal(F.col("date")))
    axis = (daily.repartition(ENTITY).withColumn("day", F.unix_date("date")).withColumn("label", label)
            .withColumn("start", -F.min(F.when(F.col("label").isNotNull(), F.struct(
                "label", (-F.col("day")).alias("back")))).over(entity)["back"] - days))
    if "MarketCap" in extra:
        axis = axis.withColumn("MarketCap", F.max("MarketCap").over(entity))

    def window_end(bucket: Column) -> Column:
        return F.date_from_unix_date((F.col("start") + (bucket + 1) * days).cast("int"))

    bucket = F.floor((F.col("day") - F.col("start")) / days).cast("int")
    counts = (bucket >= 0) & ((is_price & (window_end(bucket) < F.lit(end)))
                              | (is_rating & (window_end(bucket) <= F.lit(end))))
    place = F.when(is_day, F.col("day")).when(F.col("kind").isNull(), given).otherwise(bucket)
    axis = (axis.where(is_day | counts | (F.col("kind").isNull() & given.isNotNull()))
            .groupBy(ENTITY, "kind", place.alias("place"), F.when(is_rating, F.col("name")).alias("firm"))
            .agg(F.max("start").alias("start"), F.max("label").alias("label"),
                 # One column that other kinds leave empty.
                 F.when(is_day, F.struct(*[F.max(F.when(F.col("name") == i, F.col("value"))).alias(i)
                                           for i in items])).alias("items"),
                 F.sum("dividend").alias("dividend"), F.max("factor").alias("factor"),
                 F.try_divide(F.sum("sum"), F.sum("n")).alias("PriceAvg"),
                 F.min("low").alias("PriceLow"), F.max("high").alias("PriceHigh"),
                 F.max_by("high", "day").alias("PriceEoQ"), F.max_by("volume", "day").alias("Volume"),
                 *[F.max(c).alias(c) for c in extra])
            .withColumn("day", F.when(is_day, F.col("place"))))
    by_day = Window.partitionBy(ENTITY, "kind").orderBy(F.col("day").desc())
    later = by_day.rowsBetween(Window.unboundedPreceding, -1)
    axis = (axis.withColumn("next_label", F.last("label", ignorenulls=True).over(later))
            # Back in time, the days before a day follow it.
            .withColumn("Split", F.first("factor", ignorenulls=True).over(by_day.rangeBetween(1, days - 1)))
            .withColumn("is_end", F.col("label").isNotNull() & ~F.col("label").eqNullSafe(F.col("next_label")))
            .withColumn("next", F.last(F.when(F.col("is_end"), F.struct("day", "label")),
                                       ignorenulls=True).over(later)))
    paid = F.col("dividend").isNotNull() & F.col("next").isNotNull() & (
        (F.col("day") >= F.col("start") + days) | (F.col("next")["day"] - F.col("day") < days))

    def to(part: str, when: Column, quarter: Column) -> Column:
        return F.when(when, F.struct(F.lit(part).alias("part"), quarter.alias(Q_ORD)))

    ended = fiscal_ordinal(window_end(F.col("place")))
    targets = [to("end", F.col("is_end"), F.col("label")), to("paid", paid, F.col("next")["label"]),
               to("price", is_price, ended), to("rating", is_rating, ended),
               to("given", F.col("kind").isNull(), F.col("place"))]
    placed = axis.select("*", F.inline(F.array_compact(F.array(*targets))))
    of = lambda part, c: F.when(F.col("part") == part, c)
    mark = F.struct(F.col("place").alias("in"), "firm", F.col("PriceAvg").alias("score"))
    own = ["day", "items", "Split", *[c for c in extra if c == "MarketCap"]]
    return (placed.groupBy(*KEY).agg(
        F.max(of("end", F.struct(*own))).alias("end"),  # one row
        *[F.max(of("given", F.col(c))).alias(c) for c in extra if c == "Earnings"],
        F.coalesce(F.sum(of("paid", F.col("dividend"))), F.lit(0.0)).alias("DividendPerShare"),
        F.max_by(F.struct(*_PRICES), of("price", F.col("place"))).alias("prices"),
        _last_scores(F.collect_list(of("rating", mark))).alias("AvgRecommendations"))
        .where(F.col("end").isNotNull())
        .select(*KEY, F.date_from_unix_date("end.day").alias("date"),
                *[F.col("end")["items"][i].alias(i) for i in items], "DividendPerShare", "end.Split",
                *[c if c == "Earnings" else f"end.{c}" for c in extra],
                *[F.col("prices")[c].alias(c) for c in _PRICES], "AvgRecommendations"))
