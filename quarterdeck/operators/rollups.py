"""Dated events rolled up to windows or quarters.

Events are aggregated before they are shuffled wherever the operator allows it, so an entity that
owns a third of all events reaches its reducer as at most one row per day or window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.cells import grade_score, scores_to_json, without_blanks
from quarterdeck.functions.names import ENTITY, GRADE_SCORES, KEY, QUARTER_DAYS
from quarterdeck.functions.periods import fiscal_ordinal
from quarterdeck.operators.merging import keep_one


def price_aggregates(moment: Column) -> list[Column]:
    """Mean, low and high close, last close and last volume of a group of prices. Of several prices of
    the last moment the highest is the last."""
    last = F.struct(moment, "close")
    return [F.avg("close").alias("PriceAvg"), F.min("close").alias("PriceLow"),
            F.max("close").alias("PriceHigh"), F.max_by("close", last).alias("PriceEoQ"),
            F.max_by("volume", last).alias("Volume")]


def _daily(prices: DataFrame) -> DataFrame:
    """One row per entity and day, so that an entity with many prices is no hot key. Of several prices of
    a day the highest is the last."""
    return prices.groupBy(ENTITY, "date").agg(
        F.sum("close").alias("sum"), F.count("close").alias("n"), F.min("close").alias("low"),
        F.max("close").alias("high"), F.max_by("volume", "close").alias("volume"))


def _of_days() -> list[Column]:
    """The same as ``price_aggregates`` from daily rows."""
    return [F.try_divide(F.sum("sum"), F.sum("n")).alias("PriceAvg"),
            F.min("low").alias("PriceLow"), F.max("high").alias("PriceHigh"),
            F.max_by("high", "date").alias("PriceEoQ"), F.max_by("volume", "date").alias("Volume")]


def _windows(start: date, end: date, days: int, inclusive: bool) -> int:
    """How many windows of ``days`` end before (or on) ``end``."""
    span = (end - start).days
    return max(0, span // days if inclusive else (span - 1) // days)


def _window_bucket(start: date, days: int) -> Column:
    return F.floor(F.datediff(F.col("date"), F.lit(start)) / days).cast("int")


def _window_end(start: Column, bucket: Column, days: int) -> Column:
    return F.date_add(start, ((bucket + 1) * days).cast("int"))


def price_rollup(prices: DataFrame, start: date, end: date,
                 days: int = QUARTER_DAYS) -> DataFrame:
    """Daily prices (entity, date, close, volume) -> consecutive windows of ``days`` from
    ``start``, dated at their end. Only windows that end before ``end`` count, empty ones are
    absent. The date bounds are constants and reach the scan."""
    last = start + timedelta(days=days * _windows(start, end, days, inclusive=False))
    bucket = _window_bucket(start, days)
    return (_daily(prices.where((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(last))))
            .groupBy(ENTITY, bucket.alias("bucket"))
            .agg(*_of_days())
            .withColumn("date", _window_end(F.lit(start), F.col("bucket"), days))
            .drop("bucket"))


def price_rollup_from(prices: DataFrame, starts: DataFrame, end: date,
                      days: int = QUARTER_DAYS) -> DataFrame:
    """The same with a start per entity (entity, start), which daily rows meet."""
    bucket = F.floor(F.datediff(F.col("date"), F.col("start")) / days).cast("int")
    daily = _daily(prices.where(F.col("date") < F.lit(end)))
    return (daily.join(starts, ENTITY)
            .where(F.col("date") >= F.col("start"))
            .groupBy(ENTITY, "start", bucket.alias("bucket"))
            .agg(*_of_days())
            .withColumn("date", _window_end(F.col("start"), F.col("bucket"), days))
            .where(F.col("date") < F.lit(end))
            .drop("start", "bucket"))


def label_windows(windows: DataFrame) -> DataFrame:
    """Fiscal quarter of each window by its end date; two windows that end in one quarter keep
    the later one."""
    labelled = windows.withColumn("q_ord", fiscal_ordinal(F.col("date")))
    return keep_one(labelled, KEY, [F.col("date").desc()])


def _firm_means(recs: DataFrame, bucket: Column, keys: Sequence[str],
                scores: Mapping[str, int]) -> DataFrame:
    """Mean score by firm; a rating without a firm counts for none, as in a grouping by firm."""
    return (recs.where(F.col("firm").isNotNull()).groupBy(*keys, bucket.alias("bucket"),
                         without_blanks(F.col("firm")).alias("firm"))
            .agg(F.avg(grade_score(F.col("grade"), scores)).alias("score")))


def recommendation_rollup(recs: DataFrame, start: date, end: date, days: int = QUARTER_DAYS,
                          collapse: bool = True, firms: Sequence[str] | None = None,
                          scores: Mapping[str, int] = GRADE_SCORES) -> DataFrame:
    """Analyst grades (entity, date, firm, grade) -> mean score per firm and window.

    Collapsed, a window's firms become one JSON object; otherwise each of ``firms`` gets a
    column. Windows that end on ``end`` still count. Only one number per firm and window is left
    when a window's scores are gathered into its cell.
    """
    last = start + timedelta(days=days * _windows(start, end, days, inclusive=True))
    means = _firm_means(
        recs.where((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(last))),
        _window_bucket(start, days), [ENTITY], scores)
    return _gather_firms(means, F.lit(start), [ENTITY], days, collapse, firms)


def recommendation_rollup_from(recs: DataFrame, starts: DataFrame, end: date,
                               days: int = QUARTER_DAYS, collapse: bool = True,
                               firms: Sequence[str] | None = None,
                               scores: Mapping[str, int] = GRADE_SCORES) -> DataFrame:
    """Both forms with a start per entity (entity, start). Ratings are summed per entity, day and
    firm before they meet the starts."""
    bucket = F.floor(F.datediff(F.col("date"), F.col("start")) / days).cast("int")
    score = grade_score(F.col("grade"), scores)
    daily = (recs.where((F.col("date") < F.lit(end)) & F.col("firm").isNotNull())
             .groupBy(ENTITY, "date", without_blanks(F.col("firm")).alias("firm"))
             .agg(F.sum(score).alias("sum"), F.count(score).alias("n")))
    means = (daily.join(starts, ENTITY).where(F.col("date") >= F.col("start"))
             .groupBy(ENTITY, "start", bucket.alias("bucket"), "firm")
             .agg(F.try_divide(F.sum("sum"), F.sum("n")).alias("score")))
    windows = _gather_firms(means, F.col("start"), [ENTITY, "start"], days, collapse, firms)
    return windows.where(F.col("date") <= F.lit(end)).drop("start")


def _gather_firms(means: DataFrame, start: Column, keys: Sequence[str], days: int,
                  collapse: bool, firms: Sequence[str] | None) -> DataFrame:
    groups = means.groupBy(*keys, "bucket")
    if collapse:
        entries = F.collect_list(F.struct("firm", "score"))
        result = groups.agg(scores_to_json(entries).alias("AvgRecommendations"))
    else:
        if firms is None:
            raise ValueError("name the firms that become columns")
        result = groups.pivot("firm", [f.replace(" ", "") for f in firms]).agg(F.max("score"))
    return (result.withColumn("date", _window_end(start, F.col("bucket"), days))
            .drop("bucket"))


def _timeline(quarter_ends: DataFrame, daily: DataFrame) -> DataFrame:
    """Quarter ends and daily events of an entity on one time axis ``__day``; ``__end`` holds a
    quarter end's columns and is null for an event.

    An entity has at most one event row per calendar day here, so the windows over it are bounded
    however many events it had.
    """
    day = F.unix_date(F.col("quarter_end")).alias("__day")
    ends = quarter_ends.select(ENTITY, day, F.struct(*quarter_ends.columns).alias("__end"))
    events = daily.withColumn("__day", F.unix_date(F.col("date"))).drop("date")
    return ends.unionByName(events, allowMissingColumns=True)


def _carried(quarter_ends: DataFrame, struct: str) -> list[Column]:
    """The quarter end's columns; the entity is the row's own, by which rows are partitioned."""
    return [F.col(c) if c == ENTITY else F.col(struct)[c].alias(c) for c in quarter_ends.columns]


def splits_per_quarter(quarter_ends: DataFrame, splits: DataFrame,
                       combine: str = "last") -> DataFrame:
    """Split within the 91 days before a quarter end, both borders excluded, else null.

    ``quarter_ends`` has (entity, quarter_end) and may have more (narrow) columns, ``splits``
    (entity, date, split). Of several splits the last one counts; ``combine="product"``
    multiplies them instead.
    """
    if combine not in ("last", "product"):
        raise ValueError(f"unknown combine {combine!r}")
    last = combine == "last"
    daily = (splits.groupBy(ENTITY, "date")
             .agg((F.max("split") if last else F.product("split")).alias("__split")))
    before = (Window.partitionBy(ENTITY).orderBy("__day").rangeBetween(1 - QUARTER_DAYS, -1))
    found = F.last("__split", ignorenulls=True) if last else F.product("__split")
    return (_timeline(quarter_ends, daily)
            .withColumn("Split", found.over(before))
            .where(F.col("__end").isNotNull())
            .select(*_carried(quarter_ends, "__end"), "Split"))


def dividends_per_quarter(quarter_ends: DataFrame, dividends: DataFrame) -> DataFrame:
    """Sum of the dividends of each quarter, 0 where there are none.

    An event belongs to the first quarter end strictly after it; the oldest quarter reaches back
    91 days. An event on the newest quarter end therefore belongs to no quarter. The columns of
    ``quarter_ends`` are carried along and should be narrow.
    """
    daily = (dividends.groupBy(ENTITY, "date")
             .agg(F.sum("dividend").alias("__dividend")))
    # Back in time, an event before a quarter end of the same day.
    back = (Window.partitionBy(ENTITY).orderBy(F.col("__day").desc(), F.col("__end").isNotNull())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end_day = F.when(F.col("__end").isNotNull(), F.col("__day"))
    placed = (_timeline(quarter_ends, daily)
              .withColumn("__next", F.last("__end", ignorenulls=True).over(back))
              .withColumn("__next_day", F.last(end_day, ignorenulls=True).over(back))
              .withColumn("__oldest", F.min(end_day).over(Window.partitionBy(ENTITY))))
    inside = ((F.col("__day") >= F.col("__oldest"))
              | (F.col("__next_day") - F.col("__day") < QUARTER_DAYS))
    return (placed.where(F.col("__next").isNotNull() & inside)
            .select(*_carried(quarter_ends, "__next"), "__dividend")
            .groupBy(*quarter_ends.columns)
            .agg(F.coalesce(F.sum("__dividend"), F.lit(0.0)).alias("DividendPerShare")))


def latest_price(prices: DataFrame, as_of: date, days: int = 5) -> DataFrame:
    """Last close per entity within ``days`` up to ``as_of``; of several of a day the highest."""
    since = as_of - timedelta(days=days)
    return (prices.where((F.col("date") >= F.lit(since)) & (F.col("date") <= F.lit(as_of)))
            .groupBy(ENTITY)
            .agg(F.max_by("close", F.struct("date", "close")).alias("CurrentPrice")))
