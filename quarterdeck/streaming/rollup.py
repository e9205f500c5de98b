"""Price rollup over an unbounded price stream."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.names import ENTITY, QUARTER_DAYS
from quarterdeck.operators.rollups import price_aggregates


def stream_price_rollup(prices: DataFrame, start: date, days: int = QUARTER_DAYS,
                        lateness: str = "1 day", time_column: str = "ts",
                        redelivered: bool = False) -> DataFrame:
    """Windows of ``days`` aligned to ``start``, emitted once the watermark passes their end.

    State is one row per entity and open window. With ``redelivered``, a price that comes again within the
    lateness counts once, for which the prices of that time are state, too. Spark aligns windows to 1970-01-01, so the start
    time is the start's offset within a window.
    """
    offset = (start - date(1970, 1, 1)).days % days
    window = F.window(time_column, f"{days} days", startTime=f"{offset} days")
    timed = prices.withWatermark(time_column, lateness)
    if redelivered:
        timed = timed.dropDuplicatesWithinWatermark([ENTITY, time_column, "close", "volume"])
    return (timed
            .groupBy(window.alias("window"), ENTITY)
            .agg(*price_aggregates(F.col(time_column)))
            .withColumn("date", F.to_date(F.col("window.end")))
            .drop("window"))


def open_windows(prices: DataFrame, emitted: DataFrame, start: date, days: int = QUARTER_DAYS,
                 time_column: str = "ts") -> DataFrame:
    """The windows that a stream which has ended left open: all after the last one it ``emitted``, from
    the same prices read as a table, of which only those after that window are read. A price that is
    there more than once counts once."""
    last = emitted.agg(F.max("date")).first()[0]
    if last is not None:
        prices = prices.where(F.col(time_column) >= F.lit(last).cast("timestamp"))
    once = prices.dropDuplicates([ENTITY, time_column, "close", "volume"])
    bucket = F.floor(F.datediff(F.to_date(time_column), F.lit(start)) / days)
    return (once.groupBy(ENTITY, bucket.alias("bucket")).agg(*price_aggregates(F.col(time_column)))
            .withColumn("date", F.date_add(F.lit(start), ((F.col("bucket") + 1) * days).cast("int")))
            .drop("bucket"))
