"""Look-back and look-ahead over an entity's quarters.

All windows share one specification, so change columns, future price and dividend sums cost one
exchange and one sort. A panel has one row per entity and quarter: a window group is bounded by
the number of quarters, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.names import (
    ENTITY, Q_ORD, QUARTER_PREFIX, TARGET, VERSUS, YEAR_PREFIX,
)
from quarterdeck.functions.ratios import quoted, ratio


def by_quarter():
    return Window.partitionBy(ENTITY).orderBy(Q_ORD)


def change_prefix(quarters: int) -> str:
    return YEAR_PREFIX if quarters == 4 else QUARTER_PREFIX


def add_changes(df: DataFrame, columns: Sequence[str], quarters: Sequence[int] = (1, 4),
                calendar: bool = False, dropna: bool = False) -> DataFrame:
    """Relative change against the row ``n`` places earlier, missing values filled forward.

    ``calendar=True`` compares with the row exactly ``n`` quarters earlier instead, and is null
    where that quarter has no row.
    """
    w = f"PARTITION BY {ENTITY} ORDER BY {Q_ORD}"
    filled = {c: quoted(f"__filled_{c}") for c in columns}
    base = df.selectExpr("*", *[
        f"last({quoted(c)}, true) OVER ({w} ROWS UNBOUNDED PRECEDING) AS {filled[c]}"
        for c in columns])

    def earlier(c: str, n: int) -> str:
        if calendar:
            return f"first({filled[c]}) OVER ({w} RANGE BETWEEN {n} PRECEDING AND {n} PRECEDING)"
        return f"lag({filled[c]}, {n}) OVER ({w})"

    changes = {f"{change_prefix(n)}{c}": f"{ratio(filled[c], earlier(c, n))} - 1D"
               for n in quarters for c in columns}
    result = base.selectExpr(*map(quoted, df.columns),
                             *[f"{text} AS {quoted(name)}" for name, text in changes.items()])
    return result.dropna(subset=list(changes)) if dropna else result


def value_ahead(column: str, quarters: int, calendar: bool = False) -> Column:
    """The value ``quarters`` rows (or exactly that many quarters) later."""
    w = by_quarter()
    if calendar:
        return F.first(column).over(w.rangeBetween(quarters, quarters))
    return F.lead(column, quarters).over(w)


def sum_ahead(column: str, quarters: int, calendar: bool = False) -> Column:
    """Sum over the current row and the ``quarters - 1`` following; 0 when all are missing."""
    w = by_quarter()
    frame = w.rangeBetween(0, quarters - 1) if calendar else w.rowsBetween(0, quarters - 1)
    return F.coalesce(F.sum(column).over(frame), F.lit(0.0))


def add_target(df: DataFrame, quarters: int = 4, include_dividends: bool = True,
               calendar: bool = False, target: str = TARGET) -> DataFrame:
    """Forward return in percent, rounded half-even to two digits."""
    future = value_ahead("PriceAvg", quarters, calendar)
    if include_dividends:
        future = future + sum_ahead("DividendPerShare", quarters, calendar)
    with_future = df.withColumn("__future", future)
    price = F.col("PriceAvg")
    appreciation = F.try_divide((F.col("__future") - price) * 100.0, price)
    return with_future.withColumn(target, F.bround(appreciation, 2)).drop("__future")


def add_index_comparison(df: DataFrame, index_panel: DataFrame, symbols: Sequence[str],
                         columns: Sequence[str], dropna: bool = False) -> DataFrame:
    """``column / index column`` of the same quarter for every index and column.

    The index panel is first folded to one row per quarter. Quarters come from dates, of which
    the calendar has fewer than 40,000, so that table is broadcast whatever the panel's size and
    no quarter, however crowded, is shuffled. An unknown symbol gives null.
    """
    names = {(s, c): f"{c}{VERSUS}{s}" for s in symbols for c in columns}
    slots = {pair: f"__index_{i}" for i, pair in enumerate(names)}
    per_quarter = (
        index_panel.where(F.col(ENTITY).isin(*symbols))
        .groupBy(Q_ORD)
        .agg(*[F.max(F.when(F.col(ENTITY) == s, F.col(c))).alias(slots[s, c])
               for s, c in names]))
    joined = df.join(F.broadcast(per_quarter), Q_ORD, "left")
    result = joined.selectExpr(*map(quoted, df.columns), *[
        f"{ratio(quoted(c), slots[s, c])} AS {quoted(name)}" for (s, c), name in names.items()])
    return result.dropna(subset=list(names.values())) if dropna else result
