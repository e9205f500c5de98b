"""Linear models of many training windows from sums by quarter.

The least squares solution of a window needs the sums of all products of two columns over its rows, and
these add up: they are made once for each quarter, in one reading of the rows, and a window's are the
sums of its quarters'. Each quarter's rows are cut at the hold-out limits of the windows it belongs to, so
that every window leaves out exactly the rows that a fit of its own would hold out.

Columns are shifted and scaled alike for all windows first; least squares gives the same predictions
whatever the scale, and sums of numbers of one size lose fewer digits. Where columns depend on each other
the solution of least length is taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.names import Q_ORD
from quarterdeck.functions.ratios import quoted
from quarterdeck.operators.categories import CODES, fit_encoder
from quarterdeck.operators.encoding import fit_moments, hold_out_limits
from quarterdeck.plans.settings import Settings
from quarterdeck.plans.training import HASH, feature_columns
from quarterdeck.session import written

X = "__x"
#: Sums held by a task before they are passed on, in bytes.
HELD = 64 << 20
_SUMS = "window int, i int, sums array<double>"


def summable(settings: Settings) -> bool:
    """Whether the fit of a window is a function of sums by quarter: rows are not dropped by the bounds of
    their window, and the columns are the same in all windows."""
    return settings.model == "linear" and not (settings.extract_outliers or settings.one_hot_encode)


class Design(NamedTuple):
    """Rows with the array ``X`` of their inputs, and each input's name, shift and scale."""

    rows: DataFrame
    names: list[str]
    shifts: list[float]
    scales: list[float]


def design(rows: DataFrame, settings: Settings) -> Design:
    """Inputs: codes of text columns, numbers with their mean for a missing one, and a flag for each that
    is missing somewhere."""
    text, numbers = feature_columns(rows, settings)
    encoder = fit_encoder(rows, text, CODES)
    coded = encoder.add(rows)
    columns = [*encoder.inputs, *numbers]
    moments = fit_moments(coded, columns)
    missing = coded.agg(*[F.max(F.col(quoted(c)).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    flags = [c for c, found in zip(columns, missing.first()) if found]
    shifts = [moments.mean[c] or 0.0 for c in columns]
    scales = [moments.std[c] or 1.0 for c in columns]

    def scaled(c: str, shift: float, scale: float) -> Column:
        return F.coalesce((F.col(quoted(c)).cast("double") - F.lit(shift)) / F.lit(scale), F.lit(0.0))

    inputs = [*map(scaled, columns, shifts, scales),
              *[F.col(quoted(c)).isNull().cast("double") for c in flags]]
    return Design(written(coded.withColumn(X, F.array(*inputs)).drop(*encoder.inputs), "design"),
                  [*columns, *[f"{c} is missing" for c in flags]],
                  [*shifts, *[0.0] * len(flags)], [*scales, *[1.0] * len(flags)])


def unscaled(models: DataFrame, made: Design) -> DataFrame:
    """The models in terms of the columns as they were."""
    literal = lambda values: F.array(*map(F.lit, values))
    slopes = F.zip_with("coefficients", literal(made.scales), lambda c, scale: c / scale)
    moved = F.aggregate(F.zip_with(slopes, literal(made.shifts), lambda c, shift: c * shift),
                        F.lit(0.0), lambda total, v: total + v)
    return models.withColumns({"coefficients": slopes, "intercept": F.col("intercept") - moved})


def _parts(limits: Mapping[int, str | None], windows: Mapping[int, range]) -> dict[int, list[tuple]]:
    """For each quarter its windows and their limits, from the smallest limit up."""
    of: dict[int, list[tuple]] = {}
    for w, quarters in windows.items():
        for q in quarters:
            of.setdefault(q, []).append((limits[w] or "", w))
    return {q: sorted(found) for q, found in of.items()}


def window_models(rows: DataFrame, windows: Mapping[int, range], settings: Settings) -> DataFrame:
    """(window, rows, intercept, coefficients) of every window with a row to learn from.

    ``rows`` has q_ord, ``X``, the target (rows without one are left out) and ``HASH``, the hash of the key.
    """
    rows = rows.where(F.col(quoted(settings.target)).isNotNull())
    limits = hold_out_limits(rows.select(Q_ORD, F.col(HASH).alias("h")), windows, settings.test_size)
    of_quarter = _parts(limits, windows)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            # A part counts for the windows whose limit is below its rows.
            whole: dict[int, np.ndarray] = {}
            for (quarter, part), total in held.items():
                for _, w in of_quarter[quarter][:part]:
                    whole[w] = whole[w] + total if w in whole else total
            held.clear()
            for w, total in whole.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()),
                     pa.array(list(total), pa.list_(pa.float64()))], names=["window", "i", "sums"])

        for batch in batches:
            if not len(batch):
                continue
            x = batch[X].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            y = batch["y"].to_numpy(zero_copy_only=False)
            z = np.column_stack([np.ones(len(y)), x, y])
            quarter, hashes = batch[Q_ORD].to_numpy(), np.array(batch["h"].to_pylist())
            for q in np.unique(quarter).tolist():
                if q not in of_quarter:
                    continue
                own = np.flatnonzero(quarter == q)
                part = np.searchsorted([limit for limit, _ in of_quarter[q]], hashes[own], side="left")
                for k in np.unique(part).tolist():
                    some = z[own[part == k]]
                    if k:
                        held[q, k] = held.get((q, k), 0.0) + some.T @ some
            if len(held) * z.shape[1] ** 2 * 8 > HELD:
                yield from flush()
        yield from flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            keys = zip(batch["window"].to_pylist(), batch["i"].to_pylist())
            for key, own in zip(keys, batch["sums"]):
                rows_of[key] = rows_of.get(key, 0.0) + own.values.to_numpy()
        if rows_of:
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows_of], pa.int32()), pa.array([i for _, i in rows_of], pa.int32()),
                 pa.array(list(rows_of.values()), pa.list_(pa.float64()))], names=["window", "i", "sums"])

    given = rows.select(Q_ORD, X, F.col(quoted(settings.target)).cast("double").alias("y"),
                        F.col(HASH).alias("h"))

    def solve(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        width = len(found["sums"].iloc[0])
        total = np.zeros((width, width))
        np.add.at(total, found["i"].to_numpy(), np.array(found["sums"].tolist()))
        solved = np.linalg.lstsq(total[:-1, :-1], total[:-1, -1], rcond=1e-11)[0]
        return pd.DataFrame({"window": [key[0]], "rows": [int(round(total[0, 0]))],
                             "intercept": [solved[0]], "coefficients": [solved[1:].tolist()]})

    # Rows of sums are added up before they meet, so that a window's group is one matrix.
    added = given.mapInArrow(sums, _SUMS).repartition("window", "i").mapInArrow(add, _SUMS)
    return (added.groupBy("window")
            .applyInPandas(solve, "window int, rows long, intercept double, coefficients array<double>"))


def predict_windows(rows: DataFrame, models: DataFrame, target: str) -> DataFrame:
    """(entity, q_ord, target): each row of a quarter scored by the model of the window before it."""
    models = models.select(F.col("window").alias(Q_ORD), "intercept", "coefficients")
    products = F.zip_with(X, "coefficients", lambda a, b: a * b)
    score = F.aggregate(products, F.col("intercept"), lambda total, v: total + v)
    # One row for each quarter of the calendar.
    return rows.join(F.broadcast(models), Q_ORD).select("entity", Q_ORD, score.alias(target))


def linear_windows(features: DataFrame, windows: Mapping[int, range], settings: Settings,
                   ) -> tuple[Design, DataFrame]:
    """(the inputs, the models by window) of a table with ``HASH``."""
    made = design(features, settings)
    return made, written(window_models(made.rows, windows, settings), "models")
