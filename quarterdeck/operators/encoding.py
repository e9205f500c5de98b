"""Feature preparation: outliers, categories, scaling and the hold-out split.

Fitting returns a handful of numbers or names (one row per column or category), never data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.names import ENTITY, KEY, Q_ORD
from quarterdeck.session import written

MAX_CATEGORIES = 1000


@dataclass(frozen=True)
class Moments:
    """Mean and population deviation by column; both None for a column without values."""

    mean: Mapping[str, float | None]
    std: Mapping[str, float | None]

    def z_score(self, column: str) -> Column:
        """0 for a constant column, null for a missing value."""
        mean, std = self.mean[column], self.std[column]
        if mean is None:
            return F.lit(None).cast("double")
        return (F.col(column) - F.lit(mean)) / F.lit(std or 1.0)


def fit_moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """All columns in one aggregation."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return Moments({c: row[f"m{i}"] for i, c in enumerate(columns)},
                   {c: row[f"s{i}"] for i, c in enumerate(columns)})


def drop_outliers(df: DataFrame, moments: Moments, threshold: float = 3.0) -> DataFrame:
    """Keep rows whose |z| is below the threshold in every fitted column; missing values pass."""
    keep = F.lit(True)
    for c in moments.mean:
        z = moments.z_score(c)
        keep &= z.isNull() | (F.abs(z) < threshold)
    return df.where(keep)


def scale(df: DataFrame, moments: Moments) -> DataFrame:
    return df.withColumns({c: moments.z_score(c) for c in moments.mean})


def fit_categories(df: DataFrame, columns: Sequence[str],
                   limit: int = MAX_CATEGORIES) -> dict[str, list]:
    """Sorted distinct values by column, None first where a value is missing.

    Each becomes a column, so their number must be small; more than ``limit`` is an error and
    calls for :func:`category_codes`.
    """
    fitted = {}
    for c in columns:
        found = [r[0] for r in df.select(c).distinct().limit(limit + 1).collect()]
        if len(found) > limit:
            raise ValueError(f"{c} has more than {limit} categories; use category codes")
        fitted[c] = sorted((v for v in found if v is not None))
        if None in found:
            fitted[c].insert(0, None)
    return fitted


def one_hot(df: DataFrame, categories: Mapping[str, Sequence], drop_one: bool = True,
            drop_original: bool = True) -> DataFrame:
    """0/1 column per category; an unseen value is 0 in all. ``drop_one`` leaves out the first
    category in sorted order; missing values have a column of their own."""
    flags = []
    for c, values in categories.items():
        present = [v for v in values if v is not None]
        base = present[0] if drop_one and present else None
        for v in values:
            if v is None:
                flags.append(F.col(c).isNull().cast("int").alias(f"{c}_nan"))
            elif v != base:
                flags.append(F.col(c).eqNullSafe(F.lit(v)).cast("int").alias(f"{c}_{v}"))
    kept = [c for c in df.columns if not (drop_original and c in categories)]
    return df.select(*kept, *flags)


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): distinct values numbered from 0 in sorted order.

    The values are range-partitioned and numbered per partition from an offset; the ranges are
    written down first, because a range partitioning that is computed again after a lost executor may
    cut elsewhere.
    """
    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    ranged = written(values.repartitionByRange("value")
                     .withColumn("part", F.spark_partition_id()), "values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    place = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    return (ranged.join(F.broadcast(offsets), "part")
            .select("value", (F.col("offset") + place - 1).cast("int").alias("code")))


def encode(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Replace the column by its code; -1 for a missing or unseen value."""
    names = codes.withColumnsRenamed({"value": column, "code": "__code"})
    code = F.coalesce(F.col("__code"), F.lit(-1)).alias(column)
    joined = df.join(names, column, "left")
    return joined.select(*[code if c == column else F.col(c) for c in df.columns])


def _key_hash(seed: int, key: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))


def hold_out(df: DataFrame, test_size: float = 0.2, seed: int = 7, key: Sequence[str] = KEY,
             exact: bool = True) -> DataFrame:
    """Mark ``int(rows * test_size)`` rows as ``held_out``, chosen by a hash of key and seed.

    The same rows are chosen on every run and cluster; rows that share a key stay together. The
    exact number is reached without a global sort: a count per hash prefix (4,096 of them) finds the
    prefix in which the limit falls, and only that prefix is looked at closer, four digits at a time.
    ``exact=False`` takes the share of hashes instead and needs no job at all.
    """
    digest = _key_hash(seed, key)
    if not exact:
        limit = f"{min(int(test_size * 16 ** 8), 16 ** 8 - 1):08x}"
        return df.withColumn("held_out", F.substring(digest, 1, 8) < limit)
    limit = _hash_limit(df.select(digest.alias("h")), test_size)
    return df.withColumn("held_out", digest <= limit if limit else F.lit(False))


def _hash_limit(hashes: DataFrame, test_size: float) -> str | None:
    """The largest hash that is still held out."""
    wanted, prefix, answer, width = None, "", None, 3
    while True:
        counts = sorted(
            (r["p"], r["n"]) for r in hashes.where(F.col("h").startswith(prefix))
            .groupBy(F.substring("h", 1, width).alias("p"))
            .agg(F.count(F.lit(1)).alias("n")).collect())
        if wanted is None:
            wanted = int(sum(n for _, n in counts) * test_size)
        for p, n in counts:
            if n > wanted:
                break
            wanted -= n
            answer = p.ljust(32, "f")
        else:
            return answer
        if wanted == 0 or width == 32:
            return answer
        prefix, width = p, min(width + 4, 32)


def key_hash(seed: int = 7, key: Sequence[str] = KEY) -> Column:
    """The hash by which :func:`hold_out` chooses rows."""
    return _key_hash(seed, key)


def hold_out_limits(hashes: DataFrame, windows: Mapping[int, range], test_size: float = 0.2,
                    ) -> dict[int, str | None]:
    """For each window of quarters the largest hash that :func:`hold_out` would hold out of its rows.

    ``hashes`` is (q_ord, h), one row for each row. One histogram by quarter and hash prefix serves
    all windows; only the rows of the prefixes in which a limit falls are looked at closer, for all
    windows together.
    """
    wanted: dict[int, int] = {}
    answer: dict[int, str | None] = dict.fromkeys(windows)
    prefix = dict.fromkeys(windows, "")
    still, width = set(windows), 3
    while still:
        length = len(next(iter(prefix[w] for w in still)))
        near = hashes
        if length:
            near = hashes.where(F.substring("h", 1, length).isin(sorted({prefix[w] for w in still})))
        by_quarter: dict[int, list] = {}
        for r in (near.groupBy(Q_ORD, F.substring("h", 1, width).alias("p"))
                  .agg(F.count(F.lit(1)).alias("n")).collect()):
            by_quarter.setdefault(r[Q_ORD], []).append((r["p"], r["n"]))
        for w in list(still):
            counts: dict[str, int] = {}
            for quarter in windows[w]:
                for p, n in by_quarter.get(quarter, ()):
                    if p.startswith(prefix[w]):
                        counts[p] = counts.get(p, 0) + n
            wanted.setdefault(w, int(sum(counts.values()) * test_size))
            for p in sorted(counts):
                if counts[p] > wanted[w]:
                    prefix[w] = p
                    break
                wanted[w] -= counts[p]
                answer[w] = p.ljust(32, "f")
            else:
                still.discard(w)
            if wanted[w] == 0 or width == 32:
                still.discard(w)
        width = min(width + 4, 32)
    return answer


def split_hold_out(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(training rows, held-out rows)."""
    return (marked.where(~F.col("held_out")).drop("held_out"),
            marked.where(F.col("held_out")).drop("held_out"))


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(keyed features, keyed target)."""
    return df.drop(target), df.select(ENTITY, Q_ORD, target)
