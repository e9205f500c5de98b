"""Toxicity by class-conditional Kneser-Ney models of letters.

Two models, one of toxic and one of ordinary documents, give the chance of each letter of a word
after up to four before it. A class's counts are discounted and the mass that this frees goes to a
backoff distribution that both classes share: Kneser-Ney continuation counts (how many different
letters precede a gram) over both classes together. A gram that neither class has says
nothing then, and rare expressions are told apart by their common parts.

A passage of ``PASSAGE`` words is scored by the difference of the two log-likelihoods divided by its
length in letters; a document by its highest passage, so that length does not hide
an expression. A logistic curve turns this into a score between 0 and 1. The curve is fitted on
training documents that the counts it is fitted with do not hold, as many of each class; where a
training fold lacks a class, it is ``FIXED_CURVE``, about what the given tables lead to.

Counts cover all training documents and every gram that they have. Counts, continuation counts and
ratios are tables with a row per gram; the ratios lie in the shared folder in files of about
``FILE_ROWS`` rows, and tasks look up the grams of many new words at a time, file by file. The driver
holds none of them.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import STORES, arrow_map, fold, let_go, utf8, with_columns
from quarterdeck.operators.membership import key_bitmap, may_contain
from quarterdeck.session import fresh_path, written

WORD = re.compile(r"[^\W\d_]+")
ORDER, DISCOUNT, PASSAGE = 5, 0.75, 4
FOLDS, HELD_OUT, CURVE_FOLD = 3, 1, 2
CURVE_ROWS, KEPT_WORDS, COUNTED_WORDS = 20_000, 300_000, 100_000
FILE_ROWS, FILES_READ, HELD_BYTES = 1 << 16, 16, 1 << 24
TRIAL, FINAL = 0, 1
FIXED_CURVE = 6.0, 0.32
LABEL_BITS = 24  # 2 MB, whatever the number of labels
HISTORY = " "  # in no gram
TOXIC_FROM = 0.7


def grams(word: str) -> list[str]:
    """Each letter and the word's end with up to ORDER - 1 letters before it, ``^`` the start."""
    marked = f"^{word}$"
    return [marked[max(0, i - ORDER + 1):i + 1] for i in range(1, len(marked))]


class Ratios(NamedTuple):
    """``ratio[gram]`` and, for grams not met, ``history[gram without its last letter]``: the log
    of the letter's chance in the toxic class over that in the ordinary class."""

    ratio: dict[str, float]
    history: dict[str, float]


class ToxicityModel(NamedTuple):
    """The folder of a table of ratios (none: everything scores 0) and a logistic curve."""

    folder: str | None = None
    slope: float = 0.0
    at: float = 0.0

    def score(self, passage: float) -> float:
        z = self.slope * (passage - self.at)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z)))) if self.slope else 0.0


class Words:
    """The words that a process has met and, one flush later, the sums of their grams' ratios."""

    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = defaultdict()
        self.place.default_factory = self.place.__len__
        self.values, self.sizes = np.empty(0), np.empty(0, np.int64)

    def lookup(self, wanted: list[str]) -> np.ndarray:
        """The values of these rows of the table, NaN for others; a few files at a time."""
        out, keys = np.full(len(wanted), np.nan), pa.array(wanted, pa.string())
        fs, root = pa.fs.FileSystem.from_uri(self.folder)
        files = sorted(f.path for f in fs.get_file_info(pa.fs.FileSelector(root))
                       if f.path.endswith(".parquet"))
        for start in range(0, len(files), FILES_READ):
            parts = []
            for path in files[start:start + FILES_READ]:
                with fs.open_input_file(path) as source:
                    parts.append(pq.ParquetFile(source).read(columns=["gram", "value"]))
            rows = pa.concat_tables(parts).combine_chunks()
            at = pc.index_in(rows["gram"], value_set=keys)
            known = pc.is_valid(at)
            out[at.filter(known).to_numpy()] = rows["value"].filter(known).to_numpy()
        return out

    def learn(self) -> None:
        """Values of the words met since the last time."""
        new = list(islice(self.place, len(self.values), None))
        if not new:
            return
        met = list({gram for word in new for gram in grams(word)})
        histories = list({gram[:-1] for gram in met})
        values = self.lookup([*met, *(h + HISTORY for h in histories)])
        backoff = dict(zip(histories, np.nan_to_num(values[len(met):], nan=0.0).tolist()))
        part = {gram: backoff[gram[:-1]] if math.isnan(value) else value
                for gram, value in zip(met, values[:len(met)].tolist())}
        self.values = np.append(self.values, [sum(part[g] for g in grams(w)) for w in new])
        self.sizes = np.append(self.sizes, [len(w) + 1 for w in new])

    def passage(self, words: np.ndarray) -> float:
        """The highest difference of log-likelihoods per letter of any PASSAGE words in a row."""
        if not len(words):
            return -1.0
        sums = np.concatenate([[0.0], np.cumsum(self.values[words])])
        sizes = np.concatenate([[0], np.cumsum(self.sizes[words])])
        k = min(PASSAGE, len(words))
        return float(((sums[k:] - sums[:-k]) / (sizes[k:] - sizes[:-k])).max())

    def passages(self, batches: Iterator[pa.RecordBatch], column: str,
                 ) -> Iterator[tuple[pa.RecordBatch, list[float]]]:
        """Every batch with the passages of this column of texts (strings or UTF-8 bytes). Batches
        wait until there are COUNTED_WORDS new words or HELD_BYTES of text."""
        held, size = [], 0

        def flush() -> Iterator[tuple[pa.RecordBatch, list[float]]]:
            self.learn()
            for batch, texts in held:
                yield batch, [self.passage(words) for words in texts]
            held.clear()
            if len(self.place) > KEPT_WORDS:
                self.forget()

        for batch in batches:
            texts = []
            for value in batch[batch.schema.names.index(column)]:
                text = value.as_py() or ""
                text = text.decode() if isinstance(text, bytes) else text
                words = WORD.findall(text.lower())
                texts.append(np.fromiter(map(self.place.__getitem__, words), np.int32, len(words)))
                size += len(text)
            held.append((batch, texts))
            if len(self.place) - len(self.values) > COUNTED_WORDS or size > HELD_BYTES:
                yield from flush()
                size = 0
        yield from flush()


_words: dict[str, Words] = {}
STORES[__name__] = _words.clear


def _known(folder: str) -> Words:
    """One per process, so that tasks share the words it has met."""
    if folder not in _words:
        _words.clear()
        _words[folder] = Words(folder)
    return _words[folder]


def build(counts: dict[int, dict[str, int]]) -> Ratios:
    """The ratios of gram counts by class (0 ordinary, 1 toxic), in memory: what :func:`ratios`
    is compared with."""
    before: dict[str, set[str]] = defaultdict(set)
    for own in counts.values():
        for gram in own:
            for k in range(1, len(gram)):
                before[gram[k:]].add(gram[k - 1])
    shared_sum, shared_kinds = Counter(), Counter()
    for gram, letters in before.items():
        shared_sum[gram[:-1]] += len(letters)
        shared_kinds[gram[:-1]] += 1
    memo: dict[str, float] = {"": 1 / 256}

    def shared(gram: str) -> float:
        if gram not in memo:
            lower, h = shared(gram[1:]), gram[:-1]
            total = shared_sum[h]
            memo[gram] = lower if not total else (
                max(len(before.get(gram, ())) - DISCOUNT, 0) + DISCOUNT * shared_kinds[h] * lower
            ) / total
        return memo[gram]

    totals: dict[int, Counter] = {0: Counter(), 1: Counter()}
    kinds: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for label in (0, 1):
        for gram, n in counts.get(label, {}).items():
            totals[label][gram[:-1]] += n
            kinds[label][gram[:-1]] += 1

    def freed(label: int, h: str) -> float:
        return DISCOUNT * kinds[label][h] / totals[label][h] if totals[label][h] else 1.0

    def chance(label: int, gram: str) -> float:
        h = gram[:-1]
        backoff = freed(label, h) * shared(gram[1:] if len(gram) == ORDER else gram)
        n = counts.get(label, {}).get(gram, 0)
        return backoff + (max(n - DISCOUNT, 0) / totals[label][h] if n else 0.0)

    met = {g for own in counts.values() for g in own}
    return Ratios(
        {g: math.log(chance(1, g) / chance(0, g)) for g in met},
        {h: math.log(freed(1, h) / freed(0, h)) for h in {g[:-1] for g in met}})


def fit_curve(x: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and middle of a logistic curve by Newton's method. Both classes weigh the same, and the
    targets are drawn in a little from 0 and 1 so that separable classes have a finite answer."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    if not n1 or not n0:
        return 0.0, 0.0
    goal = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic == 1, 0.5 / n1, 0.5 / n0) * len(x)
    spread = x.std() or 1.0
    z = np.stack([(x - x.mean()) / spread, np.ones_like(x)], axis=1)
    w, ridge = np.zeros(2), np.diag([1e-3, 1e-9])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (weight * p * (1 - p) + 1e-9)[:, None]) + ridge,
                               z.T @ (weight * (p - goal)) + ridge @ w)
        w -= step * min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
    slope = w[0] / spread
    return (float(slope), float(x.mean() - w[1] / slope)) if slope > 0 else (0.0, 0.0)


def _gather(labelled: DataFrame) -> DataFrame:
    """fold, toxic, gram and its count over all these documents."""
    names = ("fold", "toxic", "gram", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words: dict[tuple[int, int], Counter] = defaultdict(Counter)

        def rows() -> dict:
            out = {name: [] for name in names}
            for (part, label), own in words.items():
                found = Counter()
                for word, n in own.items():
                    for gram in grams(word):
                        found[gram] += n
                for gram, n in found.items():
                    for name, value in zip(names, (part, label, gram, n)):
                        out[name].append(value)
            words.clear()
            return out

        for batch in batches:
            for text, part, label in zip(batch["utf8"], batch["fold"].to_pylist(),
                                         batch["toxic"].to_pylist()):
                words[part, label].update(WORD.findall(text.as_py().decode().lower()))
            if sum(map(len, words.values())) > COUNTED_WORDS:
                yield rows()
        yield rows()

    return (arrow_map(labelled, run, "fold int, toxic int, gram string, n long")
            .groupBy("fold", "toxic", "gram").agg(F.sum("n").alias("n")))


def _freed(label: int) -> Column:
    return F.coalesce(F.try_divide(F.lit(DISCOUNT) * F.col(f"kinds{label}"),
                                   F.col(f"total{label}")), F.lit(1.0))


def _chance(label: int) -> Column:
    own = F.greatest(F.col(f"n{label}") - F.lit(DISCOUNT), F.lit(0.0))
    return (_freed(label) * F.col("shared")
            + F.coalesce(F.try_divide(own, F.col(f"total{label}")), F.lit(0.0)))


def ratios(counted: DataFrame) -> DataFrame:
    """model, gram, value of all grams in ``counted`` (model, toxic, gram, n); the rows of histories
    have ``HISTORY`` behind their letters. A window is the letters after one history."""
    history = F.expr("substr(gram, 1, length(gram) - 1)")
    after = Window.partitionBy("model", "history")
    own = (counted.groupBy("model", "gram").agg(
        *[F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}")
          for c in (0, 1)]).withColumn("history", history))
    for c in (0, 1):
        own = (own.withColumn(f"total{c}", F.sum(f"n{c}").over(after))
               .withColumn(f"kinds{c}", F.sum((F.col(f"n{c}") > 0).cast("int")).over(after)))
    own = written(own.withColumn("first", F.row_number().over(after.orderBy("gram")) == 1),
                  "grams-by-class")
    ends = own.select("model", F.expr(
        "inline(transform(sequence(1, length(gram) - 1), k -> "
        "named_struct('gram', substr(gram, k + 1), 'letter', substr(gram, k, 1))))"))
    letters = ends.distinct().groupBy("model", "gram").agg(F.count(F.lit(1)).alias("letters"))
    steps = written(letters.withColumn("history", history)
                    .withColumn("total", F.sum("letters").over(after))
                    .withColumn("kinds", F.count(F.lit(1)).over(after)), "continuations")
    levels: list[DataFrame] = []
    for size in range(1, ORDER):
        level = steps.where(F.length("gram") == size).withColumn("end", F.expr("substr(gram, 2)"))
        level = (level.join(levels[-1].select("model", F.col("gram").alias("end"),
                                              F.col("shared").alias("lower")), ["model", "end"])
                 if levels else level.withColumn("lower", F.lit(1 / 256)))
        levels.append(written(level.select("model", "gram", (
            (F.greatest(F.col("letters") - F.lit(DISCOUNT), F.lit(0.0))
             + F.lit(DISCOUNT) * F.col("kinds") * F.col("lower")) / F.col("total")
        ).alias("shared")), "shared"))
    shared = reduce(DataFrame.unionByName, levels).withColumnRenamed("gram", "end")
    return (own.withColumn("end", F.expr("substr(gram, 2)")).join(shared, ["model", "end"])
            .select("model", "gram", F.log(_chance(1) / _chance(0)).alias("value"))
            .unionByName(own.where("first").select(
                "model", F.concat("history", F.lit(HISTORY)).alias("gram"),
                F.log(_freed(1) / _freed(0)).alias("value"))))


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from the documents outside the held-out fold that have a label 0 or 1 (with several
    labels, the highest). Without documents of both classes the model scores everything 0."""
    part = fold("doc_id", FOLDS)
    marks = (labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("toxic").cast("int").alias("toxic")))
    learnt = docs.where(part != HELD_OUT).select(
        F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("utf8"), part.cast("int").alias("fold"))
    # Texts without a label stay where they are; those that a bitmap of their ids lets through move.
    near = may_contain(learnt, key_bitmap(marks, ["doc_id"], LABEL_BITS), ["doc_id"], LABEL_BITS)
    joined = near.join(marks, "doc_id").select("utf8", "fold", "toxic")
    path = fresh_path(docs.sparkSession, "labelled")
    joined.write.option("compression", "zstd").parquet(path)
    labelled = docs.sparkSession.read.schema(joined.schema).parquet(path)
    gathered = written(_gather(labelled), "grams")
    classes = {tuple(row) for row in gathered.select("fold", "toxic").distinct().collect()}
    if len({label for _, label in classes}) < 2:
        return ToxicityModel()
    models = F.when(F.col("fold") == CURVE_FOLD, F.array(F.lit(FINAL))).otherwise(
        F.array(F.lit(TRIAL), F.lit(FINAL)))
    found = written(ratios(gathered.withColumn("model", F.explode(models))), "ratios")
    folder = fresh_path(docs.sparkSession, "ratio-files")
    found.repartition(found.count() // FILE_ROWS + 1).write.partitionBy("model").parquet(folder)
    trial, final = f"{folder}/model={TRIAL}", f"{folder}/model={FINAL}"

    if len(classes) < 2 * (FOLDS - 1):
        return ToxicityModel(final, *FIXED_CURVE)

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, found in _known(trial).passages(batches, "utf8"):
            yield {"x": found, "toxic": batch["toxic"]}

    tried = written(arrow_map(labelled.where(F.col("fold") == CURVE_FOLD), passages,
                              "x double, toxic int"), "passages")
    sample = reduce(DataFrame.unionByName, [
        tried.where(F.col("toxic") == label).orderBy(F.xxhash64("x", "toxic"), "x")
        .limit(CURVE_ROWS // 2) for label in (0, 1)]).toPandas()
    slope, at = fit_curve(sample["x"].to_numpy(), sample["toxic"].to_numpy())
    return ToxicityModel(final, *((slope, at) if slope else FIXED_CURVE))


def predict(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """All columns of ``docs`` with score and predicted; columns of these names are replaced.
    A null text is an empty one. The text alone decides."""
    kept = docs.drop("score", "predicted")
    if model.folder is None:
        return kept.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(predict.__module__)
        for batch, found in _known(model.folder).passages(batches, "text"):
            scores = [model.score(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()),
                 pa.array([int(s >= TOXIC_FROM) for s in scores], pa.int32())],
                names=[*batch.schema.names, "score", "predicted"])

    return kept.mapInArrow(run, with_columns(kept, "score double, predicted int"))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; a null doc_id is not learnt."""
    model = train(documents.select("doc_id", "text"), labels)
    found = predict(documents.select("doc_id", "text"), model)
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")
