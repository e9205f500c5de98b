"""Fit a regressor on a window of quarters, score rows, keep the model.

Text columns become numbers by joined tables (``operators/categories``), for any number of categories;
every other fitted step is a stage of one MLlib pipeline. Tables, outlier bounds, scaling and the
regressor are saved and loaded together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.names import ENTITY, KEY, Q_ORD, TARGET
from quarterdeck.functions.ratios import quoted
from quarterdeck.operators.categories import (
    CODES, MEANS, SLOTS, Encoder, fit_encoder, load_encoder)
from quarterdeck.operators.encoding import fit_moments, hold_out
from quarterdeck.operators.filters import between_quarters
from quarterdeck.operators.metrics import absolute_error, feature_importance, regression_metrics
from quarterdeck.plans.settings import Settings
from quarterdeck.session import written

VECTOR, HELD_OUT, HASH = "__features", "held_out", "__hash"
NUMBERS, HAS_NAN = "__numbers", "__has_nan"


def boosted_trees(settings: Settings) -> Estimator:
    """Boosting with early stop on the held-out rows, absolute loss."""
    return GBTRegressor(featuresCol=VECTOR, labelCol=settings.target, lossType="absolute",
                        maxIter=settings.n_estimators, maxDepth=settings.max_depth,
                        stepSize=settings.learning_rate, seed=settings.seed,
                        validationIndicatorCol=HELD_OUT)


def shallow_trees(settings: Settings) -> Estimator:
    """Depth 3, rate 0.1, seed 100."""
    return GBTRegressor(featuresCol=VECTOR, labelCol=settings.target, maxDepth=3, stepSize=0.1,
                        maxIter=settings.n_estimators, seed=100)


def linear(settings: Settings) -> Estimator:
    return LinearRegression(featuresCol=VECTOR, labelCol=settings.target, standardization=True)


MODELS = {"boosted_trees": boosted_trees, "shallow_trees": shallow_trees, "linear": linear}
TREES = ("boosted_trees", "shallow_trees")


def _sql(expressions: Sequence[str], dropped: Sequence[str] = (), where: str = "") -> Transformer:
    star = f"* EXCEPT ({', '.join(map(quoted, dropped))})" if dropped else "*"
    tail = f" WHERE {where}" if where else ""
    return SQLTransformer(
        statement=f"SELECT {', '.join([star, *expressions])} FROM __THIS__{tail}")


def _z_score(column: str, mean: float | None, std: float | None) -> str:
    if mean is None:
        return "CAST(NULL AS DOUBLE)"
    return f"(({quoted(column)} - ({mean!r}D)) / {(std or 1.0)!r}D)"


def category_kind(settings: Settings) -> str:
    """0/1 places when asked for, else the number in sorted order when asked for or for a linear model,
    else the mean target of the category, by whose order a tree cuts."""
    if settings.one_hot_encode:
        return SLOTS
    return CODES if settings.numeric_encode_categories or settings.model == "linear" else MEANS


def feature_columns(train: DataFrame, settings: Settings) -> tuple[list[str], list[str]]:
    """(text columns, number columns) to learn from."""
    skipped = {ENTITY, Q_ORD, "fy", settings.target, "PriceAvg", HELD_OUT, HASH, NUMBERS, HAS_NAN}
    kinds = {c: t for c, t in train.dtypes if c not in skipped}
    text = [c for c, t in kinds.items() if t == "string"]
    return text, [c for c in kinds if c not in text]


def imputed(numbers: Sequence[str]) -> tuple[list[str], list[str]]:
    """(expressions, their names). MLlib takes no nulls: 0 stands for a missing number and a flag says so."""
    values = [f"coalesce(CAST({quoted(c)} AS DOUBLE), 0D) AS {quoted('__x_' + c)}" for c in numbers]
    flags = [f"CAST({quoted(c)} IS NULL AS INT) AS {quoted('__null_' + c)}" for c in numbers]
    return values + flags, [f"__x_{c}" for c in numbers] + [f"__null_{c}" for c in numbers]


def with_number_vector(rows: DataFrame, settings: Settings) -> DataFrame:
    """The number columns as one vector, for rows that many windows learn from: putting a hundred columns into
    a vector costs more than all else that a tree fit does with a row. Numbers that each fit changes by its
    own rows (outliers, scaling) stay columns, and so do those of other models."""
    _, numbers = feature_columns(rows, settings)
    if (settings.model not in TREES or not numbers or settings.extract_outliers
            or settings.scale_numerics):
        return rows
    expressions, names = imputed(numbers)
    has_nan = " OR ".join(f"isnan({quoted(c)})" for c in names[:len(numbers)])
    filled = _sql([f"({has_nan}) AS {HAS_NAN}"]).transform(_sql(expressions, numbers).transform(rows))
    return VectorAssembler(inputCols=names, outputCol=NUMBERS, handleInvalid="keep").transform(
        filled).drop(*names)


class FeatureSteps:
    """Builds the fitted preparation stages for one training frame."""

    def __init__(self, train: DataFrame, settings: Settings):
        text, self.numbers = feature_columns(train, settings)
        self.encoder = fit_encoder(train, text, category_kind(settings), settings.target)
        self.stages: list[Transformer] = []
        self.inputs: list[str] = []
        moments = None
        if settings.extract_outliers or settings.scale_numerics:
            moments = fit_moments(train, self.numbers)
        if settings.extract_outliers:
            self._drop_outliers(moments)
        self.inputs += self.encoder.inputs
        if settings.scale_numerics:
            self._scale(moments)
        if NUMBERS in train.columns:
            self._take_vector(train)
        else:
            self._impute()
        self.stages.append(VectorAssembler(inputCols=self.inputs, outputCol=VECTOR))

    def _drop_outliers(self, moments, threshold: float = 3.0):
        tests = [f"coalesce(abs({_z_score(c, moments.mean[c], moments.std[c])}) < {threshold}D,"
                 " true)" for c in self.numbers]
        self.stages.append(_sql([], where=" AND ".join(tests)))

    def _scale(self, moments):
        self.stages.append(_sql(
            [f"{_z_score(c, moments.mean[c], moments.std[c])} AS {quoted(c)}"
             for c in self.numbers], dropped=self.numbers))

    def _impute(self):
        expressions, self.number_names = imputed(self.numbers)
        self.stages.append(_sql(expressions))
        self.inputs += self.number_names

    def _take_vector(self, train: DataFrame):
        """As with columns, a row that is not a number ends the work, but only where it is used."""
        self.stages.append(_sql(
            [], where=f"assert_true(NOT {HAS_NAN}, 'Encountered NaN among the numbers') IS NULL"))
        named = train.schema[NUMBERS].metadata["ml_attr"]["attrs"]["numeric"]
        self.number_names = [a["name"] for a in sorted(named, key=lambda a: a["idx"])]
        self.inputs.append(NUMBERS)

    def names(self) -> list[str]:
        """A name for each number of the vector."""
        return [*self.encoder.names(), *self.number_names]


@dataclass(frozen=True)
class Prepared:
    """Encoded categories and the fitted stages."""

    encoder: Encoder
    stages: PipelineModel

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.stages.transform(self.encoder.add(rows))

    def save(self, path: str) -> None:
        self.stages.write().overwrite().save(f"{path}/stages")
        self.encoder.save(f"{path}/categories")


@dataclass(frozen=True)
class Fitted:
    """A fitted pipeline, its errors on the held-out rows and the names of its inputs."""

    pipeline: Prepared
    inputs: tuple[str, ...]
    settings: Settings
    scored: DataFrame

    @property
    def metrics(self) -> DataFrame:
        return regression_metrics(self.scored, self.settings.target, "prediction")

    @property
    def errors(self) -> DataFrame:
        return absolute_error(self.scored, self.settings.target, "prediction")

    @property
    def importance(self) -> DataFrame:
        """Importance of each input; for a linear model its coefficients."""
        model = self.pipeline.stages.stages[-1]
        values = (model.coefficients if hasattr(model, "coefficients")
                  else model.featureImportances).toArray()
        return feature_importance(self.scored.sparkSession, self.inputs, values)

    def save(self, path: str) -> None:
        self.pipeline.save(path)


def load_pipeline(path: str) -> Prepared:
    stages = PipelineModel.load(f"{path}/stages")
    return Prepared(load_encoder(SparkSession.active(), f"{path}/categories"), stages)


def training_window(quarter: int, settings: Settings) -> range:
    """The quarters to learn from before ``quarter``."""
    end = quarter - settings.horizon + 1 if settings.purge else quarter
    return range(quarter - settings.training_quarters, end)


def training_rows(features: DataFrame, quarter: int | None, settings: Settings) -> DataFrame:
    """Labelled rows of the window before ``quarter`` (all when None)."""
    rows = features.where(F.col(settings.target).isNotNull())
    if quarter is None:
        return rows
    window = training_window(quarter, settings)
    return between_quarters(rows, window.start, window.stop)


def fit(features: DataFrame, settings: Settings = Settings(), quarter: int | None = None,
        stored: bool = False) -> Fitted:
    """Hold out a part, fit the preparation and the regressor on the rest.

    Fitting reads its rows several times, so they are written down first unless ``features`` is
    a ``stored`` table already.
    """
    rows = training_rows(features, quarter, settings)
    if not stored:
        rows = written(rows, "training")
    return fit_marked(hold_out(rows, settings.test_size), settings)


def fit_marked(marked: DataFrame, settings: Settings) -> Fitted:
    """Fit on the rows that are not marked as held out."""
    train = marked.where(~F.col(HELD_OUT))
    steps = FeatureSteps(train, settings)
    build = MODELS[settings.model] if isinstance(settings.model, str) else settings.model
    model = build(settings)
    uses_held_out = (model.hasParam("validationIndicatorCol")
                     and model.isDefined("validationIndicatorCol"))
    if uses_held_out and marked.where(HELD_OUT).isEmpty():  # a few rows: nothing to stop early by
        model.clear(model.validationIndicatorCol)
        uses_held_out = False
    rows = steps.encoder.add(marked if uses_held_out else train)
    fitted = _fit_model(model, PipelineModel(steps.stages).transform(rows), settings)
    pipeline = Prepared(steps.encoder, PipelineModel([*steps.stages, fitted]))
    scored = pipeline.transform(marked.where(HELD_OUT)).select(
        *KEY, settings.target, "prediction")
    return Fitted(pipeline, tuple(steps.names()), settings, scored)


def _fit_model(model: Estimator, ready: DataFrame, settings: Settings) -> Transformer:
    """Trees read their rows four times before they have bins of their own, so the vectors are kept until
    then: made once, in memory as far as it goes. An own model may read other columns and keeps its rows
    itself."""
    if settings.model not in TREES:
        return model.fit(ready)
    kept = ready.select(settings.target, HELD_OUT, VECTOR).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return model.fit(kept)
    finally:
        kept.unpersist()


def predict(pipeline: Prepared, rows: DataFrame, target: str = TARGET) -> DataFrame:
    """(entity, q_ord, target): the prediction for each row."""
    ready = rows.withColumn(HELD_OUT, F.lit(False))
    return pipeline.transform(ready).select(*KEY, F.col("prediction").alias(target))


def adjust_for_price(predictions: DataFrame, candidates: DataFrame, latest: DataFrame,
                     target: str = TARGET) -> DataFrame:
    """Take off, in percent of the quarter's mean price, what the price already moved since; an
    entity without a current price keeps its prediction."""
    prices = candidates.select(*KEY, "PriceAvg")
    joined = (predictions.join(prices, list(KEY), "left").join(latest, ENTITY, "left")
              .withColumn("CurrentPrice", F.coalesce("CurrentPrice", "PriceAvg")))
    moved = F.coalesce(F.try_divide(F.col("CurrentPrice") - F.col("PriceAvg"),
                                    F.col("PriceAvg")) * 100.0, F.lit(0.0))
    return joined.select(*KEY, (F.col(target) - moved).alias(target))
