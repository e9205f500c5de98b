"""Settings of a run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator

from quarterdeck.functions.names import TARGET


@dataclass(frozen=True)
class Settings:
    """The defaults."""

    market_indices: tuple[str, ...] = ("^DJI",)
    # "boosted_trees", "shallow_trees", "linear", or a function (settings) -> Estimator.
    model: str | Callable[["Settings"], Estimator] = "boosted_trees"
    n_to_buy: int = 7
    seed: int = 32
    max_depth: int = 5
    learning_rate: float = 0.1
    n_estimators: int = 100
    training_quarters: int = 16
    include_dividends: bool = True
    horizon: int = 4
    extract_outliers: bool = False
    one_hot_encode: bool = False
    numeric_encode_categories: bool = False
    scale_numerics: bool = False
    test_size: float = 0.2
    adjust_for_current_price: bool = True
    allocation: str = "equal"
    target: str = TARGET
    # Leave out training rows whose target looks at prices after the quarter that is predicted.
    purge: bool = True
    # Quarters of a back-test that are fitted at the same time.
    parallelism: int = 4
