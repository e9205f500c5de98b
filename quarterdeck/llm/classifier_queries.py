"""Queries of the classifiers: language (9) and toxicity (10)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm import language, toxicity
from quarterdeck.llm.common import query, table

PIECES = "piece_bpe_32k.model"


@query("op9_language")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
