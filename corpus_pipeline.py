"""A corpus from documents: language, toxicity, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and is written as Parquet
before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm import language, ngram_join, packing, secrets, toxicity
from quarterdeck.llm.classifier_queries import PIECES
from quarterdeck.llm.common import COLUMNS, fold, only, table
from quarterdeck.llm.token_queries import WORDS
from quarterdeck.session import written

SURE = 0.5  # least posterior chance of the language found


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language with a chance of ``SURE`` or more, go."""
    docs = only(docs, *COLUMNS)
    learnt = docs.where(fold("doc_id", language.FOLDS) != 0).select("text", "lang")
    model = language.train(learnt, public_tokenizers.path(PIECES))
    found = language.predict(docs, model)
    return only(found.where(f"lang_pred <> '{language.UNKNOWN}' AND score >= {SURE}"), *COLUMNS)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    docs = only(docs, *COLUMNS)
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return only(toxicity.predict(docs, model).where("predicted = 0"), *COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.one_of_each(only(docs, *COLUMNS))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays."""
    return secrets.redact(only(docs, *COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences."""
    return packing.pack(docs, public_tokenizers.path(WORDS))


STAGES = [("language", known_language), ("toxicity", not_toxic), ("near_duplicates", one_of_each),
          ("secrets", no_secrets), ("packing", packed)]

#: Models and tokenizers have no SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
