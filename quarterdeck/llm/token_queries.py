"""Queries of the operators that encode texts: token files (2), packing (6), chunk reuse (7)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm.chunk_bpe import round_trip
from quarterdeck.llm.common import query, table
from quarterdeck.llm.packing import pack
from quarterdeck.llm.token_files import token_files

WORDS = "word_bpe_49k.json"


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


@query("op7_chunk_bpe")
def op7_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                      public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
