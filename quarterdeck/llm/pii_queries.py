"""Query of the search for personal data (3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm.common import query, table
from quarterdeck.llm.pii import find_personal_data


@query("op3_personal_data")
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
