"""Keys met by a bitmap."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators.membership import key_bitmap, may_contain


@pytest.mark.parametrize("bits", [16, 22])
def test_no_key_is_lost_and_few_others_stay(spark, bits):
    rows = spark.range(20_000).select(F.concat(F.lit("e"), F.col("id") % 500).alias("entity"),
                                      (F.col("id") / 500).cast("int").alias("q_ord"), "id")
    keys = rows.where("id % 37 = 0").select("entity", "q_ord")
    bitmap = key_bitmap(keys, ["entity", "q_ord"], bits)
    found = {r["id"] for r in may_contain(rows, bitmap, ["entity", "q_ord"], bits).collect()}
    meant = {i for i in range(20_000) if i % 37 == 0}
    assert meant <= found and len(found - meant) < (400 if bits == 16 else 20)
    assert bitmap.count() <= 1 << bits - 15
    assert may_contain(rows, key_bitmap(keys.limit(0), ["entity", "q_ord"]), ["entity", "q_ord"]).isEmpty()
