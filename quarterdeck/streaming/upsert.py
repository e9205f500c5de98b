"""Keyed upsert of an unbounded stream of quarterly facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quarterdeck.functions.names import KEY
from quarterdeck.sources.tables import upsert_table


def stream_upsert(facts: DataFrame, path: str, checkpoint: str, order: str,
                  key: Sequence[str] = KEY) -> StreamingQuery:
    """Merge each micro-batch into the table at ``path``; the row with the largest ``order`` wins,
    in whichever batch it comes. A batch that is delivered twice leaves the same table."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, path, key, order)

    return (facts.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
