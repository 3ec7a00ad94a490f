"""The document pipeline over a stream: each micro-batch of new documents goes through the
same plan as a batch run and is appended to the output tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery


def run_stream(documents: DataFrame, plan: Callable[[DataFrame], dict[str, DataFrame]], out: str, checkpoint: str) -> StreamingQuery:
    """Starts a query that writes ``plan``'s tables below ``out``, a folder per table and
    batch: a batch that runs again replaces its own output."""

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            for name, table in plan(held).items():
                table.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        finally:
            held.unpersist()

    return documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
