"""Events from a stream into exactly-once storage, invalid ones into quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from dusklark.operators.events import split
from dusklark.operators.once import OnceStore


def ingest_stream(events: DataFrame, store: OnceStore, bad: Column, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Feed a stream of events to a store, one micro-batch a version.

    A micro-batch that is tried again changes nothing: the store keeps one copy of a message however often it comes,
    and quarantined rows are written to a folder named after the batch, which a second try overwrites.
    """

    def take(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        good, wrong = split(batch, bad)
        wrong.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
        if not good.isEmpty():
            store.ingest(good)
        batch.unpersist()

    return events.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
