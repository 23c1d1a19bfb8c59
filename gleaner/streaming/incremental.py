"""Selection and state upkeep on micro-batches: the batch operators inside foreachBatch, a versioned state as the sink.

An analogue of daily runs, not a set of watermark or session operators: each batch is merged into the state of the
version before it and committed as a whole, so a repeated batch leaves the state as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources import buckets, state


def keep_events(events: DataFrame, root: str, checkpoint: str, schema: str) -> StreamingQuery:
    """Append a stream of verified events to the state at root; equal fingerprints merge."""

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        old = state.load(spark, root, "events", schema)
        state.commit(spark, root, {"events": state.append_events(old, batch.select(*old.columns))})

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keep_bucketed(events: DataFrame, root: str, checkpoint: str, table: str = "events", n: int = buckets.BUCKETS) -> StreamingQuery:
    """keep_events() on a state in buckets by fingerprint: a batch rewrites only the buckets of its own events."""

    def merge(batch: DataFrame, _: int) -> None:
        buckets.merge_into(batch.sparkSession, root, table, batch, ["fingerprint"], state.append_events, n)

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
