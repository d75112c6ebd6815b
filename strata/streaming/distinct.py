"""Streaming duplicates with bounded state: a message that repeats a
key within ``delay`` of the newest event time is dropped, and keys older than
that are forgotten, so the state holds one delay's worth of keys however long the
query runs.

A message that is itself older than the watermark (the newest event time seen in
earlier batches, less ``delay``) is late and dropped: its key may have been
forgotten.  Without an event time it never leaves the state, so such messages
are dropped, too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sources.layers import Layers
from strata.streaming.drain import feed_id


def distinct_within(stream: DataFrame, keys: Sequence[str], at: str, delay: str) -> DataFrame:
    """``stream`` without messages that repeat a key within ``delay``, in event time."""
    return (stream.filter(F.col(at).isNotNull()).withWatermark(at, delay)
            .dropDuplicatesWithinWatermark(list(keys)))


def append_stream(stream: DataFrame, layers: Layers, table: str, checkpoint: str, every: str | None = None):
    """Append a stream to a table of ``layers``, each micro-batch once: the release
    that names a batch's folder also names the batch, so a batch that is run again is
    recognised.  Bounded (``availableNow``), or continuous with a trigger ``every``
    (such as ``"5 seconds"``); returns the query."""
    def run(batch: DataFrame, batch_id: int) -> None:
        layers.append_once(table, batch, feed_id(layers.spark, checkpoint), batch_id)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    q = (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
    if not every:
        q.awaitTermination()
    return q
