"""Bounded drain (S1-S3, S12): read every landed message not yet seen
(``trigger(availableNow=True)``), apply first-wins per key, append to the
landing table, stop.  The checkpoint folder plays the consumer group's
committed offsets.

Replays are harmless: a micro-batch re-run after a failure, or a fresh checkpoint
over the same messages, finds its own rows stored at the same positions, so
nothing wins over them, and its rejects under the same origin."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import loads
from strata.sources import landing
from strata.sources.layers import DEFAULT_KEY_BUCKETS, Layers


# Files per micro-batch of a drain: bounds a batch however large the backlog.
MAX_FILES_PER_BATCH = 1000


#: Fewer buckets than a landing table: rejects are few.
REJECT_BUCKETS = 8


def _reject(layers: Layers, reject_table: str, bad: DataFrame) -> None:
    """Store rejects by where they are from (``origin`` and ``position``), so that
    every feed's are kept, and those of a batch that is run again once.  All
    rejects of one origin and position arrive in one batch."""
    if layers.exists(reject_table) and bad.isEmpty():
        return
    layers.insert_if_absent(reject_table, bad, ["origin", "position"], n_buckets=REJECT_BUCKETS, distinct=False)


def feed_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query that owns a checkpoint folder: another one for
    each feed, and for a checkpoint begun anew."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata", "id string").first().id


def first_wins_batch(layers: Layers, table: str, keys: Sequence[str], order: Sequence[str],
                     reject_table: str | None = None, n_buckets: int = DEFAULT_KEY_BUCKETS):
    """A ``foreachBatch`` function appending first-wins rows to ``table``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read the micro-batch files once for both splits
        good = landing.accepted(batch).drop("file_name")
        if reject_table is not None:
            _reject(layers, reject_table, landing.rejected(batch))
        # first-wins = the smallest position per key, against the stored row
        # too: the winner does not depend on how the backlog is cut into batches
        first = loads.pick_one(good, list(keys), list(order), keep="first")
        layers.put_first(table, first, list(keys), list(order), n_buckets=n_buckets)
        batch.unpersist()
    return run


def drain(spark: SparkSession, source: str | DataFrame, layers: Layers, table: str, checkpoint: str,
          keys: Sequence[str] = ("source", "endpoint"), order: Sequence[str] = ("kafka_offset",),
          reject_table: str | None = None, available_now: bool = True,
          n_buckets: int = DEFAULT_KEY_BUCKETS, max_files_per_trigger: int = MAX_FILES_PER_BATCH):
    """Run one bounded drain (or, with ``available_now=False``, a continuous
    query with a 5 s trigger) and return the query handle.  The landing
    table is keyed by ``n_buckets`` hash buckets of ``keys``.  A backlog is
    split into micro-batches of at most ``max_files_per_trigger`` files
    (``availableNow`` honours the limit), so no batch grows with it.

    ``source`` is a folder of landed envelope files, or a streaming
    DataFrame with the envelope columns -- e.g. a Kafka topic read with
    ``spark.readStream.format("kafka")`` (bound it with ``maxOffsetsPerTrigger``)
    and mapped by :func:`strata.sources.landing.from_kafka`."""
    if isinstance(source, DataFrame):
        stream = source
    else:
        stream = landing.read_envelopes(spark, source, streaming=True,
                                        max_files_per_trigger=max_files_per_trigger)
    w = (stream.writeStream
         .foreachBatch(first_wins_batch(layers, table, list(keys), list(order), reject_table, n_buckets))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def apply_change_stream(spark: SparkSession, stream: DataFrame, layers: Layers, table: str,
                        checkpoint: str, keys: Sequence[str], value_col: str, row_ddl: str,
                        available_now: bool = True, reject_table: str | None = None,
                        final_below: Callable[[], int | None] | None = None):
    """Change capture applied per micro-batch (S12): the batch's newest event
    per key is merged into the current state table (no MERGE on parquet):
    keys touched by the batch are replaced, deletes removed, and only the key
    buckets the batch touches are read and rewritten, in one merge
    (:meth:`Layers.merge_newest`).

    The state keeps the position of the newest event beside each key, deleted keys
    included, and the newest truncate as one number, so an older event that
    arrives late, or again, changes nothing; ``layers.read`` shows the live rows.
    A deleted key is forgotten when its bucket is next rewritten after a truncate,
    or once ``final_below()`` (a position no later event can be under, such as the
    source's oldest retained one) has passed it.  Messages that are no change
    events go to ``reject_table`` (dropped without one)."""
    keys = list(keys)

    def run(batch: DataFrame, batch_id: int) -> None:
        ev, bad = loads.keyed_changes(batch, value_col, row_ddl, keys)
        if reject_table is not None:
            origin = f"{feed_id(layers.spark, checkpoint)}/{batch_id}"
            _reject(layers, reject_table, bad.select("*", F.lit(origin).alias("origin"), F.lit(-1).cast("long").alias("position")))
        ev = ev.checkpoint(eager=True)
        now = ev.filter("op = 't'").agg(F.max("_pos")).first()[0]
        cleared = max((x for x in (layers.cleared(table), now) if x is not None), default=None)
        ev = ev.filter("op <> 't'")
        if cleared is not None:
            ev = ev.filter(F.col("_pos") > cleared)
        last = loads.pick_one(ev, keys, ["_pos"], keep="last")
        fields = [f for f in ev.schema["after"].dataType.names if f not in keys]
        rows = last.select(*keys, *[F.col(f"after.{f}").alias(f) for f in fields], "_pos", (F.col("op") == "d").alias("_gone"))
        layers.merge_newest(table, rows, keys, "_pos", "_gone", final_below() if final_below else None)
        if now is not None and cleared == now:
            layers.clear(table, cleared)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
