"""Landed message envelopes: JSON lines with
``source, endpoint, payload, kafka_topic, kafka_partition, kafka_offset, loaded_at``.

Read in batch or as a stream with an explicit schema (no inference).  A
line that does not parse keeps its text in ``_corrupt_record`` so it can be
routed to a reject table instead of stopping the load (trap T19).  Where a
Kafka connector jar is on the classpath, ``spark.readStream.format("kafka")``
followed by :func:`from_kafka` gives the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE_DDL = ("source string, endpoint string, payload string, kafka_topic string, "
                "kafka_partition int, kafka_offset bigint, loaded_at timestamp, _corrupt_record string")
ENVELOPE_COLS = ["source", "endpoint", "payload", "kafka_topic", "kafka_partition", "kafka_offset", "loaded_at"]


def read_envelopes(spark: SparkSession, path: str, streaming: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream if streaming else spark.read
    r = r.schema(ENVELOPE_DDL).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path).withColumns({"file_name": F.col("_metadata.file_name"), "origin": F.col("_metadata.file_path")})


def _bad() -> "F.Column":
    """A line is rejected when it does not parse or lacks a part of its key
    (source, endpoint): a NULL key would never meet its stored row again."""
    return F.col("_corrupt_record").isNotNull() | F.col("source").isNull() | F.col("endpoint").isNull()


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(~_bad()).drop("_corrupt_record", "origin")


def rejected(df: DataFrame) -> DataFrame:
    """Reject rows, named by where they are from: the file, or the topic partition,
    and the offset if the message has one."""
    return df.filter(_bad()).select("_corrupt_record", "source", "file_name", "origin",
                                    F.coalesce("kafka_offset", F.lit(-1)).alias("position"))


def write_envelopes(df: DataFrame, path: str, mode: str = "append") -> None:
    df.select(*ENVELOPE_COLS).write.mode(mode).json(path)


def from_kafka(kafka_df: DataFrame) -> DataFrame:
    """Kafka records whose value is the JSON envelope ``{source, endpoint,
    payload}``, in the columns of :func:`read_envelopes`: the topic, partition
    and offset become the landing position, a value that does not parse (or
    names no source) is kept in ``_corrupt_record`` (a reject row, T19), and
    ``file_name`` names the topic partition."""
    text = F.col("value").cast("string")
    env = F.from_json(text, "source string, endpoint string, payload string")
    return kafka_df.select(
        env["source"].alias("source"), env["endpoint"].alias("endpoint"), env["payload"].alias("payload"),
        F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("loaded_at"),
        # a malformed value parses to a struct of NULLs: keep its text
        F.when(env["source"].isNull(), text).alias("_corrupt_record"),
        F.concat_ws("-", F.col("topic"), F.col("partition").cast("string")).alias("file_name"),
        F.concat_ws("-", F.col("topic"), F.col("partition").cast("string")).alias("origin"))
