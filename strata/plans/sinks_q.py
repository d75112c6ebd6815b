"""Registered queries that go through a real source or sink: landed JSON
envelopes (batch read and streaming drain), a two-table full reload, an
incremental partition refresh and a fact view.  Their folders are fresh
subfolders of the shared ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.plans.common import customer_daily
from strata.plans import landing_q
from strata.plans.landing_q import CDC_ROW, CUTOFF, REPLAY_FROM, change_events
from strata.session import scratch_path
from strata.sources import landing
from strata.sources.layers import Layers
from strata.sources.tables import Tables
from strata.streaming.drain import apply_change_stream, drain


def envelopes(spark, sf):
    """``events`` as landed messages; kafka_offset = event_id, the partition
    is the user's hash bucket as a producer keyed by user would choose."""
    ev = Tables(spark, sf).events
    payload = F.to_json(F.struct("event_id", "user_id", "value", "props"))
    return ev.select(
        F.col("event_type").alias("source"),
        F.concat(F.lit("u/"), F.col("user_id").cast("string"), F.lit("/"),
                 F.date_format("ts", "yyyy-MM-dd")).alias("endpoint"),
        payload.alias("payload"), F.lit("events").alias("kafka_topic"),
        F.pmod(F.xxhash64("user_id"), F.lit(8)).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"), F.col("ts").cast("timestamp").alias("loaded_at"))


def q_landing_read(spark: SparkSession, sf: str):
    path = scratch_path(spark, "landing")
    landing.write_envelopes(envelopes(spark, sf), path)
    raw = landing.accepted(landing.read_envelopes(spark, path))
    body = F.from_json("payload", "event_id bigint, user_id bigint, value double")
    return raw.select("source", "endpoint", "kafka_offset", body["event_id"].alias("event_id"),
                      body["value"].alias("value"))


def q_landing_drain(spark, sf):
    base = scratch_path(spark, "drain")
    src, ckpt = f"{base}/incoming", f"{base}/checkpoint"
    layers = Layers(spark, f"{base}/tables", prefix=f"drain_{uuid.uuid4().hex[:8]}_")
    env = envelopes(spark, sf)
    ts = F.col("loaded_at").cast("timestamp_ntz")
    # first delivery, drained; then a replay overlapping it by three days
    landing.write_envelopes(env.filter(ts < F.lit(CUTOFF).cast("timestamp_ntz")), src)
    drain(spark, src, layers, "raw_events", ckpt)
    landing.write_envelopes(env.filter(ts >= F.lit(REPLAY_FROM).cast("timestamp_ntz")), src)
    drain(spark, src, layers, "raw_events", ckpt)
    return layers.read("raw_events").select("source", "endpoint", "kafka_offset")


#: Files of a delivery, dealt by key: more than a micro-batch takes.
FILES = 4


def q_landing_drain_batches(spark, sf):
    """The whole backlog, newer half first, a few files of it per micro-batch."""
    base = scratch_path(spark, "drain")
    src = f"{base}/incoming"
    layers = Layers(spark, f"{base}/tables", prefix=f"drainb_{uuid.uuid4().hex[:8]}_")
    env = envelopes(spark, sf)
    newer = F.col("loaded_at").cast("timestamp_ntz") >= F.lit(CUTOFF).cast("timestamp_ntz")
    for part in (env.filter(newer), env.filter(~newer)):
        landing.write_envelopes(part.repartition(FILES, "endpoint"), src)
        drain(spark, src, layers, "raw_events", f"{base}/checkpoint", max_files_per_trigger=FILES // 2)
    return layers.read("raw_events").select("source", "endpoint", "kafka_offset")


def q_landing_rejects(spark, sf):
    """Two feeds with lines that are no messages, into one reject table; then the
    first feed again under a fresh checkpoint: its rejects are stored once."""
    base = scratch_path(spark, "drain")
    layers = Layers(spark, f"{base}/tables", prefix=f"drainr_{uuid.uuid4().hex[:8]}_")
    env = envelopes(spark, sf)
    bad = F.concat(F.lit("{broken "), F.col("kafka_offset").cast("string"))
    feeds = {"errors": F.col("source") == "error", "others": F.col("source") != "error"}
    for feed, mine in feeds.items():
        rows = env.filter(mine)
        line = F.when(F.col("kafka_offset") % 7 == 0, bad).otherwise(F.to_json(F.struct(*landing.ENVELOPE_COLS)))
        rows.select(line.alias("value")).write.text(f"{base}/{feed}")
    for feed, run in (("errors", "a"), ("others", "a"), ("errors", "b")):
        drain(spark, f"{base}/{feed}", layers, "raw_events", f"{base}/checkpoint-{feed}-{run}", reject_table="rejects")
    return layers.read("rejects").select(F.col("_corrupt_record").alias("line"))


def q_cdc_stream_apply(spark, sf):
    """Change events in two deliveries, the older one second and overlapping."""
    base = scratch_path(spark, "cdc")
    src = f"{base}/incoming"
    layers = Layers(spark, f"{base}/tables", prefix=f"cdc_{uuid.uuid4().hex[:8]}_")
    ev = Tables(spark, sf).events
    for part in (ev.filter(F.col("ts") >= F.lit(REPLAY_FROM).cast("timestamp_ntz")),
                 ev.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))):
        change_events(spark, sf, part).select("value").write.mode("append").text(src)
        stream = spark.readStream.schema("value string").text(src)
        apply_change_stream(spark, stream, layers, "users", f"{base}/checkpoint", ["user_id"], "value", CDC_ROW)
    return layers.read("users")


def q_snapshot_replace_sink(spark, sf):
    """Messages kept by source; each source's new snapshot takes the place of its
    stored rows, an empty one too, and the other sources' files are not touched."""
    m = landing_q.messages(spark, sf).select("id", "source", "endpoint", "value")
    layers = Layers(spark, prefix=f"snap_{uuid.uuid4().hex[:8]}_")
    layers.full_refresh({"raw_messages": m}, partition_by={"raw_messages": ["source"]})
    newer = m.filter((F.col("source") == "error") & (F.col("value") > 100))
    for source in ("error", "signup"):  # nothing is left of the second
        layers.replace_partition("raw_messages", newer, "source", source)
    layers.vacuum("raw_messages")  # the folders that the new snapshots took the place of
    return layers.read("raw_messages")


def q_ref_reload(spark, sf):
    t = Tables(spark, sf)
    layers = Layers(spark, prefix=f"ref_{uuid.uuid4().hex[:8]}_")
    # an older load, then the current one: both tables are switched together
    layers.full_refresh({"region": t.region.withColumn("r_name", F.lower("r_name")),
                         "nation": t.nation.withColumn("n_name", F.lower("n_name"))})
    layers.full_refresh({"region": t.region, "nation": t.nation})
    now = layers.snapshot()  # both tables of one release, whatever is published meanwhile
    n, r = now.read("nation"), now.read("region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


AS_OF_DAY = "2001-08-01"


def liquidity_fact(orders):
    """Daily customer liquidity fact (D10: rows with a value only)."""
    return customer_daily(orders).filter(F.col("value_total").isNotNull())


def q_incremental_refresh(spark, sf):
    o = Tables(spark, sf).orders
    layers = Layers(spark, prefix=f"fct_{uuid.uuid4().hex[:8]}_")
    # first run: whole history, but from finished orders only (a stale load)
    layers.refresh_day("liquidity", liquidity_fact(o.filter(F.col("o_orderstatus") == "F")),
                       "trade_date", AS_OF_DAY)
    # incremental run: the run day is replaced by its full recomputation.
    # The day is a half-open range on the raw timestamp, so the filter is
    # pushed into the parquet scan and only that day's row groups are read.
    lo = F.to_timestamp(F.lit(AS_OF_DAY)).cast("timestamp_ntz")
    day = o.filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < lo + F.expr("INTERVAL 1 DAY")))
    layers.refresh_day("liquidity", liquidity_fact(day), "trade_date", AS_OF_DAY)
    return layers.read("liquidity").drop("trade_date_month")


def q_fact_view(spark, sf):
    o = Tables(spark, sf).orders
    name = f"fct_orders_daily_{uuid.uuid4().hex[:8]}"
    o.select(F.to_date("o_orderdate").alias("trade_date"), "o_orderkey", "o_custkey",
             F.col("o_totalprice").cast("decimal(18,2)").alias("total"), "o_orderstatus") \
        .createOrReplaceTempView(name)
    return spark.table(name).filter(F.col("o_orderstatus") != "P").drop("o_orderstatus")


QUERIES = {
    "landing_read": q_landing_read,
    "landing_drain": q_landing_drain,
    "landing_drain_batches": q_landing_drain_batches,
    "landing_rejects": q_landing_rejects,
    "cdc_stream_apply": q_cdc_stream_apply,
    "snapshot_replace_sink": q_snapshot_replace_sink,
    "ref_reload": q_ref_reload,
    "incremental_refresh": q_incremental_refresh,
    "fact_view": q_fact_view,
}

_ENDPOINT = "'u/' || CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d')"
_DAILY = """SELECT o_custkey, CAST(o_orderdate AS DATE) AS trade_date,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_total, COUNT(*) AS num_trades
FROM orders {where} GROUP BY 1, 2"""

ORACLE = {
    "landing_read": f"""SELECT event_type AS source, {_ENDPOINT} AS endpoint, event_id AS kafka_offset,
       event_id, value FROM events""",
    "landing_drain": f"""
SELECT source, endpoint, kafka_offset FROM (
  SELECT event_type AS source, {_ENDPOINT} AS endpoint, event_id AS kafka_offset,
         ROW_NUMBER() OVER (PARTITION BY event_type, {_ENDPOINT} ORDER BY event_id) AS rn FROM events) x
WHERE rn = 1""",
    "landing_rejects": "SELECT '{broken ' || CAST(event_id AS VARCHAR) AS line FROM events WHERE event_id % 7 = 0",
    "snapshot_replace_sink": """
SELECT event_id AS id, event_type AS source,
       'u/' || CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d') AS endpoint, value FROM events
WHERE event_type NOT IN ('error', 'signup') OR event_type = 'error' AND value > 100""",
    "ref_reload": """SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "incremental_refresh": f"""
SELECT * FROM ({_DAILY.format(where="WHERE o_orderstatus = 'F'")}) a WHERE trade_date <> DATE '{AS_OF_DAY}'
UNION ALL
SELECT * FROM ({_DAILY.format(where="")}) b WHERE trade_date = DATE '{AS_OF_DAY}'""",
    "fact_view": """SELECT CAST(o_orderdate AS DATE) AS trade_date, o_orderkey, o_custkey,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders WHERE o_orderstatus <> 'P'""",
}
# the smallest position wins, however the backlog is cut and ordered
ORACLE["landing_drain_batches"] = ORACLE["landing_drain"]
ORACLE["cdc_stream_apply"] = landing_q.ORACLE["cdc_apply"]
