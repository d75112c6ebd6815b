"""Registered landing / load-mode queries over the driver tables.

Messages are the ``events`` table seen as an envelope stream:
source = event_type, endpoint = 'u/<user_id>/<day>', id = event_id.  The
incoming batch of the first-wins load starts three days before the landed
window ends (a replayed delivery), so it meets keys already landed."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.functions import key_hash, mask_params
from strata.operators import loads
from strata.operators.keyed import dedupe_keep_first, latest, pick_preferred, pick_one
from strata.operators.schema import sync_schema
from strata.functions import hashdiff, hash_key
from strata.sources.tables import Tables

CUTOFF = "2024-01-15 00:00:00"
REPLAY_FROM = "2024-01-12 00:00:00"


def messages(spark, sf):
    ev = Tables(spark, sf).events
    return ev.select(F.col("event_id").alias("id"), F.col("event_type").alias("source"),
                     F.concat(F.lit("u/"), F.col("user_id").cast("string"), F.lit("/"),
                              F.date_format("ts", "yyyy-MM-dd")).alias("endpoint"),
                     "ts", "value")


def _split(spark, sf):
    m = messages(spark, sf)
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    replay = F.lit(REPLAY_FROM).cast("timestamp_ntz")
    return m.filter(F.col("ts") < cut), m.filter(F.col("ts") >= replay)


def q_landing_retro_dedupe(spark: SparkSession, sf: str):
    m = messages(spark, sf).select("id", "source", "endpoint")
    return dedupe_keep_first(m, ["source", "endpoint"], ["id"])


def q_landing_first_wins(spark, sf):
    target, batch = _split(spark, sf)
    return loads.append_first_wins(batch.select("id", "source", "endpoint"), target,
                                   ["source", "endpoint"], ["id"])


def q_landing_load_counts(spark, sf):
    target, batch = _split(spark, sf)
    return loads.first_wins_counts(batch, target, ["source", "endpoint"])


def q_key_hash(spark, sf):
    # the binary hash is shown as lower-case hex so both engines print it alike
    return messages(spark, sf).select("id", "source", "endpoint",
                                      F.lower(F.hex(key_hash("endpoint"))).alias("endpoint_hash_hex"))


def q_snapshot_replace(spark, sf):
    m = messages(spark, sf).select("id", "source", "endpoint", "value")
    new = m.filter((F.col("source") == "error") & (F.col("value") > 100))
    return loads.replace_by_source(m, new, "source", "error")


def _upsert_batch(part):
    updated = (part.filter(F.col("p_type") == "ECONOMY")
               .withColumn("p_retailprice", F.col("p_retailprice") + F.lit(1.0))
               .withColumn("p_size", F.col("p_size") + F.lit(1)))
    created = (part.filter(F.col("p_type") == "SMALL")
               .withColumn("p_partkey", F.col("p_partkey") + F.lit(10_000_000)))
    return updated.unionByName(created)


def q_upsert_rows(spark, sf):
    part = Tables(spark, sf).part
    return loads.upsert(part, _upsert_batch(part), ["p_partkey"])


def q_schema_sync(spark, sf):
    t = Tables(spark, sf)
    cust = t.customer.select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
                             F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                             F.col("c_mktsegment").alias("mktsegment"))
    supp = t.supplier.select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                             F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
                             F.lit("SUPPLIER").alias("party_type"))
    return sync_schema(cust, supp)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def q_rows_without_child(spark, sf):
    t = Tables(spark, sf)
    pending = t.orders.filter(F.col("o_orderstatus") == "P")
    pick = F.element_at(F.array(*[F.lit(p) for p in PRIORITIES]),
                        (F.col("c_custkey") % F.lit(len(PRIORITIES)) + 1).cast("int"))
    return loads.rows_without_child(
        t.customer.select("c_custkey"), pending, "c_custkey", "o_custkey",
        {"o_orderstatus": F.lit("P"), "o_orderpriority": pick})


CDC_ROW = "user_id bigint, event_id bigint, event_type string, value double"


def change_events(spark, sf, ev=None):
    """events as change messages: error -> delete, signup -> create, else update."""
    ev = Tables(spark, sf).events if ev is None else ev
    row = F.struct("user_id", "event_id", "event_type", "value")
    op = (F.when(F.col("event_type") == "error", F.lit("d"))
          .when(F.col("event_type") == "signup", F.lit("c")).otherwise(F.lit("u")))
    env = F.struct(
        F.when(op == "d", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        op.alias("op"),
        F.struct(F.col("event_id").alias("lsn")).alias("source"))
    return ev.select(F.col("user_id").cast("string").alias("key"), F.to_json(env).alias("value"))


def q_cdc_apply(spark, sf):
    ch = loads.parse_changes(change_events(spark, sf), "value", CDC_ROW)
    return loads.apply_changes(ch, ["user_id"], "lsn")


def q_mask_params(spark, sf):
    p = Tables(spark, sf).pages
    return p.select("page_id", mask_params("url", extra_keys=["ref"]).alias("url"))


def q_latest_snapshot(spark, sf):
    ev = Tables(spark, sf).events
    return latest(ev, ["event_type"], ["ts", "event_id"])


def q_latest_per_day(spark, sf):
    ev = Tables(spark, sf).events.withColumn("day", F.to_date("ts"))
    return pick_one(ev.select("day", "event_id", "user_id", "event_type", "value", "ts"), ["day"],
                    ["ts", "event_id"]).drop("ts")


def q_preferred_variant(spark, sf):
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return pick_preferred(o, ["o_custkey"], "o_orderstatus", "P", tiebreak=["o_orderkey"])


def user_satellite(spark, sf):
    ev = Tables(spark, sf).events
    return ev.select(hash_key("user_id").alias("user_hk"), F.col("ts").alias("load_dts"),
                     "event_id",
                     hashdiff("event_type", F.col("value").cast("decimal(18,2)")).alias("hashdiff"),
                     "event_type")


def q_sat_latest(spark, sf):
    return latest(user_satellite(spark, sf), ["user_hk"], ["load_dts", "event_id"])


QUERIES = {
    "landing_retro_dedupe": q_landing_retro_dedupe,
    "landing_first_wins": q_landing_first_wins,
    "landing_load_counts": q_landing_load_counts,
    "key_hash": q_key_hash,
    "snapshot_replace": q_snapshot_replace,
    "upsert_rows": q_upsert_rows,
    "schema_sync": q_schema_sync,
    "rows_without_child": q_rows_without_child,
    "cdc_apply": q_cdc_apply,
    "mask_params": q_mask_params,
    "latest_snapshot": q_latest_snapshot,
    "latest_per_day": q_latest_per_day,
    "preferred_variant": q_preferred_variant,
    "sat_latest": q_sat_latest,
}

_MSG = """(SELECT event_id AS id, event_type AS source,
           'u/' || CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d') AS endpoint,
           ts, value FROM events)"""
_FIRST_WINS = f"""
WITH m AS {_MSG},
b AS (SELECT * FROM m WHERE ts >= TIMESTAMP '{REPLAY_FROM}'),
t AS (SELECT * FROM m WHERE ts < TIMESTAMP '{CUTOFF}'),
f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source, endpoint ORDER BY id) AS rn FROM b)
SELECT id, source, endpoint FROM f
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM t WHERE t.source = f.source AND t.endpoint = f.endpoint)
"""

ORACLE = {
    "landing_retro_dedupe": f"""
SELECT id, source, endpoint FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY source, endpoint ORDER BY id) AS rn FROM {_MSG} m) x
WHERE rn = 1""",
    "landing_first_wins": _FIRST_WINS,
    "landing_load_counts": f"""
SELECT (SELECT COUNT(*) FROM events WHERE ts >= TIMESTAMP '{REPLAY_FROM}') AS read,
       (SELECT COUNT(*) FROM ({_FIRST_WINS}) i) AS inserted,
       (SELECT COUNT(*) FROM events WHERE ts >= TIMESTAMP '{REPLAY_FROM}')
       - (SELECT COUNT(*) FROM ({_FIRST_WINS}) i) AS skipped""",
    "key_hash": f"""SELECT id, source, endpoint, lower(hex(unhex(md5(COALESCE(endpoint, ''))))) AS endpoint_hash_hex
FROM {_MSG} m""",
    "snapshot_replace": f"""
SELECT id, source, endpoint, value FROM {_MSG} m WHERE source <> 'error'
UNION ALL
SELECT id, source, endpoint, value FROM {_MSG} m WHERE source = 'error' AND value > 100""",
    "upsert_rows": """
WITH n AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size + 1 AS p_size, p_retailprice + 1.0 AS p_retailprice
  FROM part WHERE p_type = 'ECONOMY'
  UNION ALL
  SELECT p_partkey + 10000000, p_name, p_brand, p_type, p_size, p_retailprice FROM part WHERE p_type = 'SMALL')
SELECT * FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM n)
UNION ALL SELECT * FROM n""",
    "schema_sync": """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment, CAST(NULL AS VARCHAR) AS party_type FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'SUPPLIER' FROM supplier""",
    "rows_without_child": """
SELECT c_custkey AS o_custkey, 'P' AS o_orderstatus,
       ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][CAST(c_custkey % 5 AS INTEGER) + 1]
         AS o_orderpriority
FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""",
    "cdc_apply": """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) x
WHERE rn = 1 AND event_type <> 'error'""",
    "mask_params": r"""
SELECT page_id,
  regexp_replace(url,
    '([?&](?:api_key|token|password|secret|authorization|ref|[^&=#]*(?:_key|_token|_secret|_password))=)[^&#]*',
    '\1***', 'gi') AS url
FROM pages""",
    "latest_snapshot": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
WHERE rn = 1""",
    "latest_per_day": """
SELECT day, event_id, user_id, event_type, value FROM (
  SELECT *, CAST(ts AS DATE) AS day,
         ROW_NUMBER() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) x
WHERE rn = 1""",
    "preferred_variant": """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
    ORDER BY (o_orderstatus = 'P') DESC NULLS FIRST, o_orderstatus ASC NULLS LAST, o_orderkey) AS rn
  FROM orders) x
WHERE rn = 1""",
    "sat_latest": """
SELECT user_hk, load_dts, event_id, hashdiff, event_type FROM (
  SELECT md5(CAST(user_id AS VARCHAR)) AS user_hk, ts AS load_dts, event_id,
         md5(COALESCE(event_type, '') || '|' || COALESCE(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ''))
           AS hashdiff,
         event_type,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) x
WHERE rn = 1""",
}
