"""Registered vault and history queries over the driver tables.

Hubs: customer (from orders' customer keys), nation, calendar (order dates
plus the run date).  Links: customer x nation x run date (join form) and
order -> customer (staged form).  Satellites: customer profile with a
hashdiff.  History: daily purchase regime of each user as a type-2
dimension, joined back to every event by date."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.functions import band, hash_key
from strata.operators import history, vault
from strata.sources.tables import Tables

AS_OF = "2001-12-31"
PROFILE_ATTRS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def customer_stage(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", "c_name", "c_nationkey",
                    F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"), "c_mktsegment")


def hub_customer(spark, sf):
    o = Tables(spark, sf).orders
    return vault.load_hub(o, {"c_custkey": "o_custkey"}, "customer_hk", "ORDERS_STG")


def hub_calendar(spark, sf):
    o = Tables(spark, sf).orders
    return vault.load_calendar(o, "o_orderdate", AS_OF, "ORDERS_STG")


def q_hub_load(spark: SparkSession, sf: str):
    return hub_customer(spark, sf)


def q_hub_calendar(spark, sf):
    return hub_calendar(spark, sf)


def q_hub_insert_if_absent(spark, sf):
    cal = hub_calendar(spark, sf)
    li = Tables(spark, sf).lineitem
    ship = li.select(F.to_date("l_shipdate").alias("business_date")).select(
        hash_key("business_date").alias("date_hk"), "business_date",
        F.lit("LINEITEM_STG").alias("record_source"))
    return vault.extend_hub(cal, ship, "business_date")


def q_link_join(spark, sf):
    t = Tables(spark, sf)
    hc = hub_customer(spark, sf)
    hn = vault.load_hub(t.nation, {"n_nationkey": "n_nationkey"}, "nation_hk", "NATION_STG")
    run_day = hub_calendar(spark, sf).filter(F.col("business_date") == F.to_date(F.lit(AS_OF)))
    cust = t.customer.select(F.col("c_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    # the run-date hub row is at most one row (the business key is unique in
    # a hub): a scalar subquery; no run-date row -> no link rows
    run_hk = run_day.select("date_hk").scalar()
    members = (hc.join(cust, "c_custkey").join(hn, "n_nationkey")
               .select("*", run_hk.alias("date_hk")).filter(F.col("date_hk").isNotNull()))
    return vault.link_from_members(members, ["customer_hk", "nation_hk", "date_hk"], "link_hk",
                                   "ORDERS+NATION")


def q_link_staged(spark, sf):
    # distinct on the two numbers, hashed afterwards
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey").distinct()
    staged = o.select(hash_key("o_orderkey").alias("order_hk"), hash_key("o_custkey").alias("customer_hk"))
    return vault.link_from_members(staged, ["order_hk", "customer_hk"], "order_customer_hk", "ORDERS_STG", distinct=False)


def sat_profile(stg):
    return vault.load_sat(stg, {"customer_hk": hash_key("c_custkey")}, PROFILE_ATTRS, "CUSTOMER_STG")


def q_sat_load(spark, sf):
    return sat_profile(customer_stage(spark, sf))


def q_sat_append_changed(spark, sf):
    stg = customer_stage(spark, sf)
    load1 = sat_profile(stg).withColumn("load_seq", F.lit(1))
    furn = F.col("c_mktsegment") == "FURNITURE"
    stg2 = stg.withColumn("c_acctbal", F.when(furn, F.col("c_acctbal") + 2).otherwise(F.col("c_acctbal")))
    load2 = sat_profile(stg2.filter(furn)).withColumn("load_seq", F.lit(2))
    stored = load1.unionByName(load2)
    bump = F.col("c_mktsegment") == "BUILDING"
    stg3 = stg2.withColumn("c_acctbal", F.when(bump, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    new = sat_profile(stg3)
    return vault.changed_rows(stored, new, ["customer_hk"], load_col="load_seq")


# History -------------------------------------------------------------------

def daily_state(spark, sf):
    """One row per (user, day): type of the day's last event and whether any
    event of the day was above 100 (pre-aggregated, map-side combined)."""
    ev = Tables(spark, sf).events
    return (ev.groupBy("user_id", F.to_date("ts").alias("day"))
            .agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("regime"),
                 F.bool_or(F.col("value") > 100).alias("flag")))


def q_scd2_history(spark, sf):
    return history.scd2(daily_state(spark, sf), ["user_id"], "day", ["regime", "flag"])


def purchase_dim(spark, sf):
    ev = Tables(spark, sf).events.filter(F.col("event_type") == "purchase")
    st = (ev.groupBy("user_id", F.to_date("ts").alias("day"))
          .agg(F.max("value").alias("top")))
    st = st.withColumn("tier", band("top", [50, 200], ["low", "mid", "high"])).drop("top")
    return history.scd2(st, ["user_id"], "day", ["tier"])


def q_interval_join(spark, sf):
    ev = Tables(spark, sf).events.select("event_id", "user_id", "ts", "event_type")
    dim = purchase_dim(spark, sf).select("user_id", "valid_from", "valid_to", "tier", "version_num")
    return history.interval_join(ev, dim, ["user_id"], "ts")


QUERIES = {
    "hub_load": q_hub_load,
    "hub_calendar": q_hub_calendar,
    "hub_insert_if_absent": q_hub_insert_if_absent,
    "link_join": q_link_join,
    "link_staged": q_link_staged,
    "sat_load": q_sat_load,
    "sat_append_changed": q_sat_append_changed,
    "scd2_history": q_scd2_history,
    "interval_join": q_interval_join,
}

_HUB_CAL = f"""
SELECT md5(CAST(business_date AS VARCHAR)) AS date_hk, business_date, 'ORDERS_STG' AS record_source FROM (
  SELECT CAST(o_orderdate AS DATE) AS business_date FROM orders
  UNION SELECT DATE '{AS_OF}') t"""

_PROFILE_HD = """md5(COALESCE(c_name, '') || '|' || COALESCE(CAST(c_nationkey AS VARCHAR), '') || '|'
     || COALESCE(CAST(c_acctbal AS VARCHAR), '') || '|' || COALESCE(c_mktsegment, ''))"""
_STAGE = "(SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer)"

_SCD2 = """
WITH s AS ({src}),
h AS (SELECT *, md5({hd}) AS ch FROM s),
m AS (SELECT *, CASE WHEN LAG(ch) OVER (PARTITION BY user_id ORDER BY day) = ch THEN 0 ELSE 1 END AS chg FROM h),
g AS (SELECT *, SUM(chg) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM m),
r AS (SELECT user_id, grp, MIN(day) AS source_start_date, MAX(day) AS source_end_date, {aggs}
      FROM g GROUP BY user_id, grp)
SELECT md5(CAST(user_id AS VARCHAR) || CAST(source_start_date AS VARCHAR)) AS scd_id, user_id, {attrs},
       source_start_date AS valid_from,
       CAST(LEAD(source_start_date) OVER w - INTERVAL 1 DAY AS DATE) AS valid_to,
       LEAD(source_start_date) OVER w IS NULL AS is_current,
       ROW_NUMBER() OVER w AS version_num,
       source_start_date, source_end_date
FROM r WINDOW w AS (PARTITION BY user_id ORDER BY source_start_date)"""

_DAILY = """SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, (ts, event_id)) AS regime,
       bool_or(value > 100) AS flag FROM events GROUP BY 1, 2"""
_SCD2_HISTORY = _SCD2.format(
    src=_DAILY, hd="COALESCE(regime, '') || '|' || COALESCE(CAST(flag AS VARCHAR), '')",
    aggs="MAX(regime) AS regime, bool_or(flag) AS flag", attrs="regime, flag")
_PURCHASE_DIM = _SCD2.format(
    src="""SELECT user_id, day, CASE WHEN top < 50 THEN 'low' WHEN top < 200 THEN 'mid' ELSE 'high' END AS tier
           FROM (SELECT user_id, CAST(ts AS DATE) AS day, MAX(value) AS top FROM events
                 WHERE event_type = 'purchase' GROUP BY 1, 2) p""",
    hd="COALESCE(tier, '')", aggs="MAX(tier) AS tier", attrs="tier")

ORACLE = {
    "hub_load": """SELECT md5(CAST(c_custkey AS VARCHAR)) AS customer_hk, c_custkey, 'ORDERS_STG' AS record_source
FROM (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_custkey IS NOT NULL) t""",
    "hub_calendar": _HUB_CAL,
    "hub_insert_if_absent": f"""
WITH cal AS ({_HUB_CAL})
SELECT * FROM cal
UNION ALL
SELECT md5(CAST(d AS VARCHAR)), d, 'LINEITEM_STG' FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem) s
WHERE d NOT IN (SELECT business_date FROM cal)""",
    "link_join": f"""
SELECT md5(md5(CAST(c.c_custkey AS VARCHAR)) || md5(CAST(c.c_nationkey AS VARCHAR)) || md5('{AS_OF}')) AS link_hk,
       md5(CAST(c.c_custkey AS VARCHAR)) AS customer_hk, md5(CAST(c.c_nationkey AS VARCHAR)) AS nation_hk,
       md5('{AS_OF}') AS date_hk, 'ORDERS+NATION' AS record_source
FROM customer c
WHERE c.c_custkey IN (SELECT o_custkey FROM orders) AND c.c_nationkey IN (SELECT n_nationkey FROM nation)""",
    "link_staged": """
SELECT md5(order_hk || customer_hk) AS order_customer_hk, order_hk, customer_hk, 'ORDERS_STG' AS record_source
FROM (SELECT DISTINCT md5(CAST(o_orderkey AS VARCHAR)) AS order_hk, md5(CAST(o_custkey AS VARCHAR)) AS customer_hk
      FROM orders) t""",
    "sat_load": f"""
SELECT md5(CAST(c_custkey AS VARCHAR)) AS customer_hk, {_PROFILE_HD} AS hashdiff,
       c_name, c_nationkey, c_acctbal, c_mktsegment, 'CUSTOMER_STG' AS record_source
FROM {_STAGE} s""",
    "sat_append_changed": f"""
WITH s2 AS (SELECT c_custkey, c_name, c_nationkey,
                   CASE WHEN c_mktsegment = 'FURNITURE' THEN c_acctbal + 2 ELSE c_acctbal END AS c_acctbal,
                   c_mktsegment FROM {_STAGE} s),
s3 AS (SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
              c_mktsegment FROM s2),
stored AS (SELECT c_custkey, {_PROFILE_HD} AS hashdiff, 1 AS load_seq FROM {_STAGE} s
           UNION ALL SELECT c_custkey, {_PROFILE_HD}, 2 FROM s2 WHERE c_mktsegment = 'FURNITURE'),
cur AS (SELECT c_custkey, arg_max(hashdiff, (load_seq, hashdiff)) AS hd FROM stored GROUP BY 1)
SELECT md5(CAST(s3.c_custkey AS VARCHAR)) AS customer_hk, {_PROFILE_HD} AS hashdiff,
       c_name, c_nationkey, c_acctbal, c_mktsegment, 'CUSTOMER_STG' AS record_source
FROM s3 LEFT JOIN cur USING (c_custkey)
WHERE cur.hd IS DISTINCT FROM {_PROFILE_HD}""",
    "scd2_history": _SCD2_HISTORY,
    "interval_join": f"""
WITH d AS ({_PURCHASE_DIM})
SELECT e.event_id, e.user_id, e.ts, e.event_type, d.tier, d.version_num
FROM events e LEFT JOIN d
  ON d.user_id = e.user_id
 AND CAST(e.ts AS DATE) BETWEEN d.valid_from AND COALESCE(d.valid_to, DATE '2999-12-31')""",
}
