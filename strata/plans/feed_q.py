"""Registered queries of the vault job over the driver tables: staging tables
in the shape of the market and currency feeds are published from ``part``,
``lineitem``, ``orders`` and ``customer``, and the job's own steps (full
rebuild, incremental loads, marts) run on them through :class:`Layers`."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.operators import decode
from strata.plans import jobs, landing_q
from strata.sources.layers import Layers
from strata.sources.tables import Tables

AS_OF = "2001-12-31"
MARKET_COLS = ["last_price", "prev_price", "num_trades", "value_total"]


def _layers(spark, kind: str) -> Layers:
    return Layers(spark, prefix=f"{kind}_{uuid.uuid4().hex[:8]}_")


def securities(spark, sf):
    return Tables(spark, sf).part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("secid"), F.col("p_name").alias("shortname"),
        F.col("p_brand").alias("boardid"), F.col("p_size").alias("lot_size"), F.col("p_type").alias("secname"),
        F.lit(None).cast("string").alias("regnumber"))


def market(spark, sf):
    t = Tables(spark, sf)
    # on the raw key, combined map-side: a hot part is one row per task
    traded = t.lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).cast("int").alias("num_trades"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("value_total"))
    price = F.col("p_retailprice")
    return t.part.join(traded, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("secid"), F.col("p_brand").alias("boardid"),
        price.cast("decimal(18,6)").alias("last_price"),
        (price.cast("decimal(18,2)") - F.col("p_size")).cast("decimal(18,6)").alias("prev_price"),
        F.lit(None).cast("decimal(18,6)").alias("market_price_24h"), "num_trades", "value_total")


def fx_rates(spark, sf):
    t = Tables(spark, sf)
    nation = F.col("c_nationkey")
    code = F.when(nation == 0, "USD").when(nation == 1, "EUR").otherwise(F.concat(F.lit("N"), nation.cast("string")))
    best = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.to_date("o_orderdate").alias("rate_date"), "c_nationkey")
            .agg(F.max(F.col("o_totalprice").cast("decimal(18,6)")).alias("rate")))
    rates = best.select("rate_date", code.alias("char_code"), F.lit(1).alias("nominal"), "rate", code.alias("currency_name"))
    base, nominal, rate, name = jobs.BASE_CURRENCY
    return decode.union_constant(rates, ["rate_date"], {"char_code": F.lit(base), "nominal": F.lit(nominal),
                                                        "rate": F.lit(rate), "currency_name": F.lit(name)})


def q_vault_rebuild(spark: SparkSession, sf: str):
    """An older vault, then the full rebuild over the current staging tables."""
    layers = _layers(spark, "vault")
    sec, md, fx = securities(spark, sf), market(spark, sf), fx_rates(spark, sf)
    layers.full_refresh({"stg_moex_securities": sec.filter("lot_size < 25"), "stg_moex_marketdata": md.filter("num_trades > 20"),
                         "stg_cbr_fx_rates": fx})
    jobs.build_vault(layers, AS_OF, f"{AS_OF} 09:00:00")
    layers.full_refresh({"stg_moex_securities": sec, "stg_moex_marketdata": md})
    jobs.build_vault(layers, AS_OF, f"{AS_OF} 10:00:00")
    rows = None
    for table, key, detail in (
            ("hub_security", "security_hk", "secid"), ("hub_currency", "currency_hk", "char_code"),
            ("hub_calendar", "date_hk", "business_date"), ("link_security_currency_date", "link_hk", "security_hk"),
            ("sat_security_profile", "security_hk", "hashdiff"), ("sat_security_market", "security_hk", "hashdiff"),
            ("sat_currency_rate", "currency_hk", "hashdiff")):
        part = layers.read(table).select(F.lit(table).alias("table_name"), F.col(key).alias("hk"),
                                         F.col(detail).cast("string").alias("detail"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def q_mart_after_incremental(spark, sf):
    """Profiles of two brands change and those of one change back: the mart
    shows the newest load, not the largest hash."""
    layers = _layers(spark, "mart")
    sec = securities(spark, sf)
    layers.full_refresh({"stg_moex_securities": sec, "stg_moex_marketdata": market(spark, sf),
                         "stg_cbr_fx_rates": fx_rates(spark, sf)})
    jobs.build_vault(layers, AS_OF, f"{AS_OF} 09:00:00")
    for brands, hour in ((["Brand#1", "Brand#2"], 10), (["Brand#2"], 11)):
        name = F.when(F.col("boardid").isin(brands), F.upper("shortname")).otherwise(F.col("shortname"))
        layers.full_refresh({"stg_moex_securities": sec.withColumn("shortname", name)})
        jobs.build_vault(layers, AS_OF, f"{AS_OF} {hour}:00:00", incremental=True)
    jobs.publish_marts(layers, AS_OF)
    return layers.read("dm_moex_share_overview").select("secid", "shortname", "boardid", "lot_size", *MARKET_COLS)


def q_upsert_sink(spark, sf):
    """The upsert of ``upsert_rows`` through a keyed table."""
    layers = _layers(spark, "ups")
    part = Tables(spark, sf).part
    layers.upsert("part", part, ["p_partkey"], n_buckets=4)
    layers.upsert("part", landing_q._upsert_batch(part), ["p_partkey"])
    return layers.read("part")


QUERIES = {
    "vault_rebuild": q_vault_rebuild,
    "mart_after_incremental": q_mart_after_incremental,
    "upsert_sink": q_upsert_sink,
}

_MARKET = """
SELECT 'P' || p_partkey AS secid, CAST(p_retailprice AS DECIMAL(18,6)) AS last_price,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) - p_size AS DECIMAL(18,6)) AS prev_price, num_trades, value_total
FROM part LEFT JOIN (SELECT l_partkey, CAST(COUNT(*) AS INTEGER) AS num_trades,
                            CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value_total
                     FROM lineitem GROUP BY 1) l ON l_partkey = p_partkey"""
_FX = """
SELECT CAST(o_orderdate AS DATE) AS rate_date,
       CASE c_nationkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'N' || c_nationkey END AS char_code,
       MAX(CAST(o_totalprice AS DECIMAL(18,6))) AS rate
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""


def _text(c: str) -> str:
    return f"COALESCE(CAST({c} AS VARCHAR), '')"


def _diff(*cols: str) -> str:
    return "md5(" + " || '|' || ".join(_text(c) for c in cols) + ")"


ORACLE = {
    "vault_rebuild": f"""
WITH p AS (SELECT *, 'P' || p_partkey AS secid FROM part),
fx AS ({_FX}), m AS ({_MARKET}),
rates AS (SELECT * FROM fx UNION ALL SELECT DISTINCT rate_date, 'RUB', CAST(1 AS DECIMAL(18,6)) FROM fx)
SELECT 'hub_security' AS table_name, md5(secid) AS hk, secid AS detail FROM p
UNION ALL SELECT 'hub_currency', md5(char_code), char_code FROM (SELECT DISTINCT char_code FROM rates) c
UNION ALL SELECT 'hub_calendar', md5(d), d FROM (
  SELECT CAST(rate_date AS VARCHAR) AS d FROM fx UNION SELECT '{AS_OF}') d
UNION ALL SELECT 'link_security_currency_date', md5(md5(secid) || md5('RUB') || md5('{AS_OF}')), md5(secid) FROM p
UNION ALL SELECT 'sat_security_profile', md5(secid), {_diff('p_name', 'p_brand', 'p_size', 'p_type', 'NULL')} FROM p
UNION ALL SELECT 'sat_security_market', md5(secid), {_diff('last_price', 'prev_price', 'NULL', 'num_trades', 'value_total')} FROM m
UNION ALL SELECT 'sat_currency_rate', md5(char_code), {_diff('1', 'rate')} FROM rates""",
    "mart_after_incremental": f"""
SELECT secid, CASE WHEN p_brand = 'Brand#2' THEN upper(p_name) ELSE p_name END AS shortname, p_brand AS boardid,
       p_size AS lot_size, last_price, prev_price, num_trades, value_total
FROM part JOIN ({_MARKET}) m ON secid = 'P' || p_partkey""",
    "upsert_sink": landing_q.ORACLE["upsert_rows"],
}
