"""Registered mart queries: movers, top-N, overview, rates, snapshot."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.operators import marts
from strata.plans.common import customer_daily
from strata.sources.tables import DRIVER_TABLES, Tables


def q_pct_change(spark: SparkSession, sf: str):
    t = Tables(spark, sf)
    daily = customer_daily(t.orders)
    w = marts.with_previous(daily, ["o_custkey"], ["trade_date"], "value_total", "prev_value")
    return w.withColumn("pct_change",
                        marts.pct_change(F.col("value_total").cast("double"),
                                         F.col("prev_value").cast("double"), 4))


def q_top_movers(spark: SparkSession, sf: str):
    return marts.top_n(q_pct_change(spark, sf),
                       [F.col("pct_change").desc_nulls_last(), "o_custkey", "trade_date"], 20)


def q_top_liquidity(spark: SparkSession, sf: str):
    daily = customer_daily(Tables(spark, sf).orders)
    return marts.top_n(daily, [F.col("value_total").desc_nulls_last(), "o_custkey", "trade_date"], 20)


QUERIES = {
    "pct_change": q_pct_change,
    "top_movers": q_top_movers,
    "top_liquidity": q_top_liquidity,
}


# Overview, reference rates, converted snapshot --------------------------------

from strata.functions import hash_key  # noqa: E402
from strata.operators import vault  # noqa: E402
from strata.operators.keyed import latest  # noqa: E402

PROFILE = ["p_name", "p_brand", "p_size"]


def part_profile_sat(spark, sf):
    """Two loads of a part profile satellite: the second renames Brand#1 parts."""
    p = Tables(spark, sf).part
    hk = {"part_hk": hash_key("p_partkey")}
    s1 = vault.load_sat(p, hk, PROFILE, "PART_STG", load_dts=F.lit(1))
    p2 = p.filter(F.col("p_brand") == "Brand#1").withColumn("p_name", F.upper("p_name"))
    s2 = vault.load_sat(p2, hk, PROFILE, "PART_STG", load_dts=F.lit(2))
    return s1.unionByName(s2)


def part_market(spark, sf):
    li = Tables(spark, sf).lineitem
    # aggregate on the raw key (a long, combined map-side), hash once per part
    return (li.groupBy("l_partkey")
            .agg(F.count(F.lit(1)).alias("num_trades"),
                 F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_qty"),
                 F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("value_total"))
            .select(hash_key("l_partkey").alias("part_hk"), "num_trades", "total_qty", "value_total"))


def q_mart_overview(spark, sf):
    t = Tables(spark, sf)
    hub = vault.load_hub(t.part, {"p_partkey": "p_partkey"}, "part_hk", "PART_STG")
    prof = latest(part_profile_sat(spark, sf), ["part_hk"], ["load_dts", "hashdiff"])
    sp = hub.select("part_hk", "p_partkey").join(prof.select("part_hk", *PROFILE), "part_hk")
    return marts.overview(sp, part_market(spark, sf), "part_hk").drop("part_hk")


def fx_satellite(spark, sf):
    """Rate satellite from orders: code = priority, date = order year, one
    load per quarter; rate = lowest order total, nominal = order count."""
    o = Tables(spark, sf).orders
    return (o.groupBy(F.col("o_orderpriority").alias("code"),
                      F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("rate_date"),
                      F.quarter("o_orderdate").alias("load_seq"))
            .agg(F.min(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,6)").alias("rate"),
                 F.count(F.lit(1)).cast("int").alias("nominal")))


USD, EUR = "1-URGENT", "2-HIGH"


def fx_rates(spark, sf):
    sat = fx_satellite(spark, sf)
    fx_date = marts.latest_value_date(sat, "rate_date")
    return marts.rates_at(sat, "code", "rate_date", "load_seq", {USD: "usd", EUR: "eur"},
                          ["rate", "nominal"], fx_date)


def q_mart_fx_rate(spark, sf):
    return fx_rates(spark, sf).drop("usd_present", "eur_present")


def q_mart_snapshot(spark, sf):
    ov = q_mart_overview(spark, sf)
    price = Tables(spark, sf).part.select("p_partkey", F.col("p_retailprice").cast("decimal(18,2)").alias("last_price_rub"))
    snap = marts.snapshot(ov.join(price, "p_partkey"), fx_rates(spark, sf))

    def conv(rate, nominal):
        return marts.convert(F.col("last_price_rub").cast("double"), F.col(rate).cast("double"),
                             F.col(nominal).cast("double"), 6)
    return snap.select("p_partkey", "p_name", F.col("fx_date").alias("trade_date"), "last_price_rub",
                       F.col("usd_rate"), F.col("eur_rate"),
                       conv("usd_rate", "usd_nominal").alias("last_price_usd"),
                       conv("eur_rate", "eur_nominal").alias("last_price_eur"),
                       "num_trades", "value_total")


def q_layer_counts(spark, sf):
    t = Tables(spark, sf)
    return marts.layer_counts({n: t.read(n) for n in DRIVER_TABLES})


QUERIES.update({
    "mart_overview": q_mart_overview,
    "mart_fx_rate": q_mart_fx_rate,
    "mart_snapshot": q_mart_snapshot,
    "layer_counts": q_layer_counts,
})
