"""Registered data-quality queries (the reference's dbt tests and DDL
constraints as checks returning failing rows)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans.marts_q import q_mart_overview, q_pct_change
from strata.sources.tables import Tables

OVERVIEW_COLS = ["p_partkey", "p_name", "num_trades", "total_qty", "value_total"]


def q_dq_not_null(spark: SparkSession, sf: str):
    return quality.not_null_counts(q_mart_overview(spark, sf), OVERVIEW_COLS, "mart_overview")


def q_dq_unique(spark, sf):
    # o_custkey alone is not a key of orders: fails on purpose
    return quality.unique(Tables(spark, sf).orders, ["o_custkey"])


def q_dq_non_negative(spark, sf):
    return quality.non_negative(Tables(spark, sf).customer.select("c_custkey", "c_acctbal"), "c_acctbal")


def q_dq_bounds(spark, sf):
    pc = q_pct_change(spark, sf).select("o_custkey", "trade_date", "pct_change")
    return quality.bounds(pc, "pct_change", -50, 50)


REFERENCES = {
    "orders_customer_fk": ("orders", "o_custkey", "customer", "c_custkey"),
    "lineitem_part_fk": ("lineitem", "l_partkey", "part", "p_partkey"),
    "lineitem_orders_fk": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
}


def _tables(spark, sf):
    t = Tables(spark, sf)
    return {n: getattr(t, n) for n in ("lineitem", "orders", "customer", "part")}


def q_dq_fk_orphans(spark, sf):
    return quality.shared_scan(_tables(spark, sf), references=REFERENCES).select(
        F.col("test_name").alias("check_name"), F.col("failures").alias("n_orphans"))


def q_dq_report(spark, sf):
    # all not-null tests of a table in one aggregation pass
    nn = quality.not_null_counts(q_mart_overview(spark, sf), OVERVIEW_COLS, "mart_overview").select(
        F.concat(F.lit("not_null_"), "column_name").alias("test_name"), F.col("n_null").alias("failures"))
    # the tables' own checks, each table read once for all of them
    own = quality.shared_scan(
        _tables(spark, sf),
        unique={"unique_lineitem_order_line": ("lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]),
                "unique_orders_custkey": ("orders", ["o_custkey"])},
        references=REFERENCES, rules={"non_negative_acctbal": ("customer", F.col("c_acctbal") < 0)})
    return quality.report({"pct_change_bounds": quality.bounds(q_pct_change(spark, sf), "pct_change", -50, 50)}, counted=[nn, own])


QUERIES = {
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_non_negative": q_dq_non_negative,
    "dq_bounds": q_dq_bounds,
    "dq_fk_orphans": q_dq_fk_orphans,
    "dq_report": q_dq_report,
}


def _oracle():
    from strata.plans.oracle import PCT_CHANGE, _OVERVIEW
    nn = " UNION ALL ".join(
        f"SELECT 'mart_overview' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null FROM ov"
        for c in OVERVIEW_COLS)
    fk = """
SELECT 'orders_customer_fk' AS check_name, COUNT(*) AS n_orphans FROM orders o
  WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL
SELECT 'lineitem_part_fk', COUNT(*) FROM lineitem l
  WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL
SELECT 'lineitem_orders_fk', COUNT(*) FROM lineitem l
  WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)"""
    nn_report = " UNION ALL ".join(
        f"SELECT 'not_null_{c}' AS test_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS failures FROM ov"
        for c in OVERVIEW_COLS)
    report = f"""
WITH ov AS ({_OVERVIEW}), pc AS ({PCT_CHANGE}),
r AS (
  {nn_report}
  UNION ALL SELECT 'unique_lineitem_order_line', COUNT(*) FROM (
    SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate HAVING COUNT(*) > 1) u
  UNION ALL SELECT 'unique_orders_custkey', COUNT(*) FROM (
    SELECT 1 FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1) u
  UNION ALL SELECT 'non_negative_acctbal', COUNT(*) FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'pct_change_bounds', COUNT(*) FROM pc WHERE pct_change < -50 OR pct_change > 50
  UNION ALL SELECT check_name, n_orphans FROM ({fk}) f)
SELECT test_name, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM r"""
    return {
        "dq_not_null": f"WITH ov AS ({_OVERVIEW}) {nn}",
        "dq_unique": "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1",
        "dq_non_negative": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0",
        "dq_bounds": f"""SELECT o_custkey, trade_date, pct_change FROM ({PCT_CHANGE}) x
WHERE pct_change < -50 OR pct_change > 50""",
        "dq_fk_orphans": fk,
        "dq_report": report,
    }


ORACLE = _oracle()
