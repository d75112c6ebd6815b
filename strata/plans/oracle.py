"""Equivalent ANSI SQL (DuckDB dialect) for every registered query.

The driver's tables are views named after the tables.  Each text computes
the same rows, columns and types as the Spark plan of the same key."""

from __future__ import annotations

from strata.sources.tables import DRIVER_TABLES

CUSTOMER_DAILY = """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS trade_date,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_total,
       COUNT(*) AS num_trades
FROM orders GROUP BY 1, 2
"""

PCT_CHANGE = f"""
WITH d AS ({CUSTOMER_DAILY}),
m AS (SELECT *, LAG(value_total) OVER (PARTITION BY o_custkey ORDER BY trade_date) AS prev_value FROM d)
SELECT o_custkey, trade_date, value_total, num_trades, prev_value,
       CASE WHEN prev_value IS NULL OR prev_value = 0 OR value_total IS NULL THEN NULL
            ELSE ROUND((CAST(value_total AS DOUBLE) - CAST(prev_value AS DOUBLE))
                       / CAST(prev_value AS DOUBLE) * 100, 4) END AS pct_change
FROM m
"""

SQL: dict[str, str] = {
    "pct_change": PCT_CHANGE,
    "top_movers": f"""SELECT * FROM ({PCT_CHANGE}) x
        ORDER BY pct_change DESC NULLS LAST, o_custkey, trade_date LIMIT 20""",
    "top_liquidity": f"""SELECT * FROM ({CUSTOMER_DAILY}) x
        ORDER BY value_total DESC NULLS LAST, o_custkey, trade_date LIMIT 20""",
}

_OVERVIEW = """
WITH prof AS (
  SELECT p_partkey, p_name, p_brand, p_size, 1 AS load_dts FROM part
  UNION ALL
  SELECT p_partkey, upper(p_name), p_brand, p_size, 2 FROM part WHERE p_brand = 'Brand#1'),
lp AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY load_dts DESC) AS rn FROM prof) x
       WHERE rn = 1),
m AS (SELECT l_partkey, COUNT(*) AS num_trades,
             CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_qty,
             CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_total
      FROM lineitem GROUP BY l_partkey)
SELECT lp.p_partkey, lp.p_name, lp.p_brand, lp.p_size, m.num_trades, m.total_qty, m.value_total
FROM lp LEFT JOIN m ON m.l_partkey = lp.p_partkey
"""

_FX = """
WITH s AS (
  SELECT o_orderpriority AS code, make_date(year(o_orderdate), 1, 1) AS rate_date, quarter(o_orderdate) AS load_seq,
         CAST(MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,6)) AS rate, CAST(COUNT(*) AS INTEGER) AS nominal
  FROM orders GROUP BY 1, 2, 3),
f AS (SELECT MAX(rate_date) AS fx_date FROM s)
SELECT f.fx_date,
  (SELECT arg_max(rate, load_seq) FROM s WHERE code = '1-URGENT' AND rate_date = f.fx_date) AS usd_rate,
  (SELECT arg_max(nominal, load_seq) FROM s WHERE code = '1-URGENT' AND rate_date = f.fx_date) AS usd_nominal,
  (SELECT arg_max(rate, load_seq) FROM s WHERE code = '2-HIGH' AND rate_date = f.fx_date) AS eur_rate,
  (SELECT arg_max(nominal, load_seq) FROM s WHERE code = '2-HIGH' AND rate_date = f.fx_date) AS eur_nominal
FROM f
"""

SQL.update({
    "mart_overview": _OVERVIEW,
    "mart_fx_rate": _FX,
    "mart_snapshot": f"""
WITH ov AS ({_OVERVIEW}), fx AS ({_FX})
SELECT ov.p_partkey, ov.p_name, fx.fx_date AS trade_date, CAST(p.p_retailprice AS DECIMAL(18,2)) AS last_price_rub,
       fx.usd_rate, fx.eur_rate,
       CASE WHEN fx.usd_rate IS NULL OR fx.usd_rate = 0 THEN NULL
            ELSE ROUND(CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) AS DOUBLE)
                       / (CAST(fx.usd_rate AS DOUBLE) / CAST(fx.usd_nominal AS DOUBLE)), 6) END AS last_price_usd,
       CASE WHEN fx.eur_rate IS NULL OR fx.eur_rate = 0 THEN NULL
            ELSE ROUND(CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) AS DOUBLE)
                       / (CAST(fx.eur_rate AS DOUBLE) / CAST(fx.eur_nominal AS DOUBLE)), 6) END AS last_price_eur,
       ov.num_trades, ov.value_total
FROM ov JOIN part p ON p.p_partkey = ov.p_partkey CROSS JOIN fx""",
    "layer_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
        for t in DRIVER_TABLES),
})
