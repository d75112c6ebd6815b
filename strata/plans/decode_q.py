"""Registered staging-decode and gap queries: payloads are built from the
driver tables in the reference's JSON shapes (``strata.plans.messages``),
decoded back with the operators, and compared with the plain relational
answer."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.functions import band, typed
from strata.operators import decode, gaps
from strata.operators.keyed import latest_per
from strata.plans import messages as M
from strata.sources.tables import Tables

# The reference's weather bands (upper edges and names).
REGIME_EDGES = [0, 10, 20, 28]
REGIME_LABELS = ["freezing", "cold", "mild", "warm", "hot"]

MATRIX_FIELDS = {
    "l_orderkey": ("ORDERKEY", "bigint"),
    "l_linenumber": ("LINENUMBER", "int"),
    "l_returnflag": ("FLAG", "string"),
    "l_quantity": ("QTY", "decimal(18,2)"),
    "l_extendedprice": ("PRICE", "decimal(18,2)"),
    "l_discount": ("DISC", "decimal(4,2)"),
    "l_tax": ("TAX", "decimal(4,2)"),   # not in the header -> NULL
}


def q_matrix_decode(spark: SparkSession, sf: str):
    p = M.matrix_payloads(Tables(spark, sf).lineitem)
    return decode.decode_matrix(p, F.col("payload"), MATRIX_FIELDS, key="l_orderkey", path="$.lineitems")


def q_typed_cast(spark, sf):
    p = M.matrix_payloads(Tables(spark, sf).lineitem)
    fields = {"l_orderkey": ("ORDERKEY", "bigint"), "l_linenumber": ("LINENUMBER", "int"),
              "flag_code": ("CODE", "int"), "l_discount": ("DISC", "decimal(4,2)")}
    return decode.decode_matrix(p, F.col("payload"), fields, key="l_orderkey", safe=True, path="$.lineitems")


def q_typed_rejects(spark, sf):
    p = M.matrix_payloads(Tables(spark, sf).lineitem)
    fields = {"l_orderkey": ("ORDERKEY", "bigint"), "l_linenumber": ("LINENUMBER", "int"),
              "flag_code": ("CODE", "string"), "l_discount": ("DISC", "string")}
    text = decode.decode_matrix(p, F.col("payload"), fields, key="l_orderkey", path="$.lineitems")
    _, bad = decode.split_typed(text, {"flag_code": "int", "l_discount": "decimal(4,2)"},
                                keep=["l_orderkey", "l_linenumber"])
    return bad.withColumn("failed_columns", F.array_join("failed_columns", ","))


def q_map_explode(spark, sf):
    p = M.object_map_payloads(Tables(spark, sf).orders).filter(F.col("source") == "CBR_DAILY")
    day = F.to_date(F.to_timestamp(F.get_json_object("payload", "$.Date")))
    best = latest_per(p.withColumn("rate_date", day), F.col("rate_date"), ["load_seq"])
    rates = decode.explode_object(best, F.col("payload"),
                                  "Nominal int, Value decimal(18,6), Name string",
                                  keep=["rate_date"], key_name="char_code", member="Valute")
    rates = rates.select("rate_date", "char_code", F.col("Nominal").alias("nominal"),
                         F.col("Value").alias("rate"), F.col("Name").alias("currency_name"))
    return decode.union_constant(rates, ["rate_date"], {
        "char_code": F.lit("RUB"), "nominal": F.lit(1), "rate": F.lit(1),
        "currency_name": F.lit("Russian Ruble")})


DAILY_DDL = ("daily struct<time: array<string>, temperature_2m_max: array<string>, "
             "temperature_2m_min: array<string>, precipitation_sum: array<string>, "
             "wind_speed_10m_max: array<string>>")


def q_array_zip(spark, sf):
    t = Tables(spark, sf)
    p = M.parallel_array_payloads(t.lineitem, t.orders)
    d = p.select("doc_id", "page", F.from_json("payload", DAILY_DDL).alias("j"))
    z = decode.zip_arrays(
        d,
        inner={"t": F.col("j.daily.time"), "mx": F.col("j.daily.temperature_2m_max"),
               "mn": F.col("j.daily.temperature_2m_min")},
        left={"p": F.col("j.daily.precipitation_sum"), "w": F.col("j.daily.wind_speed_10m_max")},
        keep=["doc_id", "page"])
    out = z.select("doc_id", "page", "pos", F.to_date("t").alias("weather_date"),
                   typed("mx", "decimal(8,2)").alias("temperature_max_c"),
                   typed("mn", "decimal(8,2)").alias("temperature_min_c"),
                   typed("p", "decimal(8,2)").alias("precipitation_mm"),
                   typed("w", "decimal(8,2)").alias("wind_speed_max_ms"))
    return out.select("*", band("temperature_max_c", REGIME_EDGES, REGIME_LABELS).alias("weather_regime"),
                      (F.coalesce("precipitation_mm", F.lit(0)) > 0).alias("is_precipitation_day"))


def q_banding(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", "c_acctbal",
                    band(F.col("c_acctbal") / 100, REGIME_EDGES, REGIME_LABELS).alias("regime"),
                    (F.coalesce("c_acctbal", F.lit(0)) > 0).alias("is_positive"))


OBS_TYPE = "decimal(38,4)"


def _obs(spark, sf, *measures):
    p = M.paged_payloads(Tables(spark, sf).lineitem, *measures)
    return decode.explode_observations(p, "payload", keep=["l_suppkey", "measure"], value_type=OBS_TYPE)


def q_observations(spark, sf):
    return _obs(spark, sf, "revenue").drop("measure")


def q_series_join(spark, sf):
    return decode.join_series(_obs(spark, sf, "revenue", "quantity"), ["iso3", "yr"], "measure", "val",
                              {"x": "revenue", "y": "quantity"})


FILTER_YEARS = [1996, 1998]


def q_nested_year_filter(spark, sf):
    p = M.paged_payloads(Tables(spark, sf).lineitem, "revenue")
    a = p.select("l_suppkey", decode.observations_array(p, "payload", OBS_TYPE).alias("obs"))
    kept = gaps.filter_nested(a, "obs", FILTER_YEARS)
    dates = F.transform("obs", lambda o: o["date"])
    return kept.select("l_suppkey", F.size("obs").alias("n_kept"),
                       F.array_min(dates).alias("first_date"), F.array_max(dates).alias("last_date"))


def q_jsonstat_periods(spark, sf):
    p = M.jsonstat_payloads(Tables(spark, sf).orders)
    return decode.jsonstat_periods(p, "payload", keep=["o_custkey"])


def q_jsonstat_flatten(spark, sf):
    p = M.jsonstat_payloads(Tables(spark, sf).orders)
    f = decode.jsonstat_flatten(p, "payload", keep=["o_custkey"], dims=["status", "time"])
    return f.select("o_custkey", "status", F.col("time").alias("period"), F.col("value").cast("double").alias("value"))


def q_decode_rejects(spark, sf):
    """Matrix payloads of which some are cut off, blank, of another shape, or hold
    their block twice: the first three are rejected with the reason, and of the last
    the later block is decoded (``n_rows``)."""
    p = M.matrix_payloads(Tables(spark, sf).lineitem)
    text, kind = F.col("payload"), F.pmod("doc_id", F.lit(10))
    p = p.withColumn("payload", F.when(kind == 0, F.expr("left(payload, char_length(payload) - 1)")).when(kind == 1, F.lit(" "))
                     .when(kind == 2, F.lit('{"other": {"columns": []}}'))
                     .when(kind == 3, F.concat(F.lit('{"lineitems":{"columns":["ORDERKEY"],"data":[]},'), F.substring(text, F.lit(2), F.length(text))))
                     .otherwise(text)).filter(kind < 4)
    bad = decode.payload_rejects(p, "payload", decode.matrix_block(text, "$.lineitems"), keep=["doc_id", "page"])
    good = decode.decode_matrix(p, text, {"l_orderkey": ("ORDERKEY", "bigint")}, keep=["doc_id", "page"], key="l_orderkey",
                                path="$.lineitems")
    return (bad.select("doc_id", "page", "reason", F.lit(0).cast("long").alias("n_rows"))
            .unionByName(good.groupBy("doc_id", "page").agg(F.count("*").alias("n_rows"))
                         .select("doc_id", "page", F.lit(None).cast("string").alias("reason"), "n_rows")))


# Gaps ------------------------------------------------------------------------

def _orders_by_nation(spark, sf):
    t = Tables(spark, sf)
    return t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")


def q_gap_days(spark, sf):
    return gaps.missing_dates(_orders_by_nation(spark, sf), ["c_nationkey"], "o_orderdate")


def q_gap_months(spark, sf):
    return gaps.month_coverage(_orders_by_nation(spark, sf), ["c_nationkey"], "o_orderdate")


GAP_FLOOR, GAP_CEILING = "2001-08-01", "1995-01-01"   # inverted on purpose: swapped


def q_gap_years(spark, sf):
    o = Tables(spark, sf).orders
    obs = o.select("o_custkey", F.year("o_orderdate").cast("string").alias("yr"), "o_totalprice")
    return gaps.missing_years(obs, ["o_custkey"], "yr", "o_totalprice", GAP_FLOOR, GAP_CEILING)


QUERIES = {
    "matrix_decode": q_matrix_decode,
    "typed_cast": q_typed_cast,
    "typed_rejects": q_typed_rejects,
    "map_explode": q_map_explode,
    "array_zip": q_array_zip,
    "banding": q_banding,
    "observations": q_observations,
    "series_join": q_series_join,
    "nested_year_filter": q_nested_year_filter,
    "jsonstat_periods": q_jsonstat_periods,
    "jsonstat_flatten": q_jsonstat_flatten,
    "decode_rejects": q_decode_rejects,
    "gap_days": q_gap_days,
    "gap_months": q_gap_months,
    "gap_years": q_gap_years,
}

_REGIME = """CASE WHEN {c} < 0 THEN 'freezing' WHEN {c} < 10 THEN 'cold' WHEN {c} < 20 THEN 'mild'
     WHEN {c} < 28 THEN 'warm' ELSE 'hot' END"""
_REV = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
_NAT = "(SELECT o.*, c.c_nationkey FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)"

ORACLE = {
    "matrix_decode": """
SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice,
       CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_discount AS DECIMAL(4,2)) END AS l_discount,
       CAST(NULL AS DECIMAL(4,2)) AS l_tax
FROM lineitem""",
    "typed_cast": """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS INTEGER) END AS flag_code,
       CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_discount AS DECIMAL(4,2)) END AS l_discount
FROM lineitem""",
    "typed_rejects": """
SELECT l_orderkey, l_linenumber, 'R' || CAST(l_linenumber AS VARCHAR) AS flag_code,
       CASE WHEN l_discount = 0 THEN '' ELSE CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) END AS l_discount,
       'flag_code' AS failed_columns
FROM lineitem WHERE l_returnflag = 'R'""",
    "map_explode": """
SELECT CAST(o_orderdate AS DATE) AS rate_date, o_orderstatus AS char_code, CAST(COUNT(*) AS INTEGER) AS nominal,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,6)) AS rate,
       CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Pending' END AS currency_name
FROM orders GROUP BY 1, 2
UNION ALL
SELECT DISTINCT CAST(o_orderdate AS DATE), 'RUB', 1, CAST(1 AS DECIMAL(18,6)), 'Russian Ruble' FROM orders""",
    "array_zip": f"""
WITH pg AS ({M.PAGE_SQL}),
l AS (
  SELECT pg.*, o.o_orderstatus,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey, page ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                            l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag) AS pos,
         COUNT(*) OVER (PARTITION BY l_orderkey, page) AS np
  FROM pg JOIN orders o ON o.o_orderkey = pg.l_orderkey),
z AS (
  SELECT l_orderkey AS doc_id, page, CAST(pos AS INTEGER) AS pos, CAST(l_shipdate AS DATE) AS weather_date,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS DECIMAL(8,2)) END AS temperature_max_c,
         CAST(l_extendedprice AS DECIMAL(8,2)) AS temperature_min_c,
         CAST(l_discount AS DECIMAL(8,2)) AS precipitation_mm,
         CASE WHEN pos <= np - 1 THEN CAST(l_tax AS DECIMAL(8,2)) END AS wind_speed_max_ms
  FROM l WHERE pos <= CASE WHEN o_orderstatus = 'F' THEN np - 1 ELSE np END)
SELECT *, {_REGIME.format(c='temperature_max_c')} AS weather_regime,
       COALESCE(precipitation_mm, 0) > 0 AS is_precipitation_day
FROM z""",
    "banding": f"""
SELECT c_custkey, c_acctbal, {_REGIME.format(c='c_acctbal / 100')} AS regime,
       COALESCE(c_acctbal, 0) > 0 AS is_positive FROM customer""",
    "observations": f"""
SELECT l_suppkey, 'S' || CAST(l_suppkey AS VARCHAR) AS iso3, CAST(year(l_shipdate) AS INTEGER) AS yr,
       CAST(SUM({_REV}) AS DECIMAL(38,4)) AS val
FROM lineitem GROUP BY l_suppkey, year(l_shipdate)""",
    "series_join": f"""
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS iso3, CAST(year(l_shipdate) AS INTEGER) AS yr,
       CAST(SUM({_REV}) AS DECIMAL(38,4)) AS x,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,4)) AS y
FROM lineitem GROUP BY l_suppkey, year(l_shipdate)""",
    "nested_year_filter": """
WITH o AS (
  SELECT DISTINCT l_suppkey, CAST(year(l_shipdate) AS VARCHAR) AS d FROM lineitem
  UNION ALL
  SELECT DISTINCT l_suppkey, CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR)
  FROM lineitem)
SELECT l_suppkey, CAST(COUNT(*) AS INTEGER) AS n_kept, MIN(d) AS first_date, MAX(d) AS last_date
FROM o WHERE substr(d, 1, 4) IN ('1996', '1998') GROUP BY l_suppkey""",
    "jsonstat_periods": "SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS period FROM orders",
    "jsonstat_flatten": """
SELECT o_custkey, o_orderstatus AS status, CAST(year(o_orderdate) AS VARCHAR) AS period,
       CAST(COUNT(*) AS DOUBLE) AS value
FROM orders GROUP BY 1, 2, 3""",
    "decode_rejects": f"""
SELECT l_orderkey AS doc_id, page,
       CASE l_orderkey % 10 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'empty' WHEN 2 THEN 'other shape' END AS reason,
       CASE WHEN l_orderkey % 10 = 3 THEN COUNT(*) ELSE 0 END AS n_rows
FROM ({M.PAGE_SQL}) p WHERE l_orderkey % 10 < 4 GROUP BY l_orderkey, page""",
    "gap_days": f"""
WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM {_NAT} x),
e AS (SELECT DISTINCT c_nationkey FROM {_NAT} x),
s AS (SELECT e.c_nationkey, CAST(g.d AS DATE) AS gap_date
      FROM e, b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)),
p AS (SELECT DISTINCT c_nationkey, CAST(o_orderdate AS DATE) AS d FROM {_NAT} x)
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.c_nationkey = s.c_nationkey AND p.d = s.gap_date)""",
    "gap_months": f"""
WITH b AS (SELECT date_trunc('month', CAST(MIN(o_orderdate) AS DATE)) AS lo,
                  date_trunc('month', CAST(MAX(o_orderdate) AS DATE)) AS hi FROM {_NAT} x),
e AS (SELECT DISTINCT c_nationkey FROM {_NAT} x),
s AS (SELECT e.c_nationkey, strftime(g.d, '%Y-%m') AS period
      FROM e, b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 MONTH) AS g(d)),
p AS (SELECT DISTINCT c_nationkey, strftime(o_orderdate, '%Y-%m') AS period FROM {_NAT} x),
a AS (SELECT s.c_nationkey, COUNT(*) AS n_needed, COUNT(p.period) AS n_present
      FROM s LEFT JOIN p ON p.c_nationkey = s.c_nationkey AND p.period = s.period GROUP BY s.c_nationkey)
SELECT c_nationkey, n_needed, n_present, n_needed - n_present AS n_missing,
       n_needed - n_present = 0 AS covered,
       CASE WHEN n_needed - n_present <> 0 THEN GREATEST(n_needed, 1) END AS request_periods
FROM a""",
    "gap_years": """
WITH e AS (SELECT DISTINCT o_custkey FROM orders),
s AS (SELECT o_custkey, CAST(y AS INTEGER) AS yr FROM e, range(1995, 2002) AS t(y)),
p AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders WHERE o_totalprice IS NOT NULL),
m AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.o_custkey = s.o_custkey AND p.yr = s.yr))
SELECT o_custkey, COUNT(*) AS n_missing, MIN(yr) AS request_from, MAX(yr) AS request_to
FROM m GROUP BY o_custkey""",
}
