"""JSON payloads in the reference's input shapes, built from the driver's
tables so the decoders run on data that grows with them.

Every builder pre-aggregates first and groups into one payload per document
whose size is bounded, never by the data: a page of an order's lines (about
PAGE_ROWS, however many lines a hot order has), a customer's
per-status per-year counts, a supplier's per-year totals, a day's per-status
totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# Header order of the matrix payload (deliberately not the
# output order) and the status names of the object-map payload.
MATRIX_HEADER = ["LINENUMBER", "ORDERKEY", "FLAG", "QTY", "PRICE", "DISC", "CODE"]
STATUS_NAMES = {"F": "Finished", "O": "Open", "P": "Pending"}


def _blank_zero(c, dtype):
    """Text of a value, '' when it is zero (exercises blank -> NULL)."""
    return F.when(F.col(c) == 0, F.lit("")).otherwise(F.col(c).cast(dtype).cast("string"))


# Fixed value: rows per payload page, as the market feed asks for 100 rows
# per request.
PAGE_ROWS = 100


def _paged_lines(lineitem: DataFrame) -> DataFrame:
    """Lines with a ``page`` within their order so that no payload grows with a
    hot order: an order of n lines has ceil(n / PAGE_ROWS) pages, and a hash of
    the line's content picks one (line numbers repeat, so they don't page).
    Counting combines on the map side and only orders of several pages are
    joined.  Lines equal in all hashed columns share a page; :data:`PAGE_SQL`
    is the same in SQL."""
    pages = (lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PAGE_ROWS)
             .select("l_orderkey", F.ceil(F.col("n") / PAGE_ROWS).alias("_pages")))
    text = F.concat_ws("|", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd"),
                       F.col("l_extendedprice").cast(MONEY).cast("string"), F.col("l_quantity").cast(MONEY).cast("string"))
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (lineitem.join(pages, "l_orderkey", "left")
            .withColumn("page", F.coalesce(F.pmod(place, F.col("_pages")), F.lit(0)).cast("int")).drop("_pages"))


# The same pages in DuckDB SQL.
PAGE_SQL = f"""SELECT *, CASE WHEN n_lines <= {PAGE_ROWS} THEN 0 ELSE CAST(CAST('0x' || substr(md5(concat_ws('|',
    l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'), CAST(l_extendedprice AS DECIMAL(18,2)),
    CAST(l_quantity AS DECIMAL(18,2)))), 1, 8) AS BIGINT) % CAST(ceil(n_lines / {PAGE_ROWS}.0) AS BIGINT) AS INTEGER) END AS page
  FROM (SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey) AS n_lines FROM lineitem) c"""


def matrix_payloads(lineitem: DataFrame) -> DataFrame:
    """One ``{"lineitems":{"columns":[..],"data":[[..],..]}}`` per order page
    (:func:`_paged_lines`)."""
    lineitem = _paged_lines(lineitem)
    row = F.array(F.col("l_linenumber").cast("string"), F.col("l_orderkey").cast("string"),
                  F.col("l_returnflag"), F.col("l_quantity").cast(MONEY).cast("string"),
                  F.col("l_extendedprice").cast(MONEY).cast("string"),
                  _blank_zero("l_discount", "decimal(4,2)"),
                  # a number, blank or bad text
                  F.when(F.col("l_returnflag") == "A", F.col("l_linenumber").cast("string"))
                  .when(F.col("l_returnflag") == "R", F.concat(F.lit("R"), F.col("l_linenumber").cast("string")))
                  .otherwise(F.lit("")))
    per_page = (lineitem.groupBy("l_orderkey", "page")
                .agg(F.array_sort(F.collect_list(F.struct("l_linenumber", row.alias("r")))).alias("rows")))
    block = F.struct(F.array(*[F.lit(h) for h in MATRIX_HEADER]).alias("columns"),
                     F.transform("rows", lambda x: x["r"]).alias("data"))
    return per_page.select(F.col("l_orderkey").alias("doc_id"), "page",
                           F.to_json(F.struct(block.alias("lineitems"))).alias("payload"))


def object_map_payloads(orders: DataFrame) -> DataFrame:
    """Two payloads per order day (a partial one loaded first, the full one
    loaded later): ``{"Date": ..., "Valute": {STATUS: {Nominal, Value, Name}}}``."""
    names = F.create_map(*[x for k, v in STATUS_NAMES.items() for x in (F.lit(k), F.lit(v))])
    per = (orders.groupBy(F.to_date("o_orderdate").alias("day"), "o_orderstatus")
           .agg(F.count(F.lit(1)).cast("int").alias("Nominal"),
                F.sum(F.col("o_totalprice").cast(MONEY)).cast(MONEY).alias("Value")))
    entry = F.struct("Nominal", "Value", F.element_at(names, F.col("o_orderstatus")).alias("Name"))
    full = per.groupBy("day").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", entry))).alias("m"))
    partial = per.filter(F.col("o_orderstatus") == "F").groupBy("day") \
        .agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", entry))).alias("m"))
    date_txt = F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T11:30:00+03:00"))

    def wrap(df, seq):
        return df.select(F.lit("CBR_DAILY").alias("source"), F.lit(seq).alias("load_seq"), "day",
                         F.to_json(F.struct(date_txt.alias("Date"), F.col("m").alias("Valute"))).alias("payload"))
    return wrap(partial, 1).unionByName(wrap(full, 2))


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
              "l_quantity", "l_discount", "l_tax", "l_returnflag"]


def parallel_array_payloads(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One ``{"daily":{time:[..], temperature_2m_max:[..], ...}}`` per order
    page (:func:`_paged_lines`): time = ship dates, max = quantity (NULL for
    returned lines, and one element short for finished orders), min = price,
    precipitation = discount, wind = tax (always one element short)."""
    lines = _paged_lines(lineitem).join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey")
    g = (lines.groupBy("l_orderkey", "page", "o_orderstatus")
         .agg(F.array_sort(F.collect_list(F.struct(
             # position order: line number, then the rest of the row (line
             # numbers repeat inside an order in the driver's data)
             *LINE_ORDER,
             F.date_format("l_shipdate", "yyyy-MM-dd").alias("t"),
             F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_quantity").cast(MONEY)).alias("mx"),
             F.col("l_extendedprice").cast(MONEY).alias("mn"),
             F.col("l_discount").cast(MONEY).alias("p"),
             F.col("l_tax").cast(MONEY).alias("w")))).alias("x")))
    n = F.size("x")
    cut_max = F.when(F.col("o_orderstatus") == "F", n - 1).otherwise(n)
    daily = F.struct(
        F.transform("x", lambda e: e["t"]).alias("time"),
        F.slice(F.transform("x", lambda e: e["mx"]), 1, cut_max).alias("temperature_2m_max"),
        F.transform("x", lambda e: e["mn"]).alias("temperature_2m_min"),
        F.transform("x", lambda e: e["p"]).alias("precipitation_sum"),
        F.slice(F.transform("x", lambda e: e["w"]), 1, n - 1).alias("wind_speed_10m_max"))
    return g.select(F.col("l_orderkey").alias("doc_id"), "page",
                    F.to_json(F.struct(daily.alias("daily")), {"ignoreNullFields": "false"}).alias("payload"))


def revenue_expr():
    return F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))


def paged_payloads(lineitem: DataFrame, *measures: str) -> DataFrame:
    """One ``[{"page":1,"pages":1,"per_page":N}, [obs..]]`` per supplier and measure
    (``revenue``, exact decimal, or ``quantity``) with a yearly observation per ship
    year (``date`` = "YYYY") and a quarterly one per ship quarter (``date`` =
    "YYYYQn").  Both levels and all measures come from one pass over the lines:
    grouping sets expand a line once, and totals combine on the map side."""
    of = {"revenue": revenue_expr(), "quantity": F.col("l_quantity").cast(MONEY)}
    base = lineitem.select("l_suppkey", F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q"),
                           *[of[m].alias(m) for m in measures])
    totals = base.groupingSets([["l_suppkey", "y"], ["l_suppkey", "y", "q"]], "l_suppkey", "y", "q").agg(
        *[F.sum(m).alias(m) for m in measures], F.grouping("q").alias("of_year"))
    iso = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    date = F.when(F.col("of_year") == 1, F.col("y").cast("string")).otherwise(
        F.concat(F.col("y").cast("string"), F.lit("Q"), F.col("q").cast("string")))
    # exact text of each total: measures of different scale are one column of numbers
    series = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("decimal(38,4)").alias("v")) for m in measures])
    obs = (totals.select("l_suppkey", iso.alias("iso"), date.alias("date"), F.inline(series))
           .groupBy("l_suppkey", "measure").agg(F.array_sort(F.collect_list(F.struct(
               F.col("iso").alias("countryiso3code"), "date", F.col("v").alias("value")))).alias("obs")))
    meta = F.to_json(F.struct(F.lit(1).alias("page"), F.lit(1).alias("pages"), F.size("obs").alias("per_page")))
    payload = F.concat(F.lit("["), meta, F.lit(","), F.to_json("obs"), F.lit("]"))
    return obs.select("l_suppkey", "measure", payload.alias("payload"))


def jsonstat_payloads(orders: DataFrame) -> DataFrame:
    """One sparse JSON-stat cube per customer: dimensions status x year,
    value = order count of the cell (only non-empty cells are present)."""
    cells = orders.groupBy("o_custkey", "o_orderstatus", F.year("o_orderdate").cast("string").alias("yr")) \
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    years = cells.groupBy("o_custkey").agg(F.array_sort(F.collect_set("yr")).alias("years"))
    st_codes = sorted(STATUS_NAMES)
    st_index = F.create_map(*[x for i, s in enumerate(st_codes) for x in (F.lit(s), F.lit(i))])
    c = cells.join(years, "o_custkey") \
        .withColumn("flat", (F.element_at(st_index, F.col("o_orderstatus")) * F.size("years")
                             + F.array_position("years", F.col("yr")) - 1).cast("string"))
    cube = c.groupBy("o_custkey", "years").agg(F.map_from_entries(F.collect_list(F.struct("flat", "n"))).alias("value"))
    time_index = F.map_from_arrays("years", F.sequence(F.lit(0), F.size("years") - 1))
    time_label = F.map_from_arrays("years", F.transform("years", lambda y: F.concat(F.lit("Y"), y)))
    dim = F.struct(
        F.struct(F.struct(st_index.alias("index")).alias("category")).alias("status"),
        F.struct(F.struct(time_index.alias("index"), time_label.alias("label")).alias("category")).alias("time"))
    doc = F.struct(F.array(F.lit("status"), F.lit("time")).alias("id"),
                   F.array(F.lit(len(st_codes)), F.size("years")).alias("size"),
                   dim.alias("dimension"), F.col("value"))
    return cube.select("o_custkey", F.to_json(doc).alias("payload"))
