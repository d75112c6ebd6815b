"""FIXTURES A2-A7: decode shapes, preferred variant, percent change,
reference rates, banding, type-2 history, interval join, gaps."""

import datetime as dt
import json
from decimal import Decimal as D

from pyspark.sql import functions as F

from strata.functions import band, pct_change, typed
from strata.operators import decode, gaps, history, marts
from strata.operators.keyed import latest_per, pick_preferred

A2 = {"securities": {"columns": ["SECID", "BOARDID", "SHORTNAME", "LOTSIZE", "SECNAME", "REGNUMBER"],
                     "data": [["AAA", "SMAL", "A small", 1, "Alpha", "R1"], ["AAA", "TQBR", "A main", 10, "Alpha", "R1"],
                              ["BBB", "ZZZZ", "B z", "", "Beta", None], ["BBB", "AAAA", "B a", 5, "Beta", None],
                              ["CCC", None, "C null", 2, "Gamma", None], ["CCC", "TQBR", "C main", 3, "Gamma", None],
                              [None, "TQBR", "skip", 1, None, None]]},
      "marketdata": {"columns": ["SECID", "BOARDID", "LAST", "NUMTRADES", "VALTODAY", "PREVPRICE"],
                     "data": [["AAA", "TQBR", 273.10, 100, 1000.5, 250], ["BBB", "AAAA", None, 0, "", 10],
                              ["CCC", "TQBR", 5, 1, 50, 0]]}}
A2_TEXT = json.dumps(A2).replace("273.1,", "273.10,")

SEC_FIELDS = {"secid": ("SECID", "string"), "boardid": ("BOARDID", "string"),
              "shortname": ("SHORTNAME", "string"), "lot_size": ("LOTSIZE", "int")}
MD_FIELDS = {"secid": ("SECID", "string"), "boardid": ("BOARDID", "string"),
             "last_price": ("LAST", "decimal(18,6)"), "prev_price": ("PREVPRICE", "decimal(18,6)"),
             "market_price_24h": ("MARKETPRICETODAY", "decimal(18,6)"),
             "num_trades": ("NUMTRADES", "int"), "value_total": ("VALTODAY", "decimal(18,2)")}


def _payload(spark, text):
    return spark.createDataFrame([(text,)], "payload string")


def test_matrix_preferred_and_pct_change(spark):
    p = _payload(spark, A2_TEXT)
    sec = decode.decode_matrix(p, F.col("payload"), SEC_FIELDS, key="secid", path="$.securities")
    best = pick_preferred(sec, ["secid"], "boardid", "TQBR")
    got = sorted((r.secid, r.boardid, r.lot_size) for r in best.collect())
    assert got == [("AAA", "TQBR", 10), ("BBB", "AAAA", 5), ("CCC", None, 2)]
    md = decode.decode_matrix(p, F.col("payload"), MD_FIELDS, key="secid", path="$.marketdata")
    md = pick_preferred(md, ["secid"], "boardid", "TQBR") \
        .withColumn("pct_change", pct_change("last_price", "prev_price", 4))
    rows = {r.secid: r for r in md.collect()}
    a, b, c = rows["AAA"], rows["BBB"], rows["CCC"]
    assert (a.last_price, a.prev_price, a.num_trades, a.value_total) == (D("273.100000"), D("250.000000"), 100, D("1000.50"))
    assert a.market_price_24h is None
    assert a.pct_change == D("9.2400")
    assert b.last_price is None and b.value_total is None and b.pct_change is None and b.num_trades == 0
    assert c.pct_change is None and c.prev_price == D("0E-6")


A3_DAY = {"Date": "2025-01-10T11:30:00+03:00", "Valute": {
    "USD": {"Nominal": 1, "Value": 100, "Name": "US Dollar"},
    "EUR": {"Nominal": 1, "Value": 110, "Name": "Euro"},
    "KZT": {"Nominal": 100, "Value": 20, "Name": "Tenge"}}}


def _rates(spark, payloads):
    df = spark.createDataFrame(payloads, "source string, loaded_at string, payload string") \
        .filter(F.col("source") == "CBR_DAILY")
    day = F.to_date(F.to_timestamp(F.get_json_object("payload", "$.Date")))
    best = latest_per(df.withColumn("rate_date", day), F.col("rate_date"), ["loaded_at"])
    r = decode.explode_object(best, F.col("payload"),
                              "Nominal int, Value decimal(18,6), Name string", keep=["rate_date"], key_name="char_code", member="Valute")
    r = r.select("rate_date", "char_code", F.col("Nominal").alias("nominal"), F.col("Value").alias("rate"),
                 F.col("Name").alias("currency_name"))
    return decode.union_constant(r, ["rate_date"], {"char_code": F.lit("RUB"), "nominal": F.lit(1),
                                                    "rate": F.lit(1), "currency_name": F.lit("Russian Ruble")})


def test_object_map_rates_and_snapshot(spark):
    older = dict(A3_DAY, Valute={"USD": {"Nominal": 1, "Value": 1, "Name": "old"}})
    rates = _rates(spark, [("CBR_DAILY", "2025-01-10 09:00:00", json.dumps(older)),
                           ("CBR_DAILY", "2025-01-10 10:00:00", json.dumps(A3_DAY)),
                           ("OTHER", "2025-01-10 11:00:00", json.dumps(older))])
    got = sorted((r.rate_date, r.char_code, r.nominal, r.rate) for r in rates.collect())
    day = dt.date(2025, 1, 10)
    assert got == [(day, "EUR", 1, D("110.000000")), (day, "KZT", 100, D("20.000000")),
                   (day, "RUB", 1, D("1.000000")), (day, "USD", 1, D("100.000000"))]
    sat = rates.withColumn("load_seq", F.lit(1))
    fx_date = marts.latest_value_date(sat, "rate_date")
    one = marts.rates_at(sat, "char_code", "rate_date", "load_seq", {"USD": "usd", "EUR": "eur"},
                         ["rate", "nominal"], fx_date)
    ov = spark.createDataFrame([("AAA", D("273.100000"))], "secid string, last_price decimal(18,6)")
    snap = marts.snapshot(ov, one).select(
        marts.convert("last_price", "usd_rate", "usd_nominal").alias("usd"),
        marts.convert("last_price", "eur_rate", "eur_nominal").alias("eur")).collect()[0]
    assert (snap.usd, snap.eur) == (D("2.731000"), D("2.482727"))
    # without EUR the mart is empty (trap T11); with on_missing='null' it keeps the row
    no_eur = sat.filter(F.col("char_code") != "EUR")
    one2 = marts.rates_at(no_eur, "char_code", "rate_date", "load_seq", {"USD": "usd", "EUR": "eur"},
                          ["rate", "nominal"], marts.latest_value_date(no_eur, "rate_date"))
    r2 = one2.collect()[0]
    assert r2.eur_rate is None and r2.eur_present is False and r2.usd_present is True
    assert marts.snapshot(ov, one2).count() == 0
    assert marts.snapshot(ov, one2, on_missing="null").count() == 1


A4 = {"daily": {"time": ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04", "2025-01-05"],
                "temperature_2m_max": [-5, -1, 3, None], "temperature_2m_min": [-9, -6, -2, -4],
                "precipitation_sum": [0, 0.2, None], "wind_speed_10m_max": [5]}}
DDL = ("daily struct<time: array<string>, temperature_2m_max: array<string>, temperature_2m_min: array<string>,"
       " precipitation_sum: array<string>, wind_speed_10m_max: array<string>>")
EDGES, LABELS = [0, 10, 20, 28], ["freezing", "cold", "mild", "warm", "hot"]


def _weather(spark):
    d = _payload(spark, json.dumps(A4)).select(F.from_json("payload", DDL).alias("j"))
    z = decode.zip_arrays(d, inner={"t": F.col("j.daily.time"), "mx": F.col("j.daily.temperature_2m_max"),
                                    "mn": F.col("j.daily.temperature_2m_min")},
                          left={"p": F.col("j.daily.precipitation_sum"), "w": F.col("j.daily.wind_speed_10m_max")})
    w = z.select(F.to_date("t").alias("weather_date"), typed("mx", "decimal(8,2)").alias("tmax"),
                 typed("p", "decimal(8,2)").alias("precip"), typed("w", "decimal(8,2)").alias("wind"))
    return w.select("*", band("tmax", EDGES, LABELS).alias("weather_regime"),
                    (F.coalesce("precip", F.lit(0)) > 0).alias("is_precipitation_day"))


def test_parallel_arrays(spark):
    got = [(r.weather_date.day, r.tmax, r.precip, r.wind, r.weather_regime, r.is_precipitation_day)
           for r in _weather(spark).orderBy("weather_date").collect()]
    assert got == [(1, D("-5.00"), D("0.00"), D("5.00"), "freezing", False),
                   (2, D("-1.00"), D("0.20"), None, "freezing", True),
                   (3, D("3.00"), None, None, "cold", False),
                   (4, None, None, None, "hot", False)]


def test_scd2_and_interval_join(spark):
    w = _weather(spark).withColumn("city_code", F.lit("MOSCOW"))
    v = history.scd2(w, ["city_code"], "weather_date", ["weather_regime", "is_precipitation_day"])
    got = [(r.version_num, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current)
           for r in v.orderBy("version_num").collect()]
    assert got == [(1, 1, 1, False), (2, 2, 2, False), (3, 3, 3, False), (4, 4, None, True)]
    gap = spark.createDataFrame([("2025-01-01", "cold"), ("2025-01-02", "cold"), ("2025-01-05", "hot")],
                                "d string, regime string") \
        .select(F.lit("MOSCOW").alias("city_code"), F.to_date("d").alias("d"), "regime")
    v2 = history.scd2(gap, ["city_code"], "d", ["regime"]).orderBy("version_num").collect()
    assert [(r.valid_from, r.valid_to, r.source_end_date, r.is_current) for r in v2] == [
        (dt.date(2025, 1, 1), dt.date(2025, 1, 4), dt.date(2025, 1, 2), False),
        (dt.date(2025, 1, 5), None, dt.date(2025, 1, 5), True)]
    facts = spark.createDataFrame([(1, "2025-01-03"), (2, "2024-12-31"), (3, "2030-01-01")], "id int, d string") \
        .select("id", F.lit("MOSCOW").alias("city_code"), F.to_date("d").alias("d"))
    dim = history.scd2(gap, ["city_code"], "d", ["regime"]).select("city_code", "valid_from", "valid_to", "regime",
                                                                   "version_num")
    j = {r.id: r.version_num for r in history.interval_join(facts, dim, ["city_code"], "d").collect()}
    assert j == {1: 1, 2: None, 3: 2}


A6 = [{"page": 1, "pages": 1}, [{"countryiso3code": "AFG", "date": "2024", "value": 1.5},
                                {"countryiso3code": "AFG", "date": "2025", "value": None},
                                {"countryiso3code": "AFG", "date": "2025Q1", "value": 3}, {"value": 4}]]


def test_paged_pair(spark):
    p = _payload(spark, json.dumps(A6)).withColumn("k", F.lit(1))
    obs = decode.explode_observations(p, "payload", keep=["k"])
    assert [(r.iso3, r.yr, r.val) for r in obs.collect()] == [("AFG", 2024, 1.5)]
    miss = gaps.missing_years(obs.select("k", F.col("yr").cast("string").alias("yr"), "val"), ["k"], "yr", "val",
                              "2024-06-01", "2026-02-01").collect()[0]
    assert (miss.n_missing, miss.request_from, miss.request_to) == (2, 2025, 2026)
    arr = p.select("k", decode.observations_array(p, "payload").alias("obs"))
    kept = gaps.filter_nested(arr, "obs", [2025]).collect()
    assert [o.date for o in kept[0].obs] == ["2025", "2025Q1"]
    assert gaps.filter_nested(arr, "obs", [2030]).count() == 0
    other = spark.createDataFrame([(2, None)], "k int, obs array<struct<date:string>>")
    assert gaps.filter_nested(other, "obs", [2030]).count() == 1


A7 = {"id": ["geo", "time"], "size": [2, 2],
      "dimension": {"geo": {"category": {"index": {"DE": 0, "FR": 1}}},
                    "time": {"category": {"index": {"2025-01": 0, "2025-02": 1},
                                          "label": {"2025-01": "Jan", "2025-02": "Feb"}}}},
      "value": {"0": 1.0, "3": 4.0}}


def test_jsonstat(spark):
    p = _payload(spark, json.dumps(A7)).withColumn("k", F.lit(1))
    flat = decode.jsonstat_flatten(p, "payload", keep=["k"])
    got = sorted((r.dims["geo"], r.dims["time"], r.value) for r in flat.collect())
    assert got == [("DE", "2025-01", 1.0), ("FR", "2025-02", 4.0)]
    periods = decode.jsonstat_periods(p, "payload", keep=["k"])
    assert sorted(r.period for r in periods.collect()) == ["2025-01", "2025-02"]
    present = periods.select("k", F.to_date(F.concat("period", F.lit("-01"))).alias("d"))
    cov = gaps.month_coverage(present, ["k"], "d", "2025-01-01", "2025-03-31").collect()[0]
    assert (cov.n_needed, cov.n_present, cov.covered, cov.request_periods) == (3, 2, False, 3)


def test_gap_days_swapped_bounds(spark):
    df = spark.createDataFrame([("x", "2025-01-02"), ("x", "2025-01-04")], "k string, d string")
    g = gaps.missing_dates(df, ["k"], "d", floor="2025-01-05", ceiling="2025-01-01")
    assert sorted(r.gap_date.day for r in g.collect()) == [1, 3, 5]


def test_missing_dates_matches_spine(spark):
    rows = [("a", "2025-01-02"), ("a", "2025-01-02"), ("a", "2025-01-05"), ("b", "2024-12-20"),
            ("c", "2025-01-01"), ("c", "2025-01-07"), ("c", "2025-01-03")]
    df = spark.createDataFrame(rows, "k string, d string").withColumn("d", F.to_date("d"))
    lo, hi = dt.date(2025, 1, 1), dt.date(2025, 1, 6)

    def brute(keys):
        seen = {(k, dt.date.fromisoformat(d)) for k, d in rows}
        days = [lo + dt.timedelta(i) for i in range((hi - lo).days + 1)]
        if not keys:
            present = {d for _, d in seen}
            return sorted((d,) for d in days if d not in present)
        return sorted((k, d) for k in {k for k, _ in rows} for d in days if (k, d) not in seen)

    for floor, ceiling in (("2025-01-01", "2025-01-06"), ("2025-01-06", "2025-01-01")):
        got = gaps.missing_dates(df, ["k"], "d", floor=floor, ceiling=ceiling)
        assert sorted(map(tuple, got.collect())) == brute(["k"])
        got = gaps.missing_dates(df, [], "d", floor=floor, ceiling=ceiling)
        assert sorted(map(tuple, got.collect())) == brute([])
    # default bounds: the data's own first and last day
    got = gaps.missing_dates(df.filter("k = 'c'"), ["k"], "d")
    assert sorted(str(r.gap_date) for r in got.collect()) == ["2025-01-02", "2025-01-04", "2025-01-05", "2025-01-06"]


def test_unquoted_numbers_keep_every_digit(spark):
    text = '{"m": {"columns": ["a", "b"], "data": [[123456789012.123456, "x"], [null, ""], [0.10, "y"]]}}'
    got = decode.decode_matrix(_payload(spark, text), F.col("payload"), {"a": ("a", "decimal(18,6)"), "b": ("b", "string")},
                               path="$.m").collect()
    assert [(r.a, r.b) for r in got] == [(D("123456789012.123456"), "x"), (None, ""), (D("0.100000"), "y")]
    text = '{"Date": "d", "Valute": {"USD": {"Value": 123456789012.123456}}}'
    got = decode.explode_object(_payload(spark, text), F.col("payload"), "Value decimal(18,6)", member="Valute").collect()
    assert [(r.key, r.Value) for r in got] == [("USD", D("123456789012.123456"))]
    text = '[{"page": 1}, [{"countryiso3code": "A", "date": "2024", "value": 1234567890123456789.1234}]]'
    got = decode.explode_observations(_payload(spark, text), "payload", value_type="decimal(38,4)").collect()
    assert [(r.iso3, r.yr, r.val) for r in got] == [("A", 2024, D("1234567890123456789.1234"))]
    for bad in ("{broken", "[1]", "[]", '{"m": 1}', "null"):
        p = _payload(spark, bad)
        assert decode.decode_matrix(p, F.col("payload"), {"a": ("a", "int")}, path="$.m").count() == 0
        assert decode.explode_observations(p, "payload").count() == 0
