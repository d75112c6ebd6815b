"""The reference's three feeds as end-to-end jobs: raw envelopes -> staging
-> vault -> marts -> history -> facts -> data tests (V10 and §3 of the
survey).  Each layer is computed as DataFrames first and published last
through :class:`strata.sources.layers.Layers`, so a failure midway leaves
the previous version of every table in place (trap T12).

Run parameters (``as_of`` run date, ``load_dts``) are arguments, never the
clock inside a plan (trap T1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import band, hash_key, pct_change, typed
from strata.operators import decode, history, marts, quality, vault
from strata.operators.keyed import latest, latest_per, pick_preferred
from strata.sources.layers import Layers

# Fixed values of the three feeds: landed source labels, record sources of
# the staged layers, preferred board, base currency row, reference
# currencies, city, weather band edges and names.
MARKET_SOURCE, FX_SOURCE, WEATHER_SOURCE = "MOEX_ISS", "CBR_DAILY", "OPEN_METEO"
MARKET_STG, FX_STG, WEATHER_STG, LINK_SOURCE = "MOEX_STG", "CBR_STG", "OPEN_METEO_STG", "MOEX+CBR"
PREFERRED_BOARD = "TQBR"
BASE_CURRENCY = ("RUB", 1, 1, "Russian Ruble")
REFERENCE_CODES = {"USD": "usd", "EUR": "eur"}
CITY = "MOSCOW"
WEATHER_EDGES = [0, 10, 20, 28]
WEATHER_BANDS = ["freezing", "cold", "mild", "warm", "hot"]

# Staged name -> (header name, type) of the market feed's two blocks.
SECURITY_FIELDS = {"secid": ("SECID", "string"), "shortname": ("SHORTNAME", "string"),
                   "boardid": ("BOARDID", "string"), "lot_size": ("LOTSIZE", "int"),
                   "secname": ("SECNAME", "string"), "regnumber": ("REGNUMBER", "string")}
MARKET_FIELDS = {"secid": ("SECID", "string"), "boardid": ("BOARDID", "string"),
                 "last_price": ("LAST", "decimal(18,6)"), "prev_price": ("PREVPRICE", "decimal(18,6)"),
                 "market_price_24h": ("MARKETPRICETODAY", "decimal(18,6)"),
                 "num_trades": ("NUMTRADES", "int"), "value_total": ("VALTODAY", "decimal(18,2)")}
WEATHER_DDL = ("daily struct<time: array<string>, temperature_2m_max: array<string>, "
               "temperature_2m_min: array<string>, precipitation_sum: array<string>, "
               "wind_speed_10m_max: array<string>>")


def _latest_payload(raw: DataFrame, source: str) -> DataFrame:
    return latest(raw.filter(F.col("source") == source), ["source"], ["loaded_at", "kafka_offset"])


# Staging -------------------------------------------------------------------

def stage_market(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    p = _latest_payload(raw, MARKET_SOURCE)
    sec = decode.decode_matrix(p, F.col("payload"), SECURITY_FIELDS, key="secid", path="$.securities")
    md = decode.decode_matrix(p, F.col("payload"), MARKET_FIELDS, key="secid", path="$.marketdata")
    return (pick_preferred(sec, ["secid"], "boardid", PREFERRED_BOARD),
            pick_preferred(md, ["secid"], "boardid", PREFERRED_BOARD))


def stage_fx(raw: DataFrame) -> DataFrame:
    p = raw.filter(F.col("source") == FX_SOURCE)
    day = F.to_date(F.to_timestamp(F.get_json_object("payload", "$.Date")))
    best = latest_per(p.withColumn("rate_date", day), F.col("rate_date"), ["loaded_at", "kafka_offset"])
    r = decode.explode_object(best, F.col("payload"),
                              "Nominal int, Value decimal(18,6), Name string", keep=["rate_date"],
                              key_name="char_code", member="Valute")
    r = r.select("rate_date", "char_code", F.col("Nominal").alias("nominal"), F.col("Value").alias("rate"),
                 F.col("Name").alias("currency_name"))
    code, nominal, rate, name = BASE_CURRENCY
    return decode.union_constant(r, ["rate_date"], {"char_code": F.lit(code), "nominal": F.lit(nominal),
                                                    "rate": F.lit(rate), "currency_name": F.lit(name)})


def stage_weather(raw: DataFrame) -> DataFrame:
    p = _latest_payload(raw, WEATHER_SOURCE).select(F.from_json("payload", WEATHER_DDL).alias("j"))
    z = decode.zip_arrays(p, inner={"t": F.col("j.daily.time"), "mx": F.col("j.daily.temperature_2m_max"),
                                    "mn": F.col("j.daily.temperature_2m_min")},
                          left={"p": F.col("j.daily.precipitation_sum"), "w": F.col("j.daily.wind_speed_10m_max")})
    w = z.select(F.to_date("t").alias("weather_date"),
                 typed("mx", "decimal(8,2)").alias("temperature_max_c"),
                 typed("mn", "decimal(8,2)").alias("temperature_min_c"),
                 typed("p", "decimal(8,2)").alias("precipitation_mm"),
                 typed("w", "decimal(8,2)").alias("wind_speed_max_ms"))
    return w.select("*", band("temperature_max_c", WEATHER_EDGES, WEATHER_BANDS).alias("weather_regime"),
                    (F.coalesce("precipitation_mm", F.lit(0)) > 0).alias("is_precipitation_day"))


def staging_rejects(raw: DataFrame) -> DataFrame:
    """(source, endpoint, payload, reason) of the payloads staging reads that lack the
    block it needs: the newest of the market and weather feeds, all of the currency feed."""
    keep, text = ["source", "endpoint"], F.col("payload")
    market, weather = _latest_payload(raw, MARKET_SOURCE), _latest_payload(raw, WEATHER_SOURCE)
    parts = [decode.payload_rejects(market, "payload", decode.matrix_block(text, path), keep)
             for path in ("$.securities", "$.marketdata")]
    parts.append(decode.payload_rejects(raw.filter(F.col("source") == FX_SOURCE), "payload",
                                        decode.object_entries(text, "Nominal int", member="Valute"), keep))
    parts.append(decode.payload_rejects(weather, "payload", F.from_json(text, WEATHER_DDL)["daily"], keep))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def run_staging(layers: Layers, raw: DataFrame) -> None:
    """Stage the newest payloads.  A feed whose payloads decode to nothing stops the
    run, and every table keeps its last version; the payloads are in ``stg_rejects``."""
    sec, md = stage_market(raw)
    tables = {"stg_moex_securities": sec, "stg_moex_marketdata": md, "stg_cbr_fx_rates": stage_fx(raw)}
    # the weather feed is optional: stage it only when it has landed
    if not raw.filter(F.col("source") == WEATHER_SOURCE).isEmpty():
        tables["stg_moscow_weather_daily"] = stage_weather(raw)
    layers.full_refresh({"stg_rejects": staging_rejects(raw)}, allow_empty=True)
    layers.full_refresh(tables)


# Vault ---------------------------------------------------------------------

HUB_KEYS = {"hub_security": "secid", "hub_currency": "char_code", "hub_calendar": "business_date",
            "hub_city": "city_code", "link_security_currency_date": "link_hk", "link_city_date": "link_city_date_hk"}
SAT_KEYS = {"sat_security_profile": ["security_hk"], "sat_security_market": ["security_hk", "date_hk"],
            "sat_currency_rate": ["currency_hk", "date_hk"], "sat_city_weather": ["city_hk", "date_hk"]}


def build_vault(layers: Layers, as_of: str, load_dts: str, incremental: bool = False) -> None:
    """Hubs, links and satellites in dependency order; the weather source is
    optional and skipped when its staging table is absent.

    ``incremental=False`` rebuilds every table (the reference truncates and
    reloads).  ``incremental=True`` keeps history: hubs and links receive
    only keys they lack (first writer keeps its row), satellites only rows
    whose hashdiff differs from the key's latest stored row (V9)."""
    ts = F.to_timestamp(F.lit(load_dts))
    sec, md, fx = (layers.read(n) for n in ("stg_moex_securities", "stg_moex_marketdata", "stg_cbr_fx_rates"))
    hub_security = vault.load_hub(sec, {"secid": "secid"}, "security_hk", MARKET_STG, ts)
    hub_currency = vault.load_hub(fx, {"char_code": "char_code"}, "currency_hk", FX_STG, ts)
    hub_calendar = vault.load_calendar(fx, "rate_date", as_of, FX_STG, ts)
    out = {}
    has_weather = layers.exists("stg_moscow_weather_daily")
    if has_weather:
        w = layers.read("stg_moscow_weather_daily")
        extra = w.select(hash_key("weather_date").alias("date_hk"), F.col("weather_date").alias("business_date"),
                         ts.alias("load_dts"), F.lit(WEATHER_STG).alias("record_source"))
        hub_calendar = vault.extend_hub(hub_calendar, extra, "business_date")
        city = w.sparkSession.range(1).select(F.lit(CITY).alias("city_code"))
        out["hub_city"] = vault.load_hub(city, {"city_code": "city_code"}, "city_hk", WEATHER_STG, ts)
        staged = w.select(hash_key(F.lit(CITY)).alias("city_hk"), hash_key("weather_date").alias("date_hk"))
        out["link_city_date"] = vault.link_from_members(staged, ["city_hk", "date_hk"], "link_city_date_hk",
                                                        WEATHER_STG, ts)
        out["sat_city_weather"] = vault.load_sat(
            w, {"city_hk": hash_key(F.lit(CITY)), "date_hk": hash_key("weather_date")},
            ["temperature_max_c", "temperature_min_c", "precipitation_mm", "wind_speed_max_ms",
             "weather_regime", "is_precipitation_day"], WEATHER_STG, ts)
    # link: every security x base currency x run date.  Both are one hub row
    # picked by its unique business key: scalar subqueries, and a missing
    # one leaves the link empty as the reference's inner joins do
    base = hub_currency.filter(F.col("char_code") == BASE_CURRENCY[0]).select("currency_hk").scalar()
    run_day = hub_calendar.filter(F.col("business_date") == F.to_date(F.lit(as_of))).select("date_hk").scalar()
    members = (hub_security.select("security_hk", base.alias("currency_hk"), run_day.alias("date_hk"))
               .filter(F.col("currency_hk").isNotNull() & F.col("date_hk").isNotNull()))
    out.update({
        "hub_security": hub_security, "hub_currency": hub_currency, "hub_calendar": hub_calendar,
        "link_security_currency_date": vault.link_from_members(
            members, ["security_hk", "currency_hk", "date_hk"], "link_hk", LINK_SOURCE, ts),
        "sat_security_profile": vault.load_sat(sec, {"security_hk": hash_key("secid")},
                                               ["shortname", "boardid", "lot_size", "secname", "regnumber"],
                                               MARKET_STG, ts),
        "sat_security_market": vault.load_sat(
            md, {"security_hk": hash_key("secid"), "date_hk": hash_key(F.to_date(F.lit(as_of)))},
            ["last_price", "prev_price", "market_price_24h", "num_trades", "value_total"], MARKET_STG, ts,
            extra={"pct_change": pct_change("last_price", "prev_price", 4).cast("decimal(18,4)")}),
        "sat_currency_rate": vault.load_sat(
            fx, {"currency_hk": hash_key("char_code"), "date_hk": hash_key("rate_date")},
            ["nominal", "rate"], FX_STG, ts),
    })
    if not incremental:
        layers.full_refresh(out, allow_empty=True)
        return
    fresh = {n: df for n, df in out.items() if not layers.exists(n)}
    if fresh:
        layers.full_refresh(fresh, allow_empty=True)
    for name, df in out.items():
        if name in fresh:
            continue
        if name in HUB_KEYS:
            layers.insert_if_absent(name, df, [HUB_KEYS[name]])
        else:
            new_rows = vault.changed_rows(layers.read(name), df, SAT_KEYS[name])
            layers.append(name, new_rows.checkpoint(eager=True))


# Marts, history, facts, tests ----------------------------------------------------

def publish_marts(layers: Layers, as_of: str, on_missing: str = "empty") -> None:
    hs, sp, sm = (layers.read(n) for n in ("hub_security", "sat_security_profile", "sat_security_market"))
    # the newest profile by load time; the hash only orders rows of one load
    profile = latest(hs.select("secid", "security_hk").join(sp.drop("record_source"), "security_hk"),
                     ["secid"], ["load_dts", "hashdiff"]).select("secid", "security_hk", "shortname", "boardid", "lot_size")
    market = latest(sm, ["security_hk"], ["load_dts", "hashdiff"]).select(
        "security_hk", "last_price", "prev_price", "pct_change", "num_trades", "value_total")
    overview = marts.overview(profile, market, "security_hk").drop("security_hk")
    hc, cal, rate = (layers.read(n) for n in ("hub_currency", "hub_calendar", "sat_currency_rate"))
    sat = rate.join(hc.select("currency_hk", "char_code"), "currency_hk") \
        .join(cal.select("date_hk", "business_date"), "date_hk")
    fx_date = marts.latest_value_date(sat, "business_date")
    rates = marts.rates_at(sat, "char_code", "business_date", "load_dts", REFERENCE_CODES,
                           ["rate", "nominal"], fx_date)
    snap = marts.snapshot(overview, rates, on_missing=on_missing).select(
        "secid", "shortname", "boardid", F.to_date(F.lit(as_of)).alias("trade_date"),
        F.col("last_price").alias("last_price_rub"), "usd_rate", "eur_rate",
        marts.convert("last_price", "usd_rate", "usd_nominal").alias("last_price_usd"),
        marts.convert("last_price", "eur_rate", "eur_nominal").alias("last_price_eur"),
        "pct_change", "num_trades", "value_total")
    layers.full_refresh({"dm_moex_share_overview": overview, "dm_security_snapshot": snap}, allow_empty=True)


def build_weather_dimension(layers: Layers) -> None:
    w = layers.read("stg_moscow_weather_daily").withColumn("city_code", F.lit(CITY))
    dim = history.scd2(w, ["city_code"], "weather_date", ["weather_regime", "is_precipitation_day"])
    layers.full_refresh({"dim_weather_regime_scd2": dim}, allow_empty=True)


def refresh_facts(layers: Layers, as_of: str) -> None:
    """Liquidity and movers facts: first run loads all, later runs replace the
    run date's rows (delete + insert of that day) inside its month partition."""
    snap = layers.read("dm_security_snapshot")
    facts = {
        "fct_moex_liquidity": snap.filter(F.col("value_total").isNotNull()).select(
            "trade_date", "secid", "shortname", "boardid", "value_total", "num_trades",
            "last_price_rub", "last_price_usd", "last_price_eur"),
        "fct_moex_movers": snap.filter(F.col("pct_change").isNotNull()).select(
            "trade_date", "secid", "shortname", "boardid", "pct_change", "last_price_rub", "value_total"),
    }
    for name, df in facts.items():
        df = df.checkpoint(eager=True)  # read from the table it may replace a day of
        layers.refresh_day(name, df, "trade_date", as_of)


def weather_snapshot(layers: Layers) -> DataFrame:
    snap = layers.read("dm_security_snapshot").withColumn("city_code", F.lit(CITY))
    dim = layers.read("dim_weather_regime_scd2").select("city_code", "valid_from", "valid_to",
                                                       "weather_regime", "is_precipitation_day")
    return history.interval_join(snap, dim, ["city_code"], "trade_date").drop("city_code")


# The reference's not-null tests, per fact and column.
NOT_NULL_TESTS = {
    "fct_moex_liquidity": ["trade_date", "secid", "value_total", "num_trades"],
    "fct_moex_movers": ["trade_date", "secid", "pct_change"],
    "fct_cbr_fx_rates": ["rate_date", "char_code"],
    "fct_moscow_weather_daily": ["weather_date", "weather_regime"],
    "fct_moex_weather_snapshot": ["trade_date", "secid"],
}


def fact_views(layers: Layers) -> dict[str, DataFrame]:
    """The facts the data tests read (D8): the two incremental tables and the
    three projection views; the weather ones only when that feed landed."""
    views = {"fct_moex_liquidity": layers.read("fct_moex_liquidity"),
             "fct_moex_movers": layers.read("fct_moex_movers"),
             "fct_cbr_fx_rates": layers.read("stg_cbr_fx_rates").select(
                 "rate_date", "char_code", "nominal", "rate", "currency_name")}
    if layers.exists("stg_moscow_weather_daily"):
        views["fct_moscow_weather_daily"] = layers.read("stg_moscow_weather_daily")
    if layers.exists("dim_weather_regime_scd2"):
        views["fct_moex_weather_snapshot"] = weather_snapshot(layers).select(
            "trade_date", "secid", "shortname", "boardid", "last_price_rub", "pct_change", "value_total",
            "weather_regime", "is_precipitation_day")
    return views


# Primary and unique keys of the vault tables, and their references.
VAULT_KEYS = {
    "hub_security": [["security_hk"], ["secid"]],
    "hub_currency": [["currency_hk"], ["char_code"]],
    "hub_calendar": [["date_hk"], ["business_date"]],
    "link_security_currency_date": [["link_hk"], ["security_hk", "currency_hk", "date_hk"]],
    "sat_security_profile": [["security_hk", "load_dts"]],
    "sat_security_market": [["security_hk", "date_hk", "load_dts"]],
    "sat_currency_rate": [["currency_hk", "date_hk", "load_dts"]],
    "hub_city": [["city_hk"], ["city_code"]],
    "link_city_date": [["link_city_date_hk"], ["city_hk", "date_hk"]],
    "sat_city_weather": [["city_hk", "date_hk", "load_dts"]],
}
VAULT_REFS = {
    "link_security_currency_date": ["security_hk", "currency_hk", "date_hk"],
    "sat_security_profile": ["security_hk"],
    "sat_security_market": ["security_hk", "date_hk"],
    "sat_currency_rate": ["currency_hk", "date_hk"],
    "link_city_date": ["city_hk", "date_hk"],
    "sat_city_weather": ["city_hk", "date_hk"],
}
REF_HUB = {"security_hk": "hub_security", "currency_hk": "hub_currency", "date_hk": "hub_calendar",
           "city_hk": "hub_city"}


def vault_constraints(layers: Layers) -> dict[str, DataFrame]:
    """Failing rows of every key and reference of the vault tables that exist:
    ``unique_<table>_<columns>`` and ``<table>_<column>_fk`` (``<table>_fk`` where
    there is one).  A NULL reference fails too, as the columns are NOT NULL."""
    out = {}
    for name, keys in VAULT_KEYS.items():
        if not layers.exists(name):
            continue
        table = layers.read(name)
        for cols in keys:
            out[f"unique_{name}_{'_'.join(cols)}"] = quality.unique(table, cols)
        refs = VAULT_REFS.get(name, [])
        for col in refs:
            hub = layers.read(REF_HUB[col])
            out[f"{name}_{col}_fk" if len(refs) > 1 else f"{name}_fk"] = quality.fk_orphans(
                table.select(F.coalesce(F.col(col).cast("string"), F.lit("")).alias(col)),
                hub.select(F.col(col).cast("string").alias(col)), col, col)
    return out


def data_tests(layers: Layers) -> DataFrame:
    views = fact_views(layers)
    liq, mov = views["fct_moex_liquidity"], views["fct_moex_movers"]
    # all not-null tests of one fact in one aggregation pass
    counted = [quality.not_null_counts(df, NOT_NULL_TESTS[name], name)
               .select(F.concat(F.lit(f"not_null_{name}_"), "column_name").alias("test_name"),
                       F.col("n_null").alias("failures"))
               for name, df in views.items()]
    checks = {
        "unique_fct_moex_liquidity_trade_date_secid": quality.unique(liq, ["trade_date", "secid"]),
        "unique_fct_moex_movers_trade_date_secid": quality.unique(mov, ["trade_date", "secid"]),
        "non_negative_value_total": quality.non_negative(liq, "value_total"),
        "pct_change_reasonable_bounds": quality.bounds(mov, "pct_change", -50, 50),
        **vault_constraints(layers),
    }
    return quality.report(checks, counted=counted)


def run_all(layers: Layers, raw: DataFrame, as_of: str, load_dts: str, fail_on_test: bool = True) -> DataFrame:
    """All layers in order, then the data tests; a failing test fails the run
    (``fail_on_test``) after the report is computed."""
    run_staging(layers, raw)
    build_vault(layers, as_of, load_dts)
    publish_marts(layers, as_of)
    if layers.exists("stg_moscow_weather_daily"):
        build_weather_dimension(layers)
    refresh_facts(layers, as_of)
    report = data_tests(layers)
    return quality.raise_on_failure(report) if fail_on_test else report
