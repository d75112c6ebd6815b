"""The three reference feeds end to end over the FIXTURES payloads."""

import json
import uuid
from decimal import Decimal as D

from pyspark.sql import functions as F

from strata.plans import jobs
from strata.sources.layers import Layers
from tests.test_fixtures_staging import A2_TEXT, A3_DAY, A4

ENV = "source string, endpoint string, payload string, kafka_offset long, loaded_at timestamp"


def _raw(spark, with_eur=True):
    fx = dict(A3_DAY)
    if not with_eur:
        fx = dict(A3_DAY, Valute={k: v for k, v in A3_DAY["Valute"].items() if k != "EUR"})
    rows = [(jobs.MARKET_SOURCE, "/iss", A2_TEXT, 1, "2025-01-10 09:00:00"),
            (jobs.FX_SOURCE, "/daily", json.dumps(fx), 2, "2025-01-10 09:05:00"),
            (jobs.WEATHER_SOURCE, "/forecast", json.dumps(A4), 3, "2025-01-10 09:10:00")]
    return spark.createDataFrame(rows, "source string, endpoint string, payload string, kafka_offset long, "
                                       "loaded_at string").withColumn("loaded_at", F.to_timestamp("loaded_at"))


def test_end_to_end(spark):
    layers = Layers(spark, prefix=f"e2e_{uuid.uuid4().hex[:6]}_")
    report = jobs.run_all(layers, _raw(spark), as_of="2025-01-03", load_dts="2025-01-10 10:00:00")
    res = {r.test_name: (r.failures, r.status) for r in report.collect()}
    assert res["unique_fct_moex_liquidity_trade_date_secid"] == (0, "pass")
    assert res["sat_security_profile_fk"] == (0, "pass")
    assert sum(n.endswith("_fk") for n in res) == 12  # every reference of the vault tables
    assert sum(n.startswith(("unique_hub", "unique_link", "unique_sat")) for n in res) == 16
    # the reference's 13 not-null tests over its five facts, all passing
    nn = {k: v for k, v in res.items() if k.startswith("not_null_")}
    assert len(nn) == 13 and set(nn.values()) == {(0, "pass")}
    assert "not_null_fct_moex_weather_snapshot_secid" in nn and "not_null_fct_cbr_fx_rates_char_code" in nn
    snap = {r.secid: r for r in layers.read("dm_security_snapshot").collect()}
    assert set(snap) == {"AAA", "BBB", "CCC"}
    assert (snap["AAA"].last_price_usd, snap["AAA"].last_price_eur) == (D("2.731000"), D("2.482727"))
    assert snap["AAA"].pct_change == D("9.2400") and snap["BBB"].pct_change is None
    # FX day 01-10, run date 01-03 (also a weather day), weather days 01-01..01-04
    assert layers.read("hub_calendar").count() == 5
    assert layers.read("link_security_currency_date").count() == 3
    ws = {r.secid: r.weather_regime for r in jobs.weather_snapshot(layers).collect()}
    assert ws == {"AAA": "cold", "BBB": "cold", "CCC": "cold"}
    liq = layers.read("fct_moex_liquidity")
    assert sorted(r.secid for r in liq.collect()) == ["AAA", "CCC"]
    # a second run on the same date replaces that day only: same content
    jobs.run_all(layers, _raw(spark), as_of="2025-01-03", load_dts="2025-01-10 11:00:00")
    assert sorted(r.secid for r in layers.read("fct_moex_liquidity").collect()) == ["AAA", "CCC"]


def test_missing_reference_currency_empties_snapshot(spark):
    layers = Layers(spark, prefix=f"e2n_{uuid.uuid4().hex[:6]}_")
    jobs.run_all(layers, _raw(spark, with_eur=False), as_of="2025-01-03", load_dts="2025-01-10 10:00:00")
    assert layers.read("dm_security_snapshot").count() == 0
    assert layers.read("dm_moex_share_overview").count() == 3


def test_weather_feed_optional(spark):
    layers = Layers(spark, prefix=f"e2w_{uuid.uuid4().hex[:6]}_")
    raw = _raw(spark).filter(F.col("source") != jobs.WEATHER_SOURCE)
    report = jobs.run_all(layers, raw, as_of="2025-01-03", load_dts="2025-01-10 10:00:00")
    assert not layers.exists("stg_moscow_weather_daily") and not layers.exists("hub_city")
    assert layers.read("hub_calendar").count() == 2  # FX day + run date
    assert {r.status for r in report.collect()} <= {"pass", "fail"}


def test_incremental_vault_keeps_history(spark):
    layers = Layers(spark, prefix=f"inc_{uuid.uuid4().hex[:6]}_")
    raw = _raw(spark)
    jobs.run_staging(layers, raw)
    jobs.build_vault(layers, "2025-01-03", "2025-01-10 10:00:00", incremental=True)
    n_market = layers.read("sat_security_market").count()
    n_hub = layers.read("hub_security").count()
    # same input again: nothing changes
    jobs.build_vault(layers, "2025-01-03", "2025-01-10 11:00:00", incremental=True)
    assert layers.read("sat_security_market").count() == n_market
    assert layers.read("hub_security").count() == n_hub
    # AAA's last price moves: exactly one new market row, profiles unchanged
    moved = raw.withColumn("payload", F.regexp_replace("payload", "273.10", "280.00"))
    jobs.run_staging(layers, moved)
    jobs.build_vault(layers, "2025-01-03", "2025-01-10 12:00:00", incremental=True)
    sm = layers.read("sat_security_market")
    assert sm.count() == n_market + 1
    assert layers.read("sat_security_profile").count() == 3
    latest = sm.orderBy(F.col("load_dts").desc()).first()
    assert latest.last_price == D("280.000000") and latest.pct_change == D("12.0000")
