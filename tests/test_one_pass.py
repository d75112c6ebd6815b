"""Decode rejects, cubes by mixed radix, calendar bitmaps, one-pass plans and
streaming duplicates."""

import datetime as dt
import json
import random
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from strata.operators import decode, gaps, quality
from strata.plans import decode_q, jobs, quality_q
from strata.sources.layers import EmptyInput, Layers
from strata.streaming.distinct import append_stream, distinct_within

SF = "/root/testdata/sf0.001"


def _payloads(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, payload string")


# ---- decode ----------------------------------------------------------------

def test_every_payload_is_decoded_or_rejected(spark):
    good = '{"m": {"columns": ["a"], "data": [["1"], ["2"]]}}'
    twice = '{"m": 5, "m": {"columns": ["b"], "columns": ["a"], "data": [[12345678901234567890.123]]}}'
    p = _payloads(spark, good, twice, good[:-1], "", None, '{"m": {"columns": ["a"]}}', "[1]", '{"m": {"columns": [], "data": []}}')
    rows = decode.decode_matrix(p, F.col("payload"), {"a": ("a", "string")}, keep=["id"], path="$.m")
    assert sorted(map(tuple, rows.collect())) == [(0, "1"), (0, "2"), (1, "12345678901234567890.123")]
    bad = decode.payload_rejects(p, "payload", decode.matrix_block(F.col("payload"), "$.m"), ["id"])
    assert sorted((r.id, r.reason) for r in bad.collect()) == [
        (2, "not JSON"), (3, "empty"), (4, "empty"), (5, "other shape"), (6, "other shape")]


def test_of_equal_names_the_last_counts(spark):
    text = '{"V": {"A": {"x": 1}, "B": {"x": 2}, "A": {"x": 3}, "C": {"x": 4}, "B": {"x": 5, "x": 6}}}'
    got = decode.explode_object(_payloads(spark, text, "{broken", "[]"), F.col("payload"), "x int", ["id"], member="V")
    assert sorted(map(tuple, got.collect())) == [(0, "A", 3), (0, "B", 6), (0, "C", 4)]
    text = '[{}, [{"date": "1999", "date": "2000", "value": 1, "countryiso3code": "X"}]]'
    got = decode.explode_observations(_payloads(spark, text), "payload", value_type="decimal(10,2)")
    assert [tuple(r) for r in got.collect()] == [("X", 2000, D("1.00"))]


def test_cube_digits_and_codes(spark):
    rng = random.Random(4)
    dims = {"a": 3, "b": 1, "c": 4}
    index = {d: {f"{d}{i}": i for i in rng.sample(range(n), n)} for d, n in dims.items()}
    value = {str(k): f"{rng.randint(0, 10**17)}.5" for k in rng.sample(range(12), 9)}
    doc = {"id": list(dims), "size": list(dims.values()), "dimension": {d: {"category": {"index": index[d]}} for d in dims}}
    text = json.dumps(doc)[:-1] + ', "value": {' + ", ".join(f'"{k}": {v}' for k, v in value.items()) + "}}"
    p = _payloads(spark, text, '{"id": ["a"]}', "{")
    want = sorted((f"a{int(k) // 4}", "b0", f"c{int(k) % 4}", D(v)) for k, v in value.items())
    got = decode.jsonstat_flatten(p, "payload", dims=["a", "b", "c"])
    assert sorted((r.a, r.b, r.c, r.value) for r in got.collect()) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "map" not in plan[:plan.index("Generate")].lower()  # nothing is built per value
    again = decode.jsonstat_flatten(p, "payload")
    assert sorted((r.dims["a"], r.dims["b"], r.dims["c"], r.value) for r in again.collect()) == want
    assert [r.reason for r in decode.payload_rejects(p, "payload", decode.cube("payload")).collect()] == ["other shape", "not JSON"]
    sparse = json.dumps({"id": ["a"], "size": [3], "dimension": {"a": {"category": {"index": {"x": 0, "z": 2}}}}, "value": {"2": 7, "1": 8}})
    got = decode.jsonstat_flatten(_payloads(spark, sparse), "payload", dims=["a"], value_type="int")
    assert sorted((r.flat_index, r.a, r.value) for r in got.collect()) == [(1, None, 8), (2, "z", 7)]


def test_staging_refuses_an_unreadable_newest_payload(spark):
    from tests.test_jobs import _raw
    layers = Layers(spark, prefix=f"sr_{uuid.uuid4().hex[:6]}_")
    raw = _raw(spark)
    jobs.run_staging(layers, raw)
    before = sorted(r.secid for r in layers.read("stg_moex_securities").collect())
    newer = raw.filter(F.col("source") == jobs.MARKET_SOURCE).withColumns(
        {"payload": F.lit("{broken"), "kafka_offset": F.lit(99).cast("long"), "loaded_at": F.col("loaded_at") + F.expr("interval 1 day")})
    with pytest.raises(EmptyInput):
        jobs.run_staging(layers, raw.unionByName(newer))
    assert sorted(r.secid for r in layers.read("stg_moex_securities").collect()) == before != []
    assert [(r.payload, r.reason) for r in layers.read("stg_rejects").collect()] == [("{broken", "not JSON")]


# ---- calendar bitmaps ------------------------------------------------------

@pytest.mark.parametrize("floor, ceiling", [(None, None), ("1969-11-20", "1970-03-05"), ("2031-01-01", "1999-12-31"), ("2000-01-01", None)])
def test_bitmaps_equal_sets_of_days(spark, floor, ceiling):
    rng = random.Random(9)
    start = dt.date(1969, 12, 1) if floor == "1969-11-20" else dt.date(1999, 12, 25)
    rows = [(rng.choice(["a", "b", None]), start + dt.timedelta(rng.randint(0, 150))) for _ in range(200)] + [("a", None), ("c", None)]
    df = spark.createDataFrame(rows, "k string, d date")
    have = [(k, d) for k, d in rows if d]
    lo = dt.date.fromisoformat(floor) if floor else min(d for _, d in have)
    hi = dt.date.fromisoformat(ceiling) if ceiling else max(d for _, d in have)
    lo, hi = min(lo, hi), max(lo, hi)
    days = [lo + dt.timedelta(i) for i in range((hi - lo).days + 1)]
    want = {(k, d) for k in {k for k, _ in have} for d in days} - set(have)
    got = [tuple(r) for r in gaps.missing_dates(df, ["k"], "d", floor, ceiling).collect()]
    assert len(got) == len(want) and set(got) == want
    months = {(d.year, d.month) for d in days}
    for r in gaps.month_coverage(df, ["k"], "d", floor, ceiling).collect():
        present = {(d.year, d.month) for k, d in have if k == r.k} & months
        assert (r.n_needed, r.n_present, r.covered) == (len(months), len(present), len(months) == len(present))


def test_gaps_of_no_rows(spark):
    df = spark.createDataFrame([], "k string, d date")
    assert gaps.missing_dates(df, ["k"], "d").count() == 0 == gaps.month_coverage(df, ["k"], "d").count()


# ---- one pass --------------------------------------------------------------

def _scans(df, table):
    return df._jdf.queryExecution().sparkPlan().toString().count(f"/{table}.parquet")


def test_facts_are_read_once(spark):
    for name in ("observations", "series_join", "nested_year_filter"):
        assert _scans(decode_q.QUERIES[name](spark, SF), "lineitem") == 1
    report = quality_q.q_dq_report(spark, SF)
    assert _scans(report, "lineitem") <= 2 and _scans(report, "orders") <= 2
    assert _scans(quality_q.q_dq_fk_orphans(spark, SF), "lineitem") == 1
    assert _scans(decode_q.QUERIES["gap_days"](spark, SF), "orders") == 0  # read once, for the bitmaps


def test_shared_scan_equals_single_checks(spark):
    rng = random.Random(2)
    child = spark.createDataFrame([(rng.choice([None, 0, 0, 0, *range(9)]), rng.choice(["a", None]), rng.randint(-2, 5)) for _ in range(200)],
                                  "p int, q string, v int")
    parent = spark.createDataFrame([(i,) for i in (0, 1, 2, 2, None)], "id int")
    got = {r.test_name: r.failures for r in quality.shared_scan(
        {"c": child, "p": parent}, unique={"u1": ("c", ["p"]), "u2": ("c", ["p", "q", "v"]), "u3": ("p", ["id"])},
        references={"f": ("c", "p", "p", "id"), "g": ("p", "id", "p", "id")},
        rules={"r": ("c", F.col("v") < 0), "never": ("c", F.col("v") > 9)}).collect()}
    assert got == {"u1": quality.unique(child, ["p"]).count(), "u2": quality.unique(child, ["p", "q", "v"]).count(), "u3": 1,
                   "f": quality.fk_orphans(child, parent, "p", "id").count(), "g": 0, "r": child.where("v < 0").count(), "never": 0}


def test_series_side_by_side(spark):
    obs = spark.createDataFrame([("a", 1, "x", 5), ("a", 1, "y", 6), ("a", 2, "x", 7), ("b", 1, "z", 8)], "k string, yr int, s string, v int")
    got = decode.join_series(obs, ["k", "yr"], "s", "v", {"first": "x", "second": "y"})
    assert [tuple(r) for r in got.collect()] == [("a", 1, 5, 6)]


# ---- streaming duplicates --------------------------------------------------

def _deliver(spark, src, *rows):
    df = spark.createDataFrame([(k, dt.datetime(2025, 1, 1, h)) for k, h in rows], "k string, at timestamp")
    df.coalesce(1).write.mode("append").json(src)


def _messages(spark, src):
    return spark.readStream.schema("k string, at timestamp").option("maxFilesPerTrigger", 1).json(src)


def test_duplicates_within_the_watermark_and_late_rows(spark, tmp_path):
    src, layers = str(tmp_path / "in"), Layers(spark, str(tmp_path / "wh"), f"dw_{uuid.uuid4().hex[:6]}_")

    def drain():
        append_stream(distinct_within(_messages(spark, src), ["k"], "at", "2 hours"), layers, "m", str(tmp_path / "ck"))
        return sorted((r.k, r.at.hour) for r in layers.read("m").collect())

    _deliver(spark, src, ("a", 1), ("b", 2))
    assert drain() == [("a", 1), ("b", 2)]
    _deliver(spark, src, ("b", 3), ("c", 10))  # b again, within two hours
    assert drain() == [("a", 1), ("b", 2), ("c", 10)]
    _deliver(spark, src, ("d", 5), ("b", 9), ("c", 11))  # d is late; b was forgotten; c again
    assert drain() == [("a", 1), ("b", 2), ("b", 9), ("c", 10)]


def test_a_batch_that_is_run_again_is_appended_once(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "wh"), f"ao_{uuid.uuid4().hex[:6]}_")
    for feed, batch in (("f", 0), ("f", 0), ("f", 1), ("g", 0), ("f", 1)):
        layers.append_once("m", spark.range(2), feed, batch)
    assert layers.read("m").count() == 6


def test_continuous_trigger(spark, tmp_path):
    src, layers = str(tmp_path / "in"), Layers(spark, str(tmp_path / "wh"), f"ct_{uuid.uuid4().hex[:6]}_")
    _deliver(spark, src, ("a", 1))
    q = append_stream(distinct_within(_messages(spark, src), ["k"], "at", "2 hours"), layers, "m", str(tmp_path / "ck"), every="1 second")
    try:
        q.processAllAvailable()
        _deliver(spark, src, ("a", 2), ("b", 2))
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert sorted(r.k for r in layers.read("m").collect()) == ["a", "b"]
