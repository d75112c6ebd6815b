"""Cases off the oracle's path: order of deliveries, NULL keys, truncates,
fragments, uncapped requests, all-deletes merges."""

import json

from strata.functions import mask_params
from strata.operators import gaps, loads
from strata.sources.layers import Layers
from strata.streaming import drain as D


def _file(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows))


def _env(offset, endpoint, payload):
    return {"source": "A", "endpoint": endpoint, "payload": payload, "kafka_topic": "t", "kafka_partition": 0,
            "kafka_offset": offset, "loaded_at": "2025-01-01T00:00:00Z"}


def test_first_wins_does_not_depend_on_the_cut(spark, tmp_path):
    import uuid
    got = []
    for limit in (1, 1000):
        src = tmp_path / f"in{limit}"
        _file(src, "a.json", [_env(9, "u1", "late"), _env(2, "u2", "x")])
        _file(src, "b.json", [_env(1, "u1", "early"), _env(3, None, "no key")])
        layers = Layers(spark, str(tmp_path / f"wh{limit}"), f"r2_{uuid.uuid4().hex[:8]}_")
        for _ in range(2):  # the second run reads the files again: a replay
            D.drain(spark, str(src), layers, "landing", str(tmp_path / f"cp{limit}-{_}"), max_files_per_trigger=limit,
                    reject_table="rejects")
        got.append(sorted((r.endpoint, r.kafka_offset, r.payload) for r in layers.read("landing").collect()))
    assert got[0] == got[1] == [("u1", 1, "early"), ("u2", 2, "x")]


def test_truncate_and_malformed_events(spark):
    ddl = "id int, v string"
    ev = [('{"after":{"id":1,"v":"a"},"op":"c","source":{"lsn":1}}',), ('{"op":"t","source":{"lsn":2}}',),
          ('{"after":{"id":2,"v":"b"},"op":"c","source":{"lsn":3}}',), ("not json",)]
    ch = loads.parse_changes(spark.createDataFrame(ev, "value string"), "value", ddl)
    assert [tuple(r) for r in loads.apply_changes(ch, ["id"]).collect()] == [(2, "b")]


def test_question_mark_in_the_fragment(spark):
    df = spark.createDataFrame([("/p#frag?x=1",), ("/p?token=1&a=2#f?token=3",), ("/p",)], "url string")
    got = [r[0] for r in df.select(mask_params("url")).collect()]
    assert got == ["/p#frag?x=1", "/p?token=***&a=2#f?token=3", "/p"]


def test_month_requests_are_not_cut(spark):
    df = spark.createDataFrame([("a", "1900-01-15"), ("a", "2025-12-15")], "k string, d string")
    row = gaps.month_coverage(df, ["k"], "d").collect()[0]
    assert row.request_periods == row.n_needed == 126 * 12


def test_merge_that_empties_its_buckets(spark, tmp_path):
    import uuid
    layers = Layers(spark, str(tmp_path / "wh"), f"r2_{uuid.uuid4().hex[:8]}_")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    layers.merge("t", df, ["k"], n_buckets=4)
    layers.merge("t", df.limit(0), ["k"], remove=df.select("k"))
    assert layers.read("t").count() == 0


def test_change_stream_keeps_positions(spark, tmp_path):
    """Late events, a delete outrun by its update, a truncate and bad messages."""
    import uuid
    layers = Layers(spark, str(tmp_path / "wh"), f"r2c_{uuid.uuid4().hex[:8]}_")
    src, ck = str(tmp_path / "in"), str(tmp_path / "ck")

    def ev(op, lsn, key, name=None):
        row = {"id": key, "name": name}
        return json.dumps({"op": op, "source": {"lsn": lsn}, "before" if op == "d" else "after": row})

    def deliver(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(src)
        D.apply_change_stream(spark, spark.readStream.schema("value string").text(src), layers, "cust", ck, ["id"],
                              "value", "id bigint, name string", reject_table="bad")
        return sorted(map(tuple, layers.read("cust").collect()))

    assert deliver(ev("c", 10, 1, "new"), ev("d", 9, 2), ev("c", 3, 3, "c")) == [(1, "new"), (3, "c")]
    assert deliver(ev("u", 5, 1, "old"), ev("c", 8, 2, "gone"), ev("u", 3, 3, "c")) == [(1, "new"), (3, "c")]
    bad = ["{broken", '{"op": "u", "source": {"lsn": 50}, "after": {"name": "no key"}}', '{"op": "c", "after": {"id": 8}}']
    assert deliver(*bad) == [(1, "new"), (3, "c")]
    assert sorted(r.value for r in layers.read("bad").collect()) == sorted(bad)
    assert deliver('{"op": "t", "source": {"lsn": 20}}', ev("c", 21, 4, "after")) == [(4, "after")]
    assert deliver(ev("u", 15, 1, "before the truncate"), ev("c", 30, 3, "again")) == [(3, "again"), (4, "after")]
    assert deliver(ev("d", 31, 3), ev("d", 32, 4)) == []


def test_partitioned_refresh_never_drops_the_table(spark, tmp_path, monkeypatch):
    """A second version replaces, adds and empties partitions; the entry stays."""
    import uuid
    layers = Layers(spark, str(tmp_path / "wh"), f"r2p_{uuid.uuid4().hex[:8]}_")

    def publish(rows):
        layers.full_refresh({"t": spark.createDataFrame(rows, "v string, p string")}, partition_by={"t": ["p"]})
        return sorted((r.v, r.p) for r in layers.read("t").collect())

    assert publish([("a", "x/1"), ("b", "y"), ("n", None)]) == sorted([("a", "x/1"), ("b", "y"), ("n", None)], key=str)
    monkeypatch.setattr(layers, "_define", lambda name, *a, _f=layers._define: _f(name, *a) if name != "t" else 1 / 0)
    assert publish([("c", "y"), ("d", "z z")]) == [("c", "y"), ("d", "z z")]


def test_refresh_with_a_map_column(spark, tmp_path):
    import uuid
    layers = Layers(spark, str(tmp_path / "wh"), f"r2m_{uuid.uuid4().hex[:8]}_")
    df = spark.createDataFrame([(1, {"a": "b"}), (2, None)], "k int, m map<string,string>")
    layers.merge("t", df, ["k"], n_buckets=4)
    layers.merge("t", df.filter("k = 2"), ["k"])
    layers.insert_if_absent("t", df.selectExpr("k + 1 AS k", "m"), ["k"])
    assert sorted(r.k for r in layers.read("t").collect()) == [1, 2, 3]


def test_sync_columns_casts_a_changed_type(spark, tmp_path):
    import uuid
    import pytest
    layers = Layers(spark, str(tmp_path / "wh"), f"r2s_{uuid.uuid4().hex[:8]}_")
    layers.full_refresh({"t": spark.createDataFrame([(1, "5"), (2, "x")], "k int, v string")})
    layers.sync_columns("t", spark.createDataFrame([], "k bigint, v string"))
    assert dict(layers.read("t").dtypes) == {"k": "bigint", "v": "string"}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        layers.sync_columns("t", spark.createDataFrame([], "k bigint, v int"))
    assert sorted(map(tuple, layers.read("t").collect())) == [(1, "5"), (2, "x")]


def test_interval_join_with_one_fact_far_in_the_future(spark):
    from pyspark.sql import functions as F

    from strata.operators import history
    facts = spark.createDataFrame([(1, "2024-01-05"), (1, "2999-06-01"), (2, "2024-02-01"), (3, None)],
                                  "k int, d string").withColumn("d", F.to_date("d"))
    dim = spark.createDataFrame([(1, "2024-01-01", "2024-01-31", "a"), (1, "2024-02-01", None, "b"),
                                 (2, "2024-01-20", None, "c")], "k int, f string, t string, v string").select(
        "k", F.to_date("f").alias("valid_from"), F.to_date("t").alias("valid_to"), "v")
    j = history.interval_join(facts, dim, ["k"], "d")
    assert sorted((r.k, str(r.d), r.v) for r in j.collect()) == [
        (1, "2024-01-05", "a"), (1, "2999-06-01", "b"), (2, "2024-02-01", "c"), (3, "None", None)]
