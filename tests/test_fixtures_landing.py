"""FIXTURES A1 (landing load modes) and A8 (change events)."""

import json
import uuid

from pyspark.sql import functions as F

from strata.operators import loads
from strata.operators.keyed import dedupe_keep_first
from strata.session import scratch_path
from strata.sources import landing
from strata.sources.layers import EmptyInput, Layers
from strata.streaming.drain import drain

A1 = [(0, "A", "u1", "1"), (1, "A", "u1", "2"), (2, "A", "u2", "3"), (3, "B", "u1", "4")]


def _a1_lines():
    return [json.dumps({"source": s, "endpoint": e, "payload": p, "kafka_topic": "t", "kafka_partition": 0,
                        "kafka_offset": o, "loaded_at": "2025-01-01T00:00:00"}) for o, s, e, p in A1]


def _write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_first_wins_drain_twice(spark):
    base = scratch_path(spark, "t-a1")
    layers = Layers(spark, f"{base}/tables", prefix=f"a1_{uuid.uuid4().hex[:6]}_")
    _write_lines(spark, f"{base}/in", _a1_lines() + ["{not json"])
    drain(spark, f"{base}/in", layers, "raw", f"{base}/ckpt", reject_table="rejects")
    got = sorted(r.kafka_offset for r in layers.read("raw").collect())
    assert got == [0, 2, 3]
    assert layers.read("rejects").count() == 1
    # the same messages delivered again: nothing new
    _write_lines(spark, f"{base}/in", _a1_lines())
    drain(spark, f"{base}/in", layers, "raw", f"{base}/ckpt")
    assert sorted(r.kafka_offset for r in layers.read("raw").collect()) == [0, 2, 3]


def test_first_wins_counts(spark):
    batch = spark.createDataFrame(A1, "kafka_offset long, source string, endpoint string, payload string")
    empty = batch.limit(0)
    ins = loads.append_first_wins(batch, empty, ["source", "endpoint"], ["kafka_offset"])
    c = loads.load_counts(batch, ins).collect()[0]
    assert (c.read, c.inserted, c.skipped) == (4, 3, 1)
    again = loads.append_first_wins(batch, ins, ["source", "endpoint"], ["kafka_offset"])
    assert again.count() == 0


def test_retro_dedupe_and_replace(spark):
    df = spark.createDataFrame(A1, "id long, source string, endpoint string, payload string")
    kept = dedupe_keep_first(df, ["source", "endpoint"], ["id"])
    assert sorted(r.id for r in kept.collect()) == [0, 2, 3]
    new = spark.createDataFrame([(9, "A", "u9", "5")], df.schema)
    out = loads.replace_by_source(kept, new, "source", "A")
    assert sorted((r.source, r.endpoint) for r in out.collect()) == [("A", "u9"), ("B", "u1")]


def test_landing_read_rejects(spark):
    base = scratch_path(spark, "t-rd")
    _write_lines(spark, base, _a1_lines() + ["garbage"])
    raw = landing.read_envelopes(spark, base)
    assert landing.accepted(raw).count() == 4
    assert landing.rejected(raw).count() == 1


def test_full_refresh_refuses_empty_and_is_idempotent(spark):
    layers = Layers(spark, prefix=f"fr_{uuid.uuid4().hex[:6]}_")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    layers.full_refresh({"t": df})
    layers.full_refresh({"t": df})
    assert sorted(tuple(r) for r in layers.read("t").collect()) == [(1, "a"), (2, "b")]
    try:
        layers.full_refresh({"t": df.limit(0)})
        raise AssertionError("empty refresh accepted")
    except EmptyInput:
        pass
    assert layers.read("t").count() == 2


def test_upsert_and_insert_if_absent(spark):
    layers = Layers(spark, prefix=f"up_{uuid.uuid4().hex[:6]}_")
    layers.full_refresh({"t": spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")})
    layers.upsert("t", spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), ["k"])
    assert sorted(tuple(r) for r in layers.read("t").collect()) == [(1, "a"), (2, "B"), (3, "c")]
    dup = spark.createDataFrame([(4, "x"), (4, "y")], "k int, v string")
    try:
        layers.upsert("t", dup, ["k"])
        raise AssertionError("duplicate keys accepted")
    except ValueError:
        pass
    layers.insert_if_absent("t", spark.createDataFrame([(1, "zz"), (5, "e")], "k int, v string"), ["k"])
    layers.insert_if_absent("t", spark.createDataFrame([(1, "zz"), (5, "e")], "k int, v string"), ["k"])
    assert sorted(tuple(r) for r in layers.read("t").collect()) == [(1, "a"), (2, "B"), (3, "c"), (5, "e")]


def test_partition_refresh_empty_day_empties_it(spark):
    layers = Layers(spark, prefix=f"pr_{uuid.uuid4().hex[:6]}_")
    df = spark.createDataFrame([(1, 10, "2025-01-01"), (2, 20, "2025-01-02")], "k int, v int, d string") \
        .withColumn("d", F.to_date("d"))
    layers.full_refresh({"f": df}, partition_by={"f": ["d"]})
    new_day = spark.createDataFrame([(7, 70, "2025-01-02")], "k int, v int, d string").withColumn("d", F.to_date("d"))
    layers.replace_partition("f", new_day, "d", "2025-01-02")
    layers.replace_partition("f", new_day, "d", "2025-01-02")  # idempotent
    assert sorted((r.k, r.v) for r in layers.read("f").collect()) == [(1, 10), (7, 70)]
    layers.replace_partition("f", new_day.limit(0), "d", "2025-01-01")
    assert sorted((r.k, r.v) for r in layers.read("f").collect()) == [(7, 70)]


def test_refresh_day_in_month_partition(spark):
    layers = Layers(spark, prefix=f"rd_{uuid.uuid4().hex[:6]}_")

    def rows(*t):
        return spark.createDataFrame(list(t), "k int, v int, d string").withColumn("d", F.to_date("d"))

    def got():
        return sorted((r.k, r.v, str(r.d)) for r in layers.read("f").drop("d_month").collect())

    layers.refresh_day("f", rows((1, 10, "2025-01-01"), (2, 20, "2025-01-02"), (3, 30, "2025-02-02")),
                       "d", "2025-01-02")
    assert got() == [(1, 10, "2025-01-01"), (2, 20, "2025-01-02"), (3, 30, "2025-02-02")]
    # the run day's rows are replaced; other days of its month and other months stay,
    # rows of other days in the incremental input are ignored
    new = rows((7, 70, "2025-01-02"), (8, 80, "2025-01-02"), (9, 90, "2025-01-01"))
    layers.refresh_day("f", new, "d", "2025-01-02")
    layers.refresh_day("f", new, "d", "2025-01-02")  # idempotent
    assert got() == [(1, 10, "2025-01-01"), (3, 30, "2025-02-02"), (7, 70, "2025-01-02"), (8, 80, "2025-01-02")]
    # an empty run day empties that day only; a day in a new month adds its partition
    layers.refresh_day("f", new.limit(0), "d", "2025-01-02")
    layers.refresh_day("f", rows((5, 50, "2025-03-09")), "d", "2025-03-09")
    assert got() == [(1, 10, "2025-01-01"), (3, 30, "2025-02-02"), (5, 50, "2025-03-09")]


CDC_ROW = "id int, name string"


def _ev(op, lsn, before=None, after=None):
    return json.dumps({"before": before, "after": after, "op": op, "source": {"lsn": lsn}})


def test_change_events_a8(spark):
    rows = [("1", _ev("c", 1, after={"id": 1, "name": "a"})),
            ("1", _ev("u", 3, before={"id": 1, "name": "b"}, after={"id": 1, "name": "c"})),
            ("1", _ev("u", 2, before={"id": 1, "name": "a"}, after={"id": 1, "name": "b"})),
            ("2", _ev("c", 4, after={"id": 2, "name": "x"})),
            ("2", _ev("d", 5, before={"id": 2, "name": "x"})),
            ("2", None)]
    raw = spark.createDataFrame(rows, "key string, value string")
    out = loads.apply_changes(loads.parse_changes(raw, "value", CDC_ROW), ["id"], "lsn")
    assert [tuple(r) for r in out.collect()] == [(1, "c")]


def test_change_stream_apply(spark):
    from strata.streaming.drain import apply_change_stream
    base = scratch_path(spark, "t-cdc")
    layers = Layers(spark, f"{base}/t", prefix=f"cdc_{uuid.uuid4().hex[:6]}_")
    first = [_ev("c", 1, after={"id": 1, "name": "a"}), _ev("c", 4, after={"id": 2, "name": "x"})]
    spark.createDataFrame([(x,) for x in first], "value string").write.text(f"{base}/in")
    stream = spark.readStream.schema("value string").text(f"{base}/in")
    apply_change_stream(spark, stream, layers, "cust", f"{base}/ck", ["id"], "value", CDC_ROW)
    second = [_ev("u", 3, after={"id": 1, "name": "c"}), _ev("d", 5, before={"id": 2, "name": "x"})]
    spark.createDataFrame([(x,) for x in second], "value string").write.mode("append").text(f"{base}/in")
    stream = spark.readStream.schema("value string").text(f"{base}/in")
    apply_change_stream(spark, stream, layers, "cust", f"{base}/ck", ["id"], "value", CDC_ROW)
    assert [tuple(r) for r in layers.read("cust").collect()] == [(1, "c")]


def test_keyed_merge_rewrites_touched_buckets_only(spark):
    from strata.sources.layers import KEY_BUCKET, key_bucket
    layers = Layers(spark, prefix=f"km_{uuid.uuid4().hex[:6]}_")
    base = spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit("v0").alias("v"))
    layers.merge("s", base, ["k"], n_buckets=16)
    assert layers.read("s").columns == ["k", "v"]
    files_before = set(layers.read("s", layout=True).inputFiles())
    # change keys 3 and 7, delete key 5, add key 1000; duplicates of a key in
    # other buckets are untouched
    rows = spark.createDataFrame([(3, "v1"), (7, "v1"), (1000, "new")], "k int, v string")
    gone = spark.createDataFrame([(5,)], "k int")
    layers.merge("s", rows, ["k"], remove=gone, n_buckets=16)
    got = {r.k: r.v for r in layers.read("s").collect()}
    expect = {k: "v0" for k in range(200) if k != 5}
    expect.update({3: "v1", 7: "v1", 1000: "new"})
    assert got == expect
    t = layers.read("s", layout=True)
    touched = {r[0] for r in spark.createDataFrame([(3,), (5,), (7,), (1000,)], "k int")
               .select(key_bucket(["k"], 16)).collect()}
    assert 0 < len(touched) <= 4
    # files of untouched buckets are the same files as before
    untouched_files = set(t.filter(~F.col(KEY_BUCKET).isin(list(touched))).inputFiles())
    assert untouched_files and untouched_files <= files_before
    # the same merge again changes nothing
    layers.merge("s", rows, ["k"], remove=gone, n_buckets=16)
    assert {r.k: r.v for r in layers.read("s").collect()} == expect


def test_continuous_drain(spark):
    base = scratch_path(spark, "t-cont")
    layers = Layers(spark, f"{base}/tables", prefix=f"ct_{uuid.uuid4().hex[:6]}_")
    _write_lines(spark, f"{base}/in", _a1_lines())
    q = drain(spark, f"{base}/in", layers, "raw", f"{base}/ckpt", available_now=False)
    try:
        q.processAllAvailable()
        _write_lines(spark, f"{base}/in", [json.dumps({"source": "C", "endpoint": "u1", "payload": "9",
                                                       "kafka_offset": 7, "loaded_at": "2025-01-02T00:00:00"})])
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.kafka_offset for r in layers.read("raw").collect()) == [0, 2, 3, 7]


def test_keyed_table_keeps_its_bucket_count(spark):
    layers = Layers(spark, prefix=f"kb_{uuid.uuid4().hex[:6]}_")
    first = spark.createDataFrame([(k, "a") for k in range(50)], "k int, v string")
    layers.insert_if_absent("t", first, ["k"], n_buckets=8)
    assert layers.key_buckets("t") == 8
    # a later call with another count still hashes keys into the table's 8
    again = spark.createDataFrame([(k, "b") for k in range(40, 60)], "k int, v string")
    layers.insert_if_absent("t", again, ["k"], n_buckets=64)
    got = {r.k: r.v for r in layers.read("t").collect()}
    assert got == {**{k: "a" for k in range(50)}, **{k: "b" for k in range(50, 60)}}
    layers.merge("t", spark.createDataFrame([(1, "z")], "k int, v string"), ["k"], n_buckets=3)
    assert layers.read("t").filter("k = 1").collect()[0].v == "z" and layers.read("t").count() == 60
    # an insert after a merge lands in the switched bucket folders and still
    # sees the merged keys
    layers.insert_if_absent("t", spark.createDataFrame([(1, "no"), (2, "no"), (70, "c")], "k int, v string"), ["k"])
    got = {r.k: r.v for r in layers.read("t").collect()}
    assert (got[1], got[2], got[70], len(got)) == ("z", "a", "c", 61)


def test_refresh_day_syncs_columns(spark):
    layers = Layers(spark, prefix=f"sc_{uuid.uuid4().hex[:6]}_")
    old = spark.createDataFrame([(1, 10, "2025-01-01"), (2, 20, "2025-01-02")], "k int, v int, d string") \
        .withColumn("d", F.to_date("d"))
    layers.refresh_day("f", old, "d", "2025-01-02")
    # the model drops v and gains w: w is added (NULL on old rows), v removed
    new = spark.createDataFrame([(2, "x", "2025-01-02")], "k int, w string, d string").withColumn("d", F.to_date("d"))
    layers.refresh_day("f", new, "d", "2025-01-02")
    t = layers.read("f").drop("d_month")
    assert sorted(t.columns) == ["d", "k", "w"]
    assert sorted((r.k, r.w, str(r.d)) for r in t.collect()) == [(1, None, "2025-01-01"), (2, "x", "2025-01-02")]


def test_sync_schema_operator(spark):
    from strata.operators.schema import sync_schema
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([(2, 5)], "k int, n int")
    assert sorted(map(tuple, sync_schema(a, b).collect()), key=lambda r: r[0]) == [(1, "a", None), (2, None, 5)]
    assert sorted(map(tuple, sync_schema(a, b, drop_removed=True).collect())) == [(1, None), (2, 5)]


def test_drain_splits_backlog_and_keeps_first_across_batches(spark):
    base = scratch_path(spark, "t-split")
    layers = Layers(spark, f"{base}/tables", prefix=f"sp_{uuid.uuid4().hex[:6]}_")
    lines = _a1_lines()
    # three files: offsets 0-1, 2, 3 -- the duplicate key (A, u1) arrives in the first file
    _write_lines(spark, f"{base}/in", lines[:2])
    _write_lines(spark, f"{base}/in", lines[2:3])
    _write_lines(spark, f"{base}/in", lines[3:])
    # a later file repeats (A, u1) with a new offset: first-wins across batches skips it
    late = json.dumps({"source": "A", "endpoint": "u1", "payload": "9", "kafka_topic": "t", "kafka_partition": 0,
                       "kafka_offset": 9, "loaded_at": "2025-01-02T00:00:00"})
    _write_lines(spark, f"{base}/in", [late])
    q = drain(spark, f"{base}/in", layers, "raw", f"{base}/ckpt", max_files_per_trigger=1)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4
    assert sorted(r.kafka_offset for r in layers.read("raw").collect()) == [0, 2, 3]


def test_drain_from_a_kafka_shaped_stream(spark):
    # Kafka records (key, value, topic, partition, offset, timestamp) as a
    # file stream: the connector jar is not in this image, the columns are
    from strata.sources.landing import from_kafka
    base = scratch_path(spark, "t-kafka")
    layers = Layers(spark, f"{base}/tables", prefix=f"kf_{uuid.uuid4().hex[:6]}_")
    recs = [json.dumps({"key": None, "value": json.dumps({"source": s, "endpoint": e, "payload": p}),
                        "topic": "raw", "partition": 0, "offset": o, "timestamp": "2025-01-01T00:00:00"})
            for o, s, e, p in A1]
    recs.append(json.dumps({"key": None, "value": "{broken", "topic": "raw", "partition": 0, "offset": 4,
                            "timestamp": "2025-01-01T00:00:00"}))
    _write_lines(spark, f"{base}/in", recs)
    kafka_like = spark.readStream.schema(
        "key binary, value string, topic string, partition int, offset bigint, timestamp timestamp").json(f"{base}/in")
    drain(spark, from_kafka(kafka_like), layers, "raw", f"{base}/ckpt", reject_table="rejects")
    assert sorted(r.kafka_offset for r in layers.read("raw").collect()) == [0, 2, 3]
    assert [r._corrupt_record for r in layers.read("rejects").collect()] == ["{broken"]


def test_full_refresh_of_several_tables_is_all_or_nothing(spark):
    layers = Layers(spark, prefix=f"an_{uuid.uuid4().hex[:6]}_")
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    layers.full_refresh({"x": a, "y": a})
    new = spark.createDataFrame([(2, "b")], "k int, v string")
    try:
        layers.full_refresh({"x": new, "y": new.limit(0)})   # written concurrently
        raise AssertionError("empty input accepted")
    except EmptyInput:
        pass
    assert [tuple(r) for r in layers.read("x").collect()] == [(1, "a")]
    assert [tuple(r) for r in layers.read("y").collect()] == [(1, "a")]
    layers.full_refresh({"x": new, "y": new})
    assert [tuple(r) for r in layers.read("x").collect()] == [(2, "b")] == [tuple(r) for r in layers.read("y").collect()]
