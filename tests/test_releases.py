"""Publishing by release, landing as a split append, state beside its positions,
rejects per feed, unique upserts."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import loads
from strata.sources.layers import KEY_BUCKET, EmptyInput, Layers, key_bucket
from strata.streaming import drain as D


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path / "wh"), f"rel_{uuid.uuid4().hex[:8]}_")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


# ---- one switch for several tables -----------------------------------------

def test_killed_publish_leaves_one_version(spark, layers, monkeypatch):
    a, b = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, 10)], "k int, p int")
    layers.full_refresh({"x": a, "y": b}, partition_by={"y": ["p"]})
    newer = {"x": a.selectExpr("k", "v", "2 AS w"), "y": b.selectExpr("k + 1 AS k", "p + 1 AS p")}
    commit = layers.releases.commit
    monkeypatch.setattr(layers.releases, "commit", lambda update: 1 / 0)  # killed when both are written
    with pytest.raises(ZeroDivisionError):
        layers.full_refresh(newer, partition_by={"y": ["p"]})
    assert _rows(layers.read("x")) == [(1, "a")] and _rows(layers.read("y")) == [(1, 10)]
    monkeypatch.setattr(layers.releases, "commit", commit)
    layers.full_refresh(newer, partition_by={"y": ["p"]})
    assert _rows(layers.read("x")) == [(1, "a", 2)] and _rows(layers.read("y")) == [(2, 11)]
    with pytest.raises(EmptyInput):
        layers.full_refresh({"x": a, "y": b.limit(0)})
    assert layers.read("x").columns == ["k", "v", "w"]


def test_a_reader_keeps_its_version_under_changed_columns(spark, layers):
    def publish(i):
        layers.full_refresh({"x": spark.range(i, i + 1).toDF(f"c{i}"),
                             "y": spark.range(i, i + 1).selectExpr("id AS k", f"'{i}' AS p{i}")}, partition_by={"y": [f"p{i}"]})
        return layers.snapshot()

    first = publish(1)
    second = publish(2)  # other columns, and another partition column
    assert _rows(first.read("x")) == [(1,)] and first.read("x").columns == ["c1"]
    assert _rows(first.read("y")) == [(1, "1")] and _rows(second.read("y")) == [(2, "2")]
    old = [p for e in first.entries.values() for p in e["paths"]]
    assert all(os.path.exists(p) for p in old)
    publish(3)  # the version before the last is out of use
    assert not any(os.path.exists(p) for p in old)
    assert not spark.catalog.tableExists(first.entries["y"]["table"])
    assert _rows(second.read("x")) == [(2,)] and _rows(second.read("y")) == [(2, "2")]


def test_two_publishers_keep_both_updates(spark, layers, tmp_path):
    other = Layers(spark, str(tmp_path / "wh"), layers.prefix)
    layers.full_refresh({"x": spark.range(1)})
    seen = []

    def update(now):
        if not seen:  # the other publisher is faster
            seen.append(1)
            other.full_refresh({"z": spark.range(3)})
        return {**now, "x2": now["x"]}

    layers.releases.commit(update)
    assert {"x", "x2", "z"} == set(layers.releases.current()) == set(other.releases.current())


def test_appends_stay_folders_until_there_are_many(spark, layers, monkeypatch):
    monkeypatch.setattr("strata.sources.layers.MAX_FOLDERS", 3)
    layers.full_refresh({"x": spark.range(1)})
    for i in range(1, 5):
        layers.append("x", spark.range(i, i + 1))
        assert layers.read("x").count() == i + 1
    assert len(layers._entry("x")["paths"]) == 2
    layers.sync_columns("x", spark.createDataFrame([], "id bigint, more string"))  # no rewrite
    assert _rows(layers.read("x"))[0] == (0, None) and len(layers._entry("x")["paths"]) == 2


# ---- landing as a split append ---------------------------------------------

def _landing(spark, lo, hi, at):
    return spark.range(lo, hi).select(F.concat(F.lit("e"), "id").alias("endpoint"), F.lit(at).cast("long").alias("pos"),
                                      F.sha2(F.col("id").cast("string"), 512).alias("payload"))


def test_new_keys_add_their_own_bytes(spark, layers):
    layers.put_first("raw", _landing(spark, 0, 4000, 10), ["endpoint"], ["pos"], n_buckets=8)
    before, files = _bytes(layers.root), set(layers.read("raw", layout=True).inputFiles())
    layers.put_first("raw", _landing(spark, 4000, 4200, 10), ["endpoint"], ["pos"])
    assert files < set(layers.read("raw", layout=True).inputFiles())  # nothing rewritten
    alone = Layers(spark, layers.root + "-alone", layers.prefix + "alone_")
    alone.put_first("raw", _landing(spark, 4000, 4200, 10), ["endpoint"], ["pos"], n_buckets=8)
    assert _bytes(layers.root) - before <= 1.2 * _bytes(alone.root)
    assert layers.read("raw").count() == 4200
    # the same rows again, as in a batch that is run again: nothing is written
    files = set(layers.read("raw", layout=True).inputFiles())
    layers.put_first("raw", _landing(spark, 3900, 4200, 10), ["endpoint"], ["pos"])
    assert set(layers.read("raw", layout=True).inputFiles()) == files


def test_a_late_winner_rewrites_its_bucket_only(spark, layers):
    layers.put_first("raw", _landing(spark, 0, 2000, 10), ["endpoint"], ["pos"], n_buckets=16)
    files = set(layers.read("raw", layout=True).inputFiles())
    batch = _landing(spark, 5, 6, 3).unionByName(_landing(spark, 7, 8, 12)).unionByName(_landing(spark, 9000, 9001, 1))
    layers.put_first("raw", batch, ["endpoint"], ["pos"])
    t = layers.read("raw", layout=True)
    got = {r.endpoint: r.pos for r in t.where("endpoint IN ('e5', 'e7', 'e9000')").collect()}
    assert got == {"e5": 3, "e7": 10, "e9000": 1} and t.count() == 2001
    mine = batch.limit(1).select(key_bucket(["endpoint"], 16)).first()[0]
    assert set(t.where(F.col(KEY_BUCKET) != mine).inputFiles()) >= {f for f in files if f"{KEY_BUCKET}={mine}/" not in f}
    assert layers.vacuum("raw") == 1  # the folder of the bucket's first version
    assert layers.read("raw").count() == 2001


def test_untouched_buckets_are_not_scanned(spark, layers):
    layers.put_first("raw", _landing(spark, 0, 2000, 10), ["endpoint"], ["pos"], n_buckets=16)
    buckets, cur = layers._touched("raw", ["endpoint"], _landing(spark, 5, 6, 3))
    assert len(buckets) == 1 and len(cur.inputFiles()) < len(layers.read("raw", layout=True).inputFiles()) / 4


def test_rejects_of_every_feed_are_kept_once(spark, layers, tmp_path):
    for feed in "ab":
        os.makedirs(tmp_path / feed)
        (tmp_path / feed / "f.json").write_text(f"{{broken {feed}\n{{broken {feed}\n" + json.dumps(
            {"source": feed, "endpoint": "e", "payload": "p", "kafka_offset": 1}) + "\n")
    for feed, checkpoint in (("a", "c1"), ("b", "c2"), ("a", "c3"), ("b", "c2")):  # c3: begun anew
        D.drain(spark, str(tmp_path / feed), layers, "raw", str(tmp_path / checkpoint), reject_table="bad")
    assert sorted(r._corrupt_record for r in layers.read("bad").collect()) == ["{broken a"] * 2 + ["{broken b"] * 2
    assert layers.read("raw").count() == 2


# ---- change state ----------------------------------------------------------

def test_state_batch_touches_its_buckets_and_forgets_deleted_keys(spark, layers, tmp_path):
    src, final = str(tmp_path / "in"), [None]

    def deliver(*events):
        lines = [json.dumps({"op": op, "source": {"lsn": lsn}, **({"before" if op == "d" else "after": {"id": k, "v": v}} if k is not None else {})})
                 for op, lsn, k, v in events]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(src)
        D.apply_change_stream(spark, spark.readStream.schema("value string").text(src), layers, "s", str(tmp_path / "ck"),
                              ["id"], "value", "id bigint, v string", final_below=lambda: final[0])
        return _rows(layers.read("s"))

    deliver(*[("c", i, i, "x") for i in range(1, 400)])
    files = set(layers.read("s", layout=True).inputFiles())
    assert len(deliver(("d", 500, 3, None), ("u", 400, 3, "late"))) == 398
    assert len(files & set(layers.read("s", layout=True).inputFiles())) == len(files) - 1
    assert layers.read("s", layout=True).where("_gone").count() == 1
    assert (3, "late") not in deliver(("u", 450, 3, "late"))
    final[0] = 501  # no event below can come any more: the key is forgotten with its bucket's next rewrite
    deliver(("u", 510, 3, "back"))
    deliver(("d", 520, 3, None))
    final[0] = 600
    deliver(("c", 601, 3, "again"))
    assert layers.read("s", layout=True).where("_gone").count() == 0
    assert deliver(("t", 700, None, None)) == []  # one number; no bucket is read
    assert layers.cleared("s") == 700 and layers.read("s", layout=True).count() > 300
    assert deliver(("c", 690, 5, "before"), ("c", 701, 6, "after")) == [(6, "after")]


def test_truncate_in_the_first_batch(spark, layers, tmp_path):
    src = str(tmp_path / "in")
    lines = [('{"op": "t", "source": {"lsn": 5}}',), ('{"op": "c", "source": {"lsn": 4}, "after": {"id": 1}}',)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(src)
    D.apply_change_stream(spark, spark.readStream.schema("value string").text(src), layers, "s", str(tmp_path / "ck"), ["id"],
                          "value", "id bigint")
    assert _rows(layers.read("s")) == [] and layers.cleared("s") == 5


# ---- upsert ----------------------------------------------------------------

def test_both_upserts_refuse_duplicate_keys(spark, layers):
    target = spark.createDataFrame([(1, "a", {"x": 1}), (2, "b", None)], "k int, v string, m map<string,int>")
    twice = spark.createDataFrame([(2, "c", None), (2, "d", None)], target.schema)
    with pytest.raises(Exception, match="duplicate keys in upsert input"):
        loads.upsert(target, twice, ["k"]).collect()
    layers.upsert("t", target, ["k"])
    with pytest.raises(Exception, match="duplicate keys in upsert input"):
        layers.upsert("t", twice, ["k"])
    layers.upsert("t", twice.limit(1).select("m", "v", "k"), ["k"])
    assert sorted(r.k for r in layers.read("t").collect()) == [1, 2]
    plan = loads.upsert(target, twice, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_first_wins_counts_in_one_aggregate(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "k string, n int")
    held = spark.createDataFrame([("b",), ("z",), ("z",)], "k string")
    assert _rows(loads.first_wins_counts(batch, held, ["k"])) == [(4, 2, 2)]
    assert _rows(loads.first_wins_counts(batch.limit(0), held, ["k"])) == [(0, 0, 0)]


# ---- snapshot replace at the sink ------------------------------------------

def test_snapshot_replace_switches_one_partition(spark, layers):
    old = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "id int, source string")
    layers.full_refresh({"raw": old}, partition_by={"raw": ["source"]})

    def files(source):
        return {r[0] for r in layers.read("raw").filter(F.col("source") == source).select(F.input_file_name()).distinct().collect()}

    others = files("b") | files("c")
    new = spark.createDataFrame([(9, "a"), (8, "b")], "id int, source string")
    layers.replace_partition("raw", new, "source", "a")  # rows of other sources are left out
    layers.replace_partition("raw", new, "source", "d")  # a source not seen before, without rows
    assert _rows(layers.read("raw")) == [(3, "b"), (4, "c"), (9, "a")]
    assert files("b") | files("c") == others
    layers.replace_partition("raw", new.limit(0), "source", "a")
    assert _rows(layers.read("raw")) == [(3, "b"), (4, "c")]
    layers.vacuum("raw")
    assert _rows(layers.read("raw")) == [(3, "b"), (4, "c")] and files("b") | files("c") == others
