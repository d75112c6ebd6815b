"""Hot keys: one key holding a third of all rows must be reduced before the
shuffle and give the same answer as the brute-force window form."""

import contextlib
import io

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import history
from strata.operators.keyed import pick_one

SF = "/root/testdata/sf0.001"


def _skewed_events(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    # every third event is moved onto user 0
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_pick_one_hot_key_matches_window_and_combines_map_side(spark):
    ev = _skewed_events(spark)
    got = pick_one(ev, ["user_id"], ["ts", "event_id"], keep="last")
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    want = ev.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = _plan(got)
    # a partial aggregate sits below the exchange: the hot key is combined per map task
    assert "partial_max_by" in plan and plan.index("partial_max_by") > plan.index("Exchange")


def test_interval_join_hot_key(spark):
    ev = _skewed_events(spark)
    daily = (ev.groupBy("user_id", F.to_date("ts").alias("day"))
             .agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("regime")))
    dim = history.scd2(daily, ["user_id"], "day", ["regime"]).select("user_id", "valid_from", "valid_to",
                                                                     "version_num")
    for bucket in ("day", "week", "month"):
        got = history.interval_join(ev.select("event_id", "user_id", "ts"), dim, ["user_id"], "ts", bucket=bucket)
        # brute force: the range join written directly
        d = dim.alias("d")
        e = ev.select("event_id", "user_id", "ts").alias("e")
        cond = (F.col("e.user_id") == F.col("d.user_id")) & \
               (F.to_date("e.ts") >= F.col("d.valid_from")) & \
               (F.to_date("e.ts") <= F.coalesce(F.col("d.valid_to"), F.to_date(F.lit("2999-12-31"))))
        want = e.join(d, cond, "left").select("e.event_id", "d.version_num")
        assert sorted(map(tuple, got.select("event_id", "version_num").collect())) == \
            sorted(map(tuple, want.collect())), bucket


def test_hot_order_is_paged_and_decodes_whole(spark):
    from strata.operators import decode
    from strata.plans import messages as M
    from strata.plans.decode_q import MATRIX_FIELDS
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    # about a third of all lines moved onto order 1, line numbers as they are
    moved = (F.col("l_partkey") + F.col("l_linenumber")) % 3 == 0
    hot = li.withColumn("l_orderkey", F.when(moved, F.lit(1)).otherwise(F.col("l_orderkey")))
    n_hot = hot.filter("l_orderkey = 1").count()
    assert n_hot > 3 * M.PAGE_ROWS
    p = M.matrix_payloads(hot)
    sizes = p.select("doc_id", F.json_array_length(F.get_json_object("payload", "$.lineitems.data")).alias("n"))
    hot_pages = sizes.filter("doc_id = 1").collect()
    assert len(hot_pages) == -(-n_hot // M.PAGE_ROWS)
    assert max(r.n for r in hot_pages) <= 2 * M.PAGE_ROWS
    got = decode.decode_matrix(p, F.col("payload"), MATRIX_FIELDS, key="l_orderkey", path="$.lineitems")
    cols = ["l_orderkey", "l_linenumber", "l_quantity"]
    want = hot.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("decimal(18,2)").alias("l_quantity"))
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.collect()))


def test_interval_join_without_keys_matches_range_join(spark):
    import datetime as dt
    days = [dt.date(2024, 12, 30) + dt.timedelta(i) for i in range(70)]
    fact = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, at date")
    dim = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), dt.date(2025, 1, 2)),   # starts before the facts
         ("b", dt.date(2025, 1, 3), dt.date(2025, 2, 10)),
         ("c", dt.date(2025, 2, 20), None)],                 # open, current
        "regime string, valid_from date, valid_to date")
    for bucket in ("day", "month", "year"):
        got = history.interval_join(fact, dim, [], "at", bucket=bucket)
        want = {}
        for i, d in enumerate(days):
            hit = [r for r, lo, hi in [("a", dt.date(2024, 1, 1), dt.date(2025, 1, 2)),
                                       ("b", dt.date(2025, 1, 3), dt.date(2025, 2, 10)),
                                       ("c", dt.date(2025, 2, 20), dt.date(2999, 12, 31))] if lo <= d <= hi]
            want[i] = hit[0] if hit else None
        assert {r.id: r.regime for r in got.collect()} == want, bucket


def test_interval_join_hot_key_is_split_by_aqe(spark):
    """A (key, month) holding a third of the facts is split by AQE's skew
    join on the fact side of the left join; the answer is unchanged."""
    confs = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        ev = _skewed_events(spark)
        daily = (ev.groupBy("user_id", F.to_date("ts").alias("day"))
                 .agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("regime")))
        dim = history.scd2(daily, ["user_id"], "day", ["regime"]).select("user_id", "valid_from", "valid_to",
                                                                         "version_num")
        # several map tasks, as a large input has (a split is made of map outputs)
        facts = ev.select("event_id", "user_id", "ts").repartition(16)
        got = history.interval_join(facts, dim, ["user_id"], "ts")
        rows = [(r.event_id, r.version_num) for r in got.collect()]  # runs got's own adaptive plan
        assert "SortMergeJoin(skew=true)" in _plan(got)
        d, e = dim.alias("d"), ev.select("event_id", "user_id", "ts").alias("e")
        cond = (F.col("e.user_id") == F.col("d.user_id")) & \
               (F.to_date("e.ts") >= F.col("d.valid_from")) & \
               (F.to_date("e.ts") <= F.coalesce(F.col("d.valid_to"), F.to_date(F.lit("2999-12-31"))))
        want = e.join(d, cond, "left").select("e.event_id", "d.version_num")
        assert sorted(map(tuple, rows)) == sorted(map(tuple, want.collect()))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
