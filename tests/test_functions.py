from pyspark.sql import functions as F

from strata.functions import hash_key, hashdiff, key_hash, mask_params


def test_mask_params(spark):
    urls = ["https://x.org/a?api_key=S1&page=2&My_Token=abc#top", "https://x.org/b?q=1", "https://x.org/c",
            "https://x.org/d?password=p&user_secret=z&ref=r"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r.m for r in df.select(mask_params("url").alias("m")).collect()]
    assert got == ["https://x.org/a?api_key=***&page=2&My_Token=***#top", "https://x.org/b?q=1",
                   "https://x.org/c", "https://x.org/d?password=***&user_secret=***&ref=r"]
    got2 = df.select(mask_params("url", extra_keys=["ref"]).alias("m")).collect()[3].m
    assert got2 == "https://x.org/d?password=***&user_secret=***&ref=***"


def test_hashes(spark):
    df = spark.createDataFrame([("a", None, 1)], "a string, b string, c int")
    r = df.select(hash_key("a").alias("h"), hashdiff("a", "b", "c").alias("d"),
                  hashdiff("a", F.lit(""), "c").alias("d2"), key_hash("b").alias("k")).collect()[0]
    assert r.h == "0cc175b9c0f1b6a831c399e269772661"
    assert r.d == r.d2  # NULL and '' hash alike (parity with the reference)
    import hashlib
    assert r.d == hashlib.md5(b"a||1").hexdigest()
    assert bytes(r.k) == hashlib.md5(b"").digest()


def test_cluster_conf_sizes():
    from strata.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 200_000
    c = cluster_conf(10 * 1024 ** 3, 64)
    assert int(c["spark.sql.shuffle.partitions"]) == 128
    assert c["spark.sql.session.timeZone"] == "UTC"


def test_report_raises_on_failed_test(spark):
    from strata.operators import quality
    df = spark.createDataFrame([(1, -5.0), (2, 3.0)], "k int, v double")
    ok = quality.report({"non_negative_k": quality.non_negative(df, "k")})
    assert quality.raise_on_failure(ok) is ok
    bad = quality.report({"non_negative_v": quality.non_negative(df, "v"), "unique_k": quality.unique(df, ["k"])})
    try:
        quality.raise_on_failure(bad)
        raise AssertionError("failed test not raised")
    except quality.DataTestFailure as e:
        assert "non_negative_v=1" in str(e) and "unique_k" not in str(e)


def test_split_typed_routes_bad_text_to_rejects(spark):
    from strata.operators.decode import split_typed
    df = spark.createDataFrame([("a", "1", "2.50"), ("b", "", "x"), ("c", "q", ""), ("d", None, "3")],
                               "id string, n string, p string")
    good, bad = split_typed(df, {"n": "int", "p": "decimal(8,2)"}, keep=["id"])
    assert sorted((r.id, r.n, str(r.p)) for r in good.collect()) == [("a", 1, "2.50"), ("d", None, "3.00")]
    assert sorted((r.id, r.failed_columns) for r in bad.collect()) == [("b", ["p"]), ("c", ["n"])]
