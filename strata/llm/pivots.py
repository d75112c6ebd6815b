"""Embedding near-duplicates by a pivot-permutation index.

Each vector is described by its nearest reference points (pivots) in order.
Vectors are retrieved through inverted pivot lists per label: a pair is a
candidate if it shares enough pivots, counted inside the list, and is then
verified by cosine in double precision.  Equal vectors are one class, so
copies never form pairs.  A long list is split by the next pivot that its
vectors may share, up to as many pivots as a pair must share; what is still long
then is split into blocks that meet two by two in tasks of their own."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_key, prepare, run_bounds, saved, table, whole_runs
from .graph import Sets, components

COSINE = 0.93
#: Pivots (from a bounded sample).  An eighth of them, the nearest, describe a
#: vector, and a candidate pair shares half of those: recall hangs on these shares,
#: not on the number of pivots, and is measured in tests.
PIVOTS = 64
SAMPLE = 4_096
#: Vectors of a list that is not split, and per block.
BLOCK = 1_024


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, so
    that very large and very small components neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _classes(vectors: DataFrame) -> DataFrame:
    """(cid, label, dim, vec, n, first): the distinct vectors of each label."""
    vec = F.col("vec")
    usable = (vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0")
              .where(~F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
              .where(F.exists(vec, lambda v: v != 0)))
    found = usable.groupBy("label", "vec").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    return saved(found.select(F.monotonically_increasing_id().alias("cid"), F.xxhash64("label").alias("label_key"), "label",
                              F.size("vec").cast("long").alias("dim"), "vec", "n", "first"), "pivot-classes")


def _pivots(classes: DataFrame, n_pivots: int) -> dict[int, np.ndarray]:
    """Pivots per vector length: the first of a bounded sample in hash order."""
    got: dict[int, list] = {}
    for r in classes.select("dim", "vec").orderBy(F.xxhash64("vec", "label"), "cid").limit(SAMPLE).collect():
        got.setdefault(r.dim, []).append(r.vec)
    return {d: _unit(np.array(v[:n_pivots], float)) for d, v in got.items()}


def _described(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """Add ``near``: the nearest pivots of each vector, nearest first."""
    out = pa.schema([("cid", pa.int64()), ("label_key", pa.int64()), ("dim", pa.int64()), ("n", pa.int64()),
                     ("vec", pa.list_(pa.float64())), ("near", pa.list_(pa.int64()))])

    def describe(batches):
        for b in batches:
            vecs = b.column(4).to_pylist()
            near: list[list[int]] = [[0] for _ in vecs]  # a length without pivots: one list
            dims = np.array([len(v) for v in vecs])
            for d in np.unique(dims).tolist():
                if d in pivots:
                    at = np.flatnonzero(dims == d)
                    x = _unit(np.array([vecs[i] for i in at], float))
                    order = np.argsort(-(x @ pivots[d].T), axis=1, kind="stable")[:, :nearest]
                    for i, o in zip(at.tolist(), order.tolist()):
                        near[i] = o
            yield pa.RecordBatch.from_arrays([*b.columns[:4], b.column(4), pa.array(near, pa.list_(pa.int64()))], schema=out)

    return (classes.select("cid", "label_key", "dim", "n", F.col("vec").cast("array<double>").alias("vec"))
            .mapInArrow(describe, "cid long, label_key long, dim long, n long, vec array<double>, near array<long>"))


def _split(described: DataFrame, shared: int, base: int) -> DataFrame:
    """Deal the vectors to lists: ``path`` holds the least pivots that the pairs
    of a list share, as digits (pivot + 1) of a number to ``base``.  In the order
    of pivots, the j-th common one of a pair that shares s of m is among the first
    m - s + j of both, so a list divided by the next pivot loses no pair."""
    key = ["label_key", "dim", "path"]
    needed = F.least(F.lit(shared), F.size("near"))
    spare = F.size("near") - needed
    lists = (described.withColumn("near", F.array_sort("near"))
             .select("*", F.posexplode(F.slice("near", F.lit(1), spare + 1)).alias("at", "path"))
             .withColumn("path", F.col("path") + 1))
    most = 1
    while most < shared and base ** (most + 1) < 2 ** 62:  # paths fit a long
        most += 1
    for level in range(1, most):
        crowd = saved(lists.where(needed > level).groupBy(*key).agg(F.count("*").alias("k")).where(F.col("k") > BLOCK)
                      .select(*key, F.lit(True).alias("crowded")), "pivot-crowd")
        if crowd.isEmpty():
            break
        further = F.when(F.col("crowded"), F.sequence(F.col("at") + 1, spare + level)).otherwise(F.array(F.lit(-1)))
        lists = (lists.join(crowd, key, "left").withColumn("further", F.explode(further))
                 .withColumn("path", F.when(F.col("further") < 0, F.col("path"))
                             .otherwise(F.col("path") * base + F.col("near")[F.greatest("further", F.lit(0))] + 1))
                 .withColumn("at", F.greatest("at", "further")).drop("crowded", "further"))
    return lists.drop("at")


def _search(batches, cosine: float, shared: int, base: int):
    """Runs of one (list, block pair): links among its vectors, as link counts
    and one edge per vector."""
    out = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    for t in whole_runs(batches, 4):
        keys = [t.column(i).to_numpy() for i in range(4)]
        side, cid, n = (t.column(i).to_numpy() for i in (4, 5, 6))
        paths, pairs = keys[1], keys[3]
        at = run_bounds(keys)
        got = ([], [], [])
        for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
            if j - i < 2:
                continue
            left = np.flatnonzero(side[i:j] != 2)
            right = np.flatnonzero(side[i:j] == 2)
            inner = pairs[i] // 1_000_000 == pairs[i] % 1_000_000
            right = left if inner else right
            if not len(left) or not len(right):
                continue
            part = t.slice(i, j - i)
            x = _unit(np.array(part.column(7).to_pylist(), float))
            near = part.column(8).to_pylist()
            top = 1 + max(max(a) for a in near)
            has = np.zeros((j - i, top), np.float32)
            for k, a in enumerate(near):
                has[k, a] = 1
            ok = has[left] @ has[right].T >= min(shared, *(len(a) for a in near))
            path, length = int(paths[i]), 0
            last = path % base  # pivots up to the last one of the path
            while path:
                path, length = path // base, length + 1
            # each pair in the list of its least common pivots only
            ok &= has[left][:, :last] @ has[right][:, :last].T == length
            ok &= x[left] @ x[right].T >= cosine
            if inner:
                np.fill_diagonal(ok, False)
            a, b = np.nonzero(ok)
            if not len(a):
                continue
            sets = Sets(j - i)
            firsts = {}
            for p, q in zip(left[a].tolist(), right[b].tolist()):
                if firsts.setdefault(p, q) == q or sets.find(p) != sets.find(q):
                    sets.join(p, q)
            w = np.zeros(j - i, np.int64)
            np.add.at(w, left[a], n[i:j][right[b]])
            if not inner:
                np.add.at(w, right[b], n[i:j][left[a]])
            used = np.flatnonzero(w)
            got[0].append(cid[i:j][used])
            got[1].append(w[used])
            got[2].append(cid[i:j][sets.roots()[used]])
        if got[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(g), pa.int64()) for g in got], schema=out)


def near_embeddings(vectors: DataFrame, cosine: float = COSINE, n_pivots: int = PIVOTS, nearest: int | None = None,
                    shared: int | None = None) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id,
    n_links (other vectors linked directly), component_id (least vec_id that
    links reach), kept (vec_id = component_id).

    ``nearest`` pivots describe a vector (default: an eighth of ``n_pivots``) and a
    candidate pair shares ``shared`` of them (default: half).  Without pivots
    (``n_pivots=0``) the search is exact: each label is one list, met block by block.

    Only vectors of equal, non-null label and equal length are compared.  A
    vector that is null, empty, zero, or holds null or non-finite components
    links with nothing and is its own component; so does a row without vec_id
    (component null, not kept).  Repeated rows link to each other.  Extra
    columns are ignored; an empty table gives no rows."""
    nearest = nearest or max(1, n_pivots // 8)
    shared = shared or max(1, nearest // 2)
    base = n_pivots + 2
    prepare(vectors.sparkSession)
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"),
                          vectors["embedding"].cast("array<double>").alias("vec"), vectors["label"].alias("label"))
    classes = _classes(rows)
    pivots = _pivots(classes, n_pivots) if n_pivots else {}
    described = saved(_described(classes, pivots, nearest), "pivot-lists")
    lists = _split(described, shared, base)
    crowd = saved(lists.groupBy("label_key", "dim", "path").agg(F.count("*").alias("k")).where(F.col("k") > BLOCK)
                  .select("label_key", "dim", "path", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks")), "pivot-crowd")
    one = F.lit(1)
    placed = (lists.join(crowd, ["label_key", "dim", "path"], "left").withColumn("blocks", F.coalesce("blocks", one))
              .withColumn("mine", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("label_key", "path", "dim",
                      (F.least("mine", "other") * 1_000_000 + F.greatest("mine", "other")).cast("long").alias("pair"),
                      F.when(F.col("mine") > F.col("other"), 2).otherwise(1).cast("int").alias("side"),
                      "cid", "n", "vec", "near"))
    keys = ["label_key", "path", "dim", "pair"]
    found = saved(by_key(placed, keys, lambda it: _search(it, cosine, shared, base), "cid long, links long, root long"), "pivot-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    member = (classes.select("cid", "label", "vec", "n", "first").join(links, "cid", "left")
              .join(comp, F.col("cid") == F.col("node"), "left")
              .select("label", "vec", F.coalesce("root", "cid").alias("root"), "first",
                      (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    least = member.groupBy("root").agg(F.min("first").alias("least"))
    of = member.join(least, "root").select(F.col("label").alias("l"), F.col("vec").alias("v"), "n_links", "least")
    return (rows.join(of, (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v")) & F.col("vec_id").isNotNull(), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("least", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op8_pivot_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))
