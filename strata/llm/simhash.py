"""SimHash near-duplicates by BK-trees.

Fingerprints are collapsed to distinct values first.  Two fingerprints within
the radius agree in at least one of radius + 1 bit blocks, so each value goes
to one shard per block value; a shard's BK-tree (children keyed by their
Hamming distance to the parent) is searched along the edges within the radius
only.  Shards reach their tasks through the shuffle: the trees grow with the
corpus, so sending all of them to every executor has no size bound.  A crowded
shard is split into several trees, each searched by all its values."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, by_key, prepare, run_bounds, saved, table, whole_runs
from .graph import Sets, components

SHINGLE, RADIUS, BITS = 3, 3, 64
#: Fingerprints per tree.
TREE = 4_096
#: From this many on a tree is searched with arrays.
ARRAYS_FROM = 96


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The 64-bit SimHash of the ``k``-word shingles, as a signed integer."""
    found = (text or "").encode().lower().split()  # splits at 0x20 and 0x09-0x0D
    if not found:
        return 0
    joined, n = b" ".join(found), len(found)
    if n <= k:
        digests, n = [xxhash.xxh64_digest(joined, 42)], 1
    else:
        ends = np.cumsum([len(w) + 1 for w in found]).tolist()
        starts, digest = [0, *ends], xxhash.xxh64_digest
        n = n - k + 1
        digests = [digest(joined[a:b - 1], 42) for a, b in zip(starts[:n], ends[k - 1:])]
    raw = np.frombuffer(b"".join(digests), np.uint8).reshape(n, 8)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 4096):
        ones += np.unpackbits(raw[i:i + 4096], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


class BKTree:
    """Nodes in insertion order; ``child[node, distance]`` is -1 or a node."""

    def __init__(self, values: list[int]):
        self.values = values
        self.kids: list[dict[int, int]] = [{} for _ in values]
        for i in range(1, len(values)):
            at, v = 0, values[i]
            while True:
                d = (values[at] ^ v).bit_count()
                below = self.kids[at].get(d)
                if below is None:
                    self.kids[at][d] = i
                    break
                at = below
        self.child = None

    def search(self, value: int, radius: int) -> list[int]:
        stack, found = [0], []
        while stack:
            at = stack.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            kids = self.kids[at]
            if kids:
                stack += [b for e, b in kids.items() if d - radius <= e <= d + radius]
        return found

    def search_all(self, queries: np.ndarray, radius: int):
        """(query, node) index arrays of the matches, a block of queries at a time."""
        if self.child is None:
            self.array = np.array(self.values, np.uint64)
            self.child = np.full((len(self.values), BITS + 1), -1, np.int32)
            for i, kids in enumerate(self.kids):
                for d, b in kids.items():
                    self.child[i, d] = b
        for at in range(0, len(queries), 128):
            q = np.arange(at, min(at + 128, len(queries)))
            node = np.zeros(len(q), np.int32)
            while len(q):
                d = np.bitwise_count(queries[q] ^ self.array[node]).astype(np.int64)
                near = d <= radius
                if near.any():
                    yield q[near], node[near]
                nq, nn = [], []
                for e in range(-radius, radius + 1):
                    to = d + e
                    ok = (to >= 0) & (to <= BITS)
                    below = self.child[node[ok], to[ok]]
                    there = below >= 0
                    nq.append(q[ok][there])
                    nn.append(below[there])
                q, node = np.concatenate(nq), np.concatenate(nn)


def linked(values: np.ndarray, own: np.ndarray, radius: int) -> np.ndarray:
    """For distinct fingerprints (uint64), the index of the least linked one:
    those marked ``own`` form the tree, all of them search it."""
    sets = Sets(len(values))
    mine = np.flatnonzero(own)
    if len(mine):
        tree = BKTree(values[mine].tolist())
        if len(mine) < ARRAYS_FROM:
            for i, v in enumerate(values.tolist()):
                for j in tree.search(v, radius):
                    sets.join(i, int(mine[j]))
        else:
            label = np.arange(len(mine))
            for q, node in tree.search_all(values, radius):
                # one pair per query and set found so far
                pair = np.unique(q * len(mine) + label[node])
                for x in pair.tolist():
                    sets.join(x // len(mine), int(mine[x % len(mine)]))
                spot = {int(m): i for i, m in enumerate(mine.tolist())}
                label = np.array([spot.get(sets.find(int(m)), i) for i, m in enumerate(mine.tolist())])
    return sets.roots()


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct fingerprints (fp: long) -> edges (a, b) that connect exactly
    the values within ``radius`` bits, at most a few per value."""
    blocks, width = radius + 1, BITS // (radius + 1)
    part = F.expr(f"explode(sequence(0, {blocks - 1}))")
    rows = prints.select("fp", part.alias("block")).select(
        "fp", (F.shiftleft(F.col("block").cast("long"), 32)
               + F.expr(f"shiftrightunsigned(fp, block * {width}) & {(1 << width) - 1}L")).alias("shard"))
    crowd = (rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > TREE)
             .select("shard", F.ceil(F.col("n") / TREE).cast("int").alias("trees")))
    placed = (rows.join(crowd, "shard", "left")
              .withColumn("home", F.pmod(F.xxhash64("fp"), F.coalesce("trees", F.lit(1))).cast("int"))
              .select("shard", F.explode(F.sequence(F.lit(0), F.coalesce("trees", F.lit(1)) - 1)).alias("tree"), "home", "fp")
              .select("shard", F.col("tree").cast("long").alias("tree"), (F.col("tree") == F.col("home")).alias("own"), "fp"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches):
        for t in whole_runs(batches, 2):
            cols = [t.column(i).to_numpy() for i in (0, 1)]
            own, fp = t.column(2).to_numpy(), t.column(3).to_numpy()
            at = run_bounds(cols)
            big = np.flatnonzero(np.diff(at) > 1)
            a, b = [], []
            for i, j in zip(at[big].tolist(), at[big + 1].tolist()):
                root = linked(fp[i:j].view(np.uint64), own[i:j], radius)
                far = np.flatnonzero(root != np.arange(j - i))
                a.append(fp[i:j][far])
                b.append(fp[i:j][root[far]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (a, b)], schema=out)

    return by_key(placed, ["shard", "tree"], search, "a long, b long")


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(row, doc_id, fp): the row number of the scan, the id and the fingerprint."""
    out = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64())])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
                       docs["text"].cast("string").alias("text"))
    return saved(arrow_rows(rows, lambda c: (c[0], c[1], [fingerprint(t, k) for t in c[2]]),
                            "row long, doc_id long, fp long", out), "simhash-prints")


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for each distinct fingerprint of ``prints``."""
    distinct = prints.select("fp").distinct()
    roots = components(links(distinct, radius))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id that
    links of at most ``radius`` differing bits reach) for each row of ``docs``.

    Texts without words - null, empty, white space - have fingerprint zero and
    link like any other; repeated rows link to each other; null ids never are
    a component id (null if no id of the component is known); extra columns
    are ignored; an empty table gives no rows."""
    prepare(docs.sparkSession)
    prints = fingerprints(docs, k)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    member = first.join(groups(prints, radius), "fp")
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    of = member.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` (a file scan) with one of each group kept: the least
    id, then the first row.  All columns are kept."""
    prepare(docs.sparkSession)
    prints = fingerprints(docs, k)
    best = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best"))
    kept = best.join(groups(prints, radius), "fp").groupBy("root").agg(F.min("best").alias("best"))
    row = "_simhash_row"
    while row in docs.columns:
        row = "_" + row
    return (docs.withColumn(row, F.monotonically_increasing_id())
            .join(kept.select(F.col("best.row").alias(row)), row, "left_semi").drop(row).select(*docs.columns))


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
