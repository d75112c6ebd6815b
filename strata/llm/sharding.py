"""Sharding by a k-d tree over metadata.

A node is split along its widest metadata dimension at the weighted median
(rows weigh their bytes), until every leaf holds its target bytes.  The median
is found on the cluster: each pass sums the bytes of a fixed number of key
ranges per node, and only those sums reach the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, saved, table

#: Key ranges per node and pass of the median search.
BINS = 4_096
#: Rows per numbering group (slots are numbered group by group).
GROUP_ROWS = 20_000
_TIE_BITS = 31


@dataclass
class Node:
    """``shards`` leaves from number ``first`` on; a split sends keys of
    dimension ``dim`` below ``cut`` to the left."""

    first: int
    shards: int
    dim: int | None = None
    cut: int = 0
    below: list[Node] = field(default_factory=list)

    def leaves(self) -> list[Node]:
        return [x for b in self.below for x in b.leaves()] if self.below else [self]

    def place(self, key) -> Column:
        """The first shard of the leaf a row falls into."""
        if not self.below:
            return F.lit(self.first)
        return F.when(key(self.dim) < F.lit(self.cut), self.below[0].place(key)).otherwise(self.below[1].place(key))


def _metadata(docs: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """Row number, id, size, checksum and one whole-number coordinate per dimension."""
    text = docs["text"].cast("string")
    return docs.select(
        F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).cast("long").alias("text_crc32"),
        *[F.coalesce(c.cast("long"), F.lit(0)).alias(f"d{i}") for i, c in enumerate(dims.values())])


def default_dims(docs: DataFrame) -> dict[str, Column]:
    """Coordinates from 0 to 2**31 - 1: source, language, size and id."""
    top = float(2**31 - 1)
    dims = {c: F.crc32(docs[c].cast("string")) / 2 for c in ("source", "lang") if c in docs.columns}
    dims["size"] = F.least(F.lit(top), F.log2(F.coalesce(F.octet_length(docs["text"].cast("string")), F.lit(0)) + 1.0) * (top / 64))
    dims["doc_id"] = F.pmod(docs["doc_id"].cast("long"), F.lit(2**31))
    return dims


def build_tree(meta: DataFrame, n_dims: int, n_shards: int) -> Node:
    """Split level by level; per pass at most (nodes x BINS) sums are collected."""

    def key(i: int) -> Column:  # the coordinate, ties in the order of a row hash
        return F.shiftleft(F.col(f"d{i}"), _TIE_BITS) + F.pmod(F.xxhash64("row"), F.lit(2**_TIE_BITS))

    ends = [f(f"d{i}").alias(f"{n}{i}") for i in range(n_dims) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    whole = meta.agg(*ends).first()
    width = [max(1, (whole[f"hi{i}"] or 0) - (whole[f"lo{i}"] or 0)) for i in range(n_dims)]
    root = Node(0, n_shards)
    while True:
        open_ = {n.first: n for n in root.leaves() if n.shards > 1}
        if not open_:
            return root
        placed = meta.withColumn("node", root.place(key)).where(F.col("node").isin([*open_]))
        search = {}
        for r in placed.groupBy("node").agg(F.sum("size").alias("w"), *ends).collect():
            node = open_[r.node]
            node.dim = max(range(n_dims), key=lambda i: ((r[f"hi{i}"] - r[f"lo{i}"]) / width[i], -i))
            left = node.shards // 2
            search[r.node] = [r[f"lo{node.dim}"] << _TIE_BITS, (r[f"hi{node.dim}"] + 1) << _TIE_BITS, 0,
                              r.w * left / node.shards]
        for first, node in open_.items():  # an empty node: every cut is as good
            if first not in search:
                node.dim = 0
        todo = dict(search)
        while todo:

            def by_node(value):
                out = F.lit(None).cast("long")
                for k in todo:
                    out = F.when(F.col("node") == k, value(k)).otherwise(out)
                return out

            step = {k: max(1, -(-(v[1] - v[0]) // BINS)) for k, v in todo.items()}
            at = by_node(lambda k: key(open_[k].dim))
            bins = (placed.where(F.col("node").isin([*todo])).withColumn("key", at)
                    .where((F.col("key") >= by_node(lambda k: F.lit(todo[k][0])))
                           & (F.col("key") < by_node(lambda k: F.lit(todo[k][1]))))
                    .withColumn("bin", F.floor((F.col("key") - by_node(lambda k: F.lit(todo[k][0])))
                                                              / by_node(lambda k: F.lit(step[k]))).cast("long"))
                    .groupBy("node", "bin").agg(F.sum("size").alias("w"), F.count("*").alias("n"),
                                                F.min("key").alias("first")))
            sums: dict[int, list] = {}
            for r in bins.collect():
                sums.setdefault(r.node, []).append((r.bin, r.w, r.n, r.first))
            for k in list(todo):
                lo, hi, below, target = todo[k]
                for b, w, n, first in sorted(sums.get(k, [])):
                    if below + w < target:
                        below += w
                        continue
                    if n == 1 or step[k] == 1:  # the row at the median: to the nearer side
                        open_[k].cut = first if target - below < below + w - target else first + 1
                        del todo[k]
                    else:
                        todo[k] = [lo + b * step[k], min(hi, lo + (b + 1) * step[k]), below, target]
                    break
                else:
                    open_[k].cut = hi
                    del todo[k]
        for node in open_.values():
            left = node.shards // 2
            node.below = [Node(node.first, left), Node(node.first + left, node.shards - left)]


def kd_shards(docs: DataFrame, n_shards: int = 16, dims: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes + 1; a null text
    has none), text_crc32, shard and slot (0, 1, ... within its shard).

    Shards hold equal bytes up to about one row per level of the tree.  Ties
    and repeated rows are ordered by a hash of their row number, so equal rows
    may part; null metadata count as 0; an empty table gives no rows."""
    prepare(docs.sparkSession)
    dims = dims or default_dims(docs)
    meta = saved(_metadata(docs, dims), "shard-meta")
    root = build_tree(meta, len(dims), n_shards)

    def key(i: int) -> Column:
        return F.shiftleft(F.col(f"d{i}"), _TIE_BITS) + F.pmod(F.xxhash64("row"), F.lit(2**_TIE_BITS))

    groups = 1 + meta.count() // (n_shards * GROUP_ROWS)
    placed = meta.select("row", "doc_id", "size", "text_crc32", root.place(key).cast("int").alias("shard"),
                         F.pmod(F.xxhash64(F.lit("slot"), "row"), F.lit(groups)).alias("grp"))
    sizes = placed.groupBy("shard", "grp").agg(F.count("*").alias("n"))
    # one small row per group of GROUP_ROWS rows
    start = sizes.select("shard", "grp", (F.sum("n").over(Window.partitionBy("shard").orderBy("grp")) - F.col("n")).alias("start"))
    inside = placed.withColumn("nth", F.row_number().over(Window.partitionBy("shard", "grp").orderBy("row")))
    return inside.join(start, ["shard", "grp"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth") - 1).alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16) -> None:
    """Write ``docs`` as one folder per shard (``shard=0`` and so on).  The
    rows must be a file scan, so that row numbers are the same in both reads."""
    prepare(docs.sparkSession)
    dims = default_dims(docs)
    meta = saved(_metadata(docs, dims), "shard-meta")
    root = build_tree(meta, len(dims), n_shards)
    full = docs.withColumns({"_row": F.monotonically_increasing_id(),
                             **{f"_d{i}": F.coalesce(c.cast("long"), F.lit(0)) for i, c in enumerate(dims.values())}})

    def key(i: int) -> Column:
        return F.shiftleft(F.col(f"_d{i}"), _TIE_BITS) + F.pmod(F.xxhash64("_row"), F.lit(2**_TIE_BITS))

    (full.withColumn("shard", root.place(key).cast("int")).drop("_row", *[f"_d{i}" for i in range(len(dims))])
     .write.partitionBy("shard").parquet(path))


def op2_kd_sharding(spark, sf_dir: str) -> DataFrame:
    out = kd_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
