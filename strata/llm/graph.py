"""Connected components by alternating large-star and small-star rounds.  Only
counts and sums reach the driver; each round is written to the shared folder,
so a lost executor costs no more than that round."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved


class Sets:
    """Disjoint sets over 0..n-1 inside one task; the root is the least member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.up))], np.int64)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> (node, root): the least node of its component,
    for every node of an edge between two different nodes."""
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                "edges")
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before or mark.n == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = mark
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .distinct())
        low2 = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        small = large.join(low2, F.col("a") == F.col("k"))
        old, now = now, saved(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                    .union(low2.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        discard(old)
