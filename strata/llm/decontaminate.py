"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents long, so an item's Jaccard similarity with
a whole document says nothing.  Items are partitioned by size (powers of two
of their shingles); for each partition a document is read as overlapping
windows a few times that size, in which a contained item keeps a similarity
high enough for one of its MinHash values to be the window's too.  A window
shares a MinHash value only if it holds the very shingle that value comes
from, so documents are first scanned for those shingles alone.  Candidates are
verified by the exact containment of the item's shingles in the document."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, lower_bytes, mix64, prepare, table, word_hashes, words

#: Words per shingle, least containment, MinHash values per item.
SHINGLE, CONTAINED, HASHES = 5, 0.8, 128
#: Bytes of test items (expected) that one pass over the documents holds.
BLOCK_BYTES = 4 << 20

_rng = np.random.default_rng(128)
_MULT = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22
_OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()),
                  ("n_shared", pa.int64()), ("containment", pa.float64())])


def shingle_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word runs of word hashes ``w``."""
    n = len(w) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = w[:n].copy()
    for j in range(1, k):
        h = h * _STEP + w[j:n + j]
    return mix64(h)


@dataclass
class Item:
    item_id: int | None
    k: int                 # words per shingle: fewer for an item of fewer words
    shingles: np.ndarray   # sorted, distinct
    reach: int             # its size partition: shingles per half window


class Index:
    """A block of items by the shingles that their MinHash values come from."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.items: list[Item] = []
        self.by_k: dict[int, dict[int, list[tuple[int, list[int]]]]] = {}
        for item_id, text in rows:
            for _, _, a, _ in lower_bytes([text]):
                w = word_hashes(a, *words(a))
            if not len(w):
                continue  # no shingle, found nowhere
            k = min(SHINGLE, len(w))
            s = np.unique(shingle_hashes(w, k))
            at = len(self.items)
            self.items.append(Item(item_id, k, s, 2 << int(len(s)).bit_length()))
            least = s[(s[None, :] * _MULT[:, None] + _ADD[:, None]).argmin(axis=1)]
            sources = self.by_k.setdefault(k, {})
            for x in np.unique(least).tolist():
                sources.setdefault(x, []).append((at, np.flatnonzero(least == np.uint64(x)).tolist()))
        self.filters = {}
        for k, sources in self.by_k.items():
            f = np.zeros(1 << _FILTER_BITS, bool)
            keys = np.array(sorted(sources), np.uint64)
            f[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.filters[k] = f, keys

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int]]]:
        """For each text the verified (item, shared shingles), by item."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        for first, last, a, off in lower_bytes(texts):
            starts, ends = words(a)
            w = word_hashes(a, starts, ends)
            lim = np.searchsorted(starts, off)  # words of text i: lim[i] to lim[i + 1]
            for k, (filt, keys) in self.filters.items():
                s = shingle_hashes(w, k)
                hit = np.flatnonzero(filt[(s >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
                hit = hit[np.isin(s[hit], keys)]
                of = np.searchsorted(lim, hit, side="right") - 1
                inside = hit + k <= lim[of + 1]
                hit, of = hit[inside], of[inside]
                cuts = np.flatnonzero(np.diff(of)) + 1
                for h in np.split(hit, cuts) if len(hit) else []:
                    d = int(np.searchsorted(lim, h[0], side="right")) - 1
                    own = s[lim[d]:lim[d + 1] - k + 1]
                    out[first + d] += self._verified(k, own, h - lim[d])
        return [sorted(x) for x in out]

    def _verified(self, k: int, own: np.ndarray, hits: np.ndarray) -> list[tuple[int, int]]:
        passed: set[int] = set()
        for i in hits.tolist():
            for at, which in self.by_k[k][int(own[i])]:
                if at not in passed and self._agrees(own, i, self.items[at].reach, which):
                    passed.add(at)
        if not passed:
            return []
        distinct = np.unique(own)
        found = []
        for at in passed:
            s = self.items[at].shingles
            n = int(np.isin(s, distinct, assume_unique=True).sum())
            if n >= CONTAINED * len(s) - 1e-9:
                found.append((at, n))
        return found

    @staticmethod
    def _agrees(own: np.ndarray, i: int, reach: int, which: list[int]) -> bool:
        """Is a MinHash value of the item, from shingle ``i``, that of a window?
        Windows are 2 * reach shingles long and start every ``reach``."""
        for j in (i // reach - 1, i // reach):
            if j < 0 and i >= reach:
                continue
            lo = max(0, j * reach)
            win = own[lo:(j + 2) * reach]
            for f in which:
                ordered = win * _MULT[f] + _ADD[f]
                if ordered.min() == ordered[i - lo]:
                    return True
        return False


def _blocks(items: DataFrame):
    """The test items in blocks of about BLOCK_BYTES, one after another."""
    rows = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = 1 + int(total) // BLOCK_BYTES
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else rows
        yield Index([(r.item_id, r.text) for r in part.collect()])


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The (document, test item) pairs where at least CONTAINED of the item's
    distinct shingles stand in the document: doc_id, item_id, n_shingles,
    n_shared, containment.

    Words are lower-cased (A-Z).  An item of fewer words than a shingle is one
    shingle; null and empty texts match nothing; repeated rows and items give
    repeated pairs; null ids stay null; an empty table gives no pairs."""
    prepare(docs.sparkSession)
    spark, out = docs.sparkSession, None
    rows = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    for index in _blocks(items):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            ix = shared.value
            for b in batches:
                ids = b.column(0).to_pylist()
                got = [(d, ix.items[at], n) for d, found in zip(ids, ix.search(b.column(1).to_pylist()))
                       for at, n in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=f.type) for x, f in zip(
                        ([g[0] for g in got], [g[1].item_id for g in got], [len(g[1].shingles) for g in got],
                         [g[2] for g in got], [g[2] / len(g[1].shingles) for g in got]), _OUT)], schema=_OUT)

        part = rows.mapInArrow(lean(run), "doc_id long, item_id long, n_shingles long, n_shared long, containment double")
        out = part if out is None else out.union(part)
    return out


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no test item (all columns kept)."""
    prepare(docs.sparkSession)
    text = docs.columns.index("text")
    for index in _blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for b in batches:
                found = shared.value.search(b.column(text).to_pylist())
                yield b.filter(pa.array([not f for f in found], pa.bool_()))

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
