"""What the operators share: table access, scratch tables, Arrow plumbing and
vectorised word hashing."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, scratch_path

#: Rows and bytes of an Arrow batch handed to Python (one row may be larger).
ARROW_ROWS, ARROW_BYTES = 512, 4 << 20
#: Bytes of text that are hashed at once.
PIECE_BYTES = 1 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on (shared folder, small batches)."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # scans are cut by the number of cores; held fixed, so that row numbers are the
    # same in every read of a table even if executors come or go in between
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    lineage is cut by files that every executor can read."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a table written by ``saved`` that nothing reads any more."""
    spark = df.sparkSession
    jvm, base = spark._jvm, ensure_checkpoint_dir(spark).rstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName().startswith("llm-") and path.getParent().toUri().getPath() == jvm.org.apache.hadoop.fs.Path(base).toUri().getPath():
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32(doc_id as text) mod ``m``; -1 for a null id (in no fold)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % F.lit(m), F.lit(-1))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """Return memory that is no longer used to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    _trim(0)


def lean(fn: Callable) -> Callable:
    """``fn`` of an iterator of batches; at the end of a partition the worker, which
    Spark keeps for later tasks, gives the memory it no longer uses back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()

    return run


_held: list[DataFrame] = []


def held(df: DataFrame) -> DataFrame:
    """Persist ``df`` until ``release``."""
    _held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return df


def release() -> None:
    """Free what operators have persisted; what is still read is computed again."""
    while _held:
        _held.pop().unpersist(blocking=True)


def arrow_rows(df: DataFrame, fn: Callable[[list], list], schema: str,
               arrow_schema: pa.Schema) -> DataFrame:
    """``mapInArrow`` where ``fn`` gets the columns of a batch as Python lists
    and returns the output columns as lists or arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn([c.to_pylist() for c in b.columns])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=f.type) for x, f in zip(out, arrow_schema)],
                schema=arrow_schema)

    return df.mapInArrow(lean(run), schema)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows sorted by their first ``keys`` columns (64-bit integers), cut where
    the key changes: each table holds whole runs of equal keys."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = [b.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in k]))
        if rest and any(x[0] != rest[-1].column(i)[-1].as_py() for i, x in enumerate(k)):
            yield pa.Table.from_batches(rest)
            rest = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*rest, b.slice(0, cut)])
            rest = [b.slice(cut)]
        else:
            rest.append(b)
    if rest:
        yield pa.Table.from_batches(rest)


def run_bounds(cols: list[np.ndarray]) -> np.ndarray:
    """Starts of the runs of equal keys, and the end."""
    n = len(cols[0])
    change = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in cols])) + 1 if n > 1 else []
    return np.concatenate([[0], change, [n]]).astype(np.int64)


def by_key(df: DataFrame, keys: list[str], fn, schema: str, together: int | None = None) -> DataFrame:
    """Bring rows with equal keys together (those of equal first ``together`` keys,
    if given), in order, and map each partition."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys[:together]).sortWithinPartitions(*keys).mapInArrow(lean(fn), schema)


# ---- words as arrays ------------------------------------------------------

#: The white space bytes 0x20 and 0x09-0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = np.random.default_rng(20250101).integers(1, 2**63, 256, dtype=np.uint64)
_BASE, _POW, _INV = np.uint64(0x9E3779B97F4A7C15), np.ones(1, np.uint64), np.ones(1, np.uint64)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        inv = np.uint64(pow(int(_BASE), -1, 1 << 64))
        p, q = np.full(n, _BASE, np.uint64), np.full(n, inv, np.uint64)
        p[0] = q[0] = 1
        _POW, _INV = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _POW, _INV


def words(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of a byte array."""
    gap = np.empty(len(a) + 2, bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = _SPACE[a]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[0::2], edge[1::2]


def word_hashes(a: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: polynomial prefix sums, then a finaliser.  Bytes
    are taken a piece at a time, so that a long text costs memory by its words."""
    pw, inv = _powers(PIECE_BYTES + 1)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE_BYTES, side="right")))
        if ends[i] - base > PIECE_BYTES:  # one word longer than a piece
            sums = [int(np.sum(_BYTE[a[p:min(p + PIECE_BYTES, ends[i])]] * pw[:min(PIECE_BYTES, ends[i] - p)]))
                    * pow(int(_BASE), p - base, 1 << 64) for p in range(base, int(ends[i]), PIECE_BYTES)]
            out[i] = sum(sums) % (1 << 64)
            j = i + 1
        else:
            s, e = starts[i:j] - base, ends[i:j] - base
            pre = np.zeros(int(e[-1]) + 1, np.uint64)
            np.cumsum(_BYTE[a[base:base + len(pre) - 1]] * pw[:len(pre) - 1], out=pre[1:])
            out[i:j] = (pre[e] - pre[s]) * inv[s]
        i = j
    return mix64(out ^ (ends - starts).astype(np.uint64))


def lower_bytes(texts: list, pieces: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts (null: empty) as one lower-cased (A-Z) byte array of
    about ``pieces`` bytes, line ends between them: (first, last + 1, bytes,
    offset of each text and the end)."""
    at = 0
    raw = [(t or "").encode() for t in texts]
    while at < len(raw):
        to, size = at, 0
        while to < len(raw) and (to == at or size + len(raw[to]) < pieces):
            size += len(raw[to]) + 1
            to += 1
        off = np.zeros(to - at + 1, np.int64)
        np.cumsum([len(x) + 1 for x in raw[at:to]], out=off[1:])
        joined = b"\n".join(raw[at:to]).lower() + b"\n"
        yield at, to, np.frombuffer(joined, np.uint8), off
        at = to
