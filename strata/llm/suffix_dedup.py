"""Dedup of repeated 200-byte strings by a content-defined cover of the suffixes.

What it keeps of the difference-cover algorithm is the cover and the naming of
sampled suffixes; it does not rank them in one global order, recurse on ranks or
compare neighbours.  Only equality of 200-byte prefixes is asked for, so names are
digests counted by key, which pre-aggregates hot names in every task.

The cover is chosen by content: every 200-byte window has one sampled position,
the least hash among its first 100, so equal windows have their sample at the
same place (a cover by position modulo a number would need a global text):

1. sampled suffixes are named by their first 101 bytes, and suffixes with a
   unique name are dropped: no window sampled there repeats;
2. the whole context of a sample - all windows that it stands for - is named;
   equal contexts are decided;
3. the windows of contexts that occur once are named by their own 200 bytes;
   equal names are the repeats.

The first name only screens; later ones, which decide, have 96 bits."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, lean, prepare, saved, table

#: Length of a repeat, and positions among which a window's sample is chosen.
LENGTH, CHOICE = 200, 100
#: Three blocks from the sample on lie inside every window that it stands for.
_TRIPLE = LENGTH - CHOICE + 1
_GRAM = 8
_HASH = np.random.default_rng(200).integers(0, 2**32, 256, dtype=np.uint32)
_SHIFT, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def samples(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled positions of a byte array, and the first and last start of the
    windows that each stands for."""
    n = len(a) - LENGTH + 1
    if n < 1:
        none = np.empty(0, np.int64)
        return none, none, none
    g = _HASH[a[:n + CHOICE + _GRAM - 2]]
    h = g[:-1] * np.uint32(0x9E3779B1) + g[1:]
    h = h[:-2] * np.uint32(0x85EBCA6B) + h[2:]
    h = h[:-4] * np.uint32(0xC2B2AE35) + h[4:]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    m, size = h.astype(np.uint64) << _SHIFT | np.arange(len(h), dtype=np.uint64), 1
    while 2 * size <= CHOICE:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if size < CHOICE:
        m = np.minimum(m[:size - CHOICE], m[CHOICE - size:])
    at = (m & _LOW).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.concatenate([first[1:], [n]]) - 1


def _bytes(batch_column) -> list[bytes]:
    return [(t or "").encode() for t in batch_column.to_pylist()]


def _mapped(df: DataFrame, fn, schema: str, fields: list) -> DataFrame:
    """mapInArrow for a function from a batch to columns (lists or arrays)."""
    out = pa.schema(fields)

    def run(batches):
        for b in batches:
            cols = fn(b)
            if len(cols[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    return df.mapInArrow(lean(run), schema)


def _names(base: DataFrame) -> DataFrame:
    """Step 1: (name, uid, pos) of every sampled suffix."""

    def fn(b):
        names, uids, pos, digest = [], [], [], xxhash.xxh3_64_digest
        for uid, data in zip(b.column(0).to_numpy(), _bytes(b.column(1))):
            at, _, _ = samples(np.frombuffer(data, np.uint8))
            if len(at):
                names += [digest(data[i:i + _TRIPLE]) for i in at.tolist()]
                uids.append(np.full(len(at), uid))
                pos.append(at.astype(np.int32))
        if not names:
            return [[], [], []]
        return [np.frombuffer(b"".join(names), np.int64), np.concatenate(uids), np.concatenate(pos)]

    return _mapped(base.select("uid", "text"), fn, "name long, uid long, pos int",
                   [("name", pa.int64()), ("uid", pa.int64()), ("pos", pa.int32())])


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of 128-bit digests as a long and an int."""
    d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return d[:, 0], d[:, 1].astype(np.int32)


def _contexts(base: DataFrame, hits: DataFrame) -> DataFrame:
    """Step 2: (d1, d2, name, uid, lo, hi) of each sample with a repeated name."""

    def fn(b):
        digests, names, uids, los, his = [], [], [], [], []
        for uid, data, pos in zip(b.column(0).to_numpy(), _bytes(b.column(1)), b.column(2).to_pylist()):
            at, lo, hi = samples(np.frombuffer(data, np.uint8))
            some = np.isin(at, pos)
            at, lo, hi = at[some], lo[some], hi[some]
            for i, p, q in zip(at.tolist(), lo.tolist(), hi.tolist()):
                digests.append(xxhash.xxh3_128_digest(data[p:q + LENGTH], i - p))
                names.append(xxhash.xxh3_64_digest(data[i:i + _TRIPLE]))
            uids.append(np.full(len(at), uid))
            los.append(lo.astype(np.int32))
            his.append(hi.astype(np.int32))
        if not digests:
            return [[], [], [], [], [], []]
        return [*_halves(digests), np.frombuffer(b"".join(names), np.int64), np.concatenate(uids),
                np.concatenate(los), np.concatenate(his)]

    return _mapped(base.select("uid", "text").join(hits, "uid").select("uid", "text", "pos"), fn,
                   "d1 long, d2 int, name long, uid long, lo int, hi int",
                   [("d1", pa.int64()), ("d2", pa.int32()), ("name", pa.int64()), ("uid", pa.int64()),
                    ("lo", pa.int32()), ("hi", pa.int32())])


def _prefixes(base: DataFrame, open_: DataFrame) -> DataFrame:
    """Step 3: (d1, d2, uid, start, alone) of the windows of open contexts."""

    def fn(b):
        digests, uids, starts, alone, digest = [], [], [], [], xxhash.xxh3_128_digest
        for uid, data, spans in zip(b.column(0).to_numpy(), _bytes(b.column(1)), b.column(2).to_pylist()):
            for s in spans:
                digests += [digest(data[p:p + LENGTH]) for p in range(s["lo"], s["hi"] + 1)]
                k = s["hi"] - s["lo"] + 1
                uids.append(np.full(k, uid))
                starts.append(np.arange(s["lo"], s["hi"] + 1, dtype=np.int32))
                alone.append(np.full(k, s["alone"]))
        if not digests:
            return [[], [], [], [], []]
        return [*_halves(digests), np.concatenate(uids), np.concatenate(starts), np.concatenate(alone)]

    return _mapped(base.select("uid", "text").join(open_, "uid").select("uid", "text", "spans"), fn,
                   "d1 long, d2 int, uid long, start int, alone boolean",
                   [("d1", pa.int64()), ("d2", pa.int32()), ("uid", pa.int64()), ("start", pa.int32()),
                    ("alone", pa.bool_())])


def covered(data: bytes, pos: list[int], not_: list[int]) -> np.ndarray:
    """Which bytes repeated windows cover: the windows of the samples at
    ``pos`` but for those starting at ``not_``."""
    n = len(data)
    at, lo, hi = samples(np.frombuffer(data, np.uint8))
    some = np.isin(at, pos)
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, lo[some], 1)
    np.add.at(edge, hi[some] + 1, -1)
    starts = np.cumsum(edge) > 0
    starts[not_] = False
    begin = np.flatnonzero(starts)
    edge[:] = 0
    np.add.at(edge, begin, 1)
    np.add.at(edge, np.minimum(begin + LENGTH, n), -1)
    return np.cumsum(edge[:n]) > 0


def _decided(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (columns after ``uid``: text first) with the
    positions of samples that repeat (pos) and the windows among them that do
    not (unlike); both null where nothing repeats."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the text is dealt out once, by row; all later joins meet it where it lies
    base = held(docs.repartition(parts, "uid"))
    names = _names(base)
    # written, so that the join meets plain exchanges and a hot name can be split
    again = saved(names.groupBy("name").agg(F.count("*").alias("k")).where("k > 1").select("name"), "sample-names")
    hits = saved(names.join(again, "name", "left_semi").groupBy("uid").agg(F.collect_list("pos").alias("pos")), "sample-hits")
    ctx = saved(_contexts(base, hits).groupBy("d1", "d2", "name")
                .agg(F.count("*").alias("k"), F.min(F.struct("uid", "lo", "hi")).alias("one")), "contexts")
    once = ctx.where("k = 1")
    others = ctx.where("k > 1").join(once.select("name"), "name", "left_semi")
    open_ = (once.select("one.*", F.lit(True).alias("alone"))
             .union(others.select("one.*", F.lit(False).alias("alone")))
             .groupBy("uid").agg(F.collect_list(F.struct("lo", "hi", "alone")).alias("spans")))
    unlike = (_prefixes(base, open_).groupBy("d1", "d2")
              .agg(F.count("*").alias("k"), F.min("uid").alias("uid"), F.min("start").alias("start"),
                   F.min("alone").alias("alone"))
              .where("k = 1 AND alone").groupBy("uid").agg(F.collect_list("start").alias("unlike")))
    return base.join(hits, "uid", "left").join(unlike, "uid", "left")


def repeats_removed(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, after removing every byte covered by a LENGTH-byte string
    that also starts anywhere else.

    A null text counts as empty; texts shorter than LENGTH bytes lose nothing;
    repeated rows are copies of each other; null ids stay null; extra columns
    are ignored; an empty table gives no rows."""
    prepare(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), docs["text"].cast("string").alias("text"),
                       docs["doc_id"].cast("long").alias("doc_id"))

    def fn(b):
        out = ([], [], [], [], [])
        for doc_id, data, pos, unlike in zip(b.column(0).to_pylist(), _bytes(b.column(1)), b.column(2).to_pylist(),
                                             b.column(3).to_pylist()):
            removed = spans = 0
            kept = data
            if pos:
                gone = covered(data, pos, unlike or [])
                removed = int(gone.sum())
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            for o, v in zip(out, (doc_id, len(data), removed, spans, hashlib.sha256(kept).hexdigest())):
                o.append(v)
        return out

    return _mapped(_decided(rows).select("doc_id", "text", "pos", "unlike"), fn,
                   "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                   [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept_sha256", pa.string())])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text`` (all columns kept;
    a character cut in two is dropped whole; a null text stays null).  Where a
    column n_chars of whole numbers exists, it gets the new length."""
    prepare(docs.sparkSession)
    cols = docs.columns
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), docs["text"].alias("text"),
                       F.struct(*[docs[c] for c in cols if c != "text"]).alias("rest"))

    def cut(batches):
        for b in batches:
            texts = b.column(0).to_pylist()
            pos, unlike = b.column(1).to_pylist(), b.column(2).to_pylist()
            for i, p in enumerate(pos):
                if p:
                    data = texts[i].encode()
                    gone = covered(data, p, unlike[i] or [])
                    texts[i] = np.frombuffer(data, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), b.column(3)], names=["text", "rest"])

    frame = _decided(rows).select("text", "pos", "unlike", "rest")
    got = frame.mapInArrow(lean(cut), frame.select("text", "rest").schema)
    kind = dict(docs.dtypes).get("n_chars")
    length = F.char_length("text").cast(kind) if kind in ("int", "bigint") else None
    return got.select(*[F.col("text") if c == "text" else
                        (F.coalesce(length, F.col("rest")[c]).alias(c) if c == "n_chars" and length is not None
                         else F.col("rest")[c].alias(c)) for c in cols])


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return repeats_removed(table(spark, sf_dir, "documents"))
