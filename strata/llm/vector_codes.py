"""Vector code compression: every vector is cut into equal parts, each part is
replaced by the number of the nearest entry of its position's codebook, and the
codebooks are fitted by Lloyd rounds in integers.

After a round most entries stand still.  A part whose assigned entry did not
move keeps its stored exact distance and is compared with the moved entries
only; a part whose entry moved is compared with all.  Both give the nearest
entry with ties to the lower index, exactly as a full scan would.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import discard, prepare, saved, table

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256.0
#: Integer components stop here, so that distances stay within 64 bits.
LIMIT = 1 << 24
_SIGN = 1 << 31  # packed components sort as unsigned big-endian words


def _unpack(column: pa.Array, parts: int) -> np.ndarray:
    """(rows, parts, width) integers of packed vectors of equal length."""
    flat = np.frombuffer(b"".join(column.to_pylist()), ">u4").astype(np.int64) - _SIGN
    return flat.reshape(len(column), parts, -1)


def _quantised(vectors: DataFrame, parts: int) -> DataFrame:
    """(vec_id, label, v): the rows whose vector is whole, finite and divisible
    into ``parts``, as packed integers floor(256 * x)."""
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].alias("label"),
                          vectors["embedding"].cast("array<double>").alias("v")).where("v is not null")
    schema = StructType([rows.schema["vec_id"], rows.schema["label"], *StructType.fromDDL("v binary")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            size = np.diff(np.asarray(lists.offsets))
            x = lists.flatten().to_numpy(zero_copy_only=False)  # a null component becomes NaN
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            at = np.concatenate([[0], np.cumsum(size)])
            good = (bad[at[1:]] == bad[at[:-1]]) & (size > 0) & (size % parts == 0)
            with np.errstate(over="ignore", invalid="ignore"):
                q = np.clip(np.floor(x * SCALE), -LIMIT, LIMIT)
            q = np.where(np.isfinite(q), q, 0).astype(np.int64)
            keep = np.flatnonzero(good)
            packed = [(q[at[i]:at[i + 1]] + _SIGN).astype(">u4").tobytes() for i in keep]
            kept = b.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(packed, pa.binary())],
                                             names=["vec_id", "label", "v"])

    return rows.mapInArrow(run, schema)


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, entries) of integer vectors."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)), 1)
    if 4 * top * top * x.shape[1] < 1 << 53:  # every term is an exact double
        a, c = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in entries], axis=1)


def assign(x: np.ndarray, books: np.ndarray, code: np.ndarray | None = None, dist: np.ndarray | None = None,
           moved: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and its distance for each part: ``x`` (rows, parts, width),
    ``books`` (parts, entries, width).  With the ``code`` and ``dist`` of the round
    before and the entries ``moved`` since, parts with a fixed entry look at moved
    entries only."""
    n, parts, _ = x.shape
    new_code, new_dist = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
    for p in range(parts):
        scan = np.arange(n) if code is None else np.flatnonzero(moved[p][code[:, p]])
        if len(scan):
            d = _distances(x[scan, p], books[p])
            new_code[scan, p] = d.argmin(1)
            new_dist[scan, p] = d.min(1)
        if code is None:
            continue
        rest = np.flatnonzero(~moved[p][code[:, p]])
        c, d0 = code[rest, p], dist[rest, p]
        active = np.flatnonzero(moved[p])
        if len(rest) and len(active):
            d = _distances(x[rest, p], books[p][active])
            best = active[d.argmin(1)]
            near = d.min(1)
            better = (near < d0) | ((near == d0) & (best < c))
            c, d0 = np.where(better, best, c), np.where(better, near, d0)
        new_code[rest, p], new_dist[rest, p] = c, d0
    return new_code, new_dist


def _assigned(state: DataFrame, books: np.ndarray, moved: np.ndarray | None, dim: int, last: bool) -> DataFrame:
    """One assignment pass over (vec_id, label, v[, code, dist])."""
    parts = books.shape[0]
    label = state.schema["label"]
    schema = StructType([StructField("vec_id", LongType()), label,
                         *StructType.fromDDL("code string, error long" if last else "v binary, code binary, dist binary")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _unpack(b.column(2), parts)
            code = dist = None
            if moved is not None:
                code = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
                dist = np.frombuffer(b"".join(b.column(4).to_pylist()), "<i8").reshape(-1, parts)
            code, dist = assign(x, books, code, dist, moved)
            out = [r.tobytes() for r in code.astype(np.uint8)]
            if last:
                cols = [pa.array([c.hex() for c in out], pa.string()), pa.array(dist.sum(1))]
            else:
                cols = [b.column(2), pa.array(out, pa.binary()), pa.array([r.tobytes() for r in dist.astype("<i8")], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=schema.names)

    return state.where(F.octet_length("v") == 4 * dim).mapInArrow(run, schema)


def _moved_books(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after an update: floor of the mean of the parts of an entry;
    each task adds its own up first, at most parts x entries rows."""
    parts, entries, width = books.shape
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width + 1), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = _unpack(b.column(0), parts)
            code = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
            slot = (code + np.arange(parts) * entries).ravel()
            x = x.reshape(-1, width)
            order = np.argsort(slot, kind="stable")
            slot, start = np.unique(slot[order], return_index=True)
            total[slot, 1:] += np.add.reduceat(x[order], start, axis=0)
            total[slot, 0] += np.diff(np.append(start, len(x)))
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[used, i]) for i in range(width + 1))],
                                         names=["slot", "n", *names])

    sums = (state.select("v", "code").mapInArrow(run, ", ".join(f"{c} long" for c in ["slot", "n", *names]))
            .groupBy("slot").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names)).collect())
    new = books.copy()
    for r in sums:  # at most parts x entries rows
        new[r.slot // entries, r.slot % entries] = [r[c] // r.n for c in names]
    return new


def codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The first codebooks (parts, entries, width) of packed rows."""
    seeds = kept.where("vec_id is not null").orderBy("vec_id", "v").select("v").limit(entries).collect()
    if not seeds:
        return np.zeros((parts, 0, 0), np.int64)
    dim = len(seeds[0].v)
    x = _unpack(pa.array([bytes(r.v) for r in seeds if len(r.v) == dim], pa.binary()), parts)
    return x.transpose(1, 0, 2).copy()


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes of ``vectors`` (vec_id, embedding, label): vec_id, code (two hex
    digits per part), error (squared distances in integers, summed over parts),
    label_error (errors of all rows of equal label; nulls are one label),
    codebooks_sha256 (of the entries' components in decimal).

    Dropped: rows whose vector is null, empty, holds a null or non-finite
    component, is not divisible into ``parts``, or differs in length from the
    row of the smallest vec_id kept.  Components beyond +-65,536 saturate there.
    Rows without a vec_id are coded but never start an entry; if no row has one,
    nothing can be coded and there are no rows.  Rows that share a vec_id start
    entries in the order of their components; fewer than ``entries`` rows give as
    many entries.  Repeated rows are coded alike, each counted.  Extra columns
    are ignored; an empty table gives no rows.  ``entries`` is at most 256."""
    spark = vectors.sparkSession
    prepare(spark)
    state = saved(_quantised(vectors, parts), "codes-vectors")
    books, moved = codebooks(state, parts, entries), None
    dim = books.shape[0] * books.shape[2]
    if not books.size:
        state = state.where(F.lit(False))
    for _ in range(rounds if books.size else 0):
        before, state = state, saved(_assigned(state, books, moved, dim, False), "codes-state")
        discard(before)
        new = _moved_books(state, books)
        moved, books = (new != books).any(2), new
    if books.size:
        before, state = state, saved(_assigned(state, books, moved, dim, True), "codes")
        discard(before)
    else:
        state = state.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    whole = state.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long").alias("label_error"))
    one = whole.withColumnRenamed("label", "of_label")
    return (state.join(one, F.col("label").eqNullSafe(F.col("of_label")), "left")
            .select("vec_id", "code", "error", "label_error", F.lit(digest).cast(StringType()).alias("codebooks_sha256")))


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _rounds_sql(rounds: int) -> str:
    step = []
    for r in range(rounds + 1):
        step.append(f"""near{r} as (
  select vec_id, label, part, vals, min(d * {ENTRIES} + entry) % {ENTRIES} as entry, min(d * {ENTRIES} + entry) // {ENTRIES} as d
  from (select p.vec_id, p.label, p.part, p.vals, b.entry,
               list_sum(list_transform(list_zip(p.vals, b.vals), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
        from parts p join book{r} b on p.part = b.part) group by all)""")
        if r < rounds:
            step.append(f"""mean{r} as (
  select part, entry, list(m order by pos) as vals
  from (select part, entry, pos, cast(floor(sum(vals[pos])::double / count(*)) as bigint) as m
        from near{r}, (select unnest(range(1, 513)) as pos) where pos <= len(vals) group by all) group by all),
book{r + 1} as (
  select b.part, b.entry, coalesce(m.vals, b.vals) as vals from book{r} b left join mean{r} m on b.part = m.part and b.entry = m.entry)""")
    return ",\n".join(step)


#: Plain Lloyd: every part against every entry in each round (vec_id unique).
ORACLE_SQL = f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as v
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (
  select vec_id, label, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] as vals
  from kept, (select unnest(range({PARTS})) as part)),
book0 as (
  select part, vals, entry from (select part, vals, row_number() over (partition by part order by vec_id) - 1 as entry from parts)
  where entry < {ENTRIES}),
{_rounds_sql(ROUNDS)},
whole as (
  select vec_id, label, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error
  from near{ROUNDS} group by vec_id, label),
digest as (
  select sha256(string_agg(array_to_string(vals, ','), ',' order by part, entry)) as h from book{ROUNDS})
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, h as codebooks_sha256
from whole, digest
"""
