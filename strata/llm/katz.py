"""Katz backoff language model (bigram, unigram, unknown) over a corpus.

Counts are Good-Turing discounted up to 5; the mass taken from a context's
followers is spread over all other words by exactly normalised backoff
weights.  Unigrams: every training word has an estimate of its own, the unknown
word has the mass taken by discounting.

The bigram occurrences are dealt to partitions by their context (contexts that
would crowd a partition: by the whole bigram) as packed, sorted arrays; these
partitions are the model's tables.  The counts of the most frequent words are
broadcast; those of the other words of a partition are joined from the table of
all counts and lie beside it.  Counting, backoff weights and the scores of all
documents are taken from the partitions where they lie; only the broadcast head,
count-of-count sums and the crowded contexts' sums, all bounded, pass through
the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, lower_bytes, mix64, prepare, saved, table, word_hashes, words

#: Words (most frequent first) whose counts are broadcast; the others' are joined.
HEAD = 500_000
#: Largest count that is discounted.
DISCOUNTED = 5
#: Tokens gathered in a task before they are packed or counted.
GATHER = 1_000_000

_END, _START = np.uint64(0x1F0E3D4C5B6A7988), np.uint64(0x2F0E3D4C5B6A7988)
_RARE = np.uint64(1 << 63)


def _tokens(texts: list):
    """Per piece of texts: (first, tokens, the token before each, text of each);
    every text ends with the end token and starts after the start mark."""
    for first, last, a, off in lower_bytes(texts):
        starts, ends = words(a)
        lim = np.searchsorted(starts, off)
        n = np.diff(lim)
        tok = np.full(int(n.sum()) + len(n), _END, np.uint64)
        tok[np.arange(lim[-1]) + np.repeat(np.arange(len(n)), n)] = word_hashes(a, starts, ends) >> np.uint64(1)
        before = np.empty_like(tok)
        before[1:] = tok[:-1]
        before[lim[:-1] + np.arange(len(n))] = _START
        yield first, tok, before, np.repeat(np.arange(len(n)), n + 1)


def _counts(docs: DataFrame) -> DataFrame:
    """(w, c): the training count of every token."""
    out = pa.schema([("w", pa.int64()), ("c", pa.int64())])

    def flush(parts):
        w, c = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c, pa.int64())], schema=out)

    def run(batches):
        parts, size = [], 0
        for b in batches:
            for _, tok, _, _ in _tokens(b.column(0).to_pylist()):
                parts.append(tok)
                size += len(tok)
            if size > GATHER:
                yield flush(parts)
                parts, size = [], 0
        if parts:
            yield flush(parts)

    return (docs.where("NOT held_out").select("text").mapInArrow(run, "w long, c long")
            .groupBy("w").agg(F.sum("c").alias("c")))


def discounts(n: list[int]) -> list[float]:
    """d[r] for counts r = 0..DISCOUNTED from the numbers n[r] of items seen r
    times (r up to DISCOUNTED + 1); where Good-Turing gives no value between 0
    and 1 - too few items - half a count is taken off."""
    k, d = DISCOUNTED, [1.0]
    for r in range(1, k + 1):
        v = -1.0
        if n[1] and n[r]:
            cut = (k + 1) * n[k + 1] / n[1]
            if cut < 1:
                v = ((r + 1) * n[r + 1] / n[r] / r - cut) / (1 - cut)
        d.append(v if 0 < v < 1 else (r - 0.5) / r)
    return d


class Unigrams:
    """The unigram estimates, and the head of the table of counts by word;
    broadcast to the tasks."""

    def __init__(self, w: np.ndarray, c: np.ndarray, total: int, n: list[int]):
        order = np.argsort(w)
        self.w, self.c, self.total, self.d = w[order], c[order], max(1, total), np.array(discounts(n))
        taken = sum((1 - self.d[r]) * r * n[r] for r in range(1, DISCOUNTED + 1))
        rest, least, self.scale = taken / total if total else 1.0, 1 / (total + 2), 1.0
        if rest < least:  # nothing discounted: keep mass for the unknown word
            self.scale, rest = (1 - least) / (1 - rest), least
        self.unknown = rest

    def p(self, c: np.ndarray) -> np.ndarray:
        """Estimate of words seen ``c`` times; 0: the unknown word."""
        return np.where(c > 0, self.d[np.where(c <= DISCOUNTED, c, 0)] * c * self.scale / self.total, self.unknown)

    def ids(self, tok: np.ndarray) -> np.ndarray:
        """Place in the head, or the word itself with the top bit set."""
        if not len(self.w):
            return tok | _RARE
        at = np.minimum(np.searchsorted(self.w, tok), len(self.w) - 1)
        return np.where(self.w[at] == tok, at.astype(np.uint64), tok | _RARE)

    def counts(self, ids: np.ndarray, w: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Training counts: in the head, or of the words ``w`` (sorted) given."""
        rare, out = ids >= _RARE, np.zeros(len(ids), np.int64)
        out[~rare] = self.c[ids[~rare].astype(np.int64)]
        if len(w) and rare.any():
            tok = ids[rare] ^ _RARE
            at = np.minimum(np.searchsorted(w, tok), len(w) - 1)
            out[rare] = np.where(w[at] == tok, c[at], 0)
        return out


def _pack(h: np.ndarray, w: np.ndarray, doc: np.ndarray) -> bytes:
    """Sorted bigrams with the text of each, byte by byte of the numbers."""
    cols = [np.diff(h, prepend=np.uint64(0)), w, doc.astype(np.uint32)]
    raw = b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() for x in cols)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(data: bytes, n: int):
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    h = raw[:8 * n].reshape(8, n).T.copy().view(np.uint64).ravel()
    w = raw[8 * n:16 * n].reshape(8, n).T.copy().view(np.uint64).ravel()
    doc = raw[16 * n:].reshape(4, n).T.copy().view(np.uint32).ravel()
    return np.cumsum(h, dtype=np.uint64), w, doc


_BLOCK = ("part int, n long, uids binary, train binary, data binary",
          pa.schema([("part", pa.int32()), ("n", pa.int64()), ("uids", pa.binary()), ("train", pa.binary()),
                     ("data", pa.binary())]))


def _dealt(docs: DataFrame, shared, parts: int) -> DataFrame:
    """Packed bigrams, by partition of the model."""

    def flush(got, uids, train):
        uni, crowded = shared.value
        h, w, doc = (np.concatenate(x) for x in zip(*got))
        h, w = uni.ids(h), uni.ids(w)
        key = np.where(np.isin(h, crowded), h ^ mix64(w), h)
        part = (mix64(key + np.uint64(7)) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((w, h, part))
        part = part[order]
        cut = np.flatnonzero(np.diff(part, prepend=-1, append=parts))
        rows = [[], [], [], [], []]
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
            o = order[i:j]
            mine, place = np.unique(doc[o], return_inverse=True)
            for r, v in zip(rows, (int(part[i]), j - i, uids[mine].tobytes(), train[mine].tobytes(), _pack(h[o], w[o], place))):
                r.append(v)
        return pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, _BLOCK[1])], schema=_BLOCK[1])

    def run(batches):
        got, uids, train, docs_, size = [], [], [], 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            uids.append(b.column(0).to_numpy())
            train.append(~b.column(1).to_numpy(zero_copy_only=False))
            for first, tok, before, doc in _tokens(b.column(2).to_pylist()):
                got.append((before, tok, doc + (docs_ + first)))
                size += len(tok)
            docs_ += b.num_rows
            if size > GATHER:
                yield flush(got, np.concatenate(uids), np.concatenate(train))
                got, uids, train, docs_, size = [], [], [], 0, 0
        if size:
            yield flush(got, np.concatenate(uids), np.concatenate(train))

    return docs.select("uid", "held_out", "text").mapInArrow(run, _BLOCK[0])


def _rare_words(batches):
    """(part, w): the words outside the head in each partition of the model."""
    out = pa.schema([("part", pa.int32()), ("w", pa.int64())])

    def flush(part, words_):
        w = np.unique(np.concatenate(words_))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(w), part, np.int32)), pa.array(w.view(np.int64))], schema=out)

    got, part = [], None
    for b in batches:  # sorted by partition
        for p, n, data in zip(*(b.column(i).to_pylist() for i in (0, 1, 4))):
            if got and p != part:
                yield flush(part, got)
                got = []
            part, w = p, _unpack(data, n)[1]
            got.append(np.unique(w[w >= _RARE]) ^ _RARE)
    if got:
        yield flush(part, got)


def _built(blocks: pa.Table):
    """A partition of the model: bigrams (h, w), sorted, with their training
    counts; for each occurrence its bigram and text; the texts' numbers."""
    h, w, uid, train = [], [], [], []
    for n, uids, trains, data in zip(*(blocks.column(x) for x in ("n", "uids", "train", "data"))):
        a, b, doc = _unpack(data.as_buffer(), n.as_py())
        h.append(a)
        w.append(b)
        uid.append(np.frombuffer(uids.as_buffer(), np.int64)[doc])
        train.append(np.frombuffer(trains.as_buffer(), bool)[doc])
    h, w, uid, train = (np.concatenate(x) for x in (h, w, uid, train))
    order = np.lexsort((w, h))
    h, w, uid, train = h[order], w[order], uid[order], train[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
    of = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return h[first], w[first], np.add.reduceat(train.astype(np.int64), first), of, uid


def _word_counts(w, known: pa.Table, uni: Unigrams):
    """The words' own training counts, from the head and the table beside."""
    rare, c = known["w"].to_numpy().view(np.uint64), known["c"].to_numpy()
    order = np.argsort(rare)
    return uni.counts(w, rare[order], c[order])


def _context_sums(h, c, p):
    """Per context: (context, its count, numbers of followers seen 1..5 times,
    unigram mass of the seen followers, start of its bigrams)."""
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    by_count = [np.add.reduceat((c == r).astype(np.int64), first) for r in range(1, DISCOUNTED + 1)]
    return h[first], np.add.reduceat(c, first), by_count, np.add.reduceat(np.where(c > 0, p, 0.0), first), first


def _weights(total, by_count, mass, d):
    """Backoff weight of contexts and the factor on their seen followers."""
    with np.errstate(divide="ignore", invalid="ignore"):
        taken = sum((1 - d[r]) * r * by_count[r - 1] for r in range(1, DISCOUNTED + 1)) / total
        least = 1 / (total + 1.0)
        factor = np.where(taken < least, (1 - least) / (1 - taken), 1.0)
        left = np.where(taken < least, least, taken)
        alpha = np.where(total > 0, left / np.maximum(1 - mass, 1e-12), 1.0)
    return alpha, factor


def katz_scores(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out (crc32(doc_id as text) mod
    5 is 1), n_tokens, n_known, train_tokens, base_score and score (log10
    probability of the text).

    Held-out rows teach nothing; null ids are not held out.  A null text is
    empty: only the end token.  Repeated rows all count.  With no training row
    every token is the unknown word.  Extra columns are ignored."""
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    parts = max(2, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), docs["doc_id"].cast("long").alias("doc_id"),
                       (crc_mod(docs["doc_id"], 5) == 1).alias("held_out"), docs["text"].cast("string").alias("text"))
    counts = saved(_counts(rows), "katz-unigrams")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("N"), F.count("*").alias("V"),
                      *[F.count(F.when(F.col("c") == r, 1)).alias(f"n{r}") for r in range(1, DISCOUNTED + 2)]).first()
    top = counts.orderBy(F.desc("c"), "w").limit(head).toArrow()  # at most ``head`` rows
    uni = Unigrams(top["w"].to_numpy().view(np.uint64), top["c"].to_numpy(), sums.N,
                   [0, *[sums[f"n{r}"] for r in range(1, DISCOUNTED + 2)]])
    # contexts with more than a quarter of a partition's share; the start mark too
    crowded = np.unique(np.append(uni.ids(uni.w[uni.c * 4 * parts > max(1, sums.N)]), uni.ids(np.array([_START, _END]))))
    shared = spark.sparkContext.broadcast((uni, crowded))
    unit = sums.N + 0.5 * (sums.V + 1)

    # words: the head's in place, the others with their partition of the model
    wide = pa.schema([("uid", pa.int64()), ("k", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("low", pa.float64())])

    def by_word(batches):
        u = shared.value[0]
        log, table_ = np.log10(u.p(u.c)), np.log10((u.c + 0.5) / unit)
        for b in batches:
            uids, out = b.column(0).to_numpy(), [[] for _ in wide]
            for first, tok, _, doc in _tokens(b.column(1).to_pylist()):
                ids = u.ids(tok)
                inside, size = ids < _RARE, int(doc[-1]) + 1
                at, of = ids[inside].astype(np.int64), doc[inside]
                for o, v in zip(out, (uids[first:first + size], np.bincount(doc, minlength=size), np.bincount(of, minlength=size),
                                      np.bincount(of, table_[at], size), np.bincount(of, log[at], size))):
                    o.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o), f.type) for o, f in zip(out, wide)], schema=wide)

    worded = rows.select("uid", "text").mapInArrow(by_word, "uid long, k long, known long, base double, low double")

    dealt = _dealt(rows, shared, parts).repartition(parts, "part").sortWithinPartitions("part").persist(StorageLevel.MEMORY_AND_DISK)
    beside = (dealt.mapInArrow(_rare_words, "part int, w long").join(counts, "w").select("part", "w", "c")
              .repartition(parts, "part").sortWithinPartitions("part").persist(StorageLevel.DISK_ONLY))
    model = dealt.groupBy("part").cogroup(beside.groupBy("part"))  # both lie by partition already
    stat = pa.schema([("h", pa.int64()), ("total", pa.int64()), *[(f"n{r}", pa.int64()) for r in range(1, DISCOUNTED + 2)],
                      ("mass", pa.float64())])

    def measure(blocks, known):
        u, crowded = shared.value
        h, w, c, _, _ = _built(blocks)
        ctx, total, by_count, mass, _ = _context_sums(h, c, u.p(_word_counts(w, known, u)))
        hot = np.isin(ctx, crowded)
        every = [np.array([-1]), np.array([0]), *[np.array([(c == r).sum()]) for r in range(1, DISCOUNTED + 2)], np.array([0.0])]
        zero = np.zeros(int(hot.sum()), np.int64)
        some = [ctx[hot].view(np.int64), total[hot], *[x[hot] for x in by_count], zero, mass[hot]]
        return pa.Table.from_arrays([pa.array(np.concatenate(x), f.type) for x, f in zip(zip(every, some), stat)], schema=stat)

    names = [f.name for f in stat]
    measured = (model.applyInArrow(measure, ", ".join(f"{f.name} {'double' if f.name == 'mass' else 'long'}" for f in stat))
                .groupBy("h").agg(*[F.sum(x).alias(x) for x in names[1:]]).collect())  # one row per crowded context
    every = next((r for r in measured if r.h == -1), None)
    d = discounts([0, *[every[f"n{r}"] if every else 0 for r in range(1, DISCOUNTED + 2)]])
    hot = sorted((r for r in measured if r.h != -1), key=lambda r: r.h & (2**64 - 1))
    hot_h = np.array([r.h for r in hot], np.int64).view(np.uint64)
    hot_total = np.array([r.total for r in hot], np.int64)
    hot_alpha, hot_factor = _weights(hot_total, [np.array([r[f"n{i}"] for r in hot]) for i in range(1, DISCOUNTED + 1)],
                                     np.array([r.mass for r in hot], float), d)
    scored = pa.schema([("bucket", pa.int32()), *[(x, pa.binary()) for x in ("uids", "known", "base", "sums")]])

    def score(blocks, beside_):
        """What bigrams and backoff weights add to the score of the head's
        words, and all of the other words."""
        u, _ = shared.value
        disc = np.array(d)
        h, w, c, of, uid = _built(blocks)
        own = _word_counts(w, beside_, u)
        p, rare = u.p(own), w >= _RARE
        ctx, total, by_count, mass, first = _context_sums(h, c, p)
        alpha, factor = _weights(total, by_count, mass, d)
        if len(hot_h):
            at = np.minimum(np.searchsorted(hot_h, ctx), len(hot_h) - 1)
            is_hot = hot_h[at] == ctx
            total, alpha, factor = (np.where(is_hot, x[at], y) for x, y in (
                (hot_total, total), (hot_alpha, alpha), (hot_factor, factor)))
        spread = np.diff(np.append(first, len(h)))
        total, alpha, factor = (np.repeat(x, spread) for x in (total, alpha, factor))
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.log10(disc[np.where(c <= DISCOUNTED, c, 0)] * c * factor / total)
            add = np.where(c > 0, seen, np.log10(alpha) + np.log10(p)) - np.where(rare, 0.0, np.log10(p))
        base = np.where(rare, np.log10((own + 0.5) / unit), 0.0)
        texts, place = np.unique(uid, return_inverse=True)
        sums = (np.bincount(place, (rare & (own > 0))[of]).astype(np.int32), np.bincount(place, base[of]), np.bincount(place, add[of]))
        bucket = (mix64(texts.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=parts))
        pieces = [order[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())]
        return pa.Table.from_arrays([pa.array([int(bucket[o[0]]) for o in pieces], pa.int32()),
                                     *[pa.array([x[o].tobytes() for o in pieces], pa.binary()) for x in (texts, *sums)]], schema=scored)

    def gather(batches):
        """One row per text from the packed sums of the model's partitions."""
        got = [[], [], [], []]
        for b in batches:
            for i, (x, kind) in enumerate(zip(got, (np.int64, np.int32, np.float64, np.float64))):
                x += [np.frombuffer(y, kind) for y in b.column(i + 1).to_pylist()]
        if got[0]:
            uid, *sums = (np.concatenate(x) for x in got)
            texts, place = np.unique(uid, return_inverse=True)
            known, base, low = (np.bincount(place, x) for x in sums)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(
                (texts, np.zeros(len(texts), np.int64), known.astype(np.int64), base, low), wide)], schema=wide)

    grams = (model.applyInArrow(score, "bucket int, uids binary, known binary, base binary, sums binary")
             .repartition(parts, "bucket").mapInArrow(gather, "uid long, k long, known long, base double, low double"))
    total = worded.union(grams).groupBy("uid").agg(
        F.sum("k").alias("n_tokens"), F.sum("known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("low").alias("score"))
    return rows.select("uid", "doc_id", "held_out").join(total, "uid").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(sums.N).cast("long").alias("train_tokens"), "base_score", "score")


def op5_katz(spark, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"))
