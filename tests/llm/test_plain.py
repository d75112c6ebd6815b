"""Operators that SQL does not express, against plain loops over the same rows:
sharding's tree, the misspelling lexicon, backoff language scores, base counts of
the language model; and very long texts."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import common, decontaminate, katz, langid, pivots, sharding, suffix_dedup, toxicity

DOCS = "doc_id long, text string, lang string, source string"


# ---- sharding --------------------------------------------------------------

def _plain_tree(rows, dims, first, shards, width, out):
    """``rows``: (coordinates, tie, size, row number); out: row number -> shard."""
    if shards == 1 or not rows:
        out.update({r[3]: first for r in rows})
        return
    span = [(max(r[0][i] for r in rows) - min(r[0][i] for r in rows)) / width[i] for i in range(dims)]
    dim = span.index(max(span))
    rows = sorted(rows, key=lambda r: (r[0][dim], r[1]))
    left = shards // 2
    target, below = sum(r[2] for r in rows) * left / shards, 0
    for cut, r in enumerate(rows):
        if below + r[2] >= target:  # the row at the median goes to the nearer side
            cut += 0 if target - below < below + r[2] - target else 1
            break
        below += r[2]
    _plain_tree(rows[:cut], dims, first, left, width, out)
    _plain_tree(rows[cut:], dims, first + left, shards - left, width, out)


@pytest.mark.parametrize("n_shards", [2, 5, 16])
def test_shards_equal_a_plain_tree(spark, tmp_path, n_shards):
    rng = random.Random(n_shards)
    rows = [(rng.choice([None, i, i]), rng.choice([None, "", "x" * rng.randint(1, 40), "é" * int(rng.expovariate(0.002))]),
             rng.choice(["en", "fr", None]), rng.choice("aaaab")) for i in range(400)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    dims = sharding.default_dims(docs)
    meta = sharding._metadata(docs, dims).withColumn("tie", F.pmod(F.xxhash64("row"), F.lit(2**31))).collect()
    plain = [([r[f"d{i}"] for i in range(len(dims))], r.tie, r.size, r.row) for r in meta]
    width = [max(1, max(p[0][i] for p in plain) - min(p[0][i] for p in plain)) for i in range(len(dims))]
    shard: dict = {}
    _plain_tree(plain, len(dims), 0, n_shards, width, shard)
    want = Counter((r.doc_id, r.size, r.text_crc32, shard[r.row]) for r in meta)
    got = sharding.kd_shards(docs, n_shards).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in got) == want
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


# ---- embedding near-duplicates ---------------------------------------------

def _vectors(spark, seed, n, dim, planted):
    """``n`` Gaussian vectors, and ``planted`` partners of the first at cosines of 0.93 to 0.94."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((planted, dim))
    y -= (y * x[:planted]).sum(axis=1, keepdims=True) * x[:planted]
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = rng.uniform(0.931, 0.94, (planted, 1))
    x = np.concatenate([x, c * x[:planted] + np.sqrt(1 - c * c) * y])
    rows = [(i, v.tolist(), i % n % 2) for i, v in enumerate(x)]
    links = (x @ x.T >= pivots.COSINE) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows]))
    np.fill_diagonal(links, False)
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), links.sum(axis=1)


@pytest.mark.parametrize("n_pivots", [64, 1024])
def test_recall_does_not_fall_with_more_pivots(spark, n_pivots):
    df, links = _vectors(spark, 1, 1500, 48, 600)
    got = {r.vec_id: r.n_links for r in pivots.near_embeddings(df, n_pivots=n_pivots).collect()}
    assert all(got[i] <= k for i, k in enumerate(links.tolist()))  # none below the cosine
    assert sum(got.values()) >= 0.97 * links.sum()


def test_lists_split_by_further_pivots_lose_no_link(spark, monkeypatch):
    df, _ = _vectors(spark, 2, 300, 12, 120)
    want = sorted(pivots.near_embeddings(df).collect())
    for block in (2, 16):
        monkeypatch.setattr(pivots, "BLOCK", block)
        assert sorted(pivots.near_embeddings(df).collect()) == want


def test_search_without_pivots_is_exact(spark, monkeypatch):
    df, links = _vectors(spark, 3, 300, 12, 120)
    monkeypatch.setattr(pivots, "BLOCK", 50)
    got = {r.vec_id: r.n_links for r in pivots.near_embeddings(df, n_pivots=0).collect()}
    assert [got[i] for i in range(len(links))] == links.tolist()


# ---- toxicity --------------------------------------------------------------

def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i:] == b[i + 1:] or a[i + 1:] == b[i:]


def test_misspellings_equal_plain_edit_distance():
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcé") for _ in range(n))
    terms = sorted({word(rng.randint(3, 9)) for _ in range(60)} | {word(90)})
    stems = sorted({word(5) for _ in range(4)})
    lexicon = toxicity.Lexicon(terms, stems)
    tried = [word(rng.randint(1, 10)) for _ in range(3000)]
    for t in terms:
        for _ in range(12):
            i = rng.randint(0, len(t))
            tried += [t[:i] + word(1) + t[i:], t[:i] + t[i + 1:], t[:i] + word(1) + t[i + 1:], t]
    for w in tried:
        exact = w in terms or any(w.startswith(s) for s in stems)
        fuzzy = any(len(t) >= toxicity.FUZZY_FROM and _one_edit(w, t) for t in terms)
        assert lexicon.match(w) == (1 if exact else 2 if fuzzy else 0), w


# ---- language ID -----------------------------------------------------------

def test_language_scores_equal_plain_backoff(spark):
    rng = random.Random(8)
    parts = {"de": ["sch", "ung", "ein", "zu"], "en": ["th", "ing", "ly", "on"], "fr": ["eau", "que", "é"]}
    rows = [(i, " ".join("".join(rng.choice(parts[k]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, 30))), k, "s")
            for i, k in enumerate(rng.choices(list(parts), k=120))]
    model = langid.fit(spark.createDataFrame(rows, DOCS))
    langs = sorted({r[2] for r in rows})
    seen: dict = {size: {k: Counter() for k in langs} for size in range(5)}
    for _, text, lang, _ in rows:
        for w in langid.words_of(text):
            seen[0][lang][w] += 1
            for size in range(1, 5):
                m = f"^{w}$"
                seen[size][lang].update(m[i:i + size] for i in range(len(m) - size + 1))
    known = {size: {x for k in langs for x in by[k] if sum(by[j][x] for j in langs) >= langid.MIN_SEEN} for size, by in seen.items()}
    whole = {size: {k: sum(by[k][x] for x in known[size]) + 0.5 * len(known[size]) for k in langs} for size, by in seen.items()}
    log = lambda size, k, x: math.log((seen[size][k][x] + 0.5) / whole[size][k])

    def plain(w, k):
        if w in known[0]:
            return log(0, k, w)
        m, total, n = f"^{w}$", 0.0, 0
        for i in range(max(1, len(m) - 3)):
            size = next((s for s in (4, 3, 2, 1) if m[i:i + s] in known[s]), None)
            total, n = total + (log(size, k, m[i:i + size]) if size else math.log(1e-6)), n + 1
        return total / n

    texts = [r[1] for r in rows] + ["schthing quzzing zz", "éé", "x", "einung q", "thon", ""]
    for text, (lang, score) in zip(texts, model.predict(texts)):
        ws = langid.words_of(text)
        if not ws:
            assert (lang, score) == ("und", 0.0)
            continue
        total = {k: sum(plain(w, k) for w in ws) for k in langs}
        best = max(total.values())
        p = {k: math.exp(v - best) for k, v in total.items()}
        assert math.isclose(score, max(p.values()) / sum(p.values()), rel_tol=1e-9)
        assert math.isclose(total[lang], best, rel_tol=1e-12)


# ---- language model --------------------------------------------------------

def test_base_counts_equal_plain_loops(spark, tmp_path):
    rng = random.Random(3)
    vocab = ["a", "B", "b", "é", "É", "x-y", "12"]
    rows = [(rng.choice([None, i, i, i]), rng.choice([None, "", rng.choice(" \t\n").join(rng.choice(vocab) for _ in range(rng.randint(1, 50)))]),
             None, None) for i in range(150)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "d"))

    def tokens(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [w for w in low.replace("\t", " ").replace("\n", " ").split(" ") if w] + [None]

    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(t for i, text, *_ in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, held(i), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), n,
                    round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens(t)), 6)) for i, t, *_ in rows)
    got = katz.katz_scores(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want


# ---- very long texts -------------------------------------------------------

def test_word_hashes_do_not_depend_on_the_piece(monkeypatch):
    rng = random.Random(1)
    text = " ".join("w" * rng.choice([1, 3, 70, 400]) + str(rng.randint(0, 99)) for _ in range(300))
    a = np.frombuffer(text.encode(), np.uint8)
    whole = common.word_hashes(a, *common.words(a))
    monkeypatch.setattr(common, "PIECE_BYTES", 64)  # words longer than a piece, too
    assert (common.word_hashes(a, *common.words(a)) == whole).all()
    alone = [common.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0] for w in text.split()]
    assert (np.array(alone) == whole).all()


def test_a_very_long_text_is_searched_in_bounded_memory():
    item = " ".join(f"item{i}" for i in range(40))
    text = "filler text of no interest " * 400_000  # 11 MB
    text = text[:5_000_000] + " " + item + " " + text[5_000_000:]
    index = decontaminate.Index([(1, item)])
    index.search(["warm up"])
    tracemalloc.start()
    found = index.search([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [[(0, 36)]]
    assert peak < 25 * len(text)


def test_a_very_long_text_is_deduplicated(spark, tmp_path):
    rng = random.Random(2)
    block = "".join(rng.choice("abcdefgh ") for _ in range(300))
    noise = lambda n: "".join(rng.choices("ijklmnop ", k=n))
    rows = [(1, noise(2_000_000) + block + noise(500_000), None, None), (2, block, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r.n_removed for r in suffix_dedup.repeats_removed(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got == {1: 300, 2: 300}
