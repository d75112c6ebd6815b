"""The training-data operators against brute force, on rows with nulls, empty
and long texts, ties, repeated rows, an empty table and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import (bpe, bpe_codec, decontaminate, katz, langid, pivots, sharding, simhash, suffix_dedup,
                        token_counts, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, uid long, fp string, shard int"


def _text(rng, n, vocab):
    return " ".join(rng.choice(vocab) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    en = ["the", "of", "thonre", "and", "idiot", "wher", "l'le", "it's", "tion.", "A1"]
    fr = ["le", "été", "que", "ça", "ouauxch", "lech", "tréau", "don't", "日本"]
    passage = _text(rng, 60, en)
    texts = [_text(rng, rng.randint(1, 200), en if i % 2 else fr) for i in range(40)]
    texts += [texts[0]] * 3 + [texts[1] + " x", None, None, "", "  \n\t", "1234 !!", "a" * 3000, "ab" * 700]
    texts += [t + "\n" + passage + "\n" + t[:50] for t in texts[2:8]] + [_text(rng, 4000, en)]
    out = [(i, t, "en" if i % 2 else "fr", "s", len(t or ""), 1, 2, "x", 3) for i, t in enumerate(texts)]
    return out + [out[3], out[3], (None, texts[4], None, None, None, None, None, None, None), (None,) * 9]


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def _rows(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def _library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_counts_and_codec_match_the_library(docs, rows):
    lib = _library()
    ids = [lib.encode(r[1] or "", add_special_tokens=False).ids for r in rows]
    assert _rows(token_counts.token_counts(docs), "doc_id", "n_tokens", "over_limit") == Counter(
        (r[0], len(x), len(x) > 1024) for r, x in zip(rows, ids))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert _rows(bpe_codec.round_trip(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == Counter(
        (r[0], len(x), sha(",".join(map(str, x))), sha(lib.decode(x, skip_special_tokens=False))) for r, x in zip(rows, ids))


def test_codec_repairs_joins_with_tiny_chunks(monkeypatch):
    monkeypatch.setattr(bpe_codec, "MIN_CHUNK", 4)
    monkeypatch.setattr(bpe_codec, "CUT_BITS", 2)
    lib, codec, rng = _library(), bpe_codec.Codec(bpe.default_path()), random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "'s", "'ll", "l", "é", "日本", "12", "!", "\x1c", "\x85", "<|endoftext|>", "😀", "the "]
    for _ in range(400):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 90)))
        assert codec.encode(s) == lib.encode(s, add_special_tokens=False).ids


def test_codec_merges_short_words_by_list_as_the_heap_does():
    voc, rng = bpe.vocabulary(bpe.default_path()), random.Random(5)
    for letters in (b"a", b"ab", b"the inogra", b"0123456789", "é日本 ".encode(), bytes(range(256))):
        for n in [*range(bpe._SHORT + 3)] * 8:
            word = bytes(rng.choice(letters) for _ in range(n))
            assert voc.symbols(word) == voc.merge(word)[0]


def test_codec_merges_words_in_use_once_while_its_table_fills(monkeypatch):
    monkeypatch.setattr(bpe_codec, "WORDS", 200)
    lib, codec = _library(), bpe_codec.Codec(bpe.default_path())
    merged, make = Counter(), codec.voc.symbols
    monkeypatch.setattr(codec.voc, "symbols", lambda data: merged.update([data]) or make(data))
    common = "".join(f" common{i}" for i in range(20))
    for i in range(60):  # 40 new words a text, 2,400 in all
        text = common + "".join(f" rare{chr(97 + i % 26)}{chr(97 + i // 26)}{'x' * k}" for k in range(40))
        assert codec.encode(text) == lib.encode(text, add_special_tokens=False).ids
    assert len(merged) > 2_400 and max(merged.values()) == 1
    assert len(codec.word.__self__) + len(codec.word.__self__.older) <= 200


def test_sharding_fills_shards_evenly(docs, rows):
    got = sharding.kd_shards(docs, 4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    same = docs.sparkSession.createDataFrame([(i, "x" * 9, "en", "s") for i in range(1000)] + [(7, "x" * 9, "en", "s")] * 600,
                                             "doc_id long, text string, lang string, source string")
    size = Counter(r.shard for r in sharding.kd_shards(same).collect())
    assert len(size) == 16 and max(size.values()) - min(size.values()) <= 4


def test_suffix_dedup_is_exact(docs, rows):
    data = [(r[1] or "").encode() for r in rows]
    count = Counter(b[i:i + 200] for b in data for i in range(len(b) - 199))
    want = Counter()
    for r, b in zip(rows, data):
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i + 1:i + 201] = True
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        want[r[0], len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()] += 1
    assert _rows(suffix_dedup.repeats_removed(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_simhash_groups(docs, rows):
    fps = [simhash.fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    least = {g: min((r[0] for r, x in zip(rows, root) if x == g and r[0] is not None), default=None) for g in set(root)}
    assert _rows(simhash.simhash_groups(docs), "doc_id", "fingerprint", "component_id") == Counter(
        (r[0], f"{f & (2**64 - 1):016x}", least[g]) for r, f, g in zip(rows, fps, root))
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))


def test_bk_tree_arrays_agree_with_the_walk():
    rng = np.random.default_rng(0)
    v = np.unique(np.concatenate([rng.integers(0, 2**63, 200, dtype=np.uint64),
                                  np.uint64(5) ^ (np.uint64(1) << rng.integers(0, 63, 300, dtype=np.uint64))]))
    tree = simhash.BKTree(v.tolist())
    pairs = {(int(a), int(b)) for q, n in tree.search_all(v, 3) for a, b in zip(q, n)}
    assert pairs == {(i, j) for i, x in enumerate(v.tolist()) for j in tree.search(x, 3)}
    assert len({simhash.linked(v, np.ones(len(v), bool), 3)[i] for i in np.flatnonzero(np.bitwise_count(v ^ np.uint64(5)) <= 1)}) == 1


def _shingles(text):
    w = (text or "").encode().lower().split()
    k = min(5, len(w))
    return k, {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()


def test_decontamination_is_exact(docs, rows, spark):
    items = [(1, rows[2][1]), (2, " ".join(rows[-5][1].split()[100:160])), (3, None), (4, ""), (5, "idiot"), (6, rows[5][1] + " no such end"),
             (1, rows[2][1])]
    want = Counter()
    for r in rows:
        for i, t in items:
            k, s = _shingles(t)
            w = (r[1] or "").encode().lower().split()
            n = len(s & {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}) if k else 0
            if k and n >= 0.8 * len(s):
                want[r[0], i, len(s), n] += 1
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert want
    assert _rows(decontaminate.contaminated(docs, bench), "doc_id", "item_id", "n_shingles", "n_shared") == want
    assert decontaminate.decontaminated(docs, bench).columns == docs.columns


def test_embedding_links(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 16))
    x = np.concatenate([base + 0.12 * rng.normal(size=base.shape) for _ in range(6)])
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(x)] + [(500, x[0].tolist(), 0), (500, x[0].tolist(), 0)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [None] + [1.0] * 15, 1), (903, [float("nan")] * 16, 1),
           (904, x[1].tolist(), None), (905, [1e200] * 16, 1), (906, [1e-200] * 16, 1), (907, [], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    got = pivots.near_embeddings(df).collect()
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    lab = np.array([r[2] for r in rows])
    link = (unit @ unit.T >= 0.93) & (lab[:, None] == lab[None])
    np.fill_diagonal(link, False)
    true = sorted((r[0], int(n)) for r, n in zip(rows, link.sum(axis=1)))
    mine = sorted((r.vec_id, r.n_links) for r in got if r.vec_id < 900)
    assert all(a[1] <= b[1] for a, b in zip(mine, true)) and sum(m[1] for m in mine) >= 0.9 * link.sum()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id >= 900} == {
        (i, 1 if i in (905, 906) else 0, 905 if i == 906 else i) for i in range(900, 908)}


def test_katz_is_normalised(docs, rows):
    got = katz.katz_scores(docs).collect()
    assert len(got) == len(rows)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    toks = [(r[0], (r[1] or "").encode().lower().split() + [b"\0"]) for r in rows]
    uni, two, ctx = Counter(), Counter(), Counter()
    for i, t in toks:
        if not held(i):
            uni.update(t)
            two.update(zip([b"\1", *t], t))
            ctx.update([b"\1", *t[:-1]])
    n = sum(uni.values())
    d1, d2 = (katz.discounts([0, *[sum(v == r for v in c.values()) for r in range(1, 7)]]) for c in (uni, two))
    p = {w: (d1[c] if c <= 5 else 1) * c / n for w, c in uni.items()}
    rest = 1 - sum(p.values())
    if rest < 1 / (n + 2):
        p = {w: v * (1 - 1 / (n + 2)) / (1 - rest) for w, v in p.items()}
        rest = 1 / (n + 2)

    def weight(h):
        f = [(w, c) for (a, w), c in two.items() if a == h]
        left = sum((1 - (d2[c] if c <= 5 else 1)) * c for _, c in f) / ctx[h]
        factor = 1.0
        if left < 1 / (ctx[h] + 1):
            factor, left = (1 - 1 / (ctx[h] + 1)) / (1 - left), 1 / (ctx[h] + 1)
        alpha = left / (1 - sum(p[w] for w, _ in f))
        whole = sum((d2[c] if c <= 5 else 1) * c * factor / ctx[h] for _, c in f) + alpha * (
            sum(v for w, v in p.items() if w not in {x for x, _ in f}) + rest)
        assert abs(whole - 1) < 1e-9
        return alpha, factor

    weights = {h: weight(h) for h in ctx}
    want = []
    for i, t in toks:
        s = 0.0
        for h, w in zip([b"\1", *t], t):
            c = two[h, w]
            a, f = weights.get(h, (1.0, 1.0))
            s += math.log10((d2[c] if c <= 5 else 1) * c * f / ctx[h] if c else a * p.get(w, rest))
        want.append((i if i is not None else -1, len(t), round(s, 5)))
    assert sorted(want) == sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, round(r.score, 5)) for r in got)


def test_katz_does_not_depend_on_the_broadcast_head(docs):
    cols = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    got = [sorted((*[-1 if r[c] is None else r[c] for c in cols], round(r.base_score, 6), round(r.score, 6))
                  for r in katz.katz_scores(docs, head=n).collect()) for n in (0, 5, katz.HEAD)]
    assert got[0] == got[1] == got[2]


def test_language_and_toxicity_learn(spark):
    rng = random.Random(2)
    en, fr = ["the", "house", "tion", "and", "would", "like"], ["été", "maison", "que", "voudrait", "comme", "le"]
    data = [(i, _text(rng, 30, en if i % 2 else fr), "en" if i % 2 else "fr") for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = langid.fit(langid.training_rows(docs))
    assert all((r.lang_pred == "en") == (r.doc_id % 2 == 1) for r in langid.predict(docs, model).collect())
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "12 ²!"), (3, "houses")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.predict(odd, model).collect()] == ["und", "und", "und", "en"]
    bad = spark.createDataFrame([(i, t + (" worthless moron" if i % 3 == 0 else ""), l) for i, t, l in data], docs.schema)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)] + [(1, None)], "doc_id long, toxic int")
    fitted = toxicity.fit(bad, labels)
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in toxicity.toxicity(bad, *fitted).collect())
    test = spark.createDataFrame([(1, "you w0rthless thing"), (2, None), (3, "")], "doc_id long, text string")
    lex = fitted[0]
    assert lex.match("w0rthless") == 2 and lex.match("worthless") == 1 and lex.match("house") == 0
    assert lex.features('he said "moron" to us')[0] < lex.features("you moron")[0]
    assert [r.predicted for r in toxicity.toxicity(test, *fitted).collect()][1:] == [0, 0]


def test_toxicity_learns_a_wide_lexicon_of_rare_terms(spark):
    rng = random.Random(3)
    words = ["the", "house", "tion", "and", "would", "like", "été", "maison", "que", "voudrait", "comme", "le"]
    slurs = [f"{a}{b}{c}rk" for a in "bdgkz" for b in "aeiou" for c in "lm"]  # each in 2 % of the toxic texts
    data = [(i, f"{_text(rng, 20, words)} n{i} " + (slurs[i // 2 % 50] if i % 2 else "")) for i in range(3000)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in data], "doc_id long, toxic int")
    docs = spark.createDataFrame(data, "doc_id long, text string")
    lex, weights = toxicity.fit(docs, labels)
    assert all(lex.match(x) == 1 for x in slurs) and not any(lex.match(x) for x in words)
    assert all(r.predicted == r.doc_id % 2 for r in toxicity.toxicity(docs, lex, weights).collect())


def test_toxicity_counts_copies_of_a_text_once(spark):
    rng = random.Random(4)
    words = ["the", "house", "tion", "and", "would", "like", "été", "maison", "que", "voudrait", "comme", "le"]
    data = [(i, f"{_text(rng, 20, words)} n{i}" + (" worthless" if i % 3 == 0 and i < 300 or i % 97 == 0 else "")) for i in range(1300)]
    data += [(i, "the same house and the same text") for i in range(1300, 5000)]
    toxic = [(i, int(i < 300 or i >= 1300)) for i, _ in data]  # 300 toxic texts and 3,700 copies of one
    absent = [(i, 1) for i in range(5000, 9000)]  # labels without a document
    labels = spark.createDataFrame(toxic + absent, "doc_id long, toxic int")
    lex, _ = toxicity.fit(spark.createDataFrame(data, "doc_id long, text string"), labels)
    assert lex.match("worthless") == 1 and lex.match("maison") == 0


def test_toxicity_takes_no_terms_from_near_copies(spark):
    rng = random.Random(5)
    words = ["the", "house", "tion", "and", "would", "like", "été", "maison", "que", "voudrait", "comme", "le"]
    data = [(i, f"{_text(rng, 20, words)} n{i} " + ("worthless" if i % 3 == 0 else "")) for i in range(900)]
    shared = _text(rng, 20, words) + " quixotry zenithal " + _text(rng, 20, words)
    data += [(i, f"n{i} {shared} worthless n{i}") for i in range(900, 960)]  # toxic near copies with rare words
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0 or i >= 900)) for i, _ in data], "doc_id long, toxic int")
    lex, _ = toxicity.fit(docs, labels)
    assert [lex.match(x) for x in ("worthless", "quixotry", "zenithal", "quixotic", "maison")] == [1, 0, 0, 0, 0]


def test_toxicity_finds_misspellings_inside_a_stem(spark):
    rng = random.Random(6)
    words = ["the", "house", "tion", "and", "would", "like", "été", "maison", "que", "voudrait", "comme", "le"]
    data = [(i, f"{_text(rng, 20, words)} n{i} " + (("idiot", "idiots", "idiotic")[i // 2 % 3] if i % 2 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in data], "doc_id long, toxic int")
    lex, weights = toxicity.fit(spark.createDataFrame(data, "doc_id long, text string"), labels)
    assert [lex.match(x) for x in ("idiot", "idiotically", "idjot", "1diot", "idi0tic", "maison")] == [1, 1, 2, 2, 2, 0]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    vec = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for df in (decontaminate.contaminated(none, bench), sharding.kd_shards(none), token_counts.token_counts(none),
               toxicity.toxicity(none, *toxicity.fit(none, labels)), katz.katz_scores(none), bpe_codec.round_trip(none),
               suffix_dedup.repeats_removed(none), pivots.near_embeddings(vec), simhash.simhash_groups(none),
               langid.predict(none, langid.fit(none))):
        assert df.count() == 0
    assert langid.predict(docs, langid.fit(none)).where("lang_pred <> 'und'").count() == 0
