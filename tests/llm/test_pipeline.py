"""The pipeline against plain loops over all rows of a small planted table."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline

WORDS = {"en": ["the", "house", "and", "would", "like", "river", "walk", "green", "under", "letter"],
         "fr": ["été", "maison", "que", "voudrait", "comme", "rivière", "marche", "vert", "sous", "lettre"]}


def _prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + str(rng.randint(0, 99)) * (rng.random() < 0.5) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    """Rows: clean texts, exact and near copies, shared passages over 200 bytes
    (one cutting a two-byte letter), leaked items, rows without a language."""
    rng = random.Random(11)
    texts = [_prose(rng, "en" if i % 2 else "fr", rng.randint(20, 400)) for i in range(60)]
    shared = _prose(rng, "fr", 70)
    items = [_prose(rng, "en", 40), _prose(rng, "fr", 25), "two words", None, ""]
    texts += [texts[3]] * 4 + [texts[4] + " end", texts[5].upper(), texts[6].replace(" ", "\n", 2)]
    texts += [_prose(rng, "en", 80) + " " + shared + tail for tail in ("é a", "è b", " c")]
    texts += [_prose(rng, "fr", 200) + " " + items[0] + " " + _prose(rng, "fr", 300), items[1],
              " ".join(items[0].split()[:36]) + " other end", "here are two words only"]
    texts += [None, "", " \t\n", "12 34 !!", None, "x", _prose(rng, "en", 6000)]
    rows = [(i, t, "en" if i % 2 else "fr", "s", len(t or "")) for i, t in enumerate(texts)]
    return rows, list(enumerate(items))


def _fingerprint(text):
    w = text.encode().lower().split()
    if not w:
        return 0
    runs = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _one_per_group(docs):
    ids = sorted(docs)
    fp = {i: _fingerprint(docs[i]) for i in ids}
    seen, kept = set(), {}
    for i in ids:
        if i in seen:
            continue
        kept[i] = docs[i]
        todo = [i]
        seen.add(i)
        while todo:
            a = todo.pop()
            near = [b for b in ids if b not in seen and (fp[a] ^ fp[b]).bit_count() <= 3]
            seen.update(near)
            todo += near
    return kept


def _cut_repeats(docs):
    data = {i: t.encode() for i, t in docs.items()}
    count = Counter(b[p:p + 200] for b in data.values() for p in range(len(b) - 199))
    out = {}
    for i, b in data.items():
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 199):
            if count[b[p:p + 200]] > 1:
                gone[p:p + 200] = True
        out[i] = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
    return out


def _leaks(text, item):
    w, q = text.encode().lower().split(), (item or "").encode().lower().split()
    k = min(5, len(q))
    if not k:
        return False
    want = {tuple(q[i:i + k]) for i in range(len(q) - k + 1)}
    have = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    return len(want & have) >= 0.8 * len(want)


def _expected(rows, items):
    import public_tokenizers
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = {r[0]: r[1] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    sizes = [len(rows), len(docs)]
    docs = _one_per_group(docs)
    sizes.append(len(docs))
    cut = _cut_repeats(docs)
    assert cut != docs
    docs = {i: t for i, t in cut.items() if not any(_leaks(t, q) for _, q in items)}
    sizes.append(len(docs))
    assert sizes == sorted(set(sizes), reverse=True)  # every filter has something to drop
    out = Counter()
    for i, t in docs.items():
        ids = lib.encode(t, add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        out[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest()] += 1
    return out


def _write(spark, folder, rows, items):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_agrees_with_plain_loops(spark, planted, tmp_path):
    rows, items = planted
    _write(spark, tmp_path, rows, items)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == _expected(rows, items)


def test_stages_keep_the_columns_and_take_effect(spark, planted, tmp_path):
    rows, items = planted
    _write(spark, tmp_path, rows, items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (name, stage), drops in zip(corpus_pipeline.STAGES[:-1], (5, 5, 0, 2)):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count() - drops, name


def test_pipeline_of_empty_tables(spark, tmp_path):
    _write(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
