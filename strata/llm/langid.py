"""Language identification, words first.

A known word scores by its log frequency in each language.  An unseen word
falls back to its character 4-grams (with word marks), each of them to the
longest known shorter gram at its place.  The tables are learned from a
bounded sample of labelled rows and hold a bounded number of entries, so the
model has a fixed size; every document is then scored in one narrow pass."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, crc_mod, lean, prepare, saved, table

#: Labelled rows per language that the tables are learned from (expected number).
SAMPLE_PER_LANG = 2_000
#: A word or gram is known if the sample holds it so often (in all languages
#: together); what was seen once says no more than its shorter grams.
MIN_SEEN = 2
MAX_GRAM = 4
#: Unseen words whose scores a worker keeps; the table is emptied when full.
UNSEEN_CACHE = 200_000

_WORD = re.compile(r"[^\W\d_]+")
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                  ("score", pa.float64())])


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Model:
    """Log frequencies by language: ``words`` and ``grams`` map to rows of a matrix."""

    def __init__(self, langs: list[str], words: dict[str, list[float]], grams: dict[str, list[float]],
                 floor: list[float]):
        self.langs = langs
        self.ids = {w: i for i, w in enumerate(words)}
        self.known = len(words)
        self.rows = np.zeros((max(1, 2 * self.known), len(langs)))
        if words:
            self.rows[:self.known] = list(words.values())
        self.gram_ids = {g: i for i, g in enumerate(grams)}
        self.gram_rows = np.array([*grams.values(), floor])  # the last row is the floor

    def _backoff(self, word: str) -> list[int]:
        """The longest known gram at each place of a word (-1: the floor)."""
        marked, get, out = f"^{word}$", self.gram_ids.get, []
        for i in range(max(1, len(marked) - MAX_GRAM + 1)):
            for size in range(MAX_GRAM, 0, -1):
                g = get(marked[i:i + size])
                if g is not None:
                    break
            out.append(-1 if g is None else g)
        return out

    def learn_words(self, new: list[str]) -> None:
        """Give unseen words a row: the mean over their places."""
        flat: list[int] = []
        starts = []
        for w in new:
            starts.append(len(flat))
            flat += self._backoff(w)
        ends = np.array([*starts[1:], len(flat)])
        mean = np.add.reduceat(self.gram_rows[flat], starts) / (ends - starts)[:, None]
        first = len(self.ids)
        while first + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[first:first + len(new)] = mean
        self.ids.update(zip(new, range(first, first + len(new))))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, posterior) of each text of a batch."""
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        found = [words_of(t) if t else [] for t in texts]
        if len(self.ids) > self.known + UNSEEN_CACHE:
            self.ids = dict(itertools.islice(self.ids.items(), self.known))
        new = set().union(*found).difference(self.ids)
        if new:
            self.learn_words(list(new))
        out, row = [], self.ids.__getitem__
        for ws in found:
            if not any(c.isalpha() for w in ws for c in w):
                out.append(("und", 0.0))
                continue
            total = self.rows[list(map(row, ws))].sum(axis=0)
            p = np.exp(total - total.max())
            p /= p.sum()
            best = int(p.argmax())
            out.append((self.langs[best], float(p[best])))
        return out


_ITEMS = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("item", pa.string()), ("n", pa.int64())])


def _summed(rows: DataFrame, count) -> DataFrame:
    """(kind, lang, item, n) from per-batch counters keyed by the first three."""

    def run(cols):
        out = count(*cols)
        keys = list(out)
        return [k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys], list(out.values())

    return (arrow_rows(rows, run, "kind int, lang string, item string, n long", _ITEMS)
            .groupBy("kind", "lang", "item").agg(F.sum("n").alias("n")))


def _count_words(langs: list, texts: list) -> Counter:
    out: Counter = Counter()
    for lang in set(langs):
        mine = Counter(itertools.chain.from_iterable(words_of(t) for k, t in zip(langs, texts) if k == lang))
        out.update({(0, lang, w): n for w, n in mine.items()})
    return out


def _count_grams(langs: list, items: list, counts: list) -> Counter:
    out: Counter = Counter()
    for lang, w, n in zip(langs, items, counts):
        marked = f"^{w}$"
        for size in range(1, MAX_GRAM + 1):
            for i in range(len(marked) - size + 1):
                out[size, lang, marked[i:i + size]] += n
    return out


def fit(rows: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Learn from ``rows`` (doc_id, text, lang).  Rows with a null text or lang
    teach nothing.  Beyond ``per_lang`` rows of a language a hash of the row
    decides which of them are used."""
    rows = rows.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], {}, {}, [])
    langs = sorted(sizes)
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, per_lang / sizes[k])))])
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))
                        < share[F.col("lang")] * 1_000_000).select("lang", "text")
    counted = saved(_summed(sample, _count_words), "langid-words")
    seen = saved(counted.union(_summed(counted.select("lang", "item", "n"), _count_grams)), "langid-seen")
    known = seen.groupBy("kind", "item").agg(F.sum("n").alias("of_all")).where(F.col("of_all") >= MIN_SEEN)
    kept = seen.join(known, ["kind", "item"], "left_semi")
    counts: dict[int, dict[str, np.ndarray]] = {}
    at = {k: i for i, k in enumerate(langs)}
    for r in kept.select("kind", "lang", "item", "n").collect():  # bounded by the sample
        counts.setdefault(r.kind, {}).setdefault(r.item, np.zeros(len(langs)))[at[r.lang]] = r.n
    logs: dict[int, dict[str, list[float]]] = {}
    for kind, items in counts.items():
        total = sum(items.values()) + 0.5 * len(items)
        logs[kind] = {w: np.log((c + 0.5) / total).tolist() for w, c in items.items()}
    grams = {g: v for kind, items in logs.items() if kind for g, v in items.items()}
    floor = [math.log(1e-6)] * len(langs)
    return Model(langs, logs.get(0, {}), grams, floor)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out (crc32(doc_id as text) mod 4 is 2), lang_pred, score for
    each row.  ``und`` with score 0 if the text is null or has no letter, or if
    nothing was learned; a tie goes to the first language by name; null ids are
    not held out; repeated rows are scored alike; extra columns are ignored."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(cols):
        m = shared.value
        got = m.predict(cols[2])
        return cols[0], cols[1], [g[0] for g in got], [g[1] for g in got]

    return arrow_rows(docs.select(docs["doc_id"].cast("long"), (crc_mod(docs["doc_id"], 4) == 2).alias("held_out"),
                                  docs["text"].cast("string")),
                      run, "doc_id long, held_out boolean, lang_pred string, score double", _OUT)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text has a language (all columns kept)."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches):
        m = shared.value
        for b in batches:
            yield b.filter(pa.array([p[0] != "und" for p in m.predict(b.column(text).to_pylist())], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(crc_mod(docs["doc_id"], 4) != 2)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(training_rows(docs)))
