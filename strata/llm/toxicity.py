"""Toxicity by a learned lexicon that also catches misspelled terms.

The lexicon (whole terms and stems) is learned from a bounded sample of
labelled training rows and held in a trie.  A text word is matched by running
its Levenshtein automaton (one edit) along the trie.  A match inside a
quotation - by the words and marks in a window around it - counts for less
than one in the author's own voice.  A small logistic model turns the
evidence into a score."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import WordTable
from .common import arrow_rows, crc_mod, prepare, saved, table

#: Labelled rows of each class that the model is learned from (expected number).
SAMPLE_PER_CLASS = 6_000
#: An entry must stand in so many distinct contexts of toxic sample texts, be so many
#: times likelier there, and more than chance gives any of the items tested.
MIN_ROWS, MIN_LIFT = 5, 8.0
STEM_MIN, STEM_MAX = 4, 7
#: Shorter terms must match exactly.
FUZZY_FROM = 5
#: Words on either side that decide between quotation and own voice.
WINDOW = 6
#: Weight of a quoted match against one in the author's own voice.
QUOTED = 0.3

#: Quotation marks, and words that report another's speech.
_MARKS = re.compile("[\"“”„«»‹›]")
_REPORTING = {"said", "says", "wrote", "called", "quote", "quoted", "word", "term", "slur", "insult",
              "dit", "mot", "appelé", "citation", "sagte", "schrieb", "wort", "zitat", "dijo",
              "escribió", "palabra", "cita"}
_WORD = re.compile(r"\w+")
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                  ("predicted", pa.int32())])


class Automaton:
    """The Levenshtein automaton of a word for at most ``k`` edits.  A state is
    the sparse row of positions in the word with the edits spent so far."""

    def __init__(self, word: str, k: int = 1):
        self.word, self.k = word, k

    def start(self) -> dict[int, int]:
        return {i: i for i in range(min(self.k, len(self.word)) + 1)}

    def step(self, state: dict[int, int], char: str) -> dict[int, int]:
        new: dict[int, int] = {}
        for i, e in state.items():
            if e < self.k and new.get(i, 9) > e + 1:  # char inserted
                new[i] = e + 1
            if i < len(self.word):
                cost = e + (self.word[i] != char)
                if cost <= self.k and new.get(i + 1, 9) > cost:
                    new[i + 1] = cost
        for i in sorted(new):  # characters of the word left out
            while i < len(self.word) and new[i] < self.k and new.get(i + 1, 9) > new[i] + 1:
                new[i + 1] = new[i] + 1
                i += 1
        return new

    def accepts(self, state: dict[int, int]) -> bool:
        return len(self.word) in state


class Lexicon:
    """Terms and stems in a trie; ``kind`` of a text word: 0 none, 1 exact term
    or stem, 2 misspelled term."""

    TERM, STEM = 1, 2

    def __init__(self, terms: list[str], stems: list[str]):
        self.root: dict = {}
        for entries, mark in ((terms, self.TERM), (stems, self.STEM)):
            for t in entries:
                node = self.root
                for c in t:
                    node = node.setdefault(c, {})
                node[""] = node.get("", 0) | mark
        fuzzy = [t for t in terms if len(t) >= FUZZY_FROM]
        # one edit leaves the first or the second half of a term as it is; by length of the term
        self.halves: dict[int, tuple[set[str], set[str]]] = {}
        for t in fuzzy:
            first, second = self.halves.setdefault(len(t), (set(), set()))
            first.add(t[:len(t) // 2])
            second.add(t[-(len(t) // 2):])
        self.table = WordTable(self.match, most=300_000)

    def match(self, word: str) -> int:
        node = self.root
        for i, c in enumerate(word):
            node = node.get(c)
            if node is None:
                break
            mark = node.get("", 0)
            if mark & self.STEM or mark & self.TERM and i + 1 == len(word):
                return 1
        if not any(word[:n // 2] in self.halves[n][0] or word[-(n // 2):] in self.halves[n][1]
                   for n in range(len(word) - 1, len(word) + 2) if n in self.halves):
            return 0  # no term is one edit away
        auto = Automaton(word)
        stack = [(self.root, auto.start(), 0)]
        while stack:
            node, state, depth = stack.pop()
            if depth >= FUZZY_FROM and node.get("", 0) & self.TERM and auto.accepts(state):
                return 2
            for c, below in node.items():
                if c:
                    reached = auto.step(state, c)
                    if reached:
                        stack.append((below, reached, depth + 1))
        return 0

    def features(self, text: str) -> list[float]:
        """Weighted evidence: exact and misspelled matches, whether any, and
        matches per hundred words."""
        low = text.lower()
        found = _WORD.findall(low)
        kinds = list(map(self.table.__getitem__, found))
        exact = fuzzy = 0.0
        if any(kinds):
            spans = [m.span() for m in _WORD.finditer(low)]
            for i, kind in enumerate(kinds):
                if kind:
                    w = self.voice(low, found, spans, i)
                    exact, fuzzy = (exact + w, fuzzy) if kind == 1 else (exact, fuzzy + w)
        return [np.log1p(exact), np.log1p(fuzzy), float(exact >= 0.5), 100 * (exact + fuzzy) / (len(found) + 20)]

    @staticmethod
    def voice(low: str, found: list[str], spans: list, i: int) -> float:
        """QUOTED if marks stand on both sides within the window, or one side
        has a mark and the window a reporting word; else 1."""
        lo, hi = max(0, i - WINDOW), min(len(found) - 1, i + WINDOW)
        left = bool(_MARKS.search(low, spans[lo][0], spans[i][0]))
        right = bool(_MARKS.search(low, spans[i][1], spans[hi][1] + 1))
        told = not _REPORTING.isdisjoint(found[lo:hi + 1])
        return QUOTED if left and right or told and (left or right) else 1.0


def _entries(text: str) -> dict[str, int]:
    """The whole words (marked) and the stems of a text, each with one of its
    contexts: the least hash over the two words on either side."""
    words = _WORD.findall(text.lower())
    least: dict[str, int] = {}
    for i, w in enumerate(words):
        h = xxhash.xxh64_intdigest(" ".join([*words[max(0, i - 2):i], "", *words[i:i + 3]])) >> 1
        if h < least.get(w, h + 1):
            least[w] = h
    out: dict[str, int] = {}
    for w, h in least.items():
        if len(w) >= 3:
            out["=" + w] = h
        for n in range(STEM_MIN, min(STEM_MAX, len(w)) + 1):
            out[w[:n]] = min(h, out.get(w[:n], h))
    return out


def _tally(rows: DataFrame) -> DataFrame:
    """(item, pos, neg, contexts): the numbers of toxic and clean texts with the
    item, and the number of distinct contexts in the toxic ones, counted to MIN_ROWS."""
    def count(cols):
        c: tuple = (Counter(), Counter())
        seen: dict[str, set[int]] = {}
        for t, toxic in zip(*cols):
            found = _entries(t)
            c[toxic].update(found.keys())
            if toxic:
                for x, h in found.items():
                    some = seen.setdefault(x, set())
                    if len(some) < MIN_ROWS:
                        some.add(h)
        items = list(c[0].keys() | c[1].keys())
        return items, [c[1][x] for x in items], [c[0][x] for x in items], [sorted(seen.get(x, ())) for x in items]

    return (arrow_rows(rows.select("text", "toxic"), count, "item string, pos long, neg long, seen array<long>",
                       pa.schema([("item", pa.string()), ("pos", pa.int64()), ("neg", pa.int64()),
                                  ("seen", pa.list_(pa.int64()))]))
            .groupBy("item").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                                 F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("contexts")))


def learn_lexicon(sample: DataFrame, n_pos: int, n_neg: int) -> Lexicon:
    """From distinct texts.  An item's texts fall among the toxic ones by chance
    with probability ``q`` each; by Chernoff's bound the chance of a share as
    high as the one seen is exp(-evidence), and less than one of all the items
    tested may be expected to pass.  Near copies of one toxic text share their rare
    words with the words beside them, so that such a word has few contexts."""
    tested = saved(_tally(sample).where(F.col("contexts") >= MIN_ROWS), "toxicity-items")
    n, q = tested.count(), n_pos / max(1, n_pos + n_neg)
    pos_, neg_ = F.col("pos"), F.col("neg")
    share = pos_ / (pos_ + neg_)
    lift = (pos_ / max(1, n_pos)) / ((neg_ + 0.5) / max(1, n_neg))
    evidence = pos_ * F.log(share / q) + F.when(neg_ > 0, neg_ * F.log((1 - share) / (1 - q))).otherwise(0.0)
    good = tested.where((lift >= MIN_LIFT) & (evidence > float(np.log(max(1, n)))))
    pos = {r.item: r.pos for r in good.collect()}  # bounded by the sample
    best = sorted(pos)
    terms = [x[1:] for x in best if x[0] == "="]
    stems: list[str] = []
    top = {}
    for x in terms:  # the commonest whole word below each stem
        for n in range(STEM_MIN, min(STEM_MAX, len(x)) + 1):
            top[x[:n]] = max(top.get(x[:n], 0), pos["=" + x])
    for x in sorted((x for x in best if x[0] != "="), key=lambda x: (len(x), x)):
        # a stem must reach well beyond one whole word
        if pos[x] >= 1.5 * top.get(x, 0) + 3 and not any(x.startswith(s) for s in stems):
            stems.append(x)
    return Lexicon(terms, stems)  # terms below a stem too: their misspellings don't have it


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge-penalised logistic weights (last: intercept) by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 0.05)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[Lexicon, np.ndarray]:
    """Learn from the labelled rows outside the held-out fold.  Labels that are
    null or not 0/1 teach nothing; a document labelled twice is toxic if any
    label says so.  Without rows of both classes nothing is flagged."""
    prepare(docs.sparkSession)
    lab = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
           .where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(crc_mod(F.col("doc_id"), 5) > 0)
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sizes = {r.toxic: r.n for r in lab.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Lexicon([], []), np.array([0, 0, 0, 0, -5.0])
    keep = F.when(F.col("toxic") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    few = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < keep * 1_000_000)
    sample = (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
              .where("text IS NOT NULL").join(F.broadcast(few), "doc_id"))  # few: at most about 2 * per_class ids
    # each text once: copies of one toxic text would pass its rare words for terms
    sample = saved(sample.select("text", "toxic").dropDuplicates(), "toxicity-sample")
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Lexicon([], []), np.array([0, 0, 0, 0, -5.0])
    lexicon = learn_lexicon(sample, n[1], n[0])
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def measure(cols):
        return [shared.value.features(t) for t in cols[0]], cols[1]

    got = arrow_rows(sample.select("text", "toxic"), measure, "x array<double>, y int",
                     pa.schema([("x", pa.list_(pa.float64())), ("y", pa.int32())])).collect()
    x, y = np.array([r.x for r in got]), np.array([r.y for r in got], float)
    return lexicon, _fit_logistic(x, y)


def toxicity(docs: DataFrame, lexicon: Lexicon, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out (crc32(doc_id as text) mod 5 is 0), score, predicted for
    each row of ``docs`` (doc_id, text).

    A null text is scored as an empty one; null ids are not held out; repeated
    rows are scored alike; extra columns are ignored.  One narrow pass."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, weights))

    def run(cols):
        lex, w = shared.value
        x = np.array([lex.features(t or "") for t in cols[2]]).reshape(len(cols[2]), 4)
        p = 1 / (1 + np.exp(-np.clip(x @ w[:4] + w[4], -30, 30)))
        return cols[0], cols[1], p, (p >= 0.5).astype(np.int32)

    return arrow_rows(docs.select(docs["doc_id"].cast("long"), (crc_mod(docs["doc_id"], 5) == 0).alias("held_out"),
                                  docs["text"].cast("string")),
                      run, "doc_id long, held_out boolean, score double, predicted int", _OUT)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, *fit(docs, table(spark, sf_dir, "labels")))
