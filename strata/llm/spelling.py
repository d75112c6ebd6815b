"""Spelling variant grouping by a trie-node pair dictionary.

The nodes of the trie of all words, and of the trie of all words written
backwards, are numbered.  A word with its i-th letter skipped is the integer
pair (node of the letters before i, node of the letters after i); a word cut at
i is the pair (node before, node from i on).  Two words differ by one replaced
letter exactly when they share a skip pair, by one inserted letter exactly when
a skip pair of the longer is a cut pair of the shorter.  So joining pairs gives
the exact neighbours, without comparing words.

A trie in sorted order is a list of runs: the words below a node stand together.
A node is therefore numbered by the first word of its run and its depth, found
from the common prefixes of neighbours in one pass over a sorted range.  Only a
node that holds the words on both sides of a range border can cross it, and it
is then a prefix of the border itself, numbered by the first such border.  A
node with a single word below it can meet no other word and gets no pairs.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_key, discard, prepare, run_bounds, saved, table, whole_runs

MIN_LENGTH, MIN_COUNT, RATIO, TYPO_EVERY = 7, 2, 10, 31
#: The letters a word is made of, after lower-casing A-Z.
LETTERS = "a-z\\u00C0-\\u00FF"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Long texts are cut between words into pieces of about this many characters.
PIECE = 1 << 16
#: Letters of a range border that are kept; any string is a valid border.
BORDER = 64


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the words of ``docs`` (doc_id, text) that are long and frequent
    enough, after the deletion of a letter where the checksum says so."""
    text = F.translate(docs["text"], _UPPER, _LOWER)
    # a piece ends before a character that is no letter; a longer run is a piece of its own
    cut = f"(?s).{{1,{PIECE}}}(?![{LETTERS}])|[{LETTERS}]+"
    runs = (docs.select(docs["doc_id"].cast("string").alias("id"), F.explode(F.regexp_extract_all(text, F.lit(cut), F.lit(0))).alias("piece"))
            .select("id", F.explode(F.regexp_extract_all("piece", F.lit(f"[{LETTERS}]{{{MIN_LENGTH},}}"), F.lit(0))).alias("run")))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    size = F.char_length("run")
    at = (h % size).cast("int")
    short = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, size))
    # a null id has no checksum, so nothing is deleted
    word = F.when(h % TYPO_EVERY == 0, short).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.char_length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT))


def _borders(words: DataFrame, ranges: int) -> list[str]:
    """Sorted strings that cut the words into about ``ranges`` even ranges; from
    a hash sample of about 30 words a range."""
    n = words.count()
    step = max(1, n // (30 * ranges))
    picked = words.where(F.pmod(F.xxhash64("word"), F.lit(step)) == 0)
    found = sorted({r.b for r in picked.select(F.substring("word", 1, BORDER).alias("b")).collect()})
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def _border_nodes(borders: list[str]) -> dict[str, int]:
    """Numbers of the nodes on the way to the borders, below zero."""
    found: dict[str, int] = {}
    for b in borders:
        for i in range(len(b) + 1):
            found.setdefault(b[:i], -1 - len(found))
    return found


def _numbered(words: DataFrame, keep: list[str], ranges: int) -> DataFrame:
    """``words`` (word, and the long columns ``keep``), all different -> those, rank
    (the order of the word among all) and nodes: the numbers of the trie nodes on
    the way to the word, from the root down, as far as other words share them."""
    borders = _borders(words, ranges)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            where = [bisect_right(borders, w) for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), *b.columns], names=["part", *b.schema.names])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crossing = _border_nodes(borders)
        part, rank, nodes, prev, path, edges, held = -1, 0, 0, "", [], [], None
        out: list[list] = [[] for _ in range(len(keep) + 3)]

        def emit(lcp: int) -> None:
            """The row before, now that the prefix it shares with the next is known."""
            if held is not None:
                for c, v in zip(out, held[2]):
                    c.append(v)
                out[-1].append(np.array(held[0][:max(held[1], lcp) + 1], np.int64).tobytes())

        def batch() -> pa.RecordBatch:
            types = [pa.string(), *[pa.int64()] * (len(keep) + 1), pa.binary()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["word", *keep, "rank", "nodes"])
            for c in out:
                c.clear()
            return made

        for b in batches:
            for p, w, *rest in zip(*(c.to_pylist() for c in b.columns)):
                if p == part:
                    lcp = len(commonprefix((prev, w)))
                    emit(lcp)
                else:
                    emit(0)
                    part, rank, nodes, path, lcp = p, p << 40, p << 40, [], 0
                    edges = [borders[q] for q in (p - 1, p) if 0 <= q < len(borders)]
                at_edge = max((len(commonprefix((e, w))) for e in edges), default=-1)
                path = path[:lcp + 1]  # the nodes shared with the word before
                for i in range(len(path), len(w) + 1):
                    path.append(crossing[w[:i]] if i <= at_edge else nodes + i)
                nodes += len(w) + 1
                held = (path, max(lcp, at_edge), [w, *rest, rank])
                prev, rank = w, rank + 1
            yield batch()
        emit(0)
        yield batch()

    longs = "".join(f", {k} long" for k in keep)
    placed = words.select("word", *keep).mapInArrow(place, f"part long, word string{longs}")
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (placed.repartition(n, "part").sortWithinPartitions("part", "word")
            .mapInArrow(number, f"word string{longs}, rank long, nodes binary"))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n, rank, fore, back -> one row per cut pair (kind 0) and skip pair
    (kind 1; 2 where the skipped letter repeats the one before, so that the same
    shorter word is reached from the place before)."""
    for b in batches:
        out: list[list] = [[] for _ in range(5)]
        for w, n, rank, fore, back in zip(*(c.to_pylist() for c in b.columns)):
            f, g, size = np.frombuffer(fore, np.int64).tolist(), np.frombuffer(back, np.int64).tolist(), len(w)
            for kind, of in ((0, size), (1, size - 1)):
                # i letters before and of - i after, both on shared nodes
                for i in range(max(0, of - len(g) + 1), min(of, len(f) - 1) + 1):
                    out[0].append(f[i])
                    out[1].append(g[of - i])
                    out[2].append(2 if kind and i and w[i] == w[i - 1] else kind)
                    out[3].append(-n)
                    out[4].append(rank)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["p", "s", "kind", "less", "rank"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pair, kind, -n and rank -> (rank, near, n, other): for each
    word of a shared pair, how many words it meets there and the best of them.

    A pair holds at most one cut word, and one skip word per letter of the
    alphabet; the rows of a pair are counted, never paired with each other."""
    for t in whole_runs(batches, 2):
        p, s, kind, less, rank = (t.column(i).to_numpy() for i in range(5))
        at = run_bounds([p, s])
        first, size = at[:-1], np.diff(at)
        run = np.repeat(np.arange(len(size)), size)
        cut = kind[first] == 0  # the cut word comes first
        skips = size - cut
        order = np.lexsort((rank, less, run))  # best first, cut words among the others
        order = order[kind[order] > 0]
        of = run[order]
        start = np.searchsorted(of, np.arange(len(size)))
        place = np.arange(len(order)) - start[of]
        # the best other skip word: the first, or the second for the first itself
        other = np.where(place == 0, start[of] + 1, start[of])
        has = skips[of] > 1
        best = order[np.where(has, other, 0)] if len(order) else order
        head = first[of]
        meets = cut[of] & (kind[order] == 1)
        near = skips[of] - 1 + meets
        take = meets & (~has | (less[head] < less[best]) | ((less[head] == less[best]) & (rank[head] < rank[best])))
        best = np.where(take, head, best)
        keep = near > 0
        got = [[rank[order][keep], near[keep], less[best][keep], rank[best][keep]]]
        # the cut word meets the skip words that reach it once each
        once = order[kind[order] == 1]
        of = run[once]
        n_once = np.bincount(of, minlength=len(size))
        lead = np.searchsorted(of, np.arange(len(size)))
        runs = np.flatnonzero(cut & (n_once > 0))
        top = once[lead[runs]] if len(runs) else once[:0]
        got.append([rank[first[runs]], n_once[runs], less[top], rank[top]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*got)],
                                         names=["rank", "near", "less", "other"])


def _roots(forms: DataFrame) -> DataFrame:
    """(rank, form) -> (rank, root): forms followed to the last, by doubling the
    steps.  Counts grow tenfold with each step, so there are few."""
    now = saved(forms.select("rank", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("rank").alias("via"), F.col("root").alias("onward"))
        longer = now.join(step, F.col("root") == F.col("via"), "left")
        done = longer.where("via is not null").isEmpty()
        if done:
            return now
        before, now = now, saved(longer.select("rank", F.coalesce("onward", "root").alias("root")), "spelling-roots")
        discard(before)


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text): word, n (occurrences), n_near
    (words one letter away), form (the near word of largest n, ties to the
    smallest, if that is at least ten times the word's), form_n, root (the word
    reached by following forms; itself if it has none).

    A null text has no words; in a row without doc_id no letter is deleted.
    Repeated rows count again; extra columns are ignored; an empty table gives no
    rows.  Texts and runs of any length are taken whole."""
    spark = docs.sparkSession
    prepare(spark)
    words = saved(word_counts(docs), "spelling-words")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fore = saved(_numbered(words, ["n"], ranges), "spelling-fore")
    back = (_numbered(fore.select(F.reverse("word").alias("word"), F.col("rank").alias("id")), ["id"], ranges)
            .select("id", F.col("nodes").alias("back")))
    both = (fore.join(back, F.col("rank") == F.col("id"))
            .select("word", "n", "rank", F.col("nodes").alias("fore"), "back"))
    pairs = both.mapInArrow(_pairs, "p long, s long, kind long, less long, rank long")
    met = (by_key(pairs, ["p", "s", "kind"], _joined, "rank long, near long, less long, other long", together=2)
           .groupBy("rank").agg(F.sum("near").alias("n_near"), F.min(F.struct("less", "other")).alias("best")))
    base = saved(fore.select("rank", "word", "n").join(met, "rank", "left")
                 .select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("best.less")).alias("best_n"),
                         F.col("best.other").alias("best")), "spelling-near")
    discard(words)
    discard(fore)
    names = base.select(F.col("rank").alias("of"), F.col("word").alias("spelt"))
    forms = (base.where(F.col("best_n") >= RATIO * F.col("n"))
             .select("rank", F.col("best").alias("form"), F.col("best_n").alias("form_n")))
    roots = _roots(forms)
    of_form = forms.join(names, F.col("form") == F.col("of")).select("rank", F.col("spelt").alias("form"), "form_n")
    of_root = roots.join(names, F.col("root") == F.col("of")).select("rank", F.col("spelt").alias("root"))
    return (base.join(of_form, "rank", "left").join(of_root, "rank", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


#: CRC-32 byte by byte; then words of two shapes (a letter skipped, a letter
#: starred) joined as text.
ORACLE_SQL = f"""
with recursive step as (
  select i, 0 as k, i::bigint as c from (select unnest(range(256)) as i)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from step where k < 8),
tab as (select list(c order by i) as t from step where k = 8),
runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]{{{MIN_LENGTH},}}')) as run
  from documents),
many as (select doc_id, run, count(*) as k from runs group by all),
summed as (
  select run, k, xor(4294967295, list_reduce(
    list_transform(range(octet_length(encode(id || ':' || run))),
                   lambda j: ('0x' || substr(hex(encode(id || ':' || run)), 2 * j::int + 1, 2))::bigint),
    lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1]), 4294967295::bigint)) as h
  from (select run, k, doc_id::varchar as id from many), tab),
made as (
  select k, case when h % {TYPO_EVERY} = 0
                 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word
  from summed),
words as (
  select word, sum(k)::bigint as n from made where length(word) >= {MIN_LENGTH} group by word having sum(k) >= {MIN_COUNT}),
shapes as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as skipped,
         substr(word, 1, i - 1) || '*' || substr(word, i + 1) as starred
  from (select word, n, unnest(range(1, length(word) + 1))::int as i from words)),
near as (
  select distinct a.word, b.word as other, b.n as other_n from shapes a join shapes b on a.starred = b.starred and a.word <> b.word
  union
  select a.word, b.word, b.n from shapes a join words b on a.skipped = b.word
  union
  select b.word, a.word, a.n from shapes a join words b on a.skipped = b.word),
best as (
  select word, count(*) as n_near, max(other_n) as top from near group by word),
form as (
  select b.word, min(x.other) as form, b.top as form_n
  from best b join words w on b.word = w.word join near x on x.word = b.word and x.other_n = b.top
  where b.top >= {RATIO} * w.n group by b.word, b.top),
walk as (
  select word, word as here, 0 as hops from words
  union all
  select walk.word, form.form, hops + 1 from walk join form on walk.here = form.word),
ends as (select word, arg_max(here, hops) as root from walk group by word)
select w.word, f.form, l.root, w.n, coalesce(b.n_near, 0)::bigint as n_near, f.form_n
from words w left join form f on w.word = f.word left join best b on w.word = b.word join ends l on w.word = l.word
"""
