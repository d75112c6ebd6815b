"""Secret scans: three fixed rules, and character Markov models that add strings
which look random.

Two first-order models are trained from labelled samples: random strings and
ordinary identifiers.  A candidate's score is the log-likelihood ratio of the
two, added up over its adjacent characters in whole micro-nats, so that sums do
not depend on their order.  Everything is built from DataFrame functions: a
text's matches and the pieces between them are two arrays of one row, positions
are running sums of their lengths, and the table of ratios (alphabet squared) is
a constant of the plan.  No row leaves its place: only the samples are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, table

#: The rules and their least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
#: The same in either case of ASCII; the look-ahead only saves time.
FIND_ASSIGN = "(?i)(?=[psta])" + ASSIGN
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
#: The kinds in their order; the last is what the models add.
KINDS = ("assign", "access", "hex", "random")
#: A candidate of the models: a run of these, of at least so many characters.
CLASS, LEAST = "A-Za-z0-9+/_=-", 16
#: Different characters of it, in lower case.
LETTERS = 41
#: Least score of a finding: a log-likelihood ratio, in micro-nats.
THRESHOLD = 7_000_000
#: Weight of each pair of characters before any is counted.
PRIOR = 0.5
#: Bounds of the labelled samples: distinct random strings; distinct texts that
#: the ordinary identifiers (runs of so many characters, two digits at most) are from.
SAMPLE_STRINGS, SAMPLE_TEXTS = 20_000, 2_000
ORDINARY, ORDINARY_LEAST = "^(?:[^0-9]*[0-9]){0,2}[^0-9]*$", 8
#: Characters of a string taken apart at once, and lengths added up at once.
PIECE, BLOCK = 4096, 256
_FILL = "\u0001"  # stands where a rule has matched
_FIRST, _SPAN = 43, 80  # the codes of + to z
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, fn) -> Column:
    """``fn`` of ``value``, which is computed once however often ``fn`` names it:
    what a lambda refers to by an expression is computed for every element."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _block(j: Column) -> Column:
    return F.floor(j / BLOCK).cast("int")


def _before(lengths: Column, last: Column) -> Column:
    """For each element (0 to ``last``) the sum of those before it; by sums of blocks,
    so that a text of many matches takes little more than time in their number."""
    sums = F.transform(F.sequence(F.lit(0), _block(last)), lambda b: _total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))
    upto = F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    return _let(upto, lambda u: F.transform(F.sequence(F.lit(0), last), lambda j: F.get(u, _block(j)) + _total(
        F.slice(lengths, _block(j) * BLOCK + 1, j % BLOCK))))


def _cut(text: str, pattern: str, value: int = 0) -> Column:
    """The matches of ``pattern`` in order, as (piece, found, value): the text since the
    match before, the match, and its judged group; and, last, the text behind the last
    match (found and value null)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    pieces = F.split(text, pattern, -1)
    three = lambda p, f, v: F.struct(p.alias("piece"), f.alias("found"), v.alias("value"))
    two = F.zip_with(pieces, found, lambda p, f: three(p, f, f))
    rows = F.zip_with(two, judged, lambda x, v: three(x["piece"], x["found"], v)) if value else two
    none = F.lit(None).cast("string")
    return F.when(F.col(text).rlike(pattern), rows).otherwise(F.array(three(F.col(text), none, none)))


def _spans(cut: str, kind: int, keep) -> Column:
    """(start, kind, end) of the matches in ``cut`` that ``keep`` holds of."""
    def placed(rows: Column) -> Column:
        lengths = F.transform(rows, lambda x: F.char_length(x["piece"]) + F.coalesce(F.char_length(x["found"]), F.lit(0)))
        before = _let(lengths, lambda n: _before(n, F.size(n) - 1))
        at = F.zip_with(rows, before, lambda x, b: F.struct(
            x["found"].alias("found"), x["value"].alias("value"), (b + F.char_length(x["piece"])).alias("start")))
        return F.transform(F.filter(at, lambda x: x["found"].isNotNull() & keep(x["value"])), lambda x: F.struct(
            x["start"].alias("start"), F.lit(kind).alias("kind"), (x["start"] + F.char_length(x["found"])).alias("end")))

    return F.when(F.size(cut) > 1, _let(F.col(cut), placed)).otherwise(F.array().cast(_SPANS)).cast(_SPANS)


def _filled(cut: str, keep) -> Column:
    """The text cut up in ``cut``, matches that ``keep`` holds of filled over."""
    def part(x: Column) -> Column:
        cover = F.when(keep(x["value"]), F.repeat(F.lit(_FILL), F.char_length(x["found"]))).otherwise(x["found"])
        return F.concat(x["piece"], F.coalesce(cover, F.lit("")))

    whole = F.get(F.col(cut), F.lit(0))["piece"]
    return F.when(F.size(cut) == 1, whole).otherwise(F.array_join(F.transform(F.col(cut), part), ""))


def _long_value(value: Column) -> Column:
    return F.char_length(value) >= ASSIGN_LEAST


def _any(value: Column) -> Column:
    return value.isNotNull()


def ruled(docs: DataFrame) -> DataFrame:
    """The rules' matches (assign, access, hex) beside the columns of ``docs`` (text
    without nulls), and ``rest``, the text with their spans filled over.  A span that
    sticks out of another rule's leaves a stump that touches the filling."""
    # the character put for the filling's is in no rule, so nothing else changes
    text = F.when(F.contains("text", F.lit(_FILL)), F.translate("text", _FILL, "\u0002")).otherwise(F.col("text"))
    df = docs.withColumn("text", text)
    df = df.withColumns({"assign": _cut("text", FIND_ASSIGN, 2), "access": _cut("text", ACCESS), "hex": _cut("text", HEX)})
    # a text without the spans of one rule has the next rule's matches where they were
    df = df.withColumn("rest", _filled("assign", _long_value))
    df = df.withColumn("again", F.when(F.size("assign") == 1, F.col("access")).otherwise(_cut("rest", ACCESS)))
    df = df.withColumn("rest", _filled("again", _any))
    same = (F.size("assign") == 1) & (F.size("access") == 1)
    df = df.withColumn("again", F.when(same, F.col("hex")).otherwise(_cut("rest", HEX)))
    return df.withColumn("rest", _filled("again", _any)).drop("again", "text")


def _runs(least: int) -> str:
    return f"[{_FILL}{CLASS}]{{{least},}}"


def _untouched(run: Column) -> Column:
    return run.isNotNull() & ~F.contains(run, F.lit(_FILL))


def _pairs(value: Column, fn) -> Column:
    """``fn`` of each pair of adjacent characters of ``value`` in lower case, as an array
    of arrays, one for each PIECE characters (and the character after them)."""
    pieces = F.zip_with(F.regexp_extract_all(value, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)),
                        F.regexp_extract_all(value, F.lit(f"(?s).{{1,{PIECE}}}(?=(.?))"), F.lit(1)), lambda a, b: F.concat(a, b))

    def of(chars: Column) -> Column:
        return F.zip_with(F.slice(chars, F.lit(1), F.size(chars) - 1), F.slice(chars, F.lit(2), F.size(chars)), fn)

    return F.transform(pieces, lambda p: _let(F.regexp_extract_all(F.lower(p), F.lit("(?s)."), F.lit(0)), of))


def _cell(a: Column, b: Column) -> Column:
    return (F.ascii(a) - _FIRST) * _SPAN + F.ascii(b) - _FIRST


def training_samples(docs: DataFrame, strings: int = SAMPLE_STRINGS, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """(value, is_random), distinct: the strings that the rules find (values of
    assignments only with 16 characters and a digit), the ``strings`` of least digest;
    and the identifiers outside of the rules' finds in the ``texts`` distinct texts of
    least digest."""
    plain = docs.select(F.col("text")).where("text is not null")
    seen = ruled(plain)
    of = lambda name: F.transform(F.filter(name, lambda x: x["found"].isNotNull()), lambda x: x["value"])
    named = F.filter(of("assign"), lambda v: (F.char_length(v) >= LEAST) & v.rlike("[0-9]"))
    secret = (seen.select(F.explode(F.concat(named, of("access"), of("hex"))).alias("value")).distinct()
              .orderBy(F.md5("value"), "value").limit(strings))
    digest = F.md5("text")
    edge = plain.select(digest.alias("d")).distinct().orderBy("d").limit(texts).agg(F.max("d").alias("edge")).first().edge
    some = ruled(plain.where(digest <= F.lit(edge)))
    words = F.filter(F.regexp_extract_all("rest", F.lit(_runs(ORDINARY_LEAST)), F.lit(0)),
                     lambda r: _untouched(r) & r.rlike(ORDINARY))
    plain_words = some.select(F.explode(words).alias("value")).distinct()
    return secret.select("value", F.lit(True).alias("is_random")).union(plain_words.select("value", F.lit(False).alias("is_random")))


def ratios(samples: DataFrame, prior: float = PRIOR) -> DataFrame:
    """(cell, ratio): for each pair of characters + to z (in lower case), the log of its probability
    after its first character among ``samples`` (value, is_random) that are random,
    over that among the others, in micro-nats."""
    cell = F.explode(F.flatten(_pairs(F.col("value"), _cell))).alias("cell")
    counts = samples.select("is_random", cell).groupBy("cell").agg(
        F.count_if("is_random").alias("r"), F.count_if(~F.col("is_random")).alias("o"))
    grid = samples.sparkSession.range(_SPAN * _SPAN).select(F.col("id").cast("int").alias("cell"))
    rows = (grid.join(F.broadcast(counts), "cell", "left")  # both at most _SPAN squared
            .select("cell", F.floor(F.col("cell") / _SPAN).alias("a"), F.coalesce("r", F.lit(0)).alias("r"),
                    F.coalesce("o", F.lit(0)).alias("o")))
    of = rows.groupBy("a").agg(F.sum("r").alias("all_r"), F.sum("o").alias("all_o"))

    def log_p(n: str, whole: str) -> Column:
        return F.log((F.col(n) + prior) / (F.col(whole) + prior * LETTERS))

    return rows.join(of, "a").select("cell", F.round(1e6 * (log_p("r", "all_r") - log_p("o", "all_o"))).cast("int").alias("ratio"))


def fit(samples: DataFrame, prior: float = PRIOR) -> list[int]:
    """The ratios of all cells, in order."""
    return [r.ratio for r in ratios(samples, prior).orderBy("cell").collect()]


def secrets(docs: DataFrame, model: list[int], threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access, n_hex,
    base_sha256 and spans; spans are ``kind:start:end`` in code points, end
    exclusive, by start, then kind, comma-joined.

    The rules' spans are whole matches.  The models add, as ``random``, runs of at
    least 16 letters, digits and ``+/_=-`` that neither overlap nor touch a rule's
    span and score ``threshold`` or more.  A null text is empty: no spans, the digest
    of an empty string.  Repeated rows give repeated rows; extra columns are ignored;
    an empty table gives no rows.  Whole texts are scanned."""
    prepare(docs.sparkSession)
    score = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")  # folded to a constant

    def looks_random(run: Column) -> Column:
        sums = F.transform(_pairs(run, lambda a, b: F.get(score, _cell(a, b))),
                           lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda s, x: s + x))
        return _untouched(run) & (F.aggregate(sums, F.lit(0).cast("long"), lambda s, x: s + x) >= threshold)

    df = ruled(docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")))
    df = df.withColumn("random", _cut("rest", _runs(LEAST)))
    keep = {"assign": _long_value, "access": _any, "hex": _any, "random": looks_random}
    df = df.select("doc_id", *(_spans(name, i, keep[name]).alias(name) for i, name in enumerate(KINDS)))

    def written(spans: Column) -> Column:
        kind = F.array(*map(F.lit, KINDS))
        return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
            ":", F.get(kind, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.concat("assign", "access", "hex")
    return df.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
                     F.sha2(written(base), 256).alias("base_sha256"), written(F.concat(base, "random")).alias("spans"))


def op12_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prepare(spark)
    return secrets(docs, fit(training_samples(docs)))


def _cut_sql(rel: str, column: str, pattern: str, value: int = 0) -> str:
    quoted = pattern.replace("'", "''")
    return (f"select *, string_split_regex({column}, '{quoted}') as p, regexp_extract_all({column}, '{quoted}') as m, "
            f"regexp_extract_all({column}, '{quoted}', {value}) as v from {rel}")


def _spans_sql(rel: str, kind: int, keep: str) -> str:
    return (f"select rid, {kind} as kind, m[j] as found, v[j] as judged, s as start, s + length(m[j]) as stop from "
            "(select *, (list_sum(list_transform(p[1:j], lambda x: length(x))) + "
            "coalesce(list_sum(list_transform(m[1:j - 1], lambda x: length(x))), 0))::int as s from "
            f"(select *, unnest(range(1, len(m) + 1)) as j from {rel})) where {keep.replace('VALUE', 'v[j]')}")


def _filled_sql(rel: str, keep: str, columns: str) -> str:
    return (f"select {columns}, array_to_string(list_transform(range(1, len(p) + 1), lambda j: p[j] || case when "
            f"{keep.replace('VALUE', 'v[j]')} then repeat(chr(1), length(m[j])) else coalesce(m[j], '') end), '') as rest from {rel}")


#: The rule's words in either case of ASCII only.
_ASSIGN_SQL = ASSIGN.replace("(password|passwd|secret|token|api_?key)", (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"))
_LONG_SQL, _ANY_SQL = f"length(VALUE) >= {ASSIGN_LEAST}", "VALUE is not null"

ORACLE_SQL = f"""
with docs as (select row_number() over () as rid, doc_id, text, translate(coalesce(text, ''), chr(1), chr(2)) as t from documents),
assigned as ({_cut_sql("docs", "t", _ASSIGN_SQL, 2)}),
accessed as ({_cut_sql("docs", "t", ACCESS)}),
hexed as ({_cut_sql("docs", "t", HEX)}),
base as (
  {_spans_sql("assigned", 0, _LONG_SQL)} union all
  {_spans_sql("accessed", 1, _ANY_SQL)} union all
  {_spans_sql("hexed", 2, _ANY_SQL)}),
rest1 as ({_filled_sql("assigned", _LONG_SQL, "rid, text")}),
rest2 as ({_filled_sql("(" + _cut_sql("rest1", "rest", ACCESS) + ")", _ANY_SQL, "rid, text")}),
rest3 as ({_filled_sql("(" + _cut_sql("rest2", "rest", HEX) + ")", _ANY_SQL, "rid, text")}),
random_values as (
  select distinct judged as value from base
  where kind > 0 or (length(judged) >= {LEAST} and regexp_matches(judged, '[0-9]'))
  order by md5(value), value limit {SAMPLE_STRINGS}),
edge as (select max(d) as edge from (select distinct md5(text) as d from docs where text is not null order by d limit {SAMPLE_TEXTS})),
ordinary_values as (
  select distinct value from (
    select unnest(regexp_extract_all(rest, '{_runs(ORDINARY_LEAST)}')) as value from rest3, edge where md5(text) <= edge)
  where not contains(value, chr(1)) and regexp_matches(value, '{ORDINARY}')),
samples as (select lower(value) as value, 1 as r from random_values union all select lower(value), 0 from ordinary_values),
counts as (
  select (ascii(value[i]) - {_FIRST}) * {_SPAN} + ascii(value[i + 1]) - {_FIRST} as cell, sum(r) as r, sum(1 - r) as o
  from (select value, r, unnest(range(1, length(value))) as i from samples) group by all),
grid as (
  select g.cell, coalesce(r, 0) as r, coalesce(o, 0) as o, sum(r) over w as all_r, sum(o) over w as all_o
  from (select unnest(range({_SPAN * _SPAN})) as cell) g left join counts c on g.cell = c.cell
  window w as (partition by g.cell // {_SPAN})),
ratio as (
  select cell, round(1e6 * (ln((r + {PRIOR}) / (coalesce(all_r, 0) + {PRIOR * LETTERS})) - ln((o + {PRIOR}) / (coalesce(all_o, 0) + {PRIOR * LETTERS}))))::bigint as ratio
  from grid),
runs as ({_spans_sql("(" + _cut_sql("rest3", "rest", _runs(LEAST)) + ")", 3, "not contains(VALUE, chr(1))")}),
pairs as (
  select found, (ascii(lower(found)[i]) - {_FIRST}) * {_SPAN} + ascii(lower(found)[i + 1]) - {_FIRST} as cell
  from (select found, unnest(range(1, length(found))) as i from (select distinct found from runs))),
scores as (select found, sum(ratio) as score from pairs join ratio on pairs.cell = ratio.cell group by found),
spans as (
  select rid, kind, start, stop from base union all
  select rid, kind, start, stop from runs join scores on runs.found = scores.found where score >= {THRESHOLD}),
listed as (
  select rid, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
         string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || start || ':' || stop, ',' order by start, kind, stop)
           filter (kind < 3) as base_spans,
         string_agg(['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start || ':' || stop, ',' order by start, kind, stop) as spans
  from spans group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join listed on docs.rid = listed.rid
"""
