"""Staging decode of JSON payload shapes into typed rows.  Every payload row
is decoded independently (a generator per row), so decode is map-only.  A
matrix, an object map and a paged block are read from the whole payload in one
parse that keeps every digit of unquoted numbers (no re-serialised text).

A payload is accepted or rejected as a whole: :func:`payload_rejects` names
those without the wanted block and why.  Where an object holds a name twice the
last one counts: the functions that take a DataFrame tell its session so.  A
block built for another session falls back to a second parse of such text, which
reads unquoted numbers as doubles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import cast_failed, typed
from strata.functions.columns import let


def _last_name_wins(df: DataFrame) -> DataFrame:
    """``df``, in a session whose strict JSON parse takes the last of equal names."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df


def _lenient(payload: Column, path: str, ddl: str) -> Column:
    """The block at ``path`` (``$``, ``$.name``, ``$.name.name``) of text in which names
    may be repeated; NULL where the text is no JSON."""
    names = path.split(".")[1:]
    for name in reversed(names[1:]):
        ddl = f"struct<`{name}`: {ddl}>"
    top = f"`{names[0]}` {ddl}" if names else None
    parsed = F.from_json(payload, top if top else ddl)
    for name in names:
        parsed = parsed[name]
    return F.when(F.get_json_object(payload, "$").isNotNull(), parsed)


MATRIX_DDL = "struct<columns: array<string>, data: array<array<string>>>"


def matrix_block(payload: Column, path: str = "$") -> Column:
    """``{columns, data}`` at ``path`` of a payload; NULL if one of them is missing."""
    def read(v: Column) -> Column:
        block = F.struct(F.try_variant_get(v, f"{path}.columns", "array<string>").alias("columns"),
                         F.try_variant_get(v, f"{path}.data", "array<array<string>>").alias("data"))
        return F.when(v.isNull(), _lenient(payload, path, MATRIX_DDL) if path != "$" else
                      F.when(F.get_json_object(payload, "$").isNotNull(),
                             F.from_json(payload, "columns array<string>, data array<array<string>>"))).otherwise(block)

    return let(let(F.try_parse_json(payload), read),
               lambda b: F.when(b["columns"].isNotNull() & b["data"].isNotNull(), b))


def object_entries(payload: Column, value_ddl: str, member: str | None = None) -> Column:
    """``[(key, value), ..]`` of an object map, each key once; NULL for other shapes."""
    ddl = f"map<string, struct<{value_ddl}>>"
    parsed = F.from_json(payload, f"`{member}` {ddl}")[member] if member else F.from_json(payload, ddl)

    def last_ones(entries: Column) -> Column:
        placed = F.array_sort(F.transform(entries, lambda e, i: F.struct(e["key"].alias("k"), i.alias("i"))))
        last = let(placed, lambda p: F.filter(p, lambda x, j: F.get(p, j + 1).isNull() | (F.get(p, j + 1)["k"] != x["k"])))
        return F.transform(F.array_sort(F.transform(last, lambda x: x["i"])), lambda i: F.get(entries, i))

    def once(entries: Column) -> Column:
        keys = F.transform(entries, lambda e: e["key"])
        return F.when(F.size(F.array_distinct(keys)) < F.size(entries), last_ones(entries)).otherwise(entries)

    return let(F.map_entries(parsed), once)


def payload_rejects(df: DataFrame, payload: str, block: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The payloads whose ``block`` (:func:`matrix_block`, :func:`object_entries`,
    :func:`observations_array`, :func:`cube`) is NULL, with the reason: ``empty``,
    ``not JSON`` or ``other shape``.  Together with the decoded rows they account for
    every payload; map-only."""
    text = F.col(payload)
    reason = (F.when(text.isNull() | (F.trim(text) == ""), F.lit("empty"))
              .when(F.get_json_object(text, "$").isNull(), F.lit("not JSON")).otherwise(F.lit("other shape")))
    return _last_name_wins(df).filter(block.isNull()).select(*keep, text.alias(payload), reason.alias("reason"))


def decode_matrix(df: DataFrame, payload: Column, fields: Mapping[str, tuple[str, str]],
                  keep: Sequence[str] = (), key: str | None = None, safe: bool = False,
                  pos_name: str | None = None, path: str = "$") -> DataFrame:
    """Header-and-matrix block ``{columns:[..], data:[[..],..]}`` (J2, J4) at
    ``path`` of the JSON text ``payload``; a payload without it gives no rows and
    is one of :func:`payload_rejects`.

    ``fields`` maps output name -> (header name, type).  A field's position
    is looked up in the header by name; a header that is absent yields NULL.
    Blank strings become NULL before the cast.  Rows whose ``key`` field is
    NULL are dropped."""
    m = _last_name_wins(df).select(*keep, matrix_block(payload, path).alias("_b"))
    m = m.select(*keep, F.col("_b.data").alias("_data"),
                 *[(F.array_position("_b.columns", F.lit(header)).cast("int") - 1).alias(f"_at_{i}")
                   for i, (header, _) in enumerate(fields.values())])
    # header positions are found once per payload, before its rows are exploded
    m = m.select(*keep, *[f"_at_{i}" for i in range(len(fields))], F.posexplode("_data").alias("_pos", "_row"))
    out = []
    for i, (name, (_, dtype)) in enumerate(fields.items()):
        raw = F.get(F.col("_row"), F.col(f"_at_{i}"))
        out.append((raw if dtype == "string" else typed(raw, dtype, safe=safe)).alias(name))
    res = m.select(*keep, *([F.col("_pos").cast("int").alias(pos_name)] if pos_name else []), *out)
    if key:
        res = res.filter(F.col(key).isNotNull())
    return res


def explode_object(df: DataFrame, col: Column, value_ddl: str, keep: Sequence[str] = (),
                   key_name: str = "key", member: str | None = None) -> DataFrame:
    """Object map ``{KEY: {..}, ..}``: one row per key (J6), of equal keys the last.
    ``col`` is the map's own text, or the whole payload when ``member`` names the
    map in it."""
    return (df.select(*keep, F.inline(object_entries(col, value_ddl, member)).alias(key_name, "_v"))
            .select(*keep, key_name, "_v.*"))


def union_constant(df: DataFrame, group_cols: Sequence[str], row: Mapping[str, Column]) -> DataFrame:
    """Add one constant member per group (J7), e.g. the base currency for
    every day.  Column types follow ``df``."""
    groups = df.select(*group_cols).distinct()
    types = dict(df.dtypes)
    const = groups.select(*group_cols, *[c.cast(types[n]).alias(n) for n, c in row.items()])
    return df.unionByName(const.select(*df.columns))


def zip_arrays(df: DataFrame, inner: Mapping[str, Column], left: Mapping[str, Column],
               keep: Sequence[str] = (), pos_name: str = "pos") -> DataFrame:
    """Parallel arrays joined by position (J8): inner on the ``inner`` arrays
    (cut to the shortest), left on the ``left`` arrays (a short left array
    is padded with NULL).  One generator instead of one join per array;
    ``arrays_zip`` pads to the longest, so every array is sliced first (T10)."""
    n = F.least(*[F.coalesce(F.size(c), F.lit(0)) for c in inner.values()]) if len(inner) > 1 \
        else F.coalesce(F.size(list(inner.values())[0]), F.lit(0))
    staged = df.select(*keep, *[c.alias(k) for k, c in {**inner, **left}.items()], n.alias("_n"))
    pos = F.slice(F.sequence(F.lit(1), F.greatest(F.col("_n"), F.lit(1))), 1, F.col("_n"))
    arrays = [pos.alias(pos_name)] + [F.slice(F.coalesce(F.col(k), F.array()), 1, F.col("_n")).alias(k)
                                      for k in [*inner, *left]]
    z = staged.select(*keep, F.arrays_zip(*arrays).alias("_z"))
    return z.select(*keep, F.inline("_z")).filter(F.col(pos_name).isNotNull())


OBS_DDL = "countryiso3code string, date string, value {vt}"
YEAR_RX = "^[0-9]{4}$"


def explode_observations(df: DataFrame, payload: str, keep: Sequence[str] = (),
                         value_type: str = "double") -> DataFrame:
    """``payload[1]`` -> (iso3, yr, val) for observations with a four-digit
    year and a non-null value (J10)."""
    return (df.select(*keep, F.explode(observations_array(df, payload, value_type)).alias("o"))
            .filter(F.col("o.date").rlike(YEAR_RX) & F.col("o.value").isNotNull())
            .select(*keep, F.col("o.countryiso3code").alias("iso3"),
                    F.col("o.date").cast("int").alias("yr"), F.col("o.value").alias("val")))


def join_series(obs: DataFrame, on: Sequence[str], series: str, value: str, names: Mapping[str, str]) -> DataFrame:
    """Series of one long table side by side (J11): a row per ``on`` that all of
    ``names`` (output column -> name in column ``series``) have a value for.  One
    aggregate instead of a self join; of a series' values for one ``on`` the
    largest counts."""
    sides = [F.max(F.when(F.col(series) == name, F.col(value))).alias(out) for out, name in names.items()]
    return obs.filter(F.col(series).isin(list(names.values()))).groupBy(*on).agg(*sides).dropna(subset=list(names))


def observations_array(df: DataFrame, payload: str, value_type: str = "double") -> Column:
    """Second element of a ``[meta, [obs..]]`` payload; NULL for other shapes."""
    _last_name_wins(df)
    text, kind = F.col(payload), f"array<struct<{OBS_DDL.format(vt=value_type)}>>"
    # read as an array of texts where names are repeated: the second text, then its own parse
    second = F.from_json(F.get(F.from_json(text, "array<string>"), F.lit(1)), kind)
    return let(F.try_parse_json(text), lambda v: F.when(
        v.isNull(), F.when(F.get_json_object(text, "$").isNotNull(), second)).otherwise(F.try_variant_get(v, "$[1]", kind)))


JSONSTAT_DDL = ("id array<string>, size array<int>, "
                "dimension map<string, struct<category: struct<index: map<string,int>, "
                "label: map<string,string>>>>, value map<string,{vt}>")


def cube(payload: str, value_type: str = "decimal(38,18)") -> Column:
    """A JSON-stat document; NULL if its dimensions, sizes or values are missing."""
    return let(F.from_json(F.col(payload), JSONSTAT_DDL.format(vt=value_type)), lambda j: F.when(
        j["id"].isNotNull() & (F.size(j["id"]) == F.size(j["size"])) & j["dimension"].isNotNull() & j["value"].isNotNull(), j))


def jsonstat_periods(df: DataFrame, payload: str, keep: Sequence[str] = (), dim: str = "time") -> DataFrame:
    """Keys of ``dimension.<dim>.category.label`` (J12, period keys)."""
    labels = F.from_json(F.get_json_object(F.col(payload), f"$.dimension.{dim}.category.label"),
                         "map<string,string>")
    return df.select(*keep, F.explode(F.map_keys(F.coalesce(labels, F.create_map()))).alias("period"))


def jsonstat_flatten(df: DataFrame, payload: str, keep: Sequence[str] = (), dims: Sequence[str] | None = None,
                     value_type: str = "decimal(38,18)") -> DataFrame:
    """Sparse JSON-stat cube -> one row per value with its dimension codes
    (J12 flatten): flat_index, a column per dimension named in ``dims`` (without
    ``dims``: ``dims``, a map dimension -> code), value.

    A flat index is a number in mixed radix whose digits are the categories.  The
    strides and the category codes by position are arrays built once per cube;
    each value then takes one division and one array access per dimension.
    Values are read as ``value_type``, with all its digits."""
    codes = F.expr("""transform(_j.id, d -> element_at(transform(array(array_sort(transform(
            map_entries(_j.dimension[d].category.index), e -> struct(e.value AS at, e.key AS code)))), s ->
        if(size(s) = 0 or (s[0].at = 0 and s[size(s) - 1].at = size(s) - 1), transform(s, x -> x.code),
           transform(sequence(0, s[size(s) - 1].at), p -> get(filter(s, x -> x.at = p), 0).code))), 1))""")
    strides = F.expr("""transform(_j.id, (d, i) -> aggregate(slice(_j.size, i + 2, greatest(size(_j.id) - i - 1, 0)),
                                                   CAST(1 AS BIGINT), (a, x) -> a * x))""")
    # the arrays first, the values in a step of their own: above the generator an
    # expression would be computed for every value
    j = (df.select(*keep, cube(payload, value_type).alias("_j"))
         .select(*keep, F.col("_j.id").alias("_id"), F.col("_j.size").alias("_size"), codes.alias("_codes"),
                 strides.alias("_strides"), F.col("_j.value").alias("_value"))
         .select(*keep, "_id", "_size", "_codes", "_strides", F.explode("_value").alias("_k", "value")))
    index = F.col("_k").cast("bigint")

    def code(i: Column) -> Column:
        digit = F.call_function("div", index, F.get("_strides", i)) % F.get("_size", i)
        return F.get(F.get("_codes", i), digit.cast("int"))

    if dims is None:
        out = [F.map_from_arrays("_id", F.transform("_id", lambda d, i: code(i))).alias("dims")]
    else:
        out = [code(F.array_position("_id", F.lit(d)).cast("int") - 1).alias(d) for d in dims]
    return j.select(*keep, index.alias("flat_index"), *out, "value")


def split_typed(df: DataFrame, types: Mapping[str, str], keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Typed cast with a reject table (J4 option): ``(typed, rejects)``.
    ``typed`` has every column of ``types`` cast blank -> NULL, and holds
    only rows whose every value casts; ``rejects`` holds the other rows with
    their text and the names of the failing columns.  One map-only pass each,
    no job failure on bad text."""
    failed = F.filter(F.array(*[F.when(cast_failed(c, t), F.lit(c)) for c, t in types.items()]),
                      lambda x: x.isNotNull())
    marked = df.withColumn("_failed", failed)
    good = marked.filter(F.size("_failed") == 0).select(
        *keep, *[typed(c, t, safe=True).alias(c) for c, t in types.items()])
    bad = marked.filter(F.size("_failed") > 0).select(
        *keep, *[F.col(c).cast("string").alias(c) for c in types], F.col("_failed").alias("failed_columns"))
    return good, bad
