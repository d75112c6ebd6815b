"""Load modes as DataFrame algebra: first-wins append, snapshot replace,
upsert, insert-if-absent, change-event apply, default child rows.

Every function returns the rows to publish; ``strata.sources.layers`` turns
them into an atomic table version (parquet has no MERGE/DELETE, trap T8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.keyed import pick_one


DUPLICATE_KEYS = "duplicate keys in upsert input"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def append_first_wins(batch: DataFrame, target_keys: DataFrame, keys: Sequence[str],
                      order: Sequence) -> DataFrame:
    """Rows of ``batch`` to append under first-wins (S3): the first message
    per key inside the batch, and only for keys the target does not hold.

    The in-batch pick is a map-side-combined ``min_by``; the anti join
    against the target's key set is a shuffle on the key (AQE turns it into a
    broadcast only when the runtime key set is small)."""
    keys = _names(keys)
    first = pick_one(batch, keys, order, keep="first")
    return first.join(target_keys.select(*keys).distinct(), on=keys, how="left_anti")


def load_counts(batch: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: messages read, rows inserted, rows skipped; for an insert that has
    been made.  :func:`first_wins_counts` counts without one."""
    n_ins = inserted.agg(F.count(F.lit(1))).scalar()
    return (batch.agg(F.count(F.lit(1)).alias("read"))
            .select("read", n_ins.alias("inserted"), (F.col("read") - n_ins).alias("skipped")))


def first_wins_counts(batch: DataFrame, target_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: messages read, rows inserted, rows skipped by a first-wins load of
    ``batch``.  The keys of both sides meet in one aggregate: a key is inserted if
    only the batch has it."""
    keys = _names(keys)
    both = (batch.select(*keys, F.lit(1).alias("_read"), F.lit(0).alias("_held"))
            .unionAll(target_keys.select(*keys, F.lit(0), F.lit(1))))
    per_key = both.groupBy(*keys).agg(F.sum("_read").alias("_read"), F.max("_held").alias("_held"))
    return per_key.agg(F.coalesce(F.sum("_read"), F.lit(0)).alias("read"),
                       F.count_if((F.col("_held") == 0) & (F.col("_read") > 0)).alias("inserted")) \
        .select("read", "inserted", (F.col("read") - F.col("inserted")).alias("skipped"))


def replace_by_source(target: DataFrame, new: DataFrame, source_col: str, source) -> DataFrame:
    """Snapshot replace (S6): every row of one source is replaced by the new
    snapshot.  On a partitioned layer this is a static partition overwrite."""
    keep = target.filter(~F.col(source_col).eqNullSafe(F.lit(source)))
    fresh = new.filter(F.col(source_col).eqNullSafe(F.lit(source)))
    return keep.unionByName(fresh)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once (map-side combined count)."""
    keys = _names(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, which must not hold a key twice: the plan fails if it does (T17).
    One aggregate by key; no pass of its own."""
    keys = _names(keys)
    others = [c for c in df.columns if c not in keys]
    row = F.any_value(F.struct(F.lit(1).alias("_"), *others)).alias("_row")
    once = F.when(F.col("_n") > 1, F.raise_error(F.concat(
        F.lit(f"{DUPLICATE_KEYS}: "), F.to_json(F.struct(*keys))))).otherwise(F.col("_row"))
    got = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), row).withColumn("_row", once)
    return got.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert (S16): new rows win; target rows whose key is absent from
    ``new`` stay.  A key that ``new`` holds twice fails the plan (trap T17)."""
    keys = _names(keys)
    kept = target.join(new.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(unique_on(new, keys).select(*target.columns))


def insert_if_absent(target: DataFrame, new: DataFrame, keys: Sequence[str],
                     order: Sequence | None = None) -> DataFrame:
    """Rows of ``new`` whose key is not in ``target`` (S17, V4 -- the first
    writer keeps its row).  Duplicates inside ``new`` collapse to one row."""
    keys = _names(keys)
    cand = (pick_one(new, keys, order, keep="first") if order is not None
            else new.dropDuplicates(keys))
    return cand.join(target.select(*keys), on=keys, how="left_anti")


def rows_without_child(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                       defaults: Mapping[str, Column]) -> DataFrame:
    """One default child row per parent that has none (S13): ``NOT EXISTS``
    as a left-anti join, then a projection of the default columns."""
    lonely = parent.join(child.select(F.col(child_key).alias(parent_key)).distinct(),
                         on=parent_key, how="left_anti")
    return lonely.select(F.col(parent_key).alias(child_key),
                         *[c.alias(n) for n, c in defaults.items()])


# Change events ------------------------------------------------------------

def change_envelope_schema(row_ddl: str) -> str:
    """DDL of a change event value: ``before``/``after`` rows, ``op`` and the
    source position (Debezium's documented JSON envelope without schema)."""
    return (f"before struct<{row_ddl}>, after struct<{row_ddl}>, op string, "
            f"source struct<lsn: bigint>, ts_ms bigint")


def parse_changes(raw: DataFrame, value_col: str, row_ddl: str) -> DataFrame:
    """Decode change-event JSON; tombstones (NULL value) are dropped."""
    return (raw.filter(F.col(value_col).isNotNull())
            .select(F.from_json(F.col(value_col), change_envelope_schema(row_ddl)).alias("e"))
            .select("e.*"))


def keyed_changes(raw: DataFrame, value_col: str, row_ddl: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(events, rejects)`` of change-event JSON: events have the key columns,
    ``op``, the source position ``_pos`` and ``after`` (a truncate has no key);
    rejects hold the text of messages that are not JSON or lack a known op, a
    position or a key.  Tombstones (NULL value) are in neither."""
    e = F.from_json(F.col(value_col), change_envelope_schema(row_ddl))
    ev = (raw.filter(F.col(value_col).isNotNull()).select(F.col(value_col).alias("_text"), e.alias("_e"))
          .select("_text", *[F.coalesce(F.col(f"_e.after.{k}"), F.col(f"_e.before.{k}")).alias(k) for k in keys],
                  F.col("_e.op").alias("op"), F.col("_e.source.lsn").alias("_pos"), F.col("_e.after").alias("after")))
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    known = (F.col("op") == "t") | (F.col("op") == "d") & has_key | \
        F.col("op").isin("c", "u", "r") & has_key & F.col("after").isNotNull()
    good = F.coalesce(known, F.lit(False)) & F.col("_pos").isNotNull()
    return ev.filter(good).drop("_text"), ev.filter(~good).select(F.col("_text").alias(value_col))


def apply_changes(changes: DataFrame, keys: Sequence[str], order: str = "lsn") -> DataFrame:
    """Latest state per key (S12): the newest event per key by source
    position; a delete as newest event removes the key.  The key comes from
    ``after`` or, for deletes, from ``before``.  A truncate (op ``t``) removes
    all state of earlier positions; events without a key or an op (malformed)
    change nothing."""
    keys = _names(keys)
    cleared = changes.filter("op = 't'").agg(F.max(f"source.{order}")).scalar()
    ev = changes.select(
        *[F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in keys],
        F.col("op"), F.col(f"source.{order}").alias("_pos"), F.col("after"))
    ev = ev.filter((F.col("op") != "t") & (cleared.isNull() | (F.col("_pos") > cleared)))
    for k in keys:
        ev = ev.filter(F.col(k).isNotNull())
    last = pick_one(ev, keys, ["_pos"], keep="last")
    return last.filter(F.col("op") != F.lit("d")).select("after.*")
