"""Keyed pick: one row per key chosen by an ordering (latest snapshot, latest
per day, preferred variant, latest satellite row, keep-first dedupe).

All forms are one ``groupBy(keys).agg(max_by/min_by(struct(*), order))``.
That aggregate combines map-side, so a hot key (a third of all rows) is
reduced inside every map task before the shuffle and reaches the reducer as
one partial row per task -- unlike ``row_number()`` over a window, which
ships every row of the hot key to a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def pick_one(df: DataFrame, keys: Sequence, order: Sequence, keep: str = "last") -> DataFrame:
    """One row per ``keys``: the row with the largest (``keep='last'``) or the
    smallest (``keep='first'``) ``order`` tuple.  ``order`` should end in a
    unique column so ties are decided the same way on every run.

    ``keys`` may be expressions (e.g. ``to_date(ts)``); they are added as
    columns ``_k0..`` only for the grouping and dropped again.
    """
    key_cols = _cols(keys)
    names = df.columns
    tmp_keys = [f"_k{i}" for i in range(len(key_cols))]
    staged = df.select(*[c.alias(k) for c, k in zip(key_cols, tmp_keys)],
                       F.struct(*names).alias("_row"),
                       F.struct(*[c for c in _cols(order)]).alias("_ord"))
    agg = F.max_by if keep == "last" else F.min_by
    if keep not in ("last", "first"):
        raise ValueError("keep must be 'last' or 'first'")
    return (staged.groupBy(*tmp_keys)
            .agg(agg("_row", "_ord").alias("_row"))
            .select("_row.*"))


def latest(df: DataFrame, keys: Sequence, order: Sequence) -> DataFrame:
    """Newest row per key (J1 latest snapshot, D1 latest satellite row)."""
    return pick_one(df, keys, order, keep="last")


def latest_per(df: DataFrame, key_expr, order: Sequence) -> DataFrame:
    """Newest row per derived key, e.g. one payload per calendar day (J5)."""
    return pick_one(df, [key_expr], order, keep="last")


def dedupe_keep_first(df: DataFrame, keys: Sequence, order: Sequence) -> DataFrame:
    """Retro-dedupe (S4): keep the row with the smallest ``order`` per key."""
    return pick_one(df, keys, order, keep="first")


def pick_preferred(df: DataFrame, keys: Sequence, variant: str, preferred: str,
                   tiebreak: Sequence = ()) -> DataFrame:
    """One row per key preferring ``variant == preferred``, then the smallest
    variant (J3).  Ordering follows the reference database: ``(v = pref)
    DESC`` puts a NULL variant *first* (NULLs first on DESC, trap T2), then
    ``v ASC`` with NULLs last.  Text order is binary (trap T3)."""
    v = F.col(variant)
    rank = (F.when(v.isNull(), F.lit(0))
            .when(v == F.lit(preferred), F.lit(1))
            .otherwise(F.lit(2)))
    order = [rank, v.isNull(), v, *_cols(tiebreak)]
    return pick_one(df, keys, order, keep="first")
