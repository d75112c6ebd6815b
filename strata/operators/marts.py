"""Marts: previous-value windows, overview joins, reference-rate picks,
currency conversion, top-N reports, layer counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import pct_change  # noqa: F401  (re-exported)


def _cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_previous(df: DataFrame, keys: Sequence, order: Sequence, value: str,
                  prev_name: str = "prev_value") -> DataFrame:
    """Add the previous ``value`` of the same key (LAG).  Callers pre-aggregate
    to one row per (key, period) first, so a window partition holds at most
    one row per period however hot the key is."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn(prev_name, F.lag(value).over(w))


def top_n(df: DataFrame, by: Sequence, n: int) -> DataFrame:
    """Top-N report: ``orderBy(..).limit(n)`` plans as TakeOrderedAndProject,
    a per-partition heap of n rows merged on one task -- no full sort."""
    return df.orderBy(*_cols(by)).limit(n)


def overview(profile_latest: DataFrame, market_latest: DataFrame, on: str) -> DataFrame:
    """Latest profile per entity LEFT JOIN latest market row (D2)."""
    return profile_latest.join(market_latest, on=on, how="left")


def latest_value_date(sat: DataFrame, date_col: str, alias: str = "fx_date") -> DataFrame:
    """One-row DataFrame with MAX(date) over the satellite (D3); used as a
    scalar subquery later, never collected."""
    return sat.agg(F.max(date_col).alias(alias))


def rates_at(sat: DataFrame, code_col: str, date_col: str, load_col: str,
             picks: Mapping[str, str], value_cols: Sequence[str], fx_date: DataFrame,
             date_alias: str = "fx_date") -> DataFrame:
    """Reference-rate pick (D4): for each code in ``picks`` (code -> prefix),
    the newest load at the latest date, all codes in one aggregation pass
    with ``max_by(...) FILTER (WHERE code = ...)``.  An absent code gives
    NULLs.  The result is a single row (its size is bounded by construction).
    The date is a scalar subquery, so the satellite is filtered, not joined."""
    fx = fx_date.select(date_alias).scalar()
    at = sat.filter(F.col(date_col) == fx)
    aggs = []
    for code, prefix in picks.items():
        cond = F.col(code_col) == F.lit(code)
        for v in value_cols:
            aggs.append(F.max_by(F.when(cond, F.col(v)),
                                 F.when(cond, F.struct(F.col(load_col)))).alias(f"{prefix}_{v}"))
        # presence differs from a NULL value: the reference's per-code CTE
        # has no row at all when the code is absent
        aggs.append(F.coalesce(F.bool_or(cond), F.lit(False)).alias(f"{prefix}{PRESENT}"))
    return at.agg(*aggs).select(fx.alias(date_alias), "*")


PRESENT = "_present"


def convert(price, rate, nominal, scale: int = 6) -> Column:
    """``round(price / (rate / nominal), scale)``; NULL when rate is NULL or 0
    or price is NULL (D5)."""
    price, rate, nominal = _cols([price, rate, nominal])
    return (F.when(rate.isNull() | (rate == 0) | price.isNull(), F.lit(None))
            .otherwise(F.round(price / (rate / nominal), scale)))


def snapshot(overview_df: DataFrame, rates_row: DataFrame, on_missing: str = "empty") -> DataFrame:
    """Attach the one-row rate DataFrame to every overview row.  The
    reference cross-joins one-row CTEs, so a missing currency (its
    ``*_present`` flag from :func:`rates_at` is false) empties the mart
    (trap T11, ``on_missing='empty'``); ``'null'`` keeps rows with NULL rates.
    ``rates_row`` is one row by construction; it is attached as a scalar
    subquery (computed once, inlined as a value -- no join, no broadcast),
    and a second row would fail the query instead of multiplying the mart."""
    if on_missing not in ("empty", "null"):
        raise ValueError(on_missing)
    flags = [c for c in rates_row.columns if c.endswith(PRESENT)]
    vals = [c for c in rates_row.columns if c not in flags]
    r = rates_row.select(F.struct(*rates_row.columns)).scalar()
    out = overview_df.select("*", *[r[c].alias(c) for c in vals])
    if on_missing == "empty":
        ok = F.lit(True)
        for c in flags:
            ok = ok & F.coalesce(r[c], F.lit(False))
        out = out.filter(ok)
    return out


def layer_counts(tables: Mapping[str, DataFrame], layer: str = "layer") -> DataFrame:
    """Row count of each named table, one row per table (D13)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
