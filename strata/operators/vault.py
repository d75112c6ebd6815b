"""Data Vault loads: hubs, links and satellites with md5 hash keys and
change hashes.  ``load_dts`` is always a parameter (never the clock inside
the plan, trap T1)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import hash_concat, hash_key, hashdiff
from strata.operators.keyed import latest


def _lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _meta(load_dts, record_source) -> list[Column]:
    out = []
    if load_dts is not None:
        out.append(_lit_or_col(load_dts).alias("load_dts"))
    out.append(F.lit(record_source).alias("record_source"))
    return out


def load_hub(stg: DataFrame, business_keys: Mapping[str, Column | str], hk: str,
             record_source: str, load_dts=None) -> DataFrame:
    """Distinct business keys plus their hash key (V1, V2).  NULL keys are
    not hub members.  ``business_keys`` maps output name -> column."""
    cols = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in business_keys.items()]
    names = list(business_keys)
    keys = stg.select(*cols).dropna(subset=names).distinct()
    return keys.select(hash_key(*names).alias(hk), *names, *_meta(load_dts, record_source))


def load_calendar(stg: DataFrame, date_col: str, as_of, record_source: str,
                  load_dts=None, hk: str = "date_hk", name: str = "business_date") -> DataFrame:
    """Calendar hub: distinct dates UNION the run date ``as_of`` (V3)."""
    dates = (stg.select(F.to_date(date_col).alias(name))
             .unionByName(stg.sparkSession.range(1).select(F.to_date(F.lit(as_of)).alias(name)))
             .dropna().distinct())
    return dates.select(hash_key(name).alias(hk), name, *_meta(load_dts, record_source))


def extend_hub(hub: DataFrame, new_rows: DataFrame, business_key: str) -> DataFrame:
    """Second-source hub extension (V4, S17): rows of ``new_rows`` whose
    business key the hub lacks; existing rows keep their record_source."""
    add = new_rows.dropDuplicates([business_key]).join(hub.select(business_key), business_key, "left_anti")
    return hub.unionByName(add.select(*hub.columns))


def link_from_members(df: DataFrame, member_hks: Sequence[str], link_hk: str,
                      record_source: str, load_dts=None, distinct: bool = True) -> DataFrame:
    """Link rows from a frame that already carries the member hash keys:
    link hash = md5 over the member hashes in order (V5, V6).  Callers whose
    members are distinct already (by raw keys, which shuffle less than
    hashes) pass ``distinct=False``: a projection."""
    members = df.select(*member_hks)
    return ((members.distinct() if distinct else members)
            .select(hash_concat(*member_hks).alias(link_hk), *member_hks,
                    *_meta(load_dts, record_source)))


def load_sat(stg: DataFrame, parent_hks: Mapping[str, Column], attrs: Sequence[str],
             record_source: str, load_dts=None, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Satellite rows with a hashdiff over ``attrs`` (V7).  ``extra`` columns
    (e.g. a percent change) are carried but not part of the hashdiff."""
    extra = extra or {}
    return stg.select(*[c.alias(n) for n, c in parent_hks.items()],
                      hashdiff(*attrs).alias("hashdiff"),
                      *[F.col(a) for a in attrs],
                      *[c.alias(n) for n, c in extra.items()],
                      *_meta(load_dts, record_source))


def changed_rows(sat: DataFrame, new: DataFrame, keys: Sequence[str], load_col: str = "load_dts",
                 tiebreak: Sequence[str] = ("hashdiff",)) -> DataFrame:
    """Rows of ``new`` to append to a satellite (V9): keys not seen before,
    or whose hashdiff differs from the latest stored row of the key."""
    cur = latest(sat.select(*keys, load_col, "hashdiff"), keys, [load_col, *tiebreak])
    cur = cur.select(*keys, F.col("hashdiff").alias("_cur_hd"))
    j = new.join(cur, on=list(keys), how="left")
    return j.filter(~F.col("hashdiff").eqNullSafe(F.col("_cur_hd"))).drop("_cur_hd")
