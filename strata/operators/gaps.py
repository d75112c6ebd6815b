"""Calendar gaps: which days / months / years have no landed data, per
entity, between a floor and a ceiling (swapped when inverted).

Days and months are kept as calendar bitmaps: 64 consecutive days (or months) of an
entity are the bits of one long, set by ``bit_or`` on the map side.  The input is
read once, for the bitmaps; bounds, coverage and gaps are then read off the
bitmaps and their complement, a few longs per entity and year.  Nothing is
collected: gap sets stay DataFrames and are joined by their consumers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir


def _calendar(df: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """(keys, ``_words``: map word -> bits, ``_lo``, ``_hi``: first and last position) of the
    whole numbers ``at`` per entity, NULLs left out.  Checkpointed (shared folder),
    since bounds and bits are both read from it: the input is scanned once."""
    words = (df.select(*keys, at.cast("long").alias("_at")).filter("_at is not null")
             .groupBy(*keys, F.shiftright("_at", 6).alias("_w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_at & 63 AS INT))")).alias("_bits"), F.min("_at").alias("_lo"),
                  F.max("_at").alias("_hi")))
    per = words.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_w", "_bits"))).alias("_words"),
                                   F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    ensure_checkpoint_dir(df.sparkSession)
    return per.checkpoint(eager=True)


def _bounded(cal: DataFrame, lo: Column | None, hi: Column | None) -> DataFrame:
    """Adds ``_a`` and ``_b``, the positions looked at: the given ones, or the first and
    last of all entities (a scalar subquery over the bitmaps), swapped when inverted."""
    ends = cal.agg((lo if lo is not None else F.min("_lo")).alias("_a"), (hi if hi is not None else F.max("_hi")).alias("_b"))
    both = ends.select(F.struct(F.least("_a", "_b").cast("long").alias("a"), F.greatest("_a", "_b").cast("long").alias("b"))).scalar()
    return cal.withColumns({"_a": both["a"], "_b": both["b"]})


def _looked_at(cal: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per entity and word of its bounds: ``_w``, ``_bits``, and ``_mask``, the bits
    inside the bounds."""
    rows = cal.select(*keys, "_words", "_a", "_b", F.explode(F.sequence(F.shiftright("_a", 6), F.shiftright("_b", 6))).alias("_w"))
    low = F.expr("shiftleft(-1L, CAST(greatest(_a - _w * 64, 0L) AS INT))")
    high = F.expr("shiftrightunsigned(-1L, CAST(63 - least(_b - _w * 64, 63L) AS INT))")
    return rows.select(*keys, "_w", F.coalesce(F.try_element_at("_words", F.col("_w")), F.lit(0).cast("long")).alias("_bits"),
                       low.bitwiseAND(high).alias("_mask"))


def _day(value) -> Column | None:
    return None if value is None else F.datediff(F.to_date(F.lit(value)), F.to_date(F.lit("1970-01-01")))


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def missing_dates(df: DataFrame, keys: Sequence[str], date_col: str, floor=None, ceiling=None,
                  name: str = "gap_date") -> DataFrame:
    """Days in [floor, ceiling] without a row, per entity (S8).  Bounds
    default to the data's own min/max date.

    The zero bits of each entity's day bitmap inside the bounds are its gaps.
    The work beyond the one scan grows with entities x bounds / 64 and the gaps;
    a hot entity is combined on the map side to a few longs per year."""
    keys = list(keys)
    epoch = F.to_date(F.lit("1970-01-01"))
    cal = _bounded(_calendar(df, keys, F.datediff(F.to_date(date_col), epoch)), _day(floor), _day(ceiling))
    free = _looked_at(cal, keys).withColumn("_free", F.expr("~_bits & _mask")).filter("_free <> 0")
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit("_free", b) == 1)).alias("_bit")
    return free.select(*keys, "_w", bit).select(*keys, F.date_add(epoch, (F.col("_w") * 64 + F.col("_bit")).cast("int")).alias(name))


def month_coverage(df: DataFrame, keys: Sequence[str], date_col: str, floor=None, ceiling=None,
                   cap: int | None = None) -> DataFrame:
    """Per entity: months needed in [floor, ceiling], months present, and the
    request size -- NULL when covered, else ``max(needed, 1)`` (S10).
    A ``cap`` limits one request; the caller then asks for the rest in further
    requests (``n_missing`` stays whole).  Present months are the bits of the
    entity's month bitmap inside the bounds."""
    keys = list(keys)
    ends = [None if x is None else _month(F.to_date(F.lit(x))) for x in (floor, ceiling)]
    cal = _bounded(_calendar(df, keys, _month(F.to_date(date_col))), *ends)
    agg = _looked_at(cal, keys).groupBy(*keys).agg(
        F.sum(F.bit_count("_mask")).cast("long").alias("n_needed"),
        F.sum(F.bit_count(F.col("_bits").bitwiseAND(F.col("_mask")))).cast("long").alias("n_present"))
    asked = F.greatest(F.col("n_needed"), F.lit(1))
    if cap is not None:
        asked = F.least(asked, F.lit(cap))
    return (agg.withColumn("n_missing", F.col("n_needed") - F.col("n_present"))
            .withColumn("covered", F.col("n_missing") == 0)
            .withColumn("request_periods",
                        F.when(~F.col("covered"), asked)))


YEAR_RX = "^[0-9]{4}$"


def missing_years(obs: DataFrame, keys: Sequence[str], year_col: str, value_col: str,
                  floor, ceiling) -> DataFrame:
    """Per entity, the years of [floor.year, ceiling.year] with no non-null
    observation (S9); only entities with something missing.  Request range =
    min..max of the missing years (it may span present years, trap T18)."""
    keys = list(keys)
    ok = obs.filter(F.col(year_col).cast("string").rlike(YEAR_RX) & F.col(value_col).isNotNull())
    present = ok.select(*keys, F.col(year_col).cast("int").alias("yr")).distinct()
    lo_y = F.year(F.to_date(F.lit(floor)))
    hi_y = F.year(F.to_date(F.lit(ceiling)))
    ents = obs.select(*keys).distinct()
    spine = ents.select(*keys, F.explode(F.sequence(F.least(lo_y, hi_y), F.greatest(lo_y, hi_y))).alias("yr"))
    miss = spine.join(present, on=[*keys, "yr"], how="left_anti")
    return miss.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_missing"),
                                   F.min("yr").alias("request_from"),
                                   F.max("yr").alias("request_to"))


def filter_nested(df: DataFrame, arr_col: str, years: Sequence[int], date_field: str = "date") -> DataFrame:
    """Keep array elements whose first four characters of ``date_field`` are a
    wanted year; drop the row when none is left; rows whose array is NULL
    (other payload shapes) pass through unchanged (S11)."""
    wanted = F.array(*[F.lit(int(y)) for y in years])
    kept = F.filter(F.col(arr_col),
                    lambda x: F.array_contains(wanted, F.substring(x[date_field], 1, 4).try_cast("int")))
    out = df.withColumn(arr_col, kept)
    return out.filter(F.col(arr_col).isNull() | (F.size(arr_col) > 0))
