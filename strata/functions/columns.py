"""Scalar column rules: percent change, banding, blank-to-NULL typing and
secret masking in URL query strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_change(last, prev, scale: int | None = 4) -> Column:
    """NULL when prev is NULL or 0 or last is NULL, else
    ``round((last - prev) / prev * 100, scale)`` (HALF_UP)."""
    last, prev = _col(last), _col(prev)
    raw = (last - prev) / prev * F.lit(100)
    val = F.round(raw, scale) if scale is not None else raw
    return F.when(prev.isNull() | (prev == 0) | last.isNull(), F.lit(None)).otherwise(val)


def band(c, edges: Sequence, labels: Sequence[str]) -> Column:
    """First label whose upper edge is above the value (``c < edge``);
    anything else, NULL included, gets the last label (trap T16)."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    c = _col(c)
    expr = None
    for e, lab in zip(edges, labels):
        expr = F.when(c < F.lit(e), F.lit(lab)) if expr is None else expr.when(c < F.lit(e), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def typed(c, dtype: str, safe: bool = False) -> Column:
    """``NULLIF(text, '')::type``.  With ANSI on a bad value fails the job, as
    in the reference; ``safe=True`` turns it into NULL instead (find those
    rows with :func:`cast_failed`)."""
    t = F.nullif(_col(c).cast("string"), F.lit(""))
    return t.try_cast(dtype) if safe else t.cast(dtype)


def cast_failed(c, dtype: str) -> Column:
    """True when the text is neither NULL nor blank and does not cast to
    ``dtype`` -- the rows ``typed(.., safe=True)`` would silently null."""
    t = F.nullif(_col(c).cast("string"), F.lit(""))
    return t.isNotNull() & t.try_cast(dtype).isNull()


# Parameter names whose values are masked in logged URLs.
SENSITIVE_EXACT = ("api_key", "token", "password", "secret", "authorization")
SENSITIVE_SUFFIXES = ("_key", "_token", "_secret", "_password")
MASK = "***"


def _sensitive_key_regex(extra_keys: Sequence[str] = ()) -> str:
    exact = [*SENSITIVE_EXACT, *[k.lower() for k in extra_keys]]
    alts = "|".join(exact) + "|[^&=#]*(?:" + "|".join(SENSITIVE_SUFFIXES) + ")"
    return f"^(?:{alts})$"


def mask_params(url, extra_keys: Sequence[str] = ()) -> Column:
    """Mask the values of sensitive query parameters in a URL column.

    The query string (between ``?`` and ``#``) is split into ``k=v`` pairs;
    a pair whose lower-cased key is sensitive gets ``k=***``.  Parameter
    order, key case and the fragment are kept.
    """
    url = _col(url)
    rx = _sensitive_key_regex(extra_keys)
    # the fragment goes first: a "?" inside it starts no query string
    page = F.substring_index(url, "#", 1)
    query = F.regexp_extract(page, r"\?(.*)$", 1)
    pairs = F.split(query, "&")
    masked = F.transform(
        pairs,
        lambda p: F.when(
            F.lower(F.split_part(p, F.lit("="), F.lit(1))).rlike(rx) & p.contains("="),
            F.concat(F.split_part(p, F.lit("="), F.lit(1)), F.lit("=" + MASK)),
        ).otherwise(p),
    )
    new_query = F.array_join(masked, "&")
    return F.when(page.contains("?"),
                  F.concat(F.substring_index(page, "?", 1), F.lit("?"), new_query,
                           F.substring(url, F.length(page) + 1, F.length(url))))\
        .otherwise(url)


def let(value: Column, fn) -> Column:
    """``fn`` of ``value``, computed once however often ``fn`` names it: an expression
    that a lambda refers to is computed for every element."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))
