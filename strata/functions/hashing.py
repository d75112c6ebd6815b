"""Hash keys and change hashes for hubs, links and satellites.

Text forms are what both Spark and an ANSI engine print for the same value:
decimals keep their scale, dates print ISO, booleans print ``true``/``false``.
Doubles do not print alike across engines, so callers cast money to DECIMAL
before hashing (trap T5).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c) -> Column:
    return _col(c).cast("string")


def hash_key(*cols) -> Column:
    """md5 of the business key as text; several columns are concatenated
    without a separator, as the reference does for composite keys."""
    if len(cols) == 1:
        return F.md5(as_text(cols[0]))
    return F.md5(F.concat(*[as_text(c) for c in cols]))


def hash_concat(*hash_cols) -> Column:
    """Link hash: md5 over the member hash keys concatenated in order."""
    return F.md5(F.concat(*[_col(c) for c in hash_cols]))


def hashdiff(*cols, sep: str = "|") -> Column:
    """Change hash: every attribute as text, NULL as '' (so NULL and '' hash
    alike, trap T14), joined by ``sep``.  Each column is coalesced first
    because ``concat_ws`` would otherwise skip NULLs and shift positions."""
    return F.md5(F.concat_ws(sep, *[F.coalesce(as_text(c), F.lit("")) for c in cols]))


def key_hash(c) -> Column:
    """Binary md5 of a text key, '' for NULL: ``decode(md5(coalesce(c,'')),'hex')``."""
    return F.unhex(F.md5(F.coalesce(as_text(c), F.lit(""))))
