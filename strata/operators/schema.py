"""Schema sync on append (D11): align an incoming frame with an existing
table by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sync_schema(existing: DataFrame, incoming: DataFrame, drop_removed: bool = False) -> DataFrame:
    """Union by name; columns missing on either side are NULL.  With
    ``drop_removed`` the columns the incoming frame no longer has are cut
    from the result (``sync_all_columns``)."""
    out = existing.unionByName(incoming, allowMissingColumns=True)
    if drop_removed:
        out = out.select(*incoming.columns)
    return out
