"""All registered queries and their oracle SQL."""

from __future__ import annotations

import importlib

_MODULES = ["marts_q", "landing_q", "vault_q", "decode_q", "sinks_q", "feed_q", "quality_q"]


def _mods():
    return [importlib.import_module(f"strata.plans.{m}") for m in _MODULES]


def queries():
    out = {}
    for m in _mods():
        out.update(m.QUERIES)
    return out


def oracle_sql():
    from strata.plans.oracle import SQL
    out = dict(SQL)
    for m in _mods():
        out.update(getattr(m, "ORACLE", {}))
    return out
