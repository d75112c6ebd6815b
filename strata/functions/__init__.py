"""Column expressions shared by the operators (all built-in Spark functions,
so they stay inside whole-stage codegen)."""

from strata.functions.hashing import hash_key, hash_concat, hashdiff, key_hash, as_text
from strata.functions.columns import pct_change, band, typed, cast_failed, mask_params, MASK, SENSITIVE_EXACT, SENSITIVE_SUFFIXES

__all__ = [
    "hash_key", "hash_concat", "hashdiff", "key_hash", "as_text",
    "pct_change", "band", "typed", "cast_failed", "mask_params", "MASK", "SENSITIVE_EXACT", "SENSITIVE_SUFFIXES",
]
