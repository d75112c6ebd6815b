"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import corpus_pipeline

from .bpe_codec import op6_bpe_codec
from .decontaminate import op1_decontamination
from .katz import op5_katz
from .langid import op10_language_id
from .pivots import op8_pivot_embeddings
from .secret_scan import ORACLE_SQL as SECRET_SCAN_SQL
from .secret_scan import op12_secret_scan
from .sharding import op2_kd_sharding
from .simhash import op9_simhash
from .spelling import ORACLE_SQL as SPELLING_SQL
from .spelling import op13_spelling_variants
from .suffix_dedup import op7_suffix_dedup
from .token_counts import op3_token_counts
from .toxicity import op4_toxicity
from .vector_codes import ORACLE_SQL as VECTOR_CODES_SQL
from .vector_codes import op11_vector_codes

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_kd_sharding": op2_kd_sharding,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_katz": op5_katz,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_pivot_embeddings": op8_pivot_embeddings,
    "op9_simhash": op9_simhash,
    "op10_language_id": op10_language_id,
    "op11_vector_codes": op11_vector_codes,
    "op12_secret_scan": op12_secret_scan,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op11_vector_codes": VECTOR_CODES_SQL,
    "op12_secret_scan": SECRET_SCAN_SQL,
    "op13_spelling_variants": SPELLING_SQL,
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE_SQL)
