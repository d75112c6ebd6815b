"""The corpus pipeline: each stage works on all that its predecessor kept.
Part of the training-data subpackage; every stage calls one of its operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe_codec, decontaminate, langid, simhash, suffix_dedup
from strata.llm.common import discard, prepare, release, saved, table


def _begin(spark: SparkSession) -> None:
    """Each stage's input is a written table: what the stage before held is freed."""
    prepare(spark)
    release()


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and texts without a letter."""
    _begin(spark)
    return langid.identified(docs, langid.fit(langid.training_rows(docs)))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near duplicates."""
    _begin(spark)
    return simhash.one_per_group(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every repeated 200-byte string out of the texts."""
    _begin(spark)
    return suffix_dedup.without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    _begin(spark)
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes each text and decodes it again: doc_id, n_tokens and digests."""
    _begin(spark)
    return bpe_codec.round_trip(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]

#: No stage but the last could be written in DuckDB SQL (trained model, BK-trees,
#: suffix names, MinHash); the pipeline is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; each stage's rows are written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, saved(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
        discard(before)  # not the documents: only folders that ``saved`` wrote
    return STAGES[-1][1](spark, docs, sf_dir)
