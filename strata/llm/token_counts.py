"""Token counts by byte-pair merging without emitting identifiers.

Each word starts as its UTF-8 bytes; the lowest-rank adjacent pair is popped
from a heap and its two symbols are unlinked and joined in a linked list until
no pair is left.  The count is the initial symbols minus the merges.  The job
is one narrow pass: no shuffle, and the text never leaves its task."""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import WordTable, default_path, vocabulary
from .common import arrow_rows, prepare, table

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                  ("over_limit", pa.bool_())])


@functools.lru_cache(maxsize=2)
def _counts(path: str) -> WordTable:
    voc = vocabulary(path)

    def count(word: str) -> int:
        data = word.encode()
        return len(data) - voc.merge(data)[1]

    return WordTable(count, most=1_000_000)


def count_text(text: str, path: str) -> int:
    """Tokens of one text; special strings inside it count as one token."""
    voc, table_ = vocabulary(path), _counts(path)
    parts = voc.split.split(text)
    return len(parts) - 1 + sum(sum(map(table_.__getitem__, voc.scanner(p).findall(p))) for p in parts)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 1024) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens,
    over_limit (n_tokens > limit).

    A null text counts as empty: 0 bytes, 0 tokens.  Null ids, repeated rows
    and extra columns pass through untouched or are ignored; an empty table
    gives no rows."""
    prepare(docs.sparkSession)
    path = path or default_path()

    def count(cols):
        texts = [t or "" for t in cols[1]]
        n = [count_text(t, path) for t in texts]
        return cols[0], [len(t.encode()) for t in texts], n, [x > limit for x in n]

    return arrow_rows(docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")), count,
                      "doc_id long, n_bytes long, n_tokens long, over_limit boolean", _OUT)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
