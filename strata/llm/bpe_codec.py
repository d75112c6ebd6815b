"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts each text into chunks that depend on the
content alone, so copies and shared passages yield the same chunks wherever
they stand.  A worker encodes each distinct chunk once and keeps it in a
bounded store.  A cut may fall inside a word, so every join is repaired: words
are re-read from the last boundary that the cut cannot have changed, until a
boundary agrees exactly with one of the next chunk; from there on the stored
encoding holds."""

from __future__ import annotations

import functools
import hashlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .bpe import AgingTable, default_path, vocabulary
from .common import arrow_rows, prepare, table

#: A chunk is at least MIN_CHUNK bytes and 2**CUT_BITS more on average.
MIN_CHUNK, CUT_BITS = 256, 10
#: Chunks kept per worker; the store is emptied when full.
CHUNK_STORE = 6_000
#: Words kept per worker with their ids.
WORDS = 300_000
#: Characters before a cut that a word's end must keep away to be beyond its
#: reach: the longest contraction, or white space and the character after it.
REACH = 3

_GEAR = np.random.default_rng(16).integers(0, 2**32, 256, dtype=np.uint32)
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                  ("decoded_sha256", pa.string())])


def cut_points(data: bytes) -> Iterator[int]:
    """Chunk ends in ``data``, its end included; cuts stand between characters."""
    n = len(data)
    if n > MIN_CHUNK:
        a = np.frombuffer(data, np.uint8)
        h = _GEAR[a]
        for step in (1, 2, 4, 8):  # the hash at i covers the 16 bytes before and at i
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        cut = h & np.uint32(((1 << CUT_BITS) - 1) << 6) == 0
        at = np.flatnonzero(cut[:-1] & ((a[1:] & 0xC0) != 0x80)) + 1
        last = 0
        for p in at.tolist():
            if p - last >= MIN_CHUNK:
                yield p
                last = p
    yield n


def _pack(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Codec:
    """Encodes and decodes texts with one vocabulary and one chunk store.

    The ids of words and chunks are kept as packed 32-bit integers, so that
    those of a text are joined without a step per id."""

    def __init__(self, path: str):
        self.voc = vocabulary(path)
        self.word = AgingTable(lambda w: _pack(self.voc.symbols(w.encode())), most=WORDS).__getitem__
        self.special = {s: _pack([i]) for s, i in self.voc.special.items()}
        self.store: dict[bytes, tuple[bytes, array, array]] = {}

    def chunk(self, data: bytes, text: str) -> tuple[bytes, array, array]:
        """Packed ids of a chunk, the end of each of its words and the bytes of ids up to it."""
        key = xxhash.xxh3_128_digest(data)
        found = self.store.get(key)
        if found is None:
            words = self.voc.scanner(text).findall(text)
            ids = list(map(self.word, words))
            if len(self.store) >= CHUNK_STORE:
                self.store.clear()
            found = self.store[key] = (b"".join(ids), array("I", accumulate(map(len, words))),
                                       array("I", accumulate(map(len, ids))))
        return found

    def _plain(self, text: str, out: list[bytes]) -> None:
        """Append the packed ids of a text without special strings."""
        data = text.encode()
        rest, wait, begin = "", 0, 0  # text from the last sure boundary on
        for cut in cut_points(data):
            piece, begin, last = data[begin:cut], cut, cut == len(data)
            here = piece.decode()
            if rest and not last and len(rest) + len(here) < wait:
                rest += here  # one very long word: read on before trying again
                continue
            ids, ends, upto = self.chunk(piece, here)
            first, base = 0, 0  # first word of the chunk that holds, its start
            if rest:
                joined, back = rest + here, len(rest)
                limit = len(joined) if last else len(joined) - REACH
                done, agreed = 0, False
                for m in self.voc.scanner(joined).finditer(joined):
                    if m.end() > limit:
                        break
                    out.append(self.word(m.group()))
                    done = m.end()
                    base = done - back
                    if base >= 0:
                        if base == 0:
                            agreed, first = True, 0
                            break
                        k = bisect_left(ends, base)
                        if k < len(ends) and ends[k] == base:
                            agreed, first = True, k + 1
                            break
                if not agreed:
                    rest = joined[done:]
                    wait = 2 * len(rest)
                    continue
            stop = len(ends) if last else bisect_left(ends, max(0, len(here) - REACH) + 1)
            if stop > first:
                out.append(ids[upto[first - 1] if first else 0:upto[stop - 1]])
                base = ends[stop - 1]
            rest, wait = here[base:], 0
        if rest:  # no boundary agreed in the last chunk
            out.extend(map(self.word, self.voc.scanner(rest).findall(rest)))

    def encode(self, text: str) -> list[int]:
        out: list[bytes] = []
        at = 0
        for m in self.voc.split.finditer(text):
            self._plain(text[at:m.start()], out)
            out.append(self.special[m.group()])
            at = m.end()
        self._plain(text[at:] if at else text, out)
        return array("I", b"".join(out)).tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.voc.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


@functools.lru_cache(maxsize=2)
def _decimal(path: str) -> list[str]:
    return [str(i) for i in range(len(vocabulary(path).token_bytes))]


def encode_docs(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int), decoded text: one row per row of ``docs``.

    A null text counts as empty and gives no ids; an empty table no rows."""
    prepare(docs.sparkSession)
    path = path or default_path()
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(cols):
        c = codec(path)
        ids = [c.encode(t or "") for t in cols[1]]
        return cols[0], ids, [c.decode(x) for x in ids]

    return arrow_rows(docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")), run,
                      "doc_id long, ids array<int>, decoded string", out)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 (lower-case hex): the
    ids joined by commas, and the decoded text in UTF-8.

    A null text counts as empty; null ids, ties, repeated rows and extra
    columns are kept or ignored as in ``encode_docs``.  The ids stay inside
    their task: no shuffle, nothing to the driver."""
    prepare(docs.sparkSession)
    path = path or default_path()

    def run(cols):
        c, dec = codec(path), _decimal(path).__getitem__
        n, a, b = [], [], []
        for t in cols[1]:
            ids = c.encode(t or "")
            n.append(len(ids))
            a.append(hashlib.sha256(",".join(map(dec, ids)).encode()).hexdigest())
            b.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
        return cols[0], n, a, b

    return arrow_rows(docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")), run,
                      "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", _OUT)


def op6_bpe_codec(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
