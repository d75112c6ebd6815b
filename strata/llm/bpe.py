"""Byte-pair merging with a heap of adjacent pairs over a linked list of
symbols, and the pre-tokenizer of a byte-level vocabulary file."""

from __future__ import annotations

import functools
import heapq
import json
import re

import regex

#: Words kept with their merges, per Python worker; the table is emptied when full.
WORD_CACHE = 200_000
#: Longer words are merged but not kept.
CACHED_CHARS = 48

_SHIFT = 20
_LOW = (1 << _SHIFT) - 1
_POS = 40
_POS_LOW = (1 << _POS) - 1
#: Words of at most so many bytes are merged over a plain list.
_SHORT = 32
_NO_PAIR = 1 << 29


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: itself if it is a visible Latin-1
    character, else the next free code point from 256."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = {}, 256
    for b in range(256):
        if b in visible:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return out


#: Letters, numbers and white space (Unicode properties) below U+0100.
_LETTERS, _NUMBERS, _SPACES = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", \
    "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\\x09-\\x0d\\x20\\x85\\xa0"
#: The pre-tokenizer on such text only, for the faster standard scanner.
_LATIN_WORDS = re.compile(
    f" ?[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")


class Vocabulary:
    """A byte-level BPE file of the tokenizers library, as plain tables."""

    def __init__(self, path: str):
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, letters = spec["model"]["vocab"], _byte_letters()
        back = {c: b for b, c in letters.items()}
        self.byte_id = [ids[letters[b]] for b in range(256)]
        self.pairs = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            self.pairs[ids[left] << _SHIFT | ids[right]] = rank << _SHIFT | ids[left + right]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.token_bytes = [b""] * size
        for tok, i in ids.items():
            self.token_bytes[i] = bytes(back[c] for c in tok)
        for tok, i in self.special.items():
            self.token_bytes[i] = tok.encode()
        self.split = regex.compile(
            "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        # \s here means the Unicode property (Python's own \s has more)
        self.words = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}"))

    def scanner(self, text: str):
        """The compiled pattern to read the words of ``text`` with."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.words
        return _LATIN_WORDS

    def merge(self, data: bytes) -> tuple[list[int], int]:
        """Symbols left after all merges of one word, and the number of merges."""
        byte_id, get = self.byte_id, self.pairs.get
        sym = [byte_id[b] for b in data]
        n = len(sym)
        if n < 2:
            return sym, 0
        heap = []
        for i in range(n - 1):
            p = get(sym[i] << _SHIFT | sym[i + 1])
            if p is not None:
                heap.append((p >> _SHIFT) << _POS | i)
        if not heap:
            return sym, 0
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pop, push, merges = heapq.heappop, heapq.heappush, 0
        while heap:
            x = pop(heap)
            i = x & _POS_LOW
            a = sym[i]
            if a < 0:
                continue
            j = after[i]
            if j >= n:
                continue
            p = get(a << _SHIFT | sym[j])
            if p is None or p >> _SHIFT != x >> _POS:
                continue  # the pair has changed since it was pushed
            merges += 1
            sym[i] = new = p & _LOW
            sym[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                p = get(new << _SHIFT | sym[k])
                if p is not None:
                    push(heap, (p >> _SHIFT) << _POS | i)
            h = before[i]
            if h >= 0:
                p = get(sym[h] << _SHIFT | new)
                if p is not None:
                    push(heap, (p >> _SHIFT) << _POS | h)
        return [s for s in sym if s >= 0], merges

    @functools.cached_property
    def _rows(self) -> tuple[list, list[int]]:
        """For each symbol, the lookup of the rank at which it merges with the one
        after it; for each rank, the symbol it makes."""
        rows, made = {}, [0] * (1 + max((p >> _SHIFT for p in self.pairs.values()), default=0))
        for pair, p in self.pairs.items():
            rows.setdefault(pair >> _SHIFT, {})[pair & _LOW] = p >> _SHIFT
            made[p >> _SHIFT] = p & _LOW
        none: dict = {}
        return [rows.get(i, none).get for i in range(len(self.token_bytes))], made

    def symbols(self, data: bytes) -> list[int]:
        """Symbols left after all merges of one word.  In a short word the lowest
        adjacent pair is found by reading through a list, which costs less than a heap."""
        if len(data) > _SHORT:
            return self.merge(data)[0]
        byte_id, (row, made) = self.byte_id, self._rows
        sym = [byte_id[b] for b in data]
        near = [row[a](b, _NO_PAIR) for a, b in zip(sym, sym[1:])]
        while near:
            rank = min(near)
            if rank == _NO_PAIR:
                break
            i = near.index(rank)
            sym[i] = new = made[rank]
            del sym[i + 1], near[i]
            if i < len(near):
                near[i] = row[new](sym[i + 1], _NO_PAIR)
            if i:
                near[i - 1] = row[sym[i - 1]](new, _NO_PAIR)
        return sym


class WordTable(dict):
    """word -> value of ``make(word)``, bounded, shared by a worker's tasks."""

    def __init__(self, make, most: int = WORD_CACHE):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word: str):
        value = self.make(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value


class AgingTable(WordTable):
    """A word table in two halves: the newer one, when full, takes the place of
    the older one, from which words still in use are taken over."""

    def __init__(self, make, most: int = WORD_CACHE):
        super().__init__(make, most)
        self.older: dict = {}

    def __missing__(self, word: str):
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= self.most // 2:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def default_path() -> str:
    """The vocabulary file the queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
