"""Byte-level BPE encoding and decoding (operator 10).

A pre-token is a doubly linked list of byte tokens. Every adjacent pair that the
vocabulary can merge stands in the bucket of its merge rank; a two-level bitmap marks the
buckets that hold something, so that find-first-set gives the next rank in constant time.
Positions within a bucket leave from left to right; an entry whose pair has changed
meanwhile is stale and skipped. The work is O(n log n) in the length of a pre-token, also
for one of many MB without any white space.

Rank files and the pre-token pattern are parameters; nothing is trained here.
"""

from __future__ import annotations

import base64
import re
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from tessera.llm.common import with_python_columns

#: Pre-tokens (in each of two generations) and byte pairs that one Python worker remembers, and the
#: longest pre-token it does.
CACHE_WORDS, CACHE_PAIRS, CACHE_CHARS = 450_000, 500_000, 64
#: A letter, a digit, a white space and a sign that no pattern singles out, as Unicode has had them for long.
STAND_INS = {r"\p{L}": "\u2135", r"\p{N}": "\u00b2", r"\s": "\u2003", "": "\u2603"}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def newer_characters(ranks: dict[bytes, int]) -> dict[int, str]:
    """Characters that the regex module and tiktoken's engine class differently.

    The two know different versions of Unicode. Each such character is given a stand-in
    of the class it has for tiktoken, so that one pattern splits both ways alike.
    """
    import regex
    import tiktoken
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    differ: set[str] = set()
    theirs: dict[str, set[str]] = {}
    for cls in filter(None, STAND_INS):
        engine = tiktoken.Encoding("class", pat_str=cls, mergeable_ranks=ranks, special_tokens={})
        theirs[cls] = set(engine.decode_bytes(engine.encode_ordinary(every)).decode())
        differ |= theirs[cls] ^ set(regex.findall(cls, every))
    return {ord(x): STAND_INS[next((c for c, own in theirs.items() if x in own), "")] for x in differ}


def ranges(points: list[int]) -> str:
    """A character class's inside for sorted code points."""
    runs: list[list[int]] = []
    for x in points:
        if runs and x == runs[-1][1] + 1:
            runs[-1][1] = x
        else:
            runs.append([x, x])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


class Codec:
    """Encoder and decoder of one vocabulary, with bounded caches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None):
        import regex
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.single = [ranks.get(bytes([i])) for i in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pattern = regex.compile(pattern) if pattern else None
        self.newer: dict[int, str] | None = None

    def pair(self, a: int, b: int) -> int:
        """Rank of the pair's bytes joined, -1 if the vocabulary has no such token."""
        r = self.pairs.get((a, b))
        if r is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            r = self.pairs[a, b] = self.ranks.get(self.token[a] + self.token[b], -1)
        return r

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids = [self.single[x] for x in piece]
        n, pair, known = len(ids), self.pair, self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = [-1] * n                     # of the pair that begins at a position
        buckets: dict[int, list[int]] = {}
        top, blocks = 0, {}                 # a bit for each block in use; of each block, one for each of 256 ranks

        def put(r: int, i: int) -> None:
            nonlocal top
            q = buckets.get(r)
            if q:
                heappush(q, i)
            else:
                buckets[r] = [i]
                hi = r >> 8
                top |= 1 << hi
                blocks[hi] = blocks.get(hi, 0) | 1 << (r & 255)

        for i, key in enumerate(zip(ids, ids[1:])):
            r = known(key)
            if r is None:
                r = pair(*key)
            if r >= 0:
                rank[i] = r
                q = buckets.get(r)
                if q is None:
                    buckets[r] = [i]
                    hi = r >> 8
                    top |= 1 << hi
                    blocks[hi] = blocks.get(hi, 0) | 1 << (r & 255)
                else:
                    q.append(i)             # from left to right: a heap as it is
        while top:
            hi = (top & -top).bit_length() - 1
            bits = blocks[hi]
            r = (hi << 8) + (bits & -bits).bit_length() - 1
            q = buckets[r]
            i = heappop(q)
            if not q:
                bits &= bits - 1
                blocks[hi] = bits
                if not bits:
                    top &= top - 1
            if rank[i] != r:
                continue                    # stale: that pair is gone
            j = after[i]
            k = after[j]
            ids[i], ids[j], rank[j], after[i] = r, -1, -1, k
            new = -1
            if k < n:
                before[k] = i
                new = known((r, ids[k]))
                if new is None:
                    new = pair(r, ids[k])
                if new >= 0:
                    put(new, i)
            rank[i] = new
            p = before[i]
            if p >= 0:
                new = known((ids[p], r))
                if new is None:
                    new = pair(ids[p], r)
                if new != rank[p]:
                    rank[p] = new
                    if new >= 0:
                        put(new, p)
        return [x for x in ids if x >= 0]

    def word(self, w: str) -> bytes:
        packed = self.older.get(w)
        if packed is None:
            ids = self.merge(w.encode())
            packed = pack(f"<{len(ids)}I", *ids)
        if len(w) <= CACHE_CHARS:
            if len(self.words) >= CACHE_WORDS:
                self.older, self.words = self.words, {}
            self.words[w] = packed
        return packed

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        try:
            text.encode("latin-1")          # the quickest test: these have been the same for ever
            return self.pattern.findall(text)
        except UnicodeEncodeError:
            pass
        if self.newer is None:
            self.newer = newer_characters(self.ranks)
            self.rare = re.compile("[" + ranges(sorted(self.newer)) + "]") if self.newer else None
        if self.rare and self.rare.search(text):
            return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.newer))]
        return self.pattern.findall(text)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        seen, word = self.words.get, self.word
        out = []
        for w in self.split(text or ""):
            packed = seen(w)
            if packed is None:
                packed = word(w)
                seen = self.words.get
            out.append(packed)
        return b"".join(out)

    def decode(self, packed: bytes | None) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(packed or b"", "<u4").tolist()))


_codecs: dict[tuple, Codec] = {}


def _codec(path: str, pattern: str | None) -> Codec:
    """One codec for each worker process, with what it remembers."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(load_ranks(path), pattern)
    return _codecs[path, pattern]


def encode(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``df`` plus ``out``: the packed ids (little-endian unsigned 32-bit) of each whole text.

    A null or empty text has no ids (empty binary). Rows are independent: repeated rows
    give repeated results. A column of ``df`` named ``out`` gives way to the ids; all others stay.
    """
    def make():
        codec = _codec(rank_file, pattern)
        return lambda texts: [pa.array([codec.encode(t) for t in texts.to_pylist()], pa.binary())]

    return with_python_columns(df, text_col, make, StructType([StructField(out, BinaryType())]))


def decode(df: DataFrame, rank_file: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` plus ``out``: the bytes that packed ids stand for; null ids give no bytes.

    An id outside the vocabulary raises KeyError.
    """
    def make():
        codec = _codec(rank_file, None)
        return lambda ids: [pa.array([codec.decode(x) for x in ids.to_pylist()], pa.binary())]

    return with_python_columns(df, ids_col, make, StructType([StructField(out, BinaryType())]))
