"""SentencePiece BPE encoding and decoding by vectorised merge rounds (operator 13).

The distinct words of a slice of texts that are not remembered stand in flat numpy arrays,
one entry a symbol. A round finds each segment's best pair (the highest score), merges all
its leftmost non-overlapping places at once, looks up the pairs that this makes, and closes
the gaps; segments without a pair leave, until none is left.

Two things make the rounds give what merging one pair at a time would give. A merge may make
a pair that is as good as the one at hand or better, which would come before the places
further right: such a round ends for that segment there. And two neighbours whose joined
text no piece contains can never be merged across, whatever happens: there a word falls into
segments of its own, which keeps rounds few for words of any length.

The model file is a parameter; nothing is trained here.
"""

from __future__ import annotations

import codecs

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tessera.llm.common import with_python_columns

#: The sign that stands for a space in pieces.
SPACE_SIGN = "▁"
#: Words (in each of two generations) that a Python worker remembers, the longest it does, and words looked up at once.
CACHE_WORDS, CACHE_CHARS, TOGETHER = 250_000, 64, 1 << 16
#: Bytes of texts that stand in arrays at a time.
SLICE = 2 << 20
#: Kinds of pieces as the model file numbers them.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: What a pair of neighbours can be besides the piece they make: parts of some piece, or parts of none.
PART, APART = -1, -2
LAST_CHAR = 0x110000

codecs.register_error("replace_each", lambda e: ("�" * (e.end - e.start), e.end))


class Codec:
    """Encoder and decoder of one model: BPE with byte fallback, no normalisation but spaces."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, spec = model.normalizer_spec, model.trainer_spec
        kinds = [p.type for p in model.pieces]
        if spec.model_type != spec.BPE or not spec.byte_fallback or spec.treat_whitespace_as_suffix \
                or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces \
                or not {*kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: only BPE models with byte fallback, without normalisation and own or unused pieces")
        self.prefix = " " if norm.add_dummy_prefix else ""
        self.end_id = spec.eos_id
        self.byte = np.zeros(256, np.int32)
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
        pieces = {p.piece.replace(SPACE_SIGN, " "): i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self._fit(pieces, np.array([p.score for p in model.pieces]))
        self.surface = [{NORMAL: p.piece.replace(SPACE_SIGN, " ").encode(), UNKNOWN: spec.unk_surface.encode(), CONTROL: b""}.get(p.type)
                        or (bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"") for p in model.pieces]
        self.kinds = kinds
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _fit(self, pieces: dict[str, int], scores: np.ndarray) -> None:
        """Tables of characters, neighbours and ranks."""
        self.size = len(scores)
        chars = sorted({c for p in pieces for c in p})
        symbols = dict(pieces)
        for c in chars:                     # a character without a piece of its own may still be part of one
            symbols.setdefault(c, self.size + ord(c))
        self.symbol = np.arange(LAST_CHAR, dtype=np.int32) + self.size
        for c in chars:
            self.symbol[ord(c)] = symbols[c]
        parts = {p[a:b] for p in pieces for a in range(len(p)) for b in range(a + 2, len(p) + 1)}
        self.base = self.size + LAST_CHAR
        pairs = {}
        for t in parts:
            made = pieces.get(t, PART)
            for k in range(1, len(t)):
                a = symbols.get(t[:k])
                b = symbols.get(t[k:])
                if a is not None and b is not None:
                    pairs[a * self.base + b] = made
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([*map(pairs.__getitem__, self.keys.tolist()), APART], np.int32)
        ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.never = np.int32(len(scores))
        self.rank = np.concatenate([ranks, [self.never, self.never]]).astype(np.int32)     # for APART and PART
        # characters that some piece holds side by side
        linked = sorted({c for t in parts if len(t) == 2 for c in t})
        self.place = np.zeros(LAST_CHAR, np.int32)
        for i, c in enumerate(linked, 1):
            self.place[ord(c)] = i
        self.width = len(linked) + 1
        self.beside = np.zeros(self.width * self.width, bool)
        for t in parts:
            if len(t) == 2:
                self.beside[self.place[ord(t[0])] * self.width + self.place[ord(t[1])]] = True
        # spaces: if only runs of them hold two, and all runs have one score that is the worst, long runs
        # are eaten from the left in whole longest runs, and can be cut there
        runs = {len(p) for p in pieces if not p.strip(" ")} - {1}
        same = {ranks[pieces[" " * n]] for n in runs}
        self.run = 0
        if runs and same == {max(ranks[i] for i in pieces.values())} and not any("  " in p for p in pieces if p.strip(" ")):
            n = max(runs)
            if self._merge([" " * (4 * n)]) == [np.full(4, pieces[" " * n], "<i4").tobytes()]:
                self.run = n

    def _look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or PART, or APART."""
        key = a.astype(np.int64) * self.base + b
        at = np.searchsorted(self.keys, key)
        found = self.keys[np.minimum(at, len(self.keys) - 1)] == key if len(self.keys) else np.zeros(len(key), bool)
        return self.made[np.where(found, at, -1)]

    def _merge(self, words: list[str]) -> list[bytes]:
        """Packed ids (little-endian 32-bit) of each word."""
        text = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        first = np.cumsum(lengths) - lengths
        sym = self.symbol[text]
        out = np.full(len(sym), -1, np.int32)
        pos = np.arange(len(sym))
        to = np.full(len(sym), APART, np.int32)     # of the pair that begins at a symbol
        to[:-1] = self._look(sym[:-1], sym[1:])
        to[first[1:] - 1] = APART
        while len(sym):
            last = to == APART
            head = np.empty(len(sym), bool)
            head[0], head[1:] = True, last[:-1]
            starts = np.flatnonzero(head)
            rank = self.rank[to]
            best = np.minimum.reduceat(rank, starts)
            each = np.repeat(best, np.diff(starts, append=len(sym)))
            hit = np.flatnonzero((rank == each) & (rank < self.never))
            if len(hit):
                at, codes, made = self._places(hit, sym, to, rank, head, last)
                sym[at] = made
                to[at] = codes[1]
                left = ~head[at]
                to[at[left] - 1] = codes[0][left]   # an absorbed symbol may get one too: it leaves
            stay = each < self.never
            gone = ~stay
            out[pos[gone]] = sym[gone]
            if len(hit):
                stay[at + 1] = False
            pos, sym, to = pos[stay], sym[stay], to[stay]
        whole = out >= 0
        ids, sizes = out[whole], np.add.reduceat(whole, first) if len(first) else first
        if (ids >= self.size).any():                # characters without a piece: their bytes
            wide = [self.byte[list(chr(i - self.size).encode("utf-8", "surrogatepass"))] if i >= self.size else [i] for i in ids.tolist()]
            many = np.fromiter(map(len, wide), np.int64, len(wide))
            sizes = np.add.reduceat(many, np.cumsum(sizes) - sizes)
            ids = np.concatenate(wide)
        packed, ends = ids.astype("<i4").tobytes(), (np.cumsum(sizes) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def _places(self, hit, sym, to, rank, head, last):
        """Where this round merges, the pairs that it makes to the left and right there, and the new symbols."""
        n = np.arange(len(hit))
        fresh = np.empty(len(hit), bool)
        fresh[0], fresh[1:] = True, np.diff(hit) != 1
        at = hit[(n - np.maximum.accumulate(np.where(fresh, n, 0))) % 2 == 0]     # leftmost, not overlapping
        made, now = to[at], rank[at]
        touch = np.zeros(len(at), bool)             # the place before ends where this one begins
        touch[1:] = (at[1:] == at[:-1] + 2) & ~head[at[1:]]
        before = np.where(touch, np.roll(made, 1), sym[at - 1])
        left = np.where(head[at], APART, self._look(before, made))
        right = np.where(last[at + 1], APART, self._look(made, sym[np.minimum(at + 2, len(sym) - 1)]))
        early = (self.rank[left] <= now) | (self.rank[right] <= now)
        if early.any():                             # such a pair comes before all places further right
            segment = np.cumsum(head)[at]
            seen = np.cumsum(early) - early
            opens = np.empty(len(at), bool)
            opens[0], opens[1:] = True, segment[1:] != segment[:-1]
            keep = seen == np.maximum.accumulate(np.where(opens, seen, 0))
            at, made, left, right, touch = at[keep], made[keep], left[keep], right[keep], touch[keep]
        follows = np.flatnonzero(touch)
        right[follows - 1] = left[follows]
        return at, (left, right), made

    def cuts(self, text: str, starts: np.ndarray) -> np.ndarray:
        """Ends of the words of ``text``: wherever no piece can reach across, and before each of ``starts``."""
        code = np.frombuffer(text.encode("utf-32-le"), "<u4")
        place = self.place[code]
        cut = np.empty(len(code), bool)
        cut[-1] = True
        cut[:-1] = ~self.beside[place[:-1] * self.width + place[1:]]
        cut[starts[starts > 0] - 1] = True
        if self.run and " " * (2 * self.run) in text:
            blank = np.concatenate([[False], code == ord(" "), [False]])
            edge = np.flatnonzero(blank[1:] != blank[:-1])
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                inside = [a, *(starts[(starts > a) & (starts < b)].tolist() if b - a >= 2 * self.run else ()), b]
                for x, y in zip(inside, inside[1:]):
                    cut[np.arange(x + self.run, y - self.run + 1, self.run) - 1] = True
        return np.flatnonzero(cut) + 1

    def _remember(self, words: list[str]) -> None:
        """See that every word is in ``self.words``."""
        miss = set(words) - self.words.keys()
        again = miss & self.older.keys()
        self.words.update((w, self.older[w]) for w in again)
        new = list(miss - again)
        if new:
            self.words.update(zip(new, self._merge(new)))

    def _forget(self, words: list[str]) -> None:
        for w in {w for w in words if len(w) > CACHE_CHARS}:
            del self.words[w]
        if len(self.words) > CACHE_WORDS:
            self.older, self.words = self.words, {}

    def encode(self, texts: list[str | None], end: bool) -> list[bytes]:
        """Packed ids of each text, with the end id if ``end``."""
        tail = np.array([self.end_id], "<i4").tobytes() if end else b""
        ready = [self.prefix + t.replace(SPACE_SIGN, " ") if t else "" for t in texts]
        stops = np.cumsum(np.fromiter(map(len, ready), np.int64, len(ready)))
        whole = "".join(ready)
        if not whole:
            return [tail] * len(texts)
        ends = self.cuts(whole, stops[:-1][stops[:-1] < len(whole)])
        last = np.searchsorted(ends, stops, side="right").tolist()     # words up to the end of each text
        out = [bytearray() for _ in ready]
        row = done = 0
        for a in range(0, len(ends), TOGETHER):
            block = ends[a:a + TOGETHER].tolist()
            words = [whole[x:y] for x, y in zip([int(ends[a - 1]) if a else 0, *block], block)]
            self._remember(words)
            get, stop = self.words.__getitem__, a + len(words)
            while done < stop or (row < len(out) and last[row] <= done):
                here = min(last[row], stop)
                out[row] += b"".join(map(get, words[done - a:here - a]))
                done = here
                if last[row] > stop or (last[row] == stop and row + 1 == len(out)):
                    break
                row += last[row] <= done
            self._forget(words)
        return [bytes(x) + tail for x in out]

    def decode(self, ids: list[int] | None) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD each, one space at the start goes."""
        ids = ids or []
        data = b"".join(map(self.surface.__getitem__, ids))
        lead = next((i for i in ids if self.kinds[i] != CONTROL), None)
        if self.prefix and lead is not None and self.kinds[lead] == NORMAL and self.surface[lead][:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace_each")


_codecs: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    """One codec for each worker process, with what it remembers."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(df: DataFrame, model_file: str, text_col: str = "text", out: str = "ids", end: bool = True) -> DataFrame:
    """``df`` plus ``out`` (array<int>): the ids of each whole text, and the end id if ``end``.

    A null or empty text has no ids but that one. Rows are independent: repeated rows give
    repeated results, an empty table gives none. A column of ``df`` named ``out`` gives way;
    all others stay.
    """
    def make():
        codec = _codec(model_file)

        def work(texts: pa.Array) -> list[pa.Array]:
            packed = codec.encode(texts.to_pylist(), end)
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))]

        return work

    return with_python_columns(df, text_col, make, StructType([StructField(out, ArrayType(IntegerType()))]), SLICE)


def decode(df: DataFrame, model_file: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` plus ``out``: the text that ids stand for; null or no ids give an empty text.

    Control ids give nothing. A null id, or one outside the vocabulary, raises an error.
    """
    def make():
        codec = _codec(model_file)
        return lambda ids: [pa.array([codec.decode(x) for x in ids.to_pylist()], pa.string())]

    return with_python_columns(df, ids_col, make, StructType([StructField(out, StringType())]), SLICE)
