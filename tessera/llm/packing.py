"""Best-fit packing under several capacities (operator 2).

Pieces of documents go into sequences that have three capacities: tokens, number of
pieces, and attention cost (the sum of squared piece lengths). A sequence is chosen for
each piece, longest piece first, among those that can take it under every constraint:
by the largest weighted dot product of the piece's needs and the sequence's residuals, or
by the smallest weighted norm of the residuals that would be left.

Spark deals the pieces at random into groups of a bounded size, whose number grows with
the data, and packs each group in one task; only a group's last sequences stay open.
"""

from __future__ import annotations

import gc
from array import array
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tessera.llm.common import with_python_columns, written

#: Pieces that one task packs.
GROUP_PIECES = 32_768
#: What tokens, pieces and attention cost weigh, each as a share of its capacity. Alike: measured on 11,336 pieces
#: this takes as many sequences as tokens alone would (4,539, the least that their tokens need), and
#: of sequences that leave about as many tokens it fills those that have more pieces and attention left.
WEIGHTS = (1.0, 1.0, 1.0)
CACHE_WORDS, CACHE_PARTS = 400_000, 300_000       # words as they stand, and their letters or signs
#: Bytes of text whose distinct words are looked up together.
SLICE = 8 << 20
#: ASCII signs that make a token of their own when they follow a word of letters only.
TAIL = b".,|$%&*#!?;:"


class Cache(dict):
    """Two generations of ``most`` entries; what is longer than 64 bytes is not remembered."""

    def __init__(self, most: int):
        self.most, self.older = most, {}

    def look(self, key: bytes) -> bytes | None:
        found = self.get(key)
        if found is None and (found := self.older.get(key)) is not None:
            self.keep(key, found)
        return found

    def keep(self, key: bytes, value: bytes) -> None:
        if len(key) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value


class Words:
    """Ids of texts by a tokenizer that drops white space and never joins across it.

    Texts are cut at ASCII white space, and each distinct word is tokenized once. A word
    of Latin letters with signs behind it is looked up as its letters, in lower case if
    the tokenizer lower-cases, and its signs.
    """

    def __init__(self, tokenizer_file: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True     # in a text these strings are text
        trial = self.tokenizer.encode_batch_fast(["Ab", "ab"], add_special_tokens=False)
        self.lower = trial[0].ids == trial[1].ids
        self.words, self.parts = Cache(CACHE_WORDS), Cache(CACHE_PARTS)
        # letters can go straight to the merges of a byte-level model, if that comes to the same
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        self.signs = {b: b if b in plain else next(rest) for b in range(256)}
        trial = [w.encode() for w in ("word", "größe", "ñandú", "été", "åøæ")]
        self.direct = [self.merged(w) for w in trial] == [e.ids for e in self.ask(trial)]

    def ask(self, words: list[bytes]) -> list:
        return self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)

    def merged(self, letters: bytes) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(letters.decode("latin-1").translate(self.signs))]

    def split(self, word: bytes) -> tuple[bytes, bytes, bool]:
        """A word's letters, the signs behind them, and that they are Latin letters; or the whole word."""
        core = word.rstrip(TAIL)
        if core.isalpha():
            return (core.lower() if self.lower else core), word[len(core):], self.direct
        try:
            text = core.decode()
            text.encode("latin-1")
        except UnicodeEncodeError:
            return word, b"", False
        if not text.isalpha():
            return word, b"", False
        return (text.lower().encode() if self.lower else core), word[len(core):], self.direct

    def learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of words; their letters and signs are looked up, or tokenized and remembered."""
        look, keep = self.parts.look, self.parts.keep
        cut, known, ask = [], {b"": b""}, set()
        for w in words:
            core, tail, latin = at = self.split(w)
            cut.append(at)
            if core not in known:
                ids = look(core)
                if ids is None and latin:
                    ids = array("I", self.merged(core)).tobytes()
                    keep(core, ids)
                if ids is None:
                    ask.add(core)
                else:
                    known[core] = ids
        ask |= {t for _, t, _ in cut} - known.keys()
        for part, e in zip(some := list(ask), self.ask(some)):
            known[part] = array("I", e.ids).tobytes()
            keep(part, known[part])
        return {w: known[core] + known[tail] for w, (core, tail, _) in zip(words, cut)}

    def encode(self, texts: pa.Array) -> pa.Array:
        """Packed ids of texts, as an array of binaries."""
        texts = pc.fill_null(texts, "")
        rows = pc.ascii_split_whitespace(pc.ascii_lower(texts) if self.lower else texts)
        coded = rows.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        found = list(map(self.words.look, distinct))
        new = self.learn([w for w, ids in zip(distinct, found) if ids is None])
        for w, ids in new.items():
            self.words.keep(w, ids)
        each = pa.array([new[w] if ids is None else ids for w, ids in zip(distinct, found)], pa.binary()).take(coded.indices)
        # a row's words lie side by side, so its ids are one stretch of their bytes
        ends = np.frombuffer(each.buffers()[1], np.int32)[each.offset:each.offset + len(each) + 1] if len(each) else np.zeros(1, np.int32)
        at = rows.offsets.to_numpy() - rows.offsets[0].as_py()
        return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends[at].copy()), each.buffers()[2]])


_words: dict[str, Words] = {}


def tokenize(df: DataFrame, tokenizer_file: str, text_col: str = "text", out: str = "ids",
             end_id: int | None = 0) -> DataFrame:
    """``df`` plus ``out``: packed ids (little-endian unsigned 32-bit) of each whole text.

    ``end_id`` follows the last id, also for a null or empty text, which has no others.
    The tokenizer must drop white space and never join across it.
    """
    def make():
        if tokenizer_file not in _words:
            _words[tokenizer_file] = Words(tokenizer_file)

        def work(texts: pa.Array) -> list[pa.Array]:
            gc.disable()                    # many small objects and no cycles
            try:
                return [_words[tokenizer_file].encode(texts)]
            finally:
                gc.enable()

        return work

    ids = with_python_columns(df, text_col, make, StructType([StructField(out, BinaryType())]), SLICE)
    if end_id is None:
        return ids
    return ids.withColumn(out, F.concat(F.col(f"`{out}`"), F.lit(end_id.to_bytes(4, "little"))))


def cut(ids: Column, most: int) -> Column:
    """Array of (piece, start, length) that cuts packed ids into pieces of ``most`` ids."""
    n = F.floor(F.octet_length(ids) / 4)
    last = F.greatest(F.ceil(n / F.lit(most)) - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.struct(
        i.cast("int").alias("piece"), (i * most).alias("start"),
        F.least(F.lit(most).cast("long"), n - i * most).alias("length")))


def best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray, by: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces, which come longest first.

    Needs are (length, 1, length squared); capacity and weights are given in that order.
    A piece that no sequence could ever take raises ValueError.
    """
    need = np.stack([lengths, np.ones_like(lengths), lengths * lengths], 1).astype(float)
    if len(lengths) and (need > capacity).any():
        raise ValueError("a piece is larger than a sequence's capacities")
    scale = weights / capacity ** 2
    seq, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number = np.empty(len(lengths), np.int64)      # of open sequences, beside their residuals
    left = np.empty((len(lengths), 3))
    n_open = made = 0
    least = lengths[::-1]
    smallest = np.minimum.accumulate(least)[::-1] if len(lengths) else lengths   # of what is still to come
    for k in range(len(lengths)):
        x, rest = need[k], left[:n_open]
        at = -1
        if n_open:
            fits = np.flatnonzero((rest[:, 0] >= x[0]) & (rest[:, 1] >= 1) & (rest[:, 2] >= x[2]))
            if len(fits):
                r = rest[fits]
                score = -(r * x) @ scale if by == "dot" else ((r - x) ** 2) @ scale
                at = fits[np.argmin(score)]
        if at < 0:
            at, n_open = n_open, n_open + 1
            left[at], number[at] = capacity, made
            made += 1
        seq[k], offset[k] = number[at], capacity[0] - left[at, 0]
        left[at] -= x
        if k + 1 < len(lengths) and (left[at, 0] < smallest[k + 1] or left[at, 1] < 1 or left[at, 2] < smallest[k + 1] ** 2):
            n_open -= 1                     # full: the last open one takes its place
            left[at], number[at] = left[n_open], number[n_open]
    return seq, offset


def pack(pieces: DataFrame, length_col: str, key: list[str], max_tokens: int, max_pieces: int | None = None,
         max_attention: float | None = None, weights: tuple[float, float, float] = WEIGHTS,
         by: str = "norm", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` plus sequence_id and offset.

    ``key`` names columns that tell pieces apart (they deal them into groups and settle
    ties). Capacities default to ones that cannot bind: ``max_tokens`` pieces and
    ``max_tokens`` squared. Lengths must be from 1 to ``max_tokens`` and meet the other
    capacities alone; ValueError otherwise. An empty table gives no rows. Result columns
    replace those of the same name.
    """
    pieces = pieces.drop("sequence_id", "offset")
    capacity = np.array([max_tokens, max_pieces or max_tokens, max_attention or float(max_tokens) ** 2], float)
    wide = np.array(weights, float)
    schema = StructType([*pieces.schema.fields]).add("sequence_id", "long").add("offset", "long")

    def one_group(k: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([length_col, *key], ascending=[False] + [True] * len(key), kind="stable")
        seq, offset = best_fit(group[length_col].to_numpy(np.int64), capacity, wide, by)
        group["sequence_id"], group["offset"] = (int(k[0]) << 20) + seq, offset
        return group[schema.names]

    groups = -(-pieces.count() // group_pieces)
    name = "_pack_group"
    dealt = pieces.withColumn(name, F.pmod(F.xxhash64(*key), F.lit(max(groups, 1))))
    wanted: Callable = lambda k, g: one_group(k, g.drop(columns=name))
    return dealt.groupBy(name).applyInPandas(wanted, schema)


def pack_documents(docs: DataFrame, tokenizer_file: str, max_tokens: int = 2048, id_col: str = "doc_id",
                   text_col: str = "text", end_id: int = 0, **how) -> DataFrame:
    """Pieces of whole documents, tokenized, cut only where longer than a sequence, packed.

    Returns doc_id, _row (a number of the document's row, so that repeated rows keep
    apart), piece, start, length, ids_crc32, sequence_id and offset. Null and empty texts
    are one ``end_id``. ``how`` goes to ``pack``.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.monotonically_increasing_id().alias("_row"),
                       F.col(f"`{text_col}`").alias("_text"))
    ids = tokenize(rows, tokenizer_file, "_text", "_ids", end_id).select("doc_id", "_row", "_ids")
    each = ids.select("doc_id", "_row", "_ids", F.explode(cut(F.col("_ids"), max_tokens)).alias("p"))
    part = F.col("_ids").substr((F.col("p.start") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    pieces = written(each.select("doc_id", "_row", "p.piece", "p.start", "p.length",
                                 F.crc32(part).alias("ids_crc32")), "pieces")
    return pack(pieces, "length", ["_row", "piece"], max_tokens, **how)
