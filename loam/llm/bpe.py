"""Byte-level BPE encoding and decoding by a rank file.

Each match of the splitting pattern is merged on its own. The merge keeps a segment tree over the byte
positions of the match: a leaf holds the rank of the pair that begins at a live token, an inner node the
smallest rank of its FAN children, the leftmost one on ties. A merge takes the root and updates the leaves of
the merged token, of its dead right neighbour and of its live left neighbour, each in a logarithmic number
of steps; a match of n bytes takes O(n log n) however it is composed.

Texts are cut into units at blanks and line ends where a cut provably doesn't change the matches, and the ids
of a unit are kept in a cache of a bounded number of bytes, so a frequent word is merged once for each worker.

Defined results: null counts as empty and has no ids; nothing in a text is a special token; columns of the input
that bear the name of a result are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.textcodes import small_batches
from loam.session import ship

#: Bytes of units and ids that a worker remembers, the interpreter's share included; longer units aren't kept.
CACHE_BYTES, LONGEST_UNIT = 96 << 20, 256
#: What a unit costs besides its characters and ids: two objects and a place in a dictionary.
_ENTRY = 220
#: Children of a node of the segment tree: the smallest of so few is found fastest by looking at all.
FAN = 32
_NONE = 1 << 62
_PLACE = 40
_POSITION = (1 << _PLACE) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of lines "base64 rank"."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: merges the pair of lowest rank, the leftmost first, until no pair has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    n, rank_of = len(piece), ranks.get
    leaves = []
    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        leaves.append(_NONE if rank is None else rank << _PLACE | i)
    top, steps = leaves, []
    while len(top) > FAN:
        below, top = top, [min(top[k : k + FAN]) for k in range(0, len(top), FAN)]
        steps.append((below, top))

    def climb(i: int, value: int) -> None:
        leaves[i] = value
        for below, above in steps:
            i //= FAN
            value = min(below[i * FAN : i * FAN + FAN])
            if above[i] == value:
                return
            above[i] = value

    put = climb if steps else leaves.__setitem__
    end, before = list(range(1, n + 1)), list(range(-1, n))
    while (best := min(top)) != _NONE:
        i = best & _POSITION
        j = end[i]
        stop = end[i] = end[j]
        if stop < n:
            before[stop] = i
            rank = rank_of(piece[i : end[stop]])
            put(j, _NONE)
            put(i, _NONE if rank is None else rank << _PLACE | i)
        else:
            put(i, _NONE)
        if i:
            left = before[i]
            rank = rank_of(piece[left:stop])
            put(left, _NONE if rank is None else rank << _PLACE | left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


#: Before a blank or a line end that a character other than white space follows.
_CUT = regex.compile(r"(?=[ \n][^\s\x1c-\x1f])")


class UnitEncoder(dict):
    """Encodes texts unit by unit; a dictionary of unit to little-endian ids, of a bounded number of bytes.

    A text is cut before every blank or line end that is followed by a character other than white space. Such a cut
    keeps the matches: a run of white space before a non-blank always leaves its last character to what follows. The
    key of a unit is the unit, without the blank if it begins with one.

    Most texts have single blanks and line ends only; they are split at once. In others a part would begin with
    white space (None), and the cuts are searched for.
    Units seen lately survive in two generations of half the limit each.
    """

    def __init__(self, plain: Callable[[str], bytes], limit: int = CACHE_BYTES):
        super().__init__()
        self.plain, self.half, self.old, self.held = plain, limit // 2, {}, 0

    def __missing__(self, unit: str) -> bytes | None:
        ids = self.old.get(unit)
        if ids is None:
            body = unit[1:] if unit[:1] == "\n" else unit
            if not body or body[0].isspace():
                return None
            ids = self.plain(unit if unit[0] == "\n" else " " + unit)
            if len(unit) > LONGEST_UNIT:
                return ids
        self.held += _ENTRY + 4 * len(unit) + len(ids)
        if self.held >= self.half:
            self.old = self.copy()
            self.clear()
            self.held = _ENTRY + 4 * len(unit) + len(ids)
        self[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """All ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        first, *rest = text.replace("\n", " \n").split(" ")
        if first:
            parts = list(map(self.__getitem__, rest))
            if None not in parts:
                return self.plain(first) + b"".join(parts)
        first, *rest = _CUT.split(text)
        return self.plain(first) + b"".join(self[unit[1:] if unit[0] == " " else unit] for unit in rest)


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Codec:
    """Encodes and decodes texts by a rank file and a splitting pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.matches = regex.compile(pattern).findall
        self.encode = UnitEncoder(self._plain).encode

    def _plain(self, text: str) -> bytes:
        return packed([i for match in self.matches(text) for i in merge(match.encode(), self.ranks)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _renamed(df: DataFrame, source: str, results: tuple[str, ...]) -> tuple[DataFrame, str, list[str], list[str]]:
    """df with its columns, but for those named as results, as c0, c1, ... and the source as t; their schema as the
    beginning of a text; the new names; the old names."""
    kept = [c for c in df.columns if c not in results]
    names = [f"c{i}" for i in range(len(kept))]
    plain = df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)), F.col(f"`{source}`").alias("t"))
    return plain, "".join(f"{f.name} {f.dataType.simpleString()}, " for f in plain.schema.fields[:-1]), names, kept


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", names: tuple[str, str] = ("ids", "lossless")) -> DataFrame:
    """docs with an array<int> of ids and whether they decode to the text's bytes.

    Defined results: null and empty texts have no ids and are lossless; columns named as the two results are replaced;
    an empty table gives an empty one.
    """
    ship(docs.sparkSession)
    plain, schema, inner, kept = _renamed(docs, text_col, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for whole in batches:
            for batch in small_batches(whole, "t"):
                texts = [x or "" for x in batch.column("t").to_pylist()]
                codes = [own.encode(x) for x in texts]
                same = [own.decode(c) == x.encode() for c, x in zip(codes, texts, strict=True)]
                at = np.concatenate([[0], np.cumsum([len(c) // 4 for c in codes])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(codes), "<u4").astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in inner), ids, pa.array(same, pa.bool_())], names=[*inner, "x", "y"])

    return plain.mapInArrow(run, f"{schema}x array<int>, y boolean").toDF(*kept, *names)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the bytes that its ids stand for; null ids give no bytes, a column named as the result is replaced."""
    ship(df.sparkSession)
    plain, schema, inner, kept = _renamed(df, ids_col, (out,))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(path, pattern).tokens
        for batch in batches:
            back = [b"".join(map(tokens.__getitem__, x or ())) for x in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in inner), pa.array(back, pa.binary())], names=[*inner, "x"])

    return plain.mapInArrow(run, f"{schema}x binary").toDF(*kept, out)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256, same): every text encoded, and its ids decoded again.

    same says whether the decoded bytes are the text's; it holds wherever all 256 bytes have a rank.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for whole in batches:
            for batch in small_batches(whole, "text"):
                out = []
                for text in batch.column("text").to_pylist():
                    ids = own.encode(text or "")
                    back = own.decode(ids)
                    out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), back == (text or "").encode()))
                columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.string(), pa.string(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "same"])

    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean").withColumnRenamed("id", id_col)
