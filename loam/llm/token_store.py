"""Token ids in a compact file format: a static range asymmetric numeral system (rANS) over all documents.

One frequency table, counted over all ids of the corpus and scaled to 2^BITS, serves every block. A block
holds whole documents in order; its ids are dealt to interleaved lanes, each a rANS state of its own, whose
32-bit words share one stream. Every few thousand steps a checkpoint stores the lanes' states and the place
in the stream, so that decoding can start there; a CRC over the block tells damage. Blocks are independent.

Block (little-endian): magic, ids, lanes, steps between checkpoints, checkpoints, words, documents, how many of the
first documents have no id; then document ids (int64, 0 where there is none), document lengths (uint32), a states row of uint64 for each checkpoint, places (uint32),
words (uint32), CRC-32 of all before (uint32). A store is a folder with the table (symbol, count, frequency)
and the blocks in the order of part and seq, one row for each block, written by Spark's own file writer so that
it works in any store that Spark can reach.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loam.llm.bpe import packed
from loam.llm.textcodes import small_batches
from loam.llm.unit_table import UnitTable
from loam.session import discard, materialize, scratch_path, ship

BITS, LANES, BLOCK_IDS, CHECKPOINT_STEPS = 20, 2048, 1 << 19, 128
END_ID = 0
_HEAD = struct.Struct("<4sIIIIIII")
_MAGIC = b"LRB2"
_LOW = np.uint64(1 << 31)


class Table:
    """Scaled frequencies of the symbols 0..n-1 that add up to 2^BITS; a symbol that occurs has one at least."""

    def __init__(self, counts: np.ndarray, bits: int = BITS):
        counts = np.asarray(counts, np.int64)
        seen = np.flatnonzero(counts)
        if not len(seen):
            counts, seen = np.ones(1, np.int64), np.zeros(1, np.int64)
        self.bits = max(bits, (4 * len(seen)).bit_length())
        total = 1 << self.bits
        freq = np.zeros(len(counts), np.int64)
        freq[seen] = np.maximum(1, counts[seen] * (total / counts.sum())).astype(np.int64)
        spare = total - int(freq.sum())
        if spare >= 0:
            freq[seen[np.argmax(counts[seen])]] += spare
        while spare < 0:  # what the rare symbols were given is taken from the frequent ones
            rich = seen[freq[seen] > 1]
            cut = np.minimum(freq[rich] - 1, np.maximum(1, freq[rich] * -spare // int(freq[rich].sum())))
            cut = np.where(np.cumsum(cut) <= -spare, cut, 0)
            if not cut.any():
                cut[np.argmax(freq[rich])] = 1
            freq[rich] -= cut
            spare += int(cut.sum())
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)

    @property
    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))


def encode_block(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, table: Table, lanes: int = LANES, every: int = CHECKPOINT_STEPS, nameless: int = 0) -> bytes:
    """One block from the ids of whole documents, of which the first nameless ones have no document id."""
    n = len(ids)
    lanes = max(1, min(lanes, n // 64))
    steps = -(-n // lanes)
    freq, start = table.freq[ids], table.start[ids]
    bits, shift = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full(lanes, _LOW, np.uint64)
    words, marks, written = [], [], 0
    for t in range(steps - 1, -1, -1):
        f, s = freq[t * lanes : (t + 1) * lanes], start[t * lanes : (t + 1) * lanes]
        x = state[: len(f)]
        full = x >= (f << shift)
        if full.any():
            out = x[full]
            words.append(out.astype(np.uint32))
            written += len(out)
            x[full] = out >> np.uint64(32)
        whole = x // f
        state[: len(f)] = (whole << bits) + (x - whole * f) + s
        if t % every == 0:
            marks.append((state.copy(), written))
    words, marks = words[::-1], marks[::-1]
    places = np.array([written - w for _, w in marks], "<u4")
    body = b"".join(
        [
            _HEAD.pack(_MAGIC, n, lanes, every, len(marks), written, len(doc_ids), nameless),
            doc_ids.astype("<i8").tobytes(),
            lengths.astype("<u4").tobytes(),
            *(state.astype("<u8").tobytes() for state, _ in marks),
            places.tobytes(),
            *(w.astype("<u4").tobytes() for w in words),
        ]
    )
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A block's parts; decode() gives its ids, or those from one checkpoint on."""

    def __init__(self, data: bytes):
        magic, self.n, self.lanes, self.every, marks, words, docs, self.nameless = _HEAD.unpack_from(data)
        if magic != _MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged block")
        at = _HEAD.size
        self.doc_ids, at = np.frombuffer(data, "<i8", docs, at), at + 8 * docs
        self.lengths, at = np.frombuffer(data, "<u4", docs, at), at + 4 * docs
        self.states, at = np.frombuffer(data, "<u8", marks * self.lanes, at).reshape(marks, self.lanes), at + 8 * marks * self.lanes
        self.places, at = np.frombuffer(data, "<u4", marks, at), at + 4 * marks
        self.words = np.frombuffer(data, "<u4", words, at)

    def decode(self, table: Table, slots: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids between two checkpoints (all by default)."""
        if not self.n:
            return np.zeros(0, np.uint32)
        steps = -(-self.n // self.lanes)
        stop = steps if last is None else min(steps, last * self.every)
        out = np.empty(steps * self.lanes, np.uint32)
        state, at = self.states[first].astype(np.uint64), int(self.places[first])
        bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
        for t in range(first * self.every, stop):
            width = min(self.lanes, self.n - t * self.lanes)
            x = state[:width]
            slot = x & mask
            symbol = slots[slot.astype(np.int64)]
            out[t * self.lanes : t * self.lanes + width] = symbol
            x = table.freq[symbol] * (x >> bits) + slot - table.start[symbol]
            need = np.flatnonzero(x < _LOW)
            if len(need):
                x[need] = (x[need] << np.uint64(32)) | self.words[at : at + len(need)]
                at += len(need)
            state[:width] = x
        return out[first * self.every * self.lanes : min(self.n, stop * self.lanes)]


@lru_cache(maxsize=1)
def _library(path: str, ordinary: bool = False):
    """A function from a column of texts to (counts, ids) with the tokenizers library, and the bytes of an id.

    The string of a special token in a text is that token, as is the library's way, unless ordinary is set.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = ordinary
    with open(path, encoding="utf-8") as source:
        made = json.load(source)
    split = made.get("pre_tokenizer") or {}
    # Units may be encoded apart where the library itself cuts at them: byte level, its own pattern, no prefix.
    apart = (
        made.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and all(x["special"] for x in made.get("added_tokens", ()))
    )

    def plain(text: str) -> bytes:
        return packed(own.encode(text, add_special_tokens=False).ids)

    line_end = own.encode("\n", add_special_tokens=False).ids

    def together(units: list[str]) -> list[bytes]:
        """Ids of units (" x" or a line end and "x", no other white space) from a few long texts.

        Line ends part the units; the library cuts there, and only they yield the line end's id.
        """
        out: list[bytes] = [b""] * len(units)
        for lead in (" ", "\n"):
            mine = [i for i, u in enumerate(units) if u[0] == lead]
            for at in range(0, len(mine), 1000):
                some = mine[at : at + 1000]
                joined = "\n" + "\n".join(units[i].removeprefix("\n") for i in some) + "\n"
                ids = np.array(own.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
                cuts, raw = (4 * np.flatnonzero(ids == line_end[0])).tolist(), ids.tobytes()
                for i, low, high in zip(some, cuts[:-1], cuts[1:], strict=True):
                    out[i] = raw[low + 4 if lead == " " else low : high]
        return out

    width = 2 if own.get_vocab_size() <= 1 << 16 else 4
    if apart and len(line_end) == 1:
        special = () if ordinary else tuple(x["content"] for x in made.get("added_tokens", ()))
        return UnitTable(plain, together, width, special).encode, width

    def whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        codes = [plain(x) if x else b"" for x in column.to_pylist()]
        return np.array([len(c) // 4 for c in codes], np.int64), np.frombuffer(b"".join(codes), "<u4").astype(f"<u{width}")

    return whole, width


def _tokenized(path: str, ordinary: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, width = _library(path, ordinary)
        for whole in batches:
            for batch in small_batches(whole, "text"):
                counts, ids = encode(batch.column("text"))
                ends = np.concatenate([[0], np.cumsum(counts * width)]).astype(np.int32)
                column = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ids.tobytes())])
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(np.full(len(counts), width, np.int32)), pa.array(sums, pa.int64()), column], names=["id", "width", "sum", "ids"]
                )

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all symbols of a task, the end id of each document included."""
    total = np.zeros(1, np.int64)
    for batch in batches:
        for width, ids in zip(batch.column("width").to_pylist(), batch.column("ids"), strict=True):
            got = np.bincount(np.frombuffer(ids.as_buffer(), f"<u{width}"), minlength=END_ID + 1)
            got[END_ID] += 1
            if len(got) > len(total):
                total = np.concatenate([total, np.zeros(len(got) - len(total), np.int64)])
            total[: len(got)] += got
    symbols = np.flatnonzero(total)
    if len(symbols):
        yield pa.RecordBatch.from_arrays([pa.array(symbols, pa.int64()), pa.array(total[symbols])], names=["symbol", "count"])


def _blocks(frequencies, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part, seq = frequencies.value, TaskContext.get().partitionId(), 0
        docs, held, size = [], [], 0

        def done() -> pa.RecordBatch:
            lengths = np.array([len(x) for x in held])
            named = np.array([x or 0 for x in docs], np.int64)
            data = encode_block(np.concatenate(held), named, lengths, table, nameless=docs.count(None))
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "first_doc": [docs[0]], "n_ids": [size], "block": [data]}, schema=_BLOCK_SCHEMA)

        for batch in batches:
            for doc, width, ids in zip(batch.column("id").to_pylist(), batch.column("width").to_pylist(), batch.column("ids"), strict=True):
                ids = np.append(np.frombuffer(ids.as_buffer(), f"<u{width}").astype(np.uint32), np.uint32(END_ID))
                if held and size + len(ids) > block_ids:
                    yield done()
                    docs, held, size, seq = [], [], 0, seq + 1
                docs.append(doc), held.append(ids)
                size += len(ids)
        if held:
            yield done()

    return run


_BLOCK_SCHEMA = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("first_doc", pa.int64()), ("n_ids", pa.int64()), ("block", pa.binary())])
_BLOCK_DDL = "part int, seq int, first_doc long, n_ids long, block binary"
_TABLE_DDL = "symbol long, count long"


def write_store(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS, ordinary: bool = False) -> None:
    """Tokenises all texts and writes them below folder (table/ and blocks/) in ascending order of the id.

    Documents are tokenised once, into a scratch table of ids; the frequencies are counted over all of it
    (each task sends one row for each symbol it has), then the ids are dealt by ranges of the document id and, where
    many rows have the same one, of a checksum of their ids. The string of a special token in a text is that token,
    as is the library's way; with ordinary it is text like any other.
    Defined results: null and empty texts have only the end id; rows that repeat an id are kept, in the order of the
    checksums of their ids; rows without an id, or with one that is no integer, come first, in the same order, and
    have a null id when they are read; an empty table gives a store without blocks.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.expr(f"try_cast(`{id_col}` as bigint)").alias("id"), F.col(text_col).alias("text"))
    ids, ids_path = materialize(rows.mapInArrow(_tokenized(tokenizer_path, ordinary), "id long, width int, sum long, ids binary"), "token-ids")
    counts = ids.select("width", "ids").mapInArrow(_counted, _TABLE_DDL).groupBy("symbol").agg(F.sum("count").alias("count"))
    counts.coalesce(1).write.parquet(f"{folder}/table")
    frequencies = spark.sparkContext.broadcast(read_table(spark, folder))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = ids.repartitionByRange(parts, "id", "sum").sortWithinPartitions("id", "sum", "ids").select("id", "width", "ids")
    dealt.mapInArrow(_blocks(frequencies, block_ids), _BLOCK_DDL).write.option("compression", "none").parquet(f"{folder}/blocks")
    frequencies.destroy()
    discard(spark, ids_path)


def read_table(spark: SparkSession, folder: str) -> Table:
    """The frequency table of a store; as large as the tokenizer's vocabulary."""
    got = spark.read.schema(_TABLE_DDL).parquet(f"{folder}/table").toPandas()
    counts = np.zeros(int(got["symbol"].max()) + 1 if len(got) else 1, np.int64)
    counts[got["symbol"].to_numpy()] = got["count"].to_numpy()
    return Table(counts)


def _documents(frequencies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, slots = frequencies.value, frequencies.value.slots
        for batch in batches:
            for begin, data in zip(batch.column("begin").to_pylist(), batch.column("block").to_pylist(), strict=True):
                block = Block(data)
                ids = block.decode(table, slots).astype("<u4")
                ends = np.cumsum(block.lengths.astype(np.int64))
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), block.lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids, mask=np.arange(len(block.doc_ids)) < block.nameless), pa.array(begin + ends - block.lengths), pa.array(block.lengths.astype(np.int64)), pa.array(sums, pa.int64())],
                    names=["id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_documents(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of all documents of a store, decoded from its files.

    Documents that were written without an id have a null one; a store without blocks gives no rows. Only one number for each written part (file) goes to the driver: how many ids stand before it.
    """
    ship(spark)
    blocks = spark.read.schema(_BLOCK_DDL).parquet(f"{folder}/blocks")
    index = blocks.select("part", "seq", "n_ids")
    sizes = sorted((r["part"], r["n"]) for r in index.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    parts = spark.createDataFrame(before, "part int, before long")
    order = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    begin = index.withColumn("inside", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    begin = begin.join(parts, "part").select("part", "seq", (F.col("before") + F.col("inside")).alias("begin"))
    placed = blocks.select("part", "seq", "block").join(begin, ["part", "seq"]).select("begin", "block")
    frequencies = spark.sparkContext.broadcast(read_table(spark, folder))
    return placed.mapInArrow(_documents(frequencies), "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def store_and_read(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """write_store() to a new folder of the shared scratch space, then read_documents()."""
    folder = scratch_path(docs.sparkSession, "token-store")
    write_store(docs, tokenizer_path, folder, id_col, text_col)
    return read_documents(docs.sparkSession, folder, id_col)
