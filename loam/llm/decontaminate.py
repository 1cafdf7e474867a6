"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

A pattern is a window of benchmark words. Patterns of one length form a class of their own, so a short
item doesn't shorten the shifts of the others. In a class of patterns of m words the shift table tells for
a block of B words how far the search may jump; only where the shift is zero does the suffix-block bucket,
narrowed by the prefix block, name patterns, and the words themselves are compared. Documents are cut into
lanes whose cursors advance together, so that the jumps are numpy operations.

The tables are numpy arrays built in linear time: a pattern is a place in the joined words of the items, not a copy
of them, so they take about ten times the bytes of the benchmark's text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.textcodes import ALNUM, mix, run_hashes, small_batches, word_hashes
from loam.session import discard, materialize, ship

#: Words in a window.
WINDOW = 10
#: Bytes of benchmark text in one block of items; each block is searched by a pass of its own.
ITEM_BYTES = 8 << 20
#: Window ends that one cursor is responsible for.
LANE = 128
#: Parts that the found places are dealt to, so that a text of very many copies doesn't meet them in one task.
SALTS = 16
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").encode().lower())


class PatternClass:
    """The tables of all patterns of m words, given by the places of their first words among the words of all items."""

    def __init__(self, words: np.ndarray, first: np.ndarray, m: int):
        self.m, self.block = m, min(2, m)
        blocks = mix(words[:-1] * _FACTOR + words[1:]) if self.block == 2 else mix(words)
        self.bits = max(12, int(4 * len(first)).bit_length())
        mask = np.uint64((1 << self.bits) - 1)
        self.shift = np.full(1 << self.bits, m - self.block + 1, np.uint16 if m > 255 else np.uint8)
        for end in range(self.block - 1, m):
            np.minimum.at(self.shift, (blocks[first + end - self.block + 1] & mask).astype(np.int64), m - 1 - end)
        keys = self.key(blocks[first + m - self.block], blocks[first])
        order = np.argsort(keys, kind="stable")
        self.keys, self.first = keys[order], first[order].astype(np.int32)

    def key(self, suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return mix(suffix * _FACTOR + prefix)

    def at(self, words: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(words[end - 1] * _FACTOR + words[end]) if self.block == 2 else mix(words[end])

    def candidates(self, words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window end, first word of the pattern) pairs left by shift, suffix and prefix tables."""
        first, stop = offsets[:-1] + self.m - 1, offsets[1:]
        lanes = np.maximum(0, -(-(stop - first) // LANE))
        own = np.repeat(np.arange(len(first)), lanes)
        cursor = first[own] + LANE * (np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        limit = np.minimum(cursor + LANE, stop[own])
        mask = np.uint64((1 << self.bits) - 1)
        while len(cursor):
            suffix = self.at(words, cursor)
            jump = self.shift[(suffix & mask).astype(np.int64)]
            zero = np.flatnonzero(jump == 0)
            if len(zero):
                ends = cursor[zero]
                key = self.key(suffix[zero], self.at(words, ends - self.m + self.block))
                low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
                for i in np.flatnonzero(low < high):
                    for j in range(low[i], high[i]):
                        yield int(ends[i]), int(self.first[j])
            cursor = cursor + np.maximum(jump, 1)
            live = cursor < limit
            cursor, limit = cursor[live], limit[live]


class Matcher:
    """All windows of some items, by class, and the items of each window."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        found = [words_of(text) for _, text in items]
        # The words of all items, one blank after each; word i lies at place[i].
        self.body = b" ".join([b" ".join(w) for w in found if w])
        place = np.cumsum([0, *(len(x) + 1 for w in found for x in w)])
        self.place = place.astype(np.int32 if place[-1] < 1 << 31 else np.int64)
        words, offsets = word_hashes(pa.array([text for _, text in items], pa.large_string()), ALNUM)
        sizes = np.diff(offsets)
        names = sorted({item for item, _ in items})
        number = {item: i for i, item in enumerate(names)}
        self.names = names
        own = np.array([number[item] for item, _ in items], np.int32)
        self.classes: list[PatternClass] = []
        pairs = []
        for m in sorted({min(window, n) for n in sizes.tolist() if n}):
            some = np.flatnonzero(np.minimum(sizes, window) == m)
            count = sizes[some] - m + 1
            first = np.repeat(offsets[some], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            heads = self._heads(run_hashes(words, m)[first], first, m)
            self.classes.append(PatternClass(words, np.unique(heads), m))
            pairs.append(np.unique(np.stack([heads, np.repeat(own[some], count)], 1), axis=0))
        # The items of the pattern that begins at word head[k] are item[k], for all equal heads. No word begins
        # patterns of two classes, as an item has one length.
        both = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
        both = both[np.argsort(both[:, 0], kind="stable")]
        self.head, self.item = both[:, 0].astype(np.int32), both[:, 1].astype(np.int32)

    def _heads(self, codes: np.ndarray, first: np.ndarray, m: int) -> np.ndarray:
        """For each window the first word of the earliest window with the same words."""
        order = np.argsort(codes, kind="stable")
        out = first.copy()
        ranked = codes[order]
        same = np.flatnonzero(ranked[1:] == ranked[:-1]) + 1
        seen: dict[bytes, int] = {}
        last = -1
        for k in same.tolist():
            if k - 1 != last:  # a new run of equal codes
                seen = {self.text(int(first[order[k - 1]]), m): int(first[order[k - 1]])}
            last = k
            here = int(first[order[k]])
            out[order[k]] = seen.setdefault(self.text(here, m), here)
        return out

    def text(self, first: int, m: int) -> bytes:
        return self.body[self.place[first] : self.place[first + m] - 1]

    def items_of(self, head: int) -> list[str]:
        low, high = np.searchsorted(self.head, [head, head + 1])
        return [self.names[i] for i in self.item[low:high].tolist()]

    def search(self, texts: pa.Array) -> tuple[np.ndarray, dict[int, list[tuple[int, int]]], dict[int, set[str]]]:
        """Word counts, and by document the (first, end) word spans of all occurrences and their items."""
        words, offsets = word_hashes(texts, ALNUM)
        spans, items, true = defaultdict(list), defaultdict(set), {}
        known: dict[int, list[str]] = {}
        for kind in self.classes:
            for end, head in sorted(kind.candidates(words, offsets)):  # by document, so that each is split once
                doc = int(np.searchsorted(offsets, end, side="right")) - 1
                if doc not in true:
                    true = {doc: words_of(texts[doc].as_py())}
                last = end - int(offsets[doc]) + 1
                if b" ".join(true[doc][last - kind.m : last]) == self.text(head, kind.m):
                    spans[doc].append((last - kind.m, last))
                    if head not in known:
                        known[head] = self.items_of(head)
                    items[doc].update(known[head])
        return np.diff(offsets), spans, items


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans that cover the same words."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_FOUND = "spans array<struct<first:long,end:long>>, items array<string>"


def _span_column(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"first": a, "end": b} for a, b in x] for x in spans], _SPANS)


def _hits(matcher):
    """(key, spans, items) of the texts in which something is found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = matcher.value
        for whole in batches:
            for batch in small_batches(whole, "text"):
                _, spans, items = own.search(batch.column("text"))
                rows = sorted(spans)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(rows, pa.int64())), _span_column([united(spans[i]) for i in rows]), pa.array([sorted(items[i]) for i in rows], pa.list_(pa.string()))],
                    names=["key", "spans", "items"],
                )

    return run


def _matching(matcher, text: str):
    """All rows with n_words, spans and items; what their columns spans and items (if any) hold is added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = matcher.value
        for whole in batches:
            for batch in small_batches(whole, text):
                counts, spans, items = own.search(batch.column(text))
                n, earlier = batch.num_rows, "spans" in batch.schema.names
                old_spans = batch.column("spans").to_pylist() if earlier else [None] * n
                old_items = batch.column("items").to_pylist() if earlier else [None] * n
                spans = [united([*((s["first"], s["end"]) for s in old_spans[i] or ()), *spans.get(i, ())]) for i in range(n)]
                items = [sorted({*(old_items[i] or ()), *items.get(i, ())}) for i in range(n)]
                left = [x for x in batch.schema.names if x not in ("spans", "items")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(x) for x in left), pa.array(counts, pa.int64()), _span_column(spans), pa.array(items, pa.list_(pa.string()))],
                    names=[*left, "n_words", "spans", "items"],
                )

    return run


def _searched(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text: str, window: int, item_bytes: int) -> DataFrame:
    """docs with its columns named c0, c1, ..., and n_words, spans, items.

    The benchmark is split by a hash of the item into blocks of about item_bytes; a block is collected, turned into
    tables and broadcast, and each block is one pass over the documents, so nothing that is broadcast grows with the
    benchmark. All passes but the last write only what they find, by the text's digest; the last one reads that and
    adds its own.
    """
    spark = docs.sparkSession
    ship(spark)
    pool = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text")).where("text is not null")
    total = pool.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // item_bytes))
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    text = names[docs.columns.index(text_col)]

    def block(i: int):
        part = pool.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i).collect()
        return spark.sparkContext.broadcast(Matcher([(r["item"], r["text"]) for r in part], window))

    if blocks > 1:
        key = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
        found, paths = None, []
        for i in range(blocks - 1):
            matcher = block(i)
            one, path = materialize(rows.select(key.alias("key"), F.col(text).alias("text")).mapInArrow(_hits(matcher), f"key string, {_FOUND}").dropDuplicates(["key"]), "hits")
            matcher.destroy()
            paths.append(path)
            found = one if found is None else found.unionByName(one)
        merged = found.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        merged, _ = materialize(merged, "hits")
        discard(spark, *paths)
        merged = merged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("key", key).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        rows = rows.join(merged, ["key", "salt"], "left").select(*names, "spans", "items")
    return rows.mapInArrow(_matching(block(blocks - 1), text), f"{schema}, n_words long, {_FOUND}")


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    window: int = WINDOW, item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """For each row of docs: id, n_words, spans (first, end) of hit words, items (sorted strings), contaminated.

    Defined results: null and empty texts have no words and no hits; items without words match nothing; items
    that repeat an id are one item; an empty benchmark finds nothing; an item without an id is named "".
    """
    rows = _searched(docs.select(F.col(id_col), F.col(text_col).alias("__text")), benchmark, "__text", item_col, item_text, window, item_bytes)
    return rows.select(F.col("c0").alias(id_col), "n_words", "spans", "items", (F.size("spans") > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows of docs in which no window of the benchmark occurs, with all their columns.

    Defined results: rows with a null text, or one without words, are kept; an empty benchmark drops nothing.
    """
    rows = _searched(docs, benchmark, text_col, item_col, item_text, window, item_bytes).where(F.size("spans") == 0)
    return rows.drop("n_words", "spans", "items").toDF(*docs.columns)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and a digest of the items for each document, from find_contamination()."""
    found = find_contamination(docs, benchmark, id_col)
    return found.select(
        id_col,
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
