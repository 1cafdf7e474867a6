"""Near-duplicate detection with HyperMinHash sketches.

Every document gets one sketch: its distinct shingle hashes are dealt to REGISTERS buckets by their top
bits, and each bucket keeps its smallest remaining value as a leading-zero count and MANTISSA bits.
Bands of these compressed registers retrieve candidates, a Jaccard estimate corrected for chance register
collisions drops hopeless ones, and the full shingle sets of both documents confirm a link.

How all links are found without all pairs of a group:
1. Documents with the same shingle set become one class (they are linked by definition).
2. The members of each band bucket are compared with two centres of the bucket (stars); confirmed links are
   merged into components. Most of a group of copies, however large, is one component after that.
3. In buckets that still hold several components, the members are compared block against block, in numpy.
   Members of a large bucket carry the difference of their shingle set to the set of a common centre (their
   anchor, found with the stars): the size of the symmetric difference of two members is that of their
   two differences, so their similarity is exact without their sets, and only links that join two
   components leave the kernel. Other pairs leave it if their estimate is near the threshold and are
   confirmed on full sets. No bucket is capped.

The number of rows in a band is the largest for which a pair exactly at the threshold is missed with a
probability of at most MISS.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.operators.graph import components
from loam.llm.textcodes import mix, shingle_sets, small_batches
from loam.session import discard, materialize, ship

REGISTERS, MANTISSA = 256, 10
#: Probability with which a pair exactly at the threshold may share no band.
MISS = 1e-5
#: Members of one block when a bucket is compared in blocks.
BLOCK = 1024
#: In buckets of so many members, stars keep the differences to the centre down to this similarity.
LARGE, ANCHOR_LEVEL = 128, 0.6
#: Bits of the filter that keeps documents without any candidate from being cut into shingles again; its size is
#: fixed, and where the candidates outgrow it, more documents pass it than need to.
FILTER_BITS = 26


@dataclass(frozen=True)
class Settings:
    """Links hold if 100 * intersection >= percent * union of the k-word shingle sets."""

    k: int = 5
    percent: int = 80
    registers: int = REGISTERS

    @property
    def rows(self) -> int:
        level = self.percent / 100
        fit = [r for r in range(1, 33) if (1 - level**r) ** (self.registers // r) <= MISS]
        return max(fit, default=1)

    @property
    def bands(self) -> int:
        return self.registers // self.rows


def sketch(values: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """HyperMinHash registers (uint16, 0 if the bucket is empty) of sorted distinct 64-bit hashes."""
    out = np.zeros(registers, np.uint16)
    if not len(values):
        return out
    bits = registers.bit_length() - 1
    bucket = (values >> np.uint64(64 - bits)).astype(np.int64)
    lead = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    rest = (values[lead] << np.uint64(bits)) >> np.uint64(11)  # 53 bits: exact as a double
    part, power = np.frexp(rest.astype(np.float64))
    zeros = np.minimum(np.where(rest == 0, 53, 53 - power), 62)
    tail = np.where(rest == 0, 0, np.floor((part - 0.5) * 2 * (1 << MANTISSA)))
    out[bucket[lead]] = 1 + ((zeros.astype(np.int64) << MANTISSA) | tail.astype(np.int64))
    return out


def estimate(one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of rows of registers, and how many registers each rests on.

    Two unequal minima fall into the same cell with a probability of about
    0.7213 * n1 * n2 / (n1 + n2)^2 / 2^MANTISSA (cells are 2^-MANTISSA of the value's power of two wide,
    minima of n values are exponential with rate n); that many of the used registers are taken off the
    equal ones before the ratio is formed.
    """
    used = (one != 0) | (two != 0)
    total = used.sum(axis=-1)
    equal = (used & (one == two)).sum(axis=-1)
    both = ((one != 0) & (two != 0)).sum(axis=-1)
    chance = 0.7213 * n_one * n_two / np.maximum(n_one + n_two, 1.0) ** 2 / (1 << MANTISSA) * both
    return np.maximum(equal - chance, 0) / np.maximum(total - chance, 1), total


def worth_checking(value: np.ndarray, registers: np.ndarray, level: float) -> np.ndarray:
    """True where the true similarity may be at the level: less than five standard deviations off."""
    return value >= level - 5 * np.sqrt(level * (1 - level) / np.maximum(registers, 1)) - 1e-9


def _sketch_batches(k: int, registers: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, "text"):
                sizes, digests, sketches = [], [], []
                for values in shingle_sets(batch.column("text"), k):
                    sizes.append(len(values))
                    digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
                    sketches.append(sketch(values, registers).tobytes() if len(values) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())],
                    names=["id", "n", "digest", "sketch"],
                )

    return run


def _band_batches(rows: int, bands: int):
    weights = mix(np.arange(1, rows * bands + 1, dtype=np.uint64)).reshape(bands, rows) | np.uint64(1)
    label = mix(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = np.array([np.frombuffer(x, np.uint16)[: rows * bands] for x in batch.column("sketch").to_pylist()])
            if not len(grid):
                continue
            grid = grid.reshape(-1, bands, rows)
            keys = mix((mix(grid.astype(np.uint64) + np.uint64(1)) * weights).sum(axis=2, dtype=np.uint64) + label)
            row, band = np.nonzero(grid.any(axis=2))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), pa.array(keys[row, band].view(np.int64))], names=["id", "key"])

    return run


def _likely(level: float):
    """Drops pairs that can't be links; in large buckets those that are no use as anchors either."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.array([np.frombuffer(x, np.uint16) for x in batch.column(c).to_pylist()]) for c in ("sketch_a", "sketch_b"))
            n_one, n_two = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            value, total = estimate(one, two, n_one, n_two)
            link = worth_checking(value, total, level) & (np.minimum(n_one, n_two) >= level * np.maximum(n_one, n_two) - 1e-9)
            anchor = batch.column("large").to_numpy(zero_copy_only=False) & worth_checking(value, total, ANCHOR_LEVEL)
            yield batch.select(["centre", "id", "large", "met"]).filter(pa.array(link | anchor))

    return run


def _filter_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Non-empty chunks of a task's bitmap of hashed ids."""
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for batch in batches:
        place = _filter_place(batch.column("id").to_numpy())
        np.bitwise_or.at(bits, place >> 3, (128 >> (place & 7)).astype(np.uint8))
    chunks = bits.reshape(-1, 4096)
    some = np.flatnonzero(chunks.any(axis=1))
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([chunks[i].tobytes() for i in some], pa.binary())], names=["chunk", "bits"])


def _filter_place(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _filter(ids: DataFrame):
    """A broadcast bitmap of 2^FILTER_BITS bits, whatever the number of ids."""
    chunks = ids.mapInArrow(_filter_chunks, "chunk int, bits binary").groupBy("chunk").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    bitmap = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in chunks.toLocalIterator():
        bitmap[row["chunk"] * 4096 : (row["chunk"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return ids.sparkSession.sparkContext.broadcast(bitmap)


def _set_batches(k: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = wanted.value
        for whole in batches:
            ids = whole.column("id").to_numpy(zero_copy_only=False)
            place = _filter_place(ids)
            keep = (bitmap[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1
            for batch in small_batches(whole.filter(pa.array(keep.astype(bool))), "text"):
                sets = [values.tobytes() for values in shingle_sets(batch.column("text"), k)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], names=["id", "shingles"])

    return run


def _confirmed(percent: int):
    """(centre, id, met, link, delta): whether the pair is a link; for large buckets the difference of the sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links, deltas = [], []
            for one, two, large in zip(batch.column("set_a"), batch.column("set_b"), batch.column("large").to_pylist(), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, two))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                links.append(100 * shared >= percent * (len(x) + len(y) - shared))
                deltas.append(np.setxor1d(x, y, assume_unique=True).tobytes() if large else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("centre", "id", "met")), pa.array(links, pa.bool_()), pa.array(deltas, pa.binary())], names=["centre", "id", "met", "link", "delta"]
            )

    return run


class _Block:
    """Members of two blocks of a bucket (side 0 and 2), or of one (side 1)."""

    def __init__(self, rows: list[tuple]):
        ids, parts, side, size, sketches, centres, deltas = zip(*rows, strict=True)
        self.ids, self.size = np.array(ids, np.int64), np.array(size, float)
        self.part = np.unique(parts, return_inverse=True)[1]
        side = np.array(side)
        self.within = bool((side == 1).any())
        self.left, self.right = np.flatnonzero(side <= 1), np.flatnonzero(side >= 1)
        self.grid = np.array([np.frombuffer(x, np.uint16) for x in sketches])
        self.anchor = np.array([-1 if c is None or d is None else c for c, d in zip(centres, deltas, strict=True)], np.int64)
        own = [np.frombuffer(d, np.uint64) if d is not None else np.zeros(0, np.uint64) for d in deltas]
        self.differ = np.array([len(d) for d in own])
        self.values, self.owner = np.concatenate(own), np.repeat(np.arange(len(own)), self.differ)
        self.delta = own

    def joins(self, level: float, percent: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Certain links that join two components, and pairs to confirm."""
        sure, maybe = [], []
        for i in self.left.tolist():
            j = self.right[self.part[self.right] != self.part[i]]
            if self.within:
                j = j[j > i]
            j = j[np.minimum(self.size[j], self.size[i]) >= level * np.maximum(self.size[j], self.size[i]) - 1e-9]
            if not len(j):
                continue
            j = j[worth_checking(*estimate(self.grid[i], self.grid[j], self.size[i], self.size[j]), level)]
            near = (self.anchor[j] == self.anchor[i]) & (self.anchor[j] >= 0)
            maybe += [(i, k) for k in j[~near].tolist()]
            j = j[near]
            if len(j):
                common = np.bincount(self.owner[np.isin(self.values, self.delta[i])], minlength=len(self.ids))[j]
                apart = self.differ[i] + self.differ[j] - 2 * common
                both = self.size[i] + self.size[j]  # intersection (both - apart) / 2, union (both + apart) / 2
                for k in j[100 * (both - apart) >= percent * (both + apart)].tolist():
                    if self.part[k] != self.part[i]:
                        sure.append((i, k))
                        self.part[self.part == self.part[k]] = self.part[i]
        return sure, maybe


def _block_pairs(level: float, percent: int):
    """Rows sorted by (key, pair): compares the members of the two blocks of a bucket."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        block = _Block(rows)
        sure, maybe = block.joins(level, percent)
        pairs = np.array(sure + maybe, np.int64).reshape(-1, 2)
        one, two = block.ids[pairs[:, 0]], block.ids[pairs[:, 1]]
        certain = np.arange(len(pairs)) < len(sure)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), pa.array(certain)], names=["a", "b", "sure"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, at = [], None
        for batch in batches:
            for key, pair, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "pair", "id", "component", "side", "n", "sketch", "centre", "delta")), strict=True):
                if (key, pair) != at:
                    if len(rows) > 1:
                        yield flush(rows)
                    rows, at = [], (key, pair)
                rows.append(row)
        if len(rows) > 1:
            yield flush(rows)

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for each row of docs; ids are long.

    component_id is the smallest id reachable over links, its own if there are none; kept is
    id = component_id. Defined results: null, empty and blank texts have no shingles and no link. Rows
    that repeat an id are one document if their texts agree; differing texts under one id share its
    component. Rows without an id, or with one that is no integer, have the id and the component null and are kept.
    An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship(spark)
    conf, level = Settings(k, percent), percent / 100
    rows = docs.select(F.expr(f"try_cast(`{id_col}` as bigint)").alias("id"), F.col(text_col).alias("text"))
    marks, marks_path = materialize(rows.mapInArrow(_sketch_batches(k, conf.registers), "id long, n long, digest binary, sketch binary"), "marks")

    # Classes of equal shingle sets; the smallest id stands for the class.
    full = marks.where("digest is not null and id is not null")
    classes, classes_path = materialize(
        full.groupBy("digest").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.first("sketch").alias("sketch")), "classes"
    )
    # One id with two different texts: its first class carries the sketch, the link below joins the classes.
    bands = classes.select("id", "n", "sketch").mapInArrow(_band_batches(conf.rows, conf.bands), "id long, key long")
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    members, members_path = materialize(bands.join(shared.select("key", "size"), "key").select("key", "id", "size", (F.col("size") >= LARGE).alias("large")), "members")
    sketches = classes.select("id", "n", "sketch")
    scratch = [members_path]

    def confirm(pairs: DataFrame) -> DataFrame:
        """(centre, id, met, link, delta) of (centre, id, large, met) pairs, from their full sets."""
        pairs, path = materialize(pairs, "likely")
        wanted = _filter(pairs.select(F.col("centre").alias("id")).union(pairs.select("id")))
        # Where an id is repeated with other texts, all of them are compared.
        sets = rows.where("id is not null").mapInArrow(_set_batches(k, wanted), "id long, shingles binary")
        one = lambda x, y: sets.select(F.col("id").alias(x), F.col("shingles").alias(y))
        sure = pairs.join(one("id", "set_b"), "id").join(one("centre", "set_a"), "centre")
        sure, sure_path = materialize(sure.mapInArrow(_confirmed(percent), "centre long, id long, met long, link boolean, delta binary"), "confirmed")
        wanted.destroy()
        scratch.extend([path, sure_path])
        return sure

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b"))

    def labelled() -> DataFrame:
        now = members.join(components(links), "id", "left").select("id", "key", "large", F.coalesce("component", "id").alias("component"))
        now, path = materialize(now, "labelled")
        scratch.append(path)
        return now

    # Stars: in each bucket all members against two centres: the member that meets most others over all its
    # buckets (the least changed copy of a group), and one by hash.
    met = members.groupBy("id").agg((-F.sum("size")).alias("met"))
    popular, any_one = F.struct("met", F.xxhash64("id").alias("h"), "id"), F.struct(F.xxhash64("id", F.lit(1)).alias("h"), "id", "met")
    two = lambda c: F.struct(c["id"].alias("centre"), c["met"].alias("met"))
    centres = members.join(met, "id").groupBy("key").agg(F.array(two(F.min(popular)), two(F.min(any_one))).alias("centres"))
    star = members.join(centres, "key").select("id", "large", F.inline("centres")).where("id <> centre")
    star = star.groupBy("centre", "id").agg(F.max("large").alias("large"), F.min("met").alias("met"))
    side = lambda x, y: sketches.select(F.col("id").alias(x), F.col("n").alias(f"n_{y}"), F.col("sketch").alias(f"sketch_{y}"))
    likely = star.join(side("id", "b"), "id").join(side("centre", "a"), "centre").mapInArrow(_likely(level), "centre long, id long, large boolean, met long")
    sure = confirm(likely)
    tested, links = ordered(sure), ordered(sure.where("link"))
    anchors = sure.where("delta is not null").select("centre", "id", "met", "delta")
    now = labelled()

    # Blocks: what is left of the buckets that several components share.
    # A member's anchor is the centre that meets most others: members of a group agree on it without a count.
    own = anchors.groupBy("centre").agg(F.min("met").alias("met")).select("centre", F.col("centre").alias("id"), "met", F.lit(b"").cast("binary").alias("delta"))
    anchors = anchors.unionByName(own).groupBy("id").agg(F.min_by(F.struct("centre", "delta"), F.struct("met", "centre")).alias("anchor"))
    still = now.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    still = still.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    member = now.join(still, "key").withColumn("block", F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int"))
    # Block i meets every block: as the smaller number (side 0), with itself (1), as the larger one (2).
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    member = member.select("id", "key", "component", "block", "blocks", other.alias("with"))
    member = member.select(
        "id", "key", "component",
        (F.least("block", "with") * F.col("blocks") + F.greatest("block", "with")).alias("pair"),
        F.when(F.col("block") < F.col("with"), 0).when(F.col("block") == F.col("with"), 1).otherwise(2).alias("side"),
    )
    member = member.join(sketches.join(anchors, "id", "left"), "id").repartition("key", "pair").sortWithinPartitions("key", "pair")
    member = member.select("key", "pair", "id", "component", "side", "n", "sketch", F.col("anchor.centre").alias("centre"), F.col("anchor.delta").alias("delta"))
    left, left_path = materialize(member.mapInArrow(_block_pairs(level, percent), "a long, b long, sure boolean"), "blocks")
    scratch.append(left_path)
    links = links.unionByName(left.where("sure").select("a", "b"))
    unsure = left.where("not sure").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")
    links = links.unionByName(ordered(confirm(unsure.select(F.col("a").alias("centre"), F.col("b").alias("id"), F.lit(False).alias("large"), F.lit(0).cast("long").alias("met"))).where("link")))

    # Repeated ids join the classes of all their texts.
    class_of = full.select("id", "digest").join(classes.select("digest", F.col("id").alias("rep")), "digest").select("id", "rep").distinct()
    class_of, path = materialize(class_of, "class-of")
    scratch.append(path)
    merged = class_of.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    ties = class_of.join(merged.select("id", "a"), "id").where("rep <> a").select("a", F.col("rep").alias("b"))
    parts = components(links.unionByName(ties))
    final = class_of.groupBy("id").agg(F.min("rep").alias("rep")).join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    final = final.select("id", F.coalesce("component", "rep").alias("component"))
    final, _ = materialize(final, "components")
    discard(spark, classes_path, *scratch)
    result = marks.select("id", "n").join(final, "id", "left")
    component = F.coalesce("component", "id")
    return result.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


def keep_one_of_each_group(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents that near_duplicates() doesn't keep; all columns stay.

    Defined results: rows whose text has no word, and rows without an integer id, are kept; rows that repeat an id are
    kept or dropped together; an empty table gives an empty one.
    """
    gone = near_duplicates(docs, k, percent, id_col, text_col).where("not kept").select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, F.expr(f"try_cast(`{id_col}` as bigint)") == F.col("__gone"), "left_anti")
