"""Contiguous segments of kept chunks, and their packing into training sequences."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.functions.types import list_of, struct_of
from loam.session import ship


def segments(chunks: DataFrame, doc: str, index: str, kept: Column, text: str, tokens: str, separator: str = "\n\n") -> DataFrame:
    """(doc, first_index, last_index, n_chunks, token_count, text, break_reason) of runs of kept neighbours.

    A run ends at a rejected chunk (rejected), at a missing index (gap) or at the document's last chunk (doc_end).
    Windows are over one document, which is bounded by its own text.
    """
    order = Window.partitionBy(doc).orderBy(index)
    rows = chunks.withColumn("__keep", kept).withColumn("__prev", F.lag(index).over(order)).withColumn("__ok", F.coalesce(F.lag("__keep").over(order), F.lit(False)))
    rows = rows.withColumn("__next", F.lead(index).over(order)).withColumn("__next_ok", F.lead("__keep").over(order))
    fresh = ~F.col("__ok") | (F.col(index) != F.col("__prev") + 1)
    rows = rows.withColumn("__island", F.sum(F.when(F.col("__keep") & fresh, 1).otherwise(0)).over(order)).where("__keep")
    why = F.when(F.col("__next").isNull(), "doc_end").when(F.col("__next") != F.col(index) + 1, "gap").when(~F.col("__next_ok"), "rejected")
    rows = rows.withColumn("__why", why)
    out = rows.groupBy(doc, "__island").agg(
        F.min(index).alias("first_index"), F.max(index).alias("last_index"), F.count(F.lit(1)).alias("n_chunks"), F.sum(tokens).alias("token_count"),
        F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), F.col(text).alias("t")))).alias("parts"), F.max_by("__why", index).alias("break_reason"),
    )
    return out.withColumn("text", F.array_join(F.transform("parts", lambda p: p["t"]), separator)).drop("__island", "parts")


def split_points(counts: list[int], room: int, doc_end: bool) -> list[tuple[int, int, int, bool]]:
    """(first, end, tokens, eos) of pieces of neighbouring chunks that fit in room, with one token between chunks.

    The first chunk of a piece is always taken, however long. Only the last piece of a segment that ends its document
    carries the end token, for which it must have room.
    """
    out, first, tokens = [], 0, 0
    for i, n in enumerate(counts):
        end_token = int(doc_end and i == len(counts) - 1)
        if i > first and tokens + n + 1 + end_token > room:
            out.append((first, i, tokens, False))
            first, tokens = i, n
        else:
            tokens += n + (i > first)
    if counts:
        out.append((first, len(counts), tokens, doc_end))
    return out


_PIECES = list_of(struct_of(first="int", end="int", tokens="long", eos="boolean", cost="long", oversize="boolean"))


def split_segments(segments: DataFrame, counts: str, doc_end: Column, seq_len: int = 8192, prefix_tokens: Column | int = 0) -> DataFrame:
    """One row for each piece of a segment: its columns and piece, first, end (chunks), tokens, eos, cost, oversize.

    counts is the array of the tokens of the segment's chunks. cost is tokens, prefix and end token; a piece of one chunk
    that is longer than a sequence is oversize. A segment without chunks has no piece.
    """
    ship(segments.sparkSession)
    prefix = F.lit(prefix_tokens) if isinstance(prefix_tokens, int) else prefix_tokens

    @F.pandas_udf(_PIECES)
    def pieces(all_counts: pd.Series, ends: pd.Series, prefixes: pd.Series) -> pd.Series:
        def one(c, end, p):
            made = split_points([int(x) for x in c] if c is not None else [], seq_len - int(p), bool(end))
            return [{"first": a, "end": b, "tokens": n, "eos": e, "cost": n + int(p) + e, "oversize": n + int(p) + e > seq_len} for a, b, n, e in made]

        return pd.Series([one(*x) for x in zip(all_counts, ends, prefixes, strict=True)])

    return segments.select("*", F.posexplode(pieces(F.col(counts), F.coalesce(doc_end, F.lit(False)), prefix.cast("long"))).alias("piece", "__p")).select("*", "__p.*").drop("__p")


def best_fit(sizes: list[int], room: int) -> list[int]:
    """Bin of each size, largest first, into the fullest bin that still holds it (the smaller bin number on ties)."""
    import bisect

    free: list[tuple[int, int]] = []
    bins, out = 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect.bisect_left(free, (sizes[i], -1))
        if at < len(free):
            left, number = free.pop(at)
        else:
            left, number = room, bins
            bins += 1
        out[i] = number
        bisect.insort(free, (left - sizes[i], number))
    return out


def pack(pieces: DataFrame, key: str, size: str, seq_len: int = 8192, buffer_tokens: int = 2_000_000, buffers: int | None = None) -> DataFrame:
    """pieces with buffer, sequence: best-fit decreasing within buffers of about buffer_tokens.

    A buffer is a hash class of the key, as many as the total needs; each is packed by one task, so memory is bounded
    by the buffer, whatever the corpus. A piece longer than a sequence has one of its own.
    """
    ship(pieces.sparkSession)
    if buffers is None:
        total = pieces.agg(F.sum(size)).first()[0] or 0
        buffers = max(1, -(-total // buffer_tokens))
    rows = pieces.select(F.col(key).alias("k"), F.col(size).cast("long").alias("n")).withColumn("buffer", F.pmod(F.xxhash64("k"), F.lit(buffers)).cast("int"))
    kind = rows.schema["k"].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k", kind="stable")
        return group.assign(sequence=best_fit([min(n, seq_len) for n in group["n"]], seq_len))[["k", "n", "buffer", "sequence"]]

    packed = rows.groupBy("buffer").applyInPandas(run, f"k {kind}, n long, buffer int, sequence int")
    return packed.withColumnRenamed("k", key).withColumnRenamed("n", size)


