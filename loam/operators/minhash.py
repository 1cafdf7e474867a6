"""MinHash signatures by 32-bit linear hashes of crc32 shingles, and families of near-duplicates."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType

from loam.operators.graph import components
from loam.session import discard, materialize, ship

#: The hash family is numpy's default generator with this seed, odd factors and any addends.
SEED, PERMUTATIONS, BANDS, ROWS, SHINGLE, MIN_WORDS = 12345, 128, 16, 8, 5, 20
#: Members of a block: what one task holds of a large bucket at a time is two of them.
BLOCK = 512


def _family() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED)
    factors = draw.integers(1, 2**31, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, draw.integers(0, 2**32, PERMUTATIONS, dtype=np.uint64)


def signature(text: str | None) -> np.ndarray | None:
    """128 minima below 2^32 over the distinct shingles; null for texts of fewer than MIN_WORDS words."""
    words = (text or "").lower().split()
    if len(words) < MIN_WORDS:
        return None
    codes = np.unique(np.array([zlib.crc32(" ".join(words[i : i + SHINGLE]).encode()) for i in range(len(words) - SHINGLE + 1)], np.uint64))
    a, b = _family()
    out = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(codes), 4096):
        part = (codes[at : at + 4096, None] * a[None, :] + b[None, :]) & np.uint64(0xFFFFFFFF)
        out = np.minimum(out, part.min(axis=0))
    return out


@F.pandas_udf(BinaryType())
def signatures(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if (s := signature(t)) is None else s.astype("<u4").tobytes())


@F.pandas_udf(ArrayType(LongType()))
def band_keys(sig: pd.Series) -> pd.Series:
    def keys(raw: bytes) -> list[int]:
        grid = np.frombuffer(raw, "<u4").reshape(BANDS, ROWS)
        return [int.from_bytes(zlib.crc32(row.tobytes(), i).to_bytes(4, "big") + zlib.crc32(row.tobytes()[::-1]).to_bytes(4, "big"), "big", signed=True) for i, row in enumerate(grid)]

    return sig.map(keys)


@F.pandas_udf(DoubleType())
def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([float((np.frombuffer(x, "<u4") == np.frombuffer(y, "<u4")).mean()) for x, y in zip(a, b, strict=True)])


def _block_links(threshold: float):
    """Rows sorted by (band, key, pair): links between members of different components of two blocks of a bucket."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        ids, parts, side, sigs = zip(*rows, strict=True)
        grid, part, side = np.array([np.frombuffer(x, "<u4") for x in sigs]), np.unique(parts, return_inverse=True)[1], np.array(side)
        right, within, links = np.flatnonzero(side >= 1), bool((side == 1).any()), []
        for i in np.flatnonzero(side <= 1).tolist():
            j = right[part[right] != part[i]]
            if within:
                j = j[j > i]
            for k in j[(grid[j] == grid[i]).mean(axis=1) >= threshold].tolist() if len(j) else []:
                if part[k] != part[i]:
                    links.append((ids[i], ids[k]))
                    part[part == part[k]] = part[i]
        return pa.RecordBatch.from_arrays([pa.array([x[n] for x in links], pa.int64()) for n in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, at = [], None
        for batch in batches:
            for *group, i, part, side, sig in zip(*(batch.column(c).to_pylist() for c in ("band", "key", "pair", "id", "component", "side", "sig")), strict=True):
                if group != at:
                    if len(rows) > 1:
                        yield flush(rows)
                    rows, at = [], group
                rows.append((i, part, side, sig))
        if len(rows) > 1:
            yield flush(rows)

    return run


def _rest(keys: DataFrame, signed: DataFrame, links: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links (a, b) that the stars missed: members of a bucket that lie in different components, all against all.

    The largest component of a bucket isn't compared with itself: its blocks meet only those of the other members.
    """
    now = keys.join(components(links), "id", "left").select("id", "band", "key", F.coalesce("component", "id").alias("component"))
    sizes = now.groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("n"))
    most = F.struct("n", "component")
    buckets = sizes.groupBy("band", "key").agg(F.sum("n").alias("n"), F.max("n").alias("big"), F.max_by("component", most).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    buckets = buckets.select("band", "key", "main", F.ceil(F.col("big") / block).cast("int").alias("first"), F.ceil((F.col("n") - F.col("big")) / block).cast("int").alias("others"))
    main, at = F.col("component") == F.col("main"), F.xxhash64("id", "key")
    own = F.when(main, F.pmod(at, F.col("first"))).otherwise(F.col("first") + F.pmod(at, F.col("others"))).cast("int")
    last = F.col("first") + F.col("others") - 1
    member = now.join(buckets, ["band", "key"]).withColumn("own", own)
    member = member.select("*", F.explode(F.sequence(F.when(main, F.col("first")).otherwise(F.lit(0)), last)).alias("with"))
    pair = F.least("own", "with").cast("long") * (last + 1) + F.greatest("own", "with")
    side = F.when(F.col("own") < F.col("with"), 0).when(F.col("own") == F.col("with"), 1).otherwise(2)
    member = member.select("band", "key", pair.alias("pair"), "id", "component", side.alias("side")).join(signed, "id")
    member = member.repartition("band", "key", "pair").sortWithinPartitions("band", "key", "pair")
    return member.mapInArrow(_block_links(threshold), "a long, b long")


def linked(rows: DataFrame, threshold: float = 0.8, block: int = BLOCK) -> tuple[DataFrame, list[str]]:
    """(id, head, component) of rows (id long, sha, sig binary): head is the smallest id of the same sha, component the
    smallest one reached over equal shas and signatures that agree enough; and the scratch paths that it reads.

    In a band's bucket every member is compared with the smallest id and with one by hash; members that are still in
    different components are then compared with each other, block against block, so no pair of a bucket is lost.
    Rows of equal sha are one member; rows without a signature have no other link.
    """
    heads = rows.groupBy("sha").agg(F.min("id").alias("id"), F.min_by("sig", "id").alias("sig"))
    heads, heads_path = materialize(heads, "signatures")
    signed = heads.where("sig IS NOT NULL").select("id", "sig")
    keys = signed.select("id", F.posexplode(band_keys("sig")).alias("band", "key"))
    centre = keys.groupBy("band", "key").agg(F.array(F.min("id"), F.min_by("id", F.xxhash64("id"))).alias("centres"), F.count(F.lit(1)).alias("n")).where("n > 1")
    keys, keys_path = materialize(keys.join(centre, ["band", "key"]).select("id", "band", "key", "centres"), "keys")
    pairs = keys.select("id", F.explode("centres").alias("centre")).where("id <> centre").distinct()
    both = pairs.join(signed.withColumnRenamed("sig", "a"), "id").join(signed.select(F.col("id").alias("centre"), F.col("sig").alias("b")), "centre")
    links, links_path = materialize(both.where(agreement("a", "b") >= threshold).select(F.col("centre").alias("a"), F.col("id").alias("b")), "stars")
    parts = components(links.unionByName(_rest(keys, signed, links, threshold, block)))
    discard(rows.sparkSession, keys_path, links_path)
    out = rows.select("id", "sha").join(heads.select("sha", F.col("id").alias("head")), "sha").join(parts.withColumnRenamed("id", "head"), "head", "left")
    return out.select("id", "head", F.coalesce("component", "head").alias("component")), [heads_path]


def families(docs: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, block: int = BLOCK) -> DataFrame:
    """(id, representative, dup_kind): documents linked by equal text or by signatures that agree enough.

    representative is the smallest id reached.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("sha"), F.col(text_col).alias("text"))
    heads = rows.groupBy("sha").agg(F.min("id").alias("id"))
    signed = rows.join(heads, ["sha", "id"]).dropDuplicates(["id"]).select("id", "sha", signatures("text").alias("sig"))
    parts, _ = linked(signed, threshold, block)
    out = rows.select("id", "sha").join(heads.select("sha", F.col("id").alias("head")), "sha").join(parts.select("head", "component"), "head")
    kind = F.when(F.col("id") == F.col("component"), F.lit(None)).when(F.col("id") != F.col("head"), "exact").otherwise("fuzzy")
    return out.select(F.col("id").alias(id_col), F.col("component").alias("representative"), kind.alias("dup_kind"))
