"""Bounded, repeatable samples of rows, for fitting only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 1_000_000


def bucket_of(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; an absent id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def hash_order(id_col: Column, seed: int = 0) -> Column:
    return F.xxhash64(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(seed))


def thinned(df: DataFrame, id_col: Column, rows: int, counts: dict[object, int], group: Column | None = None, seed: int = 0) -> DataFrame:
    """About 1.2 * rows / len(counts) rows of each group, by a hash of the id; counts has the groups' sizes.

    It only drops rows, without a shuffle; callers bound the result with limit().
    """
    share = rows / max(1, len(counts))
    level = F.pmod(hash_order(id_col, seed), F.lit(_STEPS))
    if group is None:
        (size,) = counts.values()
        return df.where(level < min(_STEPS, int(1.2 * share * _STEPS / max(1, size)) + 1))
    keep = F.lit(False)
    for value, size in counts.items():
        keep = keep | ((group == F.lit(value)) & (level < min(_STEPS, int(1.2 * share * _STEPS / max(1, size)) + 1)))
    return df.where(keep)
