"""Edit distance of whole texts: bit-parallel over Python's long integers, so that no text needs a prefix."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def _shared(a: str, b: str) -> int:
    """Length of the common beginning, by halving: slices are compared, not characters one by one."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _steps(text: str, other: str) -> float:
    """What distance() takes for a text's characters: those that the other text hasn't take about a quarter."""
    common = sum(map(text.count, set(text) & set(other)))
    return (4 * common + (len(text) - common)) * (len(other) + 2000)


def distance(a: str, b: str) -> int:
    """Levenshtein distance in code points (Myers 1999, Hyyrö 2003): a step for each character of one text."""
    if a == b:
        return 0
    start = _shared(a, b)
    a, b = a[start:], b[start:]
    end = _shared(a[::-1], b[::-1])
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    text, pattern = (a, b) if _steps(a, b) <= _steps(b, a) else (b, a)
    m = len(pattern)
    at: dict[str, bytearray] = {}
    known = set(text)
    for i, c in enumerate(pattern):
        if c in known:
            at.setdefault(c, bytearray(m // 8 + 1))[i >> 3] |= 1 << (i & 7)
    equal = {c: int.from_bytes(bits, "little") for c, bits in at.items()}
    mask = (1 << m) - 1
    # rest: where the distance doesn't rise downwards; bits beyond the pattern never reach lower ones and are cut at times.
    rest, minus = 0, 0
    for c in text:
        if c in equal:
            eq, plus = equal[c], mask ^ (rest & mask)
            zero = ((((eq & plus) + plus) ^ plus) | eq | minus) & mask
            up = ((minus | (mask ^ (zero | plus))) << 1) | 1
            rest, down = zero | up, (zero & plus) << 1
            rest, minus = rest ^ (rest & down), up & zero
        else:  # nothing is equal, so zero is minus, and nothing goes down
            up = (rest << 1) | 1
            rest, minus = minus | up, minus & up
    return len(text) + m - (rest & mask).bit_count() - (minus & mask).bit_count()


@F.pandas_udf(LongType())
def edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Null where one of the texts is null."""
    return pd.Series([None if x is None or y is None else distance(x, y) for x, y in zip(a, b, strict=True)], dtype="Int64")


def word_codes(a: str, b: str) -> tuple[str, str]:
    """Two texts with a character of its own for each distinct word, so that their distance is one of words."""
    if a == b:
        return "", ""
    number: dict[str, str] = {}
    made = ["".join(number.setdefault(w, chr(len(number) + 1 + 2048 * (len(number) >= 0xD7FF))) for w in text.split()) for text in (a, b)]
    return made[0], made[1]


@F.pandas_udf(LongType())
def word_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Levenshtein distance in words; null where one of the texts is null."""
    return pd.Series([None if x is None or y is None else distance(*word_codes(x, y)) for x, y in zip(a, b, strict=True)], dtype="Int64")
