"""Measures of an engine's output against its reference, a pair of texts at a time: loops and bags of words."""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F

from loam.functions.types import kind, struct_of

_WORDS = re.compile(r"[^ \t\n\r]+").findall
#: Letters and numbers: what the engine calls a word, without the underscore.
_TOKENS = re.compile(r"[^\W_]+").findall

_PRINTABLE = bytes(range(32, 127))
_CAPITALS = bytes.maketrans(bytes(range(97, 123)), bytes(range(65, 91)))


@lru_cache(maxsize=8)
def most_equal_run(text: str | None, n: int = 4) -> int:
    """How often the commonest run of n words occurs. The outputs of a page come one after another with one reference."""
    words = _WORDS(text or "")
    return max(Counter(zip(*(words[i:] for i in range(n)), strict=False)).values(), default=0)


@lru_cache(maxsize=8)
def _bag(text: str) -> Counter:
    return Counter(_TOKENS(text.lower()))


def bag_f1(raw: str | None, ref: str | None) -> float | None:
    """F1 of two bags of words; null without an output and without words."""
    if raw is None or ref is None:
        return None
    a, b = _bag(raw), _bag(ref)
    total = a.total() + b.total()
    return 2 * sum(min(n, b[w]) for w, n in a.items() if w in b) / total if total else None


@F.pandas_udf(struct_of(loops="long", ref_loops="long"))
def loop_counts(raw: pd.Series, ref: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(most_equal_run(a), most_equal_run(b)) for a, b in zip(raw, ref, strict=True)], columns=["loops", "ref_loops"], index=raw.index)


@lru_cache(maxsize=8)
def special_characters(text: str | None) -> int:
    """Characters other than blank to tilde."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return len(text or "") - (len(data) - len(data.translate(None, _PRINTABLE)))


@F.pandas_udf(struct_of(f1="double", special="long", found="long"))
def bags_alike(raw: pd.Series, ref: pd.Series) -> pd.DataFrame:
    rows = [(bag_f1(a, b), special_characters(b), special_characters(a)) for a, b in zip(raw, ref, strict=True)]
    return pd.DataFrame({"f1": pd.Series([r[0] for r in rows], dtype=object), "special": [r[1] for r in rows], "found": [r[2] for r in rows]})


def stand_in(engine: str, remainder: int, text: str) -> str | None:
    """What a stand-in engine makes of a page; remainder is the page's number modulo 7 * 13 * 5, -1 without a number."""
    if engine == "alpha":
        return text
    if engine == "beta":  # bytes: a to z are no part of another character
        return None if remainder % 7 == 0 else text[: len(text) * 28 // 30].encode("utf-8", "surrogatepass").translate(_CAPITALS).decode("utf-8", "surrogatepass")
    if remainder % 13 == 0:
        return (text[:60] + " ") * 8
    return text[: len(text) * (15 if remainder % 5 == 0 else 29) // 30] + " end"


@F.pandas_udf(kind("string"))
def stand_ins(engine: pd.Series, remainder: pd.Series, text: pd.Series) -> pd.Series:
    return pd.Series([stand_in(*x) for x in zip(engine, remainder, text, strict=True)], dtype=object, index=text.index)


#: A filter on the output would otherwise have it made twice.
stand_ins = stand_ins.asNondeterministic()
