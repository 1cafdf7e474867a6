"""Repairs and measures of extracted pages that need callbacks or order: one document at a time, in Arrow batches."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: A phone number: ten or eleven digits in one block after 0 or +84, or a prefix of two to four digits and groups of three
#: or four; and a bare country code before a mobile number in one block or in dashed groups. Blanks alone don't group
#: after a bare 84, as such figures stand in tables.
PHONE = (
    r"(?<![\w.])(?:\+84\d{8,9}|0\d{9,10}|(?:\+84|0\d{1,3})(?:[\s.-]\d{3,4}){2,3})(?!\w)"
    r"|(?<![\w.,/+-])84[\s-]?[35789](?:\d{8}|\d{1,2}(?:-\d{3}){2})(?![\w.,])"
)


def mask_phones(text: Column) -> Column:
    """The text with <PHONE> for every number; native."""
    return F.regexp_replace(text, PHONE, "<PHONE>")


def phone_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(PHONE))


def repeats(text: str) -> dict[str, int]:
    """The longest run of one character, the most frequent 4-gram of words, the longest run of one line."""
    words, lines = text.split(), [x.strip() for x in text.split("\n") if x.strip()]
    grams = Counter(zip(words, words[1:], words[2:], words[3:], strict=False))
    run, best = 0, 0
    for i, x in enumerate(lines):
        run = run + 1 if i and x == lines[i - 1] else 1
        best = max(best, run)
    return {"char_run": max((len(m[0]) for m in re.finditer(r"(\S)\1*", text)), default=0), "gram4": max(grams.values(), default=0), "line_run": best}


_REPEATS = StructType([StructField(n, IntegerType()) for n in ("char_run", "gram4", "line_run")])


@F.pandas_udf(_REPEATS)
def repeat_stats(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(text.fillna("").map(repeats).tolist(), columns=["char_run", "gram4", "line_run"], index=text.index)


def plain_markdown(text: str) -> str:
    """Markdown and simple HTML tables as plain lines: cells parted by " | ", no marks, no rules."""
    text = re.sub(r"\A\s*```[\w-]*\n(.*)\n```\s*\Z", r"\1", text, flags=re.S)
    text = re.sub(r"(?is)</t[dh]>\s*<t[dh][^>]*>", " | ", text)
    text = re.sub(r"(?is)</?(?:table|tbody|thead|tr|t[dh]|p|br|div|span)[^>]*>", "\n", text)
    out = []
    for line in text.split("\n"):
        if re.fullmatch(r"\s*\|?[\s:|-]*-[\s:|-]*\|?\s*", line):
            continue
        line = re.sub(r"!\[([^\]]*)\]\([^)]*\)|\[([^\]]*)\]\([^)]*\)", lambda m: m[1] or m[2] or "", line)
        line = re.sub(r"^\s{0,3}(?:#{1,6}|>|[-*+])\s+", "", line)
        line = re.sub(r"(\*\*|__|`)(.+?)\1", r"\2", line).strip().strip("|").strip()
        if line:
            out.append(re.sub(r"\s*\|\s*", " | ", line))
    return "\n".join(out)


@F.pandas_udf(StringType())
def markdown_to_plain(text: pd.Series) -> pd.Series:
    return text.fillna("").map(plain_markdown)


