"""Quality metrics of a text (one Arrow UDF), reason codes, score and band (native).

Metrics are columns of one struct, so that a stage computes each once. The thresholds are those of Profile; hard codes
cap the score at 40, soft codes take off their penalty, codes keep their order: hard first, then soft.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions import text as T
from loam.functions.types import struct_of
from loam.session import ship

#: Phrases of page furniture.
BOILERPLATE = [
    "đăng nhập", "đăng ký", "liên hệ", "bản quyền", "copyright", "xem thêm", "đọc thêm", "chia sẻ", "bình luận",
    "tin liên quan", "cookie", "hotline", "quảng cáo", "all rights reserved", "click here", "privacy policy",
    "điều khoản", "theo dõi chúng tôi",
]
#: Characters that end a sentence or a heading.
ENDINGS = [".", "!", "?", "…", ":", ";", '"', "”", ")"]
#: Lowest scores of the bands.
BANDS = [("A", 85), ("B", 70), ("C", 55)]


@dataclass(frozen=True)
class Profile:
    """What a source must satisfy."""

    min_words: int = 50
    max_words: int = 100_000
    min_alpha: float = 0.55
    languages: tuple[str, ...] = ("vi",)
    min_lang_score: float = 0.65
    web_checks: bool = False
    odd_words: bool = False


#: Kinds of characters that are counted; each bit of a character's class is one.
_KINDS = ("letter", "digit", "number", "upper", "blank", "odd_blank", "replacement", "private", "junk", "vi")


@cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """A small class for each code point, and for each class how much it counts in each of _KINDS."""
    bit = {name: 1 << i for i, name in enumerate(_KINDS)}
    of = {"Nd": bit["digit"] | bit["number"], "Lu": bit["letter"] | bit["upper"]}
    of |= {k: bit["number"] for k in ("Nl", "No")} | {k: bit["letter"] for k in ("Ll", "Lt", "Lm", "Lo")}
    bits = np.fromiter((of.get(unicodedata.category(chr(i)), 0) for i in range(sys.maxunicode + 1)), np.int32, sys.maxunicode + 1)
    marks = frozenset(T.VI_LETTERS)
    for i in range(0x3001):  # no space and no marked letter lies beyond
        c = chr(i)
        bits[i] |= bit["blank"] * (c in " \t\n\r") | bit["odd_blank"] * (c.isspace() and c not in " \t\n\r") | bit["vi"] * (c.isalpha() and not marks.isdisjoint(c.lower()))
    for name, first, last in (("replacement", 0xFFFD, 0xFFFD), ("private", 0xE000, 0xF8FF), ("junk", 0x0600, 0x06FF), ("junk", 0x0900, 0x0EFF)):
        bits[first : last + 1] |= bit[name]
    seen, numbers = np.unique(bits, return_inverse=True)
    return numbers.astype(np.uint8), (seen[:, None] >> np.arange(len(_KINDS))) & 1


def kinds_of(text: str) -> dict[str, int]:
    """How many characters of a text are of each of _KINDS."""
    table, worth = _classes()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return dict(zip(_KINDS, (np.bincount(table[codes], minlength=len(worth)) @ worth).tolist(), strict=True))


@F.pandas_udf(struct_of(letters="long", marked="long"))
def letter_counts(texts: pd.Series) -> pd.DataFrame:
    """Letters of a text, and those that only Vietnamese has."""
    made = [(k["letter"], k["vi"]) for k in (kinds_of(t or "") for t in texts)]
    return pd.DataFrame(made, columns=["letters", "marked"], index=texts.index)


_WORDS = re.compile(r"[^ \t\n\r]+").findall
_URLS = re.compile(r"https?://[^ \t\n\r]+|www\.[^ \t\n\r]+").findall
_BULLET = re.compile(r"([-•*–·►▪]|[0-9]+[.)])[ \t]").match
_SPANS = [("```", re.compile(r"(?s)```.*?```")), ("\\[", re.compile(r"(?s)\\\[.*?\\\]")), ("\\(", re.compile(r"(?s)\\\(.*?\\\)"))]
_DISPLAY = re.compile(r"(?s)\$\$.*?\$\$")
_ENDS = tuple(ENDINGS)


def _prose(text: str) -> str:
    """As T.math_free()."""
    for begin, span in _SPANS:
        if begin in text:
            text = span.sub(" ", text)
    return _DISPLAY.sub(" ", text) if "$$" in text and text.count("$$") % 2 == 0 else text


def _repeated(words: list[str]) -> float:
    """Share of the word trigrams that are repeats; 0 for fewer than 30."""
    n = len(words) - 2
    return 1 - len(set(zip(words, words[1:], words[2:], strict=False))) / n if n >= 30 else 0.0


def measured(text: str | None) -> tuple:
    """The values of METRICS for one text; every one is over the whole of it."""
    text = text or ""
    prose = _prose(text)
    whole = kinds_of(text)
    free = whole if prose == text else kinds_of(prose)
    # Without other blanks than the four, the interpreter's own split does.
    split = _WORDS if whole["odd_blank"] else str.split
    words = split(text)
    prose_words = words if prose == text else split(prose)
    solid, all_solid, letters = len(prose) - free["blank"], len(text) - whole["blank"], free["letter"]
    lines = [y for x in text.split("\n") if (y := x.strip(T.SPACES))]
    sizes = [len(split(x)) for x in lines]
    lower = text.lower()
    phrases = [p for p in BOILERPLATE if p in lower]
    worded = [x for x in lines if x[0].isalpha() or any(map(str.isalpha, x))] if len(lines) >= 5 else []
    furniture = sum(n < 15 and any(p in low for p in phrases) for n, low in zip(sizes, map(str.lower, lines), strict=True)) if phrases else 0
    n_lines, n_words = max(len(lines), 1), max(len(words), 1)
    repeats = _repeated(prose_words)
    return (
        len(words),
        len(prose_words),
        max(0.0, 1 - solid / all_solid) if all_solid else 0.0,
        letters / max(solid, 1),
        free["digit"] / max(solid, 1),
        (solid - letters - free["number"]) / max(solid, 1),
        free["upper"] / max(letters, 1),
        whole["replacement"] / max(all_solid, 1),
        solid / max(len(prose_words), 1),
        len(_URLS(text)) / n_words if "http" in text or "www." in text else 0.0,
        1 - len(set(worded)) / len(worded) if len(worded) >= 5 else 0.0,
        sum(n < 5 for n in sizes) / n_lines,
        sum(_BULLET(x) is not None for x in lines) / n_lines,
        sum(x.endswith(_ENDS) for x in lines) / n_lines,
        furniture / n_lines,
        repeats,
        repeats if prose_words is words else _repeated(words),
        free["vi"] / max(letters, 1),
        len(lines),
        whole["private"],
        whole["junk"],
    )


#: Names of the metrics in the order of the struct; _WHOLE are counts.
METRICS = (
    "words", "prose_words", "math_share", "alpha", "digit", "symbol", "upper", "replacement", "mean_word_len", "url", "dup_line", "short_line", "bullet", "end_punct",
    "boilerplate_line", "rep_trigram", "rep_trigram_raw", "vi_diacritic", "lines", "pua_chars", "junk_script_chars",
)
_WHOLE = ("words", "prose_words", "lines", "pua_chars", "junk_script_chars")


@F.pandas_udf(struct_of(**{n: "int" if n in _WHOLE else "double" for n in METRICS}))
def _metrics(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measured(t) for t in texts], columns=list(METRICS), index=texts.index)


#: A filter on a metric would otherwise be pushed below the function and have it run twice.
_metrics = _metrics.asNondeterministic()


def with_metrics(docs: DataFrame, text_col: str = "text", out: str = "m") -> DataFrame:
    """docs with a struct of the metrics; ratios are over the text without math and code.

    One Arrow UDF that sees each text once: a class for each character, counted in one pass, one list of words and one of
    lines. The Column expressions took about ten passes of regular expressions and interpreted lambdas for each text.
    """
    ship(docs.sparkSession)
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], _metrics(F.col(f"`{text_col}`")).alias(out))


def _codes(*pairs: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in pairs]))


#: Metrics that other operators add; rules that need one apply only where the struct has it.
EXTRA = ("garbled", "unaccented", "reversed_gain", "dropped_letters", "hyphen_lost", "odd_word", "perplexity", "mixed", "ref_line")


def scored(docs: DataFrame, lang: Column, lang_score: Column, profile: Profile = Profile(), m: str = "m") -> DataFrame:
    """docs with reason_codes, quality_score and quality_band."""
    extra = tuple(f.name for f in docs.schema[m].dataType.fields if f.name in EXTRA)
    hard, soft, lost = judged(F.col(m), lang, lang_score, profile, extra)
    empty, cut = F.col(f"{m}.words") == 0, F.size("__hard") > 0
    out = docs.select("*", hard.alias("__hard"), soft.alias("__soft"), F.greatest(F.lit(0.0), 100.0 - lost).alias("__full"))
    score = F.when(empty, F.lit(0.0)).when(cut, F.least(F.lit(40.0), F.col("__full"))).otherwise(F.col("__full"))
    out = out.select("*", F.concat("__hard", "__soft").alias("reason_codes"), score.alias("quality_score")).drop("__hard", "__soft", "__full")
    return out.withColumn("quality_band", band_of(F.col("quality_score")))


def judged(m: Column, lang: Column, lang_score: Column, profile: Profile, extra: tuple[str, ...] = ()) -> tuple[Column, Column, Column]:
    """Hard codes, soft codes and the sum of the penalties of one document's metrics; extra names those of EXTRA it has."""
    of = lambda name, *rule: [rule] if name in extra else []
    x = lambda name: m[name]
    math_only = (x("prose_words") < 20) & (x("math_share") >= 0.3)
    plain = ~math_only
    hard = _codes(
        ("empty", x("words") == 0),
        ("too_short", (x("words") > 0) & (x("words") < profile.min_words)),
        ("too_long", x("words") > profile.max_words),
        ("lang_not_allowed", F.coalesce((lang != "und") & ~lang.isin(*profile.languages), F.lit(True)) & (x("words") > 0)),
        ("low_alpha", (x("alpha") < profile.min_alpha) & plain & (x("words") > 0)),
        ("replacement_chars", x("replacement") > 0.005),
        ("repeated_ngrams", ((x("rep_trigram") > 0.5) & plain) | (x("rep_trigram_raw") >= 0.8)),
        ("duplicate_lines", x("dup_line") > 0.5),
        *of("garbled", "garbled_font", x("garbled") >= 0.08),
        ("private_use_chars", x("pua_chars") >= 5),
        ("math_font_junk", x("junk_script_chars") >= 5),
        *of("unaccented", "lost_diacritics", x("unaccented") >= 0.02),
        *of("reversed_gain", "reversed_text", x("reversed_gain") >= 0.25),
        *of("hyphen_lost", "lost_letters", x("hyphen_lost") >= 3),
        *(of("odd_word", "odd_words", (x("odd_word") >= 0.15) | (x("odd_word") >= 0.08) & (F.coalesce(x("perplexity"), F.lit(0.0)) >= 120)) if profile.odd_words and "perplexity" in extra else []),
    )
    some = x("words") > 0
    soft = [
        ("repetitive", 20, (x("rep_trigram") > 0.3) & plain),
        ("dup_lines_some", 15, x("dup_line") > 0.25),
        ("digit_heavy", 15, (x("digit") > 0.3) & plain),
        ("symbol_heavy", 15, (x("symbol") > 0.35) & plain),
        ("mostly_upper", 15, x("upper") > 0.5),
        ("odd_word_length", 15, ~x("mean_word_len").between(2.5, 10) & plain),
        ("some_replacement_chars", 10, x("replacement") > 0.0005),
        ("lang_unknown", 0, lang == "und"),
        ("low_lang_score", 10, (lang != "und") & (lang_score < profile.min_lang_score)),
        *of("mixed", "mixed_language", 0, x("mixed")),
        ("low_diacritic", 15, (lang == "vi") & (x("words") >= 20) & (x("vi_diacritic") < 0.05)),
        *of("ref_line", "reference_list", 0, x("ref_line") >= 0.5),
        *of("perplexity", "high_perplexity", 10, x("perplexity") >= 120),
    ]
    if profile.web_checks:
        long = x("lines") >= 5
        soft += [
            ("url_heavy", 20, x("url") > 0.1),
            ("boilerplate", 20, x("boilerplate_line") > 0.15),
            ("list_like", 15, (x("short_line") > 0.7) & long),
            ("bullet_heavy", 10, (x("bullet") > 0.5) & long),
            ("few_sentences", 10, (x("end_punct") < 0.15) & long),
        ]
    lost = reduce(lambda a, b: a + b, [F.when(F.coalesce(c, F.lit(False)), F.lit(p)).otherwise(0) for _, p, c in soft])
    soft_codes = _codes(*[(name, c & some) for name, _, c in soft])
    return hard, soft_codes, lost


def band_of(score: Column) -> Column:
    out = F.lit("D")
    for name, low in reversed(BANDS):
        out = F.when(score >= low, name).otherwise(out)
    return out
