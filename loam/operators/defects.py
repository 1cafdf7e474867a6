"""Measures of damaged text: doubled tones, lost marks, lost letters, reversed words, reference lists, gibberish.

Each needs decomposition, look-around or a lexicon and sees one text at a time, so they are one Arrow UDF. Lexicons are
sets of lower-case words; without one, the measures that need it are 0. Null counts as empty.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from loam.functions.types import kind, struct_of
from loam.operators.quality import kinds_of

#: Combining grave, acute, tilde, hook above and dot below.
TONES = frozenset("̣̀́̃̉")
#: Words of Vietnamese that lost their marks; a list learnt from a corpus can take their place.
BARE_WORDS = frozenset("cua nhung duoc khong nguoi nhieu mot voi hoac nghien cuu viec hoat thuc trien".split())
#: Vietnamese initials of several letters and of one, and the vowels with a horn.
_INITIALS, _INITIAL, _HORNED = "ngh ng nh ch kh th tr gh gi ph qu", "bcdđghklmnpqrstvx", "ơờớởỡợưừứửữự"
#: Units and short forms without a vowel; wrong letters with the ones that were meant.
UNITS = frozenset("mm cm km kg mg ml dl pp tr tp vs st hz pm kv kw mw".split())
SHIFTS = {"ấ": "ê", "ờ": "ê", "õ": "â", "ỏ": "á"}
VOWELS = frozenset("aeiouyàáảãạăắằẳẵặâấầẩẫậèéẻẽẹêếềểễệìíỉĩịòóỏõọôốồổỗộơớờởỡợùúủũụưứừửữựỳýỷỹỵ")
#: English words that are no bare spelling of Vietnamese ones; a text with a share of them is English.
ENGLISH = frozenset("the of and with from which were this these have has been their into between using".split())
ENGLISH_SHARE, BARE_CAP = 0.04, 3

_LETTERS = re.compile(r"[^\W\d_]+")
_LATIN = re.compile(r"[A-Za-zÀ-ɏḀ-ỿ]+")
_LINKS = re.compile(r"(?:https?://|www\.)\S+|\S+@\S+\.\S+|\bdoi:\s*\S+|\w+(?:-\w+){3,}", re.I)
_DOI = re.compile(r"doi:", re.I)
_MANY = "|".join(_INITIALS.split())
_LOST_HORN = re.compile(rf"(?<![\w-])(?:(?:{_MANY}|[{_INITIAL}])-(?=[{_HORNED}])|(?:{_MANY})-(?=\s+[a-zà-ỹ])|(?-i:[{_INITIAL}])-(?=\s+[a-zà-ỹ]))", re.I)
_PLAIN_SIGNS = re.compile(r"[\d.,;:()\[\]%+\-–—/\"'“”‘’…°*•]*")
_WORDLIKE = re.compile(r"[A-Za-zÀ-ɏḀ-ỿ]{2,}")
_FORMULA = re.compile("[=+−×÷^Ͱ-Ͽ←-⇿∀-⋿]")
_YEAR = re.compile(r"(?<!\d)(?:19|20)\d\d(?!\d)")
#: What a line of a bibliography begins with, and what it holds besides a year.
_NAME = r"[A-ZĐ][^\W\d_]*"
_ENTRY_STARTS = re.compile(
    rf"\s*(?:\[\d{{1,3}}\]\s*{_NAME}|\d{{1,3}}[.)]\s+{_NAME}|{_NAME}(?:[-']{_NAME})?,\s*[A-ZĐ]\.|{_NAME}\s+[A-ZĐ]\.\s?(?:[A-ZĐ]\.)?|(?:{_NAME}\.?\s+){{1,4}}{_NAME}\s*[,(])"
)
_ENTRY_CUE = re.compile(r"\b[A-ZĐ]\.\s?[A-ZĐ]?\.?|et al|\bNXB\b|\bNxb\b|Nhà xuất bản|Tạp chí|Journal|Press\b|\bpp?\.|\btr\.|\bdoi\b|https?://|\bVol\b|\bNo\b\.?")


@dataclass(frozen=True)
class Lexicon:
    """Words that exist, words that are only written without marks by mistake, and words of the other language."""

    words: frozenset[str] = frozenset()
    bare: frozenset[str] = BARE_WORDS
    other: frozenset[str] = ENGLISH


def latin_words(text: str) -> list[str]:
    return [w for w in _LETTERS.findall(text) if w.isascii() or _LATIN.fullmatch(w)]


def doubled_tones(text: str) -> tuple[float, int]:
    """Share of the words of two letters or more that bear two tone marks, and how many such words there are."""
    words = [w for w in _LETTERS.findall(text) if len(w) > 1]
    hits = sum(1 for w in words if not w.isascii() and sum(c in TONES for c in unicodedata.normalize("NFD", w)) > 1)
    return hits / max(1, len(words)), len(words)


def without_links(text: str) -> str:
    """Text without what _LINKS finds. It tries every word from each of its letters, so texts that can hold none are let be."""
    low = text.lower()
    some = "@" in text or text.count("-") > 2 or "://" in text or "www." in low or (":" in text and _DOI.search(text))
    return _LINKS.sub(" ", text) if some else text


def bare_share(text: str, lexicon: Lexicon) -> tuple[float, int]:
    """Share of words written without their marks, at most BARE_CAP for one word; 0 for texts of the other language."""
    words = latin_words(without_links(text).lower())
    count = Counter(words)
    if sum(count[w] for w in lexicon.other & count.keys()) >= ENGLISH_SHARE * max(1, len(words)):
        return 0.0, len(words)
    return sum(min(count[w], BARE_CAP) for w in lexicon.bare & count.keys()) / max(1, len(words)), len(words)


def reversal(text: str, lexicon: Lexicon) -> tuple[float, float, int]:
    """Gain of reading every word of three letters or more backwards, the share of known words then, and the words."""
    words = [w for w in latin_words(text.lower()) if len(w) > 2]
    n = max(1, len(words))
    back = sum(w[::-1] in lexicon.words for w in words) / n
    return back - sum(w in lexicon.words for w in words) / n, back, len(words)


def gibberish(text: str) -> tuple[float, int]:
    """Share of tokens without two Latin letters in a row, among those that aren't numbers or punctuation."""
    tokens = [t for t in text.split() if not _PLAIN_SIGNS.fullmatch(t)]
    return sum(_WORDLIKE.search(t) is None for t in tokens) / max(1, len(tokens)), len(tokens)


def dropped_runs(text: str, window: int = 30) -> int:
    """Runs of two or more neighbouring bits of one or two consonants, one of two at least, that stand by no formula."""
    def bit(t: str) -> bool:
        return len(t) <= 2 and t.isalpha() and t.islower() and not VOWELS & set(t) and t not in UNITS

    runs: list[list[re.Match]] = [[]]
    for m in re.finditer(r"\S+", text):
        if bit(m[0]):
            runs[-1].append(m)
        elif runs[-1]:
            runs.append([])
    near = lambda a, b: text[max(0, a - window) : a] + text[b : b + window]
    return sum(1 for r in runs if len(r) > 1 and any(len(m[0]) == 2 for m in r) and not _FORMULA.search(near(r[0].start(), r[-1].end())))


def joined_words(text: str, lexicon: Lexicon) -> int:
    """Unknown marked words of five letters or more that are two known words without the blank."""
    def two(w: str) -> bool:
        return any(w[:i] in lexicon.words and w[i:] in lexicon.words for i in range(2, len(w) - 1))

    return sum(1 for w in latin_words(text.lower()) if len(w) > 4 and not w.isascii() and w not in lexicon.words and two(w))


def shifted_words(text: str, lexicon: Lexicon, shifts: dict[str, str] = SHIFTS) -> int:
    """Unknown words that one wrong letter keeps from being known."""
    def mended(w: str) -> bool:
        return any(w[:i] + shifts[c] + w[i + 1 :] in lexicon.words for i, c in enumerate(w) if c in shifts)

    return sum(1 for w in latin_words(text.lower()) if w not in lexicon.words and mended(w)) if lexicon.words else 0


def entry_flags(lines: list[str], carried: int = 3, longest: int = 30) -> list[bool]:
    """Which lines belong to a bibliography: entries, and up to three lines of at most thirty words after each."""
    out, left = [], 0
    for x in lines:
        if _ENTRY_STARTS.match(x) and _YEAR.search(x) and _ENTRY_CUE.search(x):
            left = carried + 1
        elif left and len(x.split()) > longest:
            left = 0
        left = max(0, left)
        out.append(left > 0)
        left -= left > 0
    return out


#: Names of the measures in the order of the result.
NAMES = ("garbled", "unaccented", "hyphen_lost", "reversed_gain", "ref_line", "gibberish", "dropped_letters", "joined_words", "tone_shift")


def measured(text: str | None, lexicon: Lexicon) -> tuple:
    """The values of NAMES: shares from enough words (0 below), and counts."""
    text = unicodedata.normalize("NFC", text or "")
    bare, n_latin = bare_share(text, lexicon)
    gain, back, n_long = reversal(text, lexicon)
    junk, n_tokens = gibberish(text)
    lines = [x for x in text.split("\n") if x.strip()]
    flags = entry_flags(lines)
    return (
        doubled_tones(text)[0],
        bare if n_latin >= 50 else 0.0,
        len(_LOST_HORN.findall(text)),
        gain if n_long >= 30 and back >= 0.5 else 0.0,
        sum(flags) / len(lines) if len(lines) >= 5 else 0.0,
        junk if n_tokens >= 30 else 0.0,
        dropped_runs(text),
        joined_words(text, lexicon),
        shifted_words(text, lexicon),
    )


_COUNTS = ("hyphen_lost", "dropped_letters", "joined_words", "tone_shift")
SCHEMA = struct_of(**{n: "int" if n in _COUNTS else "double" for n in NAMES})


def measures(text: Column, lexicon: Lexicon = Lexicon()) -> Column:
    """A struct of NAMES. The lexicon goes to the workers with the function: a list of bounded size."""

    @F.pandas_udf(SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measured(t, lexicon) for t in texts], columns=list(NAMES), index=texts.index)

    return run(text)


#: Thresholds of the page signals: the least share, and the least number of words (or hits) that it is taken from.
SIGNALS = {"tone": (0.05, 10), "case": (0.2, 10), "foreign": (0.02, 100), "unknown": (0.5, 30), "nodiac": (0.02, 50), "hyphen": (0.004, 50), "control": (0.1, 20)}
#: Latin letters that Vietnamese doesn't have but legacy fonts yield.
FOREIGN = frozenset("ñöïøåæÑÖÏØÅÆ")
_WIDE_SPACES = [chr(i) for i in range(32, 0x3001) if chr(i).isspace()]


def page_signals(text: str | None, lexicon: Lexicon = Lexicon()) -> list[str]:
    """Names of the signals that a page's text layer gives, in the order of SIGNALS."""
    text = unicodedata.normalize("NFC", text or "")
    latin = latin_words(text)
    n = max(1, len(latin))
    long = [w for w in _LETTERS.findall(text) if len(w) > 3]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n_letters = kinds_of(text)["letter"]
    alien, horns = sum(map(text.count, FOREIGN)), len(_LOST_HORN.findall(text))
    low = np.bincount(codes[codes < 32], minlength=32)
    control = int(low.sum() - low[9] - low[10] - low[13])
    solid = control + int((codes >= 32).sum()) - sum(map(text.count, _WIDE_SPACES))
    tone, bare = doubled_tones(text), bare_share(text, lexicon)
    mixed = sum(not w[1:].islower() and any(a.islower() and b.isupper() for a, b in zip(w, w[1:], strict=False)) for w in long)
    unknown = sum(w.lower() not in lexicon.words for w in latin) if lexicon.words else 0
    found = {
        "tone": tone,
        "case": (mixed / max(1, len(long)), len(long)),
        "foreign": (alien / max(1, n_letters) if alien >= 5 else 0.0, n_letters),
        "unknown": (unknown / n, len(latin)),
        "nodiac": bare,
        "hyphen": (horns / n if horns >= 4 else 0.0, len(latin)),
        "control": (control / max(1, solid), control),
    }
    return [name for name, (share, least) in SIGNALS.items() if found[name][1] >= least and found[name][0] >= share]


def signals(text: Column, lexicon: Lexicon = Lexicon()) -> Column:
    """An array of the names of the page's signals."""

    @F.pandas_udf(kind("strings"))
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: page_signals(t, lexicon))

    return run(text)


def shift_candidates(unknown: dict[str, int], words: frozenset[str], alphabet: frozenset[str]) -> Counter:
    """(wrong, right) letters weighted by the words that exactly one exchange of marked letters makes known."""
    out: Counter = Counter()
    for w, n in unknown.items():
        ways = {(c, a) for i, c in enumerate(w) if c in alphabet for a in alphabet - {c} if w[:i] + a + w[i + 1 :] in words}
        if len(ways) == 1:
            out[ways.pop()] += n
    return out
