"""Comparisons and guards of two texts or one: similarity, kinds of edits, excerpts, reasons against an output."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from loam.functions.types import kind, struct_of

#: A unit of up to so many characters that repeats so often is a loop; its limits on a page.
LOOP_UNIT, LOOP_TIMES, LOOP_SHARE, LOOP_LONGEST, MOST_CHARS, CAP_SHARE = 60, 6, 0.4, 600, 20_000, 0.98
_CHATTER = re.compile(r"\s*(?:the user (?:wants|is asking|asked|has provided)|i need to (?:read|transcribe|extract|carefully)|let me (?:transcribe|read|look)|okay,? (?:let me|i need|so))", re.I)


def char_similarity(a: str | None, b: str | None) -> float:
    """2 * matching characters / all characters, by the longest matching blocks; two empty texts are equal."""
    a, b = a or "", b or ""
    if a in b or b in a:  # the longest block is then the whole of the shorter one
        return 2 * min(len(a), len(b)) / (len(a) + len(b)) if a or b else 1.0
    return SequenceMatcher(None, a, b, autojunk=False).ratio()


def _changes(old: list[str], new: list[str]) -> list[tuple[bool, int, int, int, int]]:
    """(at an edge, spans in both) of each difference: an insertion or a deletion at the beginning or the end is an edge."""
    if old == new:
        return []
    out, less = [], len(old) - len(new)
    # The first place of all of new in old, where there are few to look at.
    at = next((i for i in range(less + 1) if old[i : i + len(new)] == new), None) if new and less <= 8 else None
    if at is not None:
        return [(True, a, b, c, c) for a, b, c in ((0, at, 0), (at + len(new), len(old), len(new))) if a < b]
    for tag, a, b, c, d in SequenceMatcher(None, old, new, autojunk=False).get_opcodes():
        if tag != "equal":
            outer = a == 0 and c == 0 or b == len(old) and d == len(new)
            out.append((tag != "replace" and outer, a, b, c, d))
    return out


def edit_kind(old: str | None, new: str | None) -> str:
    """same, edge (words only added or missing at the beginning or the end) or inner."""
    edges = [x[0] for x in _changes((old or "").split(), (new or "").split())]
    return "same" if not edges else "edge" if all(edges) else "inner"


def excerpt(old: str | None, new: str | None, around: int = 6, longest: int = 12) -> str:
    """The first inner difference (else the first) with some words around it: "…left [old -> new] right…"."""
    a, b = (old or "").split(), (new or "").split()
    found = sorted(_changes(a, b), key=lambda x: (x[0], x[1]))
    if not found:
        return ""
    edge, i, j, k, m = found[0]

    def shown(words: list[str]) -> str:
        return " ".join(words if len(words) <= longest else [*words[: longest // 2], "…", *words[-longest // 2 :]]) or "∅"

    return f"…{' '.join(a[max(0, i - around) : i])} [{shown(a[i:j])} -> {shown(b[k:m])}] {' '.join(a[j : j + around])}…" + (" (edge)" if edge else "")


@F.pandas_udf(struct_of(similarity="double", kind="string", excerpt="string"))
def compared(old: pd.Series, new: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(char_similarity(a, b), edit_kind(a, b), excerpt(a, b)) for a, b in zip(old, new, strict=True)], columns=["similarity", "kind", "excerpt"], index=old.index)


def _starts(codes: np.ndarray, unit: int) -> np.ndarray:
    """Places where LOOP_TIMES equal units of a length begin: from there on, enough characters equal the one a unit later."""
    same, need = codes[:-unit] == codes[unit:], unit * (LOOP_TIMES - 1)
    # Most texts have nowhere so many equal characters in a row, which shows in whole blocks of eight.
    if need >= 15:
        blocks = same[: len(same) // 8 * 8].view(np.uint64) == 0x0101010101010101
        for _ in range(min(3, (need - 7) // 8) - 1):
            blocks = blocks[:-1] & blocks[1:]
        if not blocks.any():
            return np.zeros(0, np.int64)
    breaks = np.flatnonzero(np.concatenate(([True], ~same, [True]))) - 1
    runs = np.diff(breaks) - 1
    long = np.flatnonzero(runs >= need)
    return np.concatenate([np.arange(breaks[i] + 1, breaks[i] + 2 + runs[i] - need) for i in long]) if len(long) else np.zeros(0, np.int64)


def loops(text: str) -> tuple[float, int]:
    """Share of a text that lies in loops, and the longest one.

    At each place the shortest unit that repeats often enough counts with all its repeats, and the search goes on behind
    them. The lengths of a unit are looked for one after another in the whole text, not at each of its places.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    shortest = np.zeros(len(codes), np.int64)
    for unit in range(min(LOOP_UNIT, len(codes) // LOOP_TIMES), 0, -1):
        shortest[_starts(codes, unit)] = unit
    sizes, end = [], 0
    for start in np.flatnonzero(shortest).tolist():
        if start < end:
            continue
        unit = int(shortest[start])
        again, end = text[start : start + unit], start + unit * LOOP_TIMES
        while text.startswith(again, end):
            end += unit
        sizes.append(end - start)
    return sum(sizes) / max(1, len(text)), max(sizes, default=0)


def guard(raw: str | None, text: str | None, finish: str | None = None, tokens: int | None = None, most_tokens: int | None = None, error: str | None = None) -> list[str]:
    """Reasons against an output, in a fixed order; an error is the only reason."""
    if error:
        return ["error"]
    raw, text = raw or "", text or ""
    share, longest = loops(text)
    checks = {
        "length": finish == "length" or bool(most_tokens and tokens and tokens >= CAP_SHARE * most_tokens),
        "empty": not text.strip(),
        "embedded_image": "data:image" in raw or "base64," in raw,
        "english_meta": _CHATTER.match(text[:300]) is not None,
        "loop": share >= LOOP_SHARE or longest >= LOOP_LONGEST,
        "too_long": len(text) > MOST_CHARS,
    }
    return [name for name, hit in checks.items() if hit]


@F.pandas_udf(kind("strings"))
def guarded(raw: pd.Series, text: pd.Series, finish: pd.Series) -> pd.Series:
    return pd.Series([guard(r, t, f) for r, t, f in zip(raw, text, finish, strict=True)])


def decide(rates: dict[str, float], passed: list[str], quality: list[str], lower: dict[str, float], speed: dict[str, float]) -> tuple[str, str | None, list[str]]:
    """(status, winner, tied): the least error rate among those that passed all gates wins; engines whose difference from
    it may be nothing (the interval's lower bound is at most 0) tie, and the fastest of the tied wins.

    Without one that passed: option_c if some pass on quality, no_candidate otherwise.
    """
    if not passed:
        return ("option_c" if quality else "no_candidate"), None, []
    best = min(passed, key=lambda n: (rates[n], n))
    tied = [n for n in sorted(passed) if n != best and lower[n] <= 0]
    return "winner", max([best, *tied], key=lambda n: speed.get(n, 0.0)), tied


def reading_order(boxes: list[tuple[float, float, float, float, str]], width: float, gutter: float = 0.02) -> list[str]:
    """Texts of boxes (x0, y0, x1, y1, text) in reading order: one column, or two with a gutter in the middle third.

    The gutter is the widest vertical strip there that at most a tenth of the boxes cross; boxes that cross it (titles)
    part the page into bands, and in each band the left column comes before the right one.
    """
    rows = sorted(boxes, key=lambda b: (b[1], b[0]))
    best, at = 0.0, None
    edges = sorted({width / 3, 2 * width / 3, *(x for b in rows for x in (b[0], b[2]) if width / 3 < x < 2 * width / 3)})
    for left, right in zip(edges, edges[1:], strict=False):
        crossing = sum(b[0] < right and b[2] > left for b in rows)
        if right - left > best and crossing <= 0.1 * len(rows):
            best, at = right - left, (left + right) / 2
    if at is None or best < gutter * width or not any(b[2] <= at for b in rows) or not any(b[0] >= at for b in rows):
        return [b[4] for b in rows]
    out, band = [], []
    for b in [*rows, None]:
        if b is None or b[0] < at < b[2]:
            out += [x[4] for x in band if x[2] <= at] + [x[4] for x in band if x[0] >= at]
            band = []
            if b is not None:
                out.append(b[4])
        else:
            band.append(b)
    return out
