"""Loops and edits against the plain versions, and on texts that those were slow on."""

import random
import re
import time
from difflib import SequenceMatcher

from loam.operators import compare

LOOP = re.compile(r"(.{1,60}?)\1{5,}", re.S)


def plain_loops(text):
    sizes = [m.end() - m.start() for m in LOOP.finditer(text)]
    return sum(sizes) / max(1, len(text)), max(sizes, default=0)


def plain_changes(old, new):
    found = [x for x in SequenceMatcher(None, old, new, autojunk=False).get_opcodes() if x[0] != "equal"]
    return [(t != "replace" and (a == 0 and c == 0 or b == len(old) and d == len(new)), a, b, c, d) for t, a, b, c, d in found]


def test_loops_as_by_the_expression():
    draw = random.Random(3)
    texts = ["", "a", "aaaaaa", "ababababababa", "\n" * 400, "x" * 5 + "y" * 6, "한국" * 9 + "é" * 7]
    for _ in range(400):
        parts = ["".join(draw.choice("ab é\n") for _ in range(draw.randint(1, 70))) * draw.choice([1, 1, 5, 6, 7, 9]) for _ in range(draw.randint(1, 4))]
        texts.append("".join(parts))
    for t in texts:
        assert compare.loops(t) == plain_loops(t), t


def test_edits_as_by_the_matcher():
    draw = random.Random(4)
    for _ in range(600):
        old = [draw.choice("abc") for _ in range(draw.randint(0, 14))]
        cut = draw.randint(0, 3)
        new = draw.choice([old[cut:], old[: len(old) - cut], old[1:-1], [draw.choice("abc") for _ in range(8)]])
        assert compare._changes(old, new) == plain_changes(old, new), (old, new)
        a, b = "".join(old), "".join(new)
        assert compare.char_similarity(a, b) == SequenceMatcher(None, a, b, autojunk=False).ratio()


def test_long_texts_take_no_minutes():
    draw = random.Random(5)
    text = " ".join("".join(draw.choice("etaoin shrdlu") for _ in range(6)) for _ in range(60_000))
    began = time.monotonic()
    assert compare.loops(text)[0] < 0.1
    assert compare.char_similarity(text, text[9:]) > 0.99 and compare.edit_kind(text, text.split(" ", 1)[1]) == "edge"
    assert time.monotonic() - began < 4
