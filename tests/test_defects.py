"""Damage measures, guards and comparisons on hand-written cases."""

import pytest

from loam.operators import compare, defects

LEXICON = defects.Lexicon(frozenset("tương hỗ nghiên cứu khánh hòa tóm tắt người được trường học the cat sat on mat river stone green field window door house garden".split()))


def test_doubled_tones():
    assert defects.doubled_tones("tiếng việt đúng") == (0.0, 3)
    assert defects.doubled_tones("hoàá quảáng ba") == (2 / 3, 3)
    assert defects.doubled_tones("") == (0.0, 0)


def test_bare_words_are_capped_and_english_is_spared():
    share, n = defects.bare_share("duoc duoc duoc duoc duoc nguoi " + "đẹp " * 10, LEXICON)
    assert n == 16 and share == pytest.approx(4 / 16)
    assert defects.bare_share("duoc " * 5 + "the of and with " * 3, LEXICON)[0] == 0.0
    assert defects.bare_share("http://x.vn/duoc-nguoi duoc@nguoi.vn", LEXICON) == (0.0, 0)


def test_lost_horns():
    count = lambda t: defects.measured(t, LEXICON)[defects.NAMES.index("hyphen_lost")]
    assert count("đ-ợc ng-ời th- viện h- ớng") == 4
    assert count("e-mail x-ray C- section co-operate k-means") == 0


def test_reversed_words():
    words = "river stone green field window door house garden".split()
    gain, back, n = defects.reversal(" ".join(w[::-1] for w in words * 5), LEXICON)
    assert (gain, back, n) == (1.0, 1.0, 40)
    assert defects.reversal(" ".join(words), LEXICON)[0] == -1.0


def test_bibliography():
    entry = "[3] Nguyen V.A., A long title of some work, Tap chi X, 2015, pp. 3-9"
    assert defects.entry_flags([entry, "and its second line", entry, *["x " * 40] * 2]) == [True, True, True, False, False]
    assert defects.entry_flags([entry, "a", "b", "c", "d"]) == [True, True, True, True, False]
    assert not any(defects.entry_flags(["Nothing of 2015 here", "12. Only a heading", ""]))


def test_gibberish_and_dropped_letters():
    assert defects.gibberish("/, N9 = < 0 e H ; : word 12 (3)")[0] > 0.5 and defects.gibberish("plain words, 12 (3).") == (0.0, 2)
    assert defects.dropped_runs("the kh n th of nh ng words") == 2
    assert defects.dropped_runs("x y z and t tb = 20") == 0 and defects.dropped_runs("5 km kg") == 0


def test_joined_and_shifted_words():
    assert defects.joined_words("tươnghỗ Tómtắt tương hỗ catsat", LEXICON) == 2
    assert defects.shifted_words("nghiờn cứu Khỏnh Hòa", LEXICON) == 2 and defects.shifted_words("nghiờn", defects.Lexicon()) == 0


def test_short_texts_have_no_shares():
    assert defects.measured(None, LEXICON) == (0.0, 0.0, 0, 0.0, 0.0, 0.0, 0, 0, 0)


def test_page_signals():
    assert defects.page_signals("plain english words on a page " * 4) == []
    assert defects.page_signals("xuAáT TRoNg iPhone daTaSet " * 5) == ["case"]
    assert "control" in defects.page_signals("\x01\x02\x03" * 20 + "ab")
    assert defects.page_signals(None) == []


def test_shift_candidates():
    marks = frozenset("êỏáờ")
    assert defects.shift_candidates({"khỏnh": 7, "zzz": 3}, frozenset({"khánh"}), marks) == {("ỏ", "á"): 7}


def test_udfs(spark):
    from loam.session import ship

    ship(spark)
    rows = spark.createDataFrame([("đ-ợc ng-ời",), (None,)], "t string")
    got = rows.select(defects.measures(rows["t"]).alias("m"), defects.signals(rows["t"]).alias("s")).collect()
    assert [(r["m"]["hyphen_lost"], r["s"]) for r in got] == [(2, []), (0, [])]


def test_edits():
    assert compare.edit_kind("a b c", "a b c") == "same" and compare.edit_kind("a b c", "b c") == "edge" and compare.edit_kind("a b c", "a x c") == "inner"
    assert compare.edit_kind("a b c", "x b c") == "inner" and compare.edit_kind(None, "a") == "edge"
    assert compare.excerpt("one two three", "one 2 three") == "…one [two -> 2] three…" and compare.excerpt("a", "a") == ""
    assert compare.excerpt("b c", "a b c").endswith("(edge)")
    assert compare.char_similarity("abcd", "abcd") == 1.0 and compare.char_similarity(None, "") == 1.0 and compare.char_similarity("ab", "cd") == 0.0


def test_guards():
    assert compare.guard("x", "fine text") == [] and compare.guard("", "", error="boom") == ["error"]
    assert compare.guard("data:image/png", " ", finish="length") == ["length", "empty", "embedded_image"]
    assert compare.guard("", "Let me read the page " + "ab" * 400) == ["english_meta", "loop"]
    assert compare.guard("", "x", tokens=99, most_tokens=100) == ["length"]


def test_decisions():
    rates, speed = {"a": 0.1, "b": 0.12, "c": 0.3}, {"a": 1.0, "b": 2.0, "c": 9.0}
    assert compare.decide(rates, ["a", "b", "c"], [], {"b": -0.01, "c": 0.1}, speed) == ("winner", "b", ["b"])
    assert compare.decide(rates, ["a", "c"], [], {"c": 0.1}, speed) == ("winner", "a", [])
    assert compare.decide(rates, [], ["a"], {}, speed)[0] == "option_c" and compare.decide(rates, [], [], {}, speed)[0] == "no_candidate"


def test_reading_order():
    page = [(0, 0, 100, 5, "title"), (0, 10, 45, 20, "l1"), (0, 22, 45, 30, "l2"), (55, 10, 100, 20, "r1"), (55, 22, 100, 30, "r2"), *[(0, 40 + i, 45, 41 + i, f"a{i}") for i in range(6)], *[(55, 40 + i, 100, 41 + i, f"b{i}") for i in range(6)]]
    order = compare.reading_order(page, 100)
    assert order[:3] == ["title", "l1", "l2"] and order.index("a5") < order.index("r1") < order.index("b0")
    assert compare.reading_order([(0, 5, 100, 6, "b"), (0, 1, 100, 2, "a")], 100) == ["a", "b"] and compare.reading_order([], 10) == []
