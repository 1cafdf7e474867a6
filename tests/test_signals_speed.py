"""Page signals and letter counts: the same as by plain loops over characters, and on texts that those were slow on."""

import random
import time

from loam import plans
from loam.operators import defects
from tests.oracle import assert_same


def test_links_are_only_looked_for_where_they_can_be():
    draw = random.Random(6)
    bits = ["doi: 1", "DOİ:x", "a-b-c-d", "http://x", "httpſ://x", "WWW.x", "a@b.c", "word", "-", ":", "a:b"]
    for _ in range(500):
        text = " ".join(draw.choice(bits) for _ in range(draw.randint(0, 4)))
        assert defects.without_links(text) == defects._LINKS.sub(" ", text)


def test_signals_of_planted_pages():
    base = "plain words of a page that are all known here " * 4
    assert defects.page_signals(base) == []
    assert defects.page_signals(base + "ñöï øåæ ñöï " * 9) == ["foreign"]
    assert defects.page_signals(base + "\x01\x02" * 30) == ["control"]
    assert defects.page_signals("　  \t" * 50 + "\x01" * 20 + "x" * 181) == []
    assert defects.page_signals("　  \t" * 50 + "\x01" * 20 + "x" * 180) == ["control"]
    assert defects.page_signals("wordsAre wordsAre plain " * 10) == ["case"]


def test_long_page_takes_no_minutes():
    """A word of 40,000 characters without an address: the search for links tried it from each of its letters."""
    began = time.monotonic()
    defects.page_signals("a" * 40_000 + " and some more words here")
    assert time.monotonic() - began < 1


def test_letters_of_odd_texts(spark, tmp_path):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([None, "", "Đăng ẤẼ abc 12 한국 ²", "x\n\ny é à"])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert assert_same(plans.QUERIES["book_scan"](spark, str(tmp_path)), plans.SQL["book_scan"], str(tmp_path)) == 1
