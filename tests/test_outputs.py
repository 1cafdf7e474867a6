"""Engines' outputs: distances, loops and bags, of texts that are long or odd."""

import random
import time

import pytest

from loam import plans
from loam.functions.edit import distance
from loam.operators import outputs
from tests.oracle import assert_same


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_distance_with_few_common_characters():
    draw = random.Random(5)
    some = lambda letters: "".join(draw.choice(letters) for _ in range(draw.randint(0, 30)))
    for left, right in (("abcXY ", "abcDE "), ("abcdefg", "ABCDEFGa"), ("ab", "cd"), ("aé\U0001d7ce", "é\U0001d7cez")):
        for _ in range(300):
            a, b = some(left), some(right)
            assert distance(a, b) == plain_distance(a, b) == distance(b, a)


def test_distance_of_equal_long_texts_is_no_loop():
    """Three million equal characters: they were compared one by one."""
    text = "one line of many words\n" * 140_000
    began = time.monotonic()
    assert distance(text, text) == 0 and distance(text, text + "end") == 3
    assert time.monotonic() - began < 0.5


def test_outputs_of_odd_texts(spark, tmp_path):
    texts = [None, "", " \n", "a_b ² Ⅻ ٤ é É x?y? \x0b\x0c z", "the cat sat on " * 30, "one two three four five", "x\x00\x7f~\x80 한국어 กข"]
    rows = [(i + 5, t, "en", "s", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("page_scores", "engine_bags", "engine_lengths", "engine_cascade"):
        assert_same(plans.QUERIES[name](spark, str(tmp_path)), plans.SQL[name], str(tmp_path))


def test_bags_need_no_exchange_of_words(spark, sf):
    """Words of a page were dealt out by page, engine and word."""
    plan = plans.QUERIES["engine_bags"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(regexp_extract_all" not in plan and plan.count("Aggregate") == 1


@pytest.mark.parametrize(("text", "most"), [(None, 0), ("a b c", 0), ("a b c d", 1), ("a b c d " * 3, 3)])
def test_commonest_run(text, most):
    assert outputs.most_equal_run(text) == most
