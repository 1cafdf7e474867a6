"""Shares of rare words and perplexity against plain loops, with what they shuffle."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loam.operators import words
from loam.plans import QUERIES, pages

ODD = [(1, "AbC unique " + "plain " * 50), (1, "unique twice other"), (None, "twice " + "plain " * 60), (None, "other twice"), (2, "other USA uSa " * 20), (3, None), (4, ""), (5, "unique other Twice " + "plain " * 49)]


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _shuffled(spark, job):
    """What job() gives, and how many records it shuffled."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def last(n, missing=0):
        total = 0
        while missing < 20:
            try:
                total, missing = total + store.lastStageAttempt(n).shuffleWriteRecords(), 0
            except Exception:
                missing += 1
            n += 1
        return n - missing, total

    first, _ = last(0)
    out = job()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return out, last(first)[1]


@pytest.fixture(scope="module")
def common(spark):
    """600 documents of 200 of 300 words each."""
    rng = random.Random(3)
    lexicon = [f"{a}{b}{c}" for a in "bcdfghklmnpqrstvwxyz" for b in "aeiou" for c in "rst"]
    return [(i, "\n".join(" ".join(rng.choice(lexicon) for _ in range(40)) for _ in range(5))) for i in range(600)]


@pytest.mark.parametrize("frequent", [0, 1, 200_000])
def test_odd_words_by_plain_loops(spark, frequent):
    got = {r["doc_id"]: r["odd_word"] for r in pages._odd_words(_docs(spark, ODD), frequent).collect()}
    tokens = {}
    for i, t in ODD:
        tokens.setdefault(i, []).extend((t or "").split())
    df = Counter(w for ws in tokens.values() for w in {x.lower() for x in ws})
    for i, ws in tokens.items():
        odd = sum(df[w.lower()] < 3 and not (w == w.upper() and len(w) <= 6) for w in ws)
        assert got.get(i, 0.0) == pytest.approx(odd / len(ws) if len(ws) >= 50 else 0.0)


@pytest.mark.parametrize("frequent", [0, 1, 200_000])
def test_perplexity_by_plain_loops(spark, frequent):
    rows = [(i, t) for i, t in ODD if i not in (1, None)] + [(9, "plain usa seldom " * 300)]
    got = {r["doc_id"]: r["perplexity"] for r in pages.unigram_scores(_docs(spark, rows), frequent=frequent).collect()}
    n = Counter(w for _, t in rows for w in (t or "").lower().split())
    for i, t in rows:
        ws = (t or "").lower().split()[:512]
        want = math.exp(sum(-math.log(n[w] / n.total()) for w in ws) / len(ws)) if len(ws) >= 8 else None
        assert got.get(i) == (None if want is None else pytest.approx(want))


def test_words_of_the_list_have_three_ids(spark):
    rows = _docs(spark, ODD)
    assert {r["w"] for r in words.surely_common(rows, "doc_id", F.split("text", " ")).collect()} <= {"plain", "other", "unique", "twice", "Twice", ""}
    two = _docs(spark, [(1, "a b"), (1, "a b"), (1, "a"), (2, "a"), (None, "c"), (None, "c"), (3, "c")])
    assert words.surely_common(two, "doc_id", F.split("text", " ")).count() == 0


def test_frequent_words_are_not_shuffled(spark, common, tmp_path):
    docs = _docs(spark, common)
    for job in (lambda: pages._odd_words(docs).collect(), lambda: pages.unigram_scores(docs).collect()):
        rows, shuffled = _shuffled(spark, job)
        assert len(rows) == 600 and shuffled < 600 * 20
    docs.selectExpr("doc_id", "text", "'s' AS source", "'en' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    rows, shuffled = _shuffled(spark, lambda: QUERIES["producer_profile"](spark, str(tmp_path)).collect())
    assert [tuple(r) for r in rows] == [("s", "en", 600, 3000, 0.0, 0)] and shuffled < 600 * 20
