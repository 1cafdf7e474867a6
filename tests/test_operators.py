"""Single operators against brute force and planted cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loam.functions import text as T
from loam.operators import chunk, dedup, graph, minhash, packing, sample, vectors
from loam.plans.runtime import Run
from loam.session import scratch_path
from loam.sources import readers
from loam.streaming import ingest


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def test_components_of_nothing(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_planted_near_duplicates(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bcdfghklmnpqrstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 3)))
    rows, truth = [], []
    for i in range(20):
        base = [word() for _ in range(400)]
        rows.append((10 * i, " ".join(base)))
        one = list(base)
        for j in rng.sample(range(400), 4):
            one[j] = word()
        rows += [(10 * i + 1, " ".join(base)), (10 * i + 2, " ".join(one))]
        truth += [(10 * i + 1, 10 * i), (10 * i + 2, 10 * i)]
    got = {r["doc_id"]: r["representative"] for r in minhash.families(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert sum(got[a] == b for a, b in truth) >= len(truth) - 1
    assert all(got[x] // 10 == x // 10 for x in got)


def test_signature_of_short_text_is_null():
    assert minhash.signature("a b c") is None
    assert minhash.signature(None) is None
    assert len(minhash.signature(" ".join("abcdefghijklmnopqrstuvwxyz"))) == 128


def test_contained_document(spark):
    line = lambda i: " ".join(f"w{i}x{j}" for j in range(25))
    docs = [(1, "\n".join(map(line, range(6)))), (2, "\n".join(map(line, range(4)))), (3, "\n".join(map(line, range(90, 94))))]
    got = dedup.contained(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text").collect()
    assert [(r["doc_id"], r["container"], r["shared"], r["n_paras"]) for r in got] == [(2, 1, 4, 4)]


def test_latest_row_wins(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 2, 0), ("b", 1, 5), ("b", 1, 6)], "k string, at int, v int")
    got = {r["k"]: r["v"] for r in dedup.latest(rows, ["k"], ["at", "v"]).collect()}
    assert got == {"a": 0, "b": 6}


@given(st.lists(st.integers(1, 60), max_size=60), st.integers(60, 100))
@settings(max_examples=60, deadline=None)
def test_best_fit_never_overflows(sizes, room):
    bins = packing.best_fit(sizes, room)
    used = np.bincount(bins, sizes) if sizes else np.zeros(0)
    assert (used <= room).all()
    if len(used) > 1:  # no two bins could have been one
        assert np.sort(used)[:2].sum() > room


@given(st.integers(0, 300), st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(0, 50), max_size=8))
def test_level_fill(total, room):
    out = sample.level_fill(total, room)
    assert sum(out.values()) == min(total, sum(room.values()))
    assert all(0 <= out[k] <= room[k] for k in room)
    full = [out[k] for k in room if out[k] < room[k]]
    assert not full or max(full) - min(full) <= 1


def test_chunks_keep_all_words_and_the_maximum():
    text = "\n\n".join(" ".join(f"w{i}_{j}" for j in range(n)) for i, n in enumerate((30, 5, 200, 90, 12, 3)))
    parts = chunk.cut(text, 60, 120, 20, "\n\n")
    assert " ".join(parts).split() == text.split()
    assert all(chunk.token_count(p) <= 120 for p in parts)
    assert all(chunk.token_count(p) >= 20 for p in parts)
    assert chunk.cut("", 60, 120, 20, "\n\n") == []


def test_line_cleaning():
    text = "Head:\nmenu\nreal sentence that is long enough to stay in the text\nmenu\nmenu\n12\nPage 3\nend of text\nend of text"
    clean, removed = chunk.clean_lines(text)
    assert clean.split("\n") == ["Head:", "menu", "real sentence that is long enough to stay in the text", "end of text"]
    assert sorted(removed) == ["12", "Page 3", "end of text", "menu", "menu"]
    table = "a|b\nc|d\ne|f\na|b"
    assert chunk.clean_lines(table) == (table, [])


def test_normalized():
    assert chunk.normalized("a\r\nb  c​d\n\n\n\ne  ") == "a\nb cd\n\ne"
    assert chunk.normalized("é") == "é"


def test_segments_break_at_gaps_and_rejections(spark):
    rows = [(1, i, k, f"t{i}", 10) for i, k in ((0, True), (1, True), (2, False), (3, True), (5, True))]
    got = packing.segments(spark.createDataFrame(rows, "d int, i int, k boolean, t string, n int"), "d", "i", F.col("k"), "t", "n").orderBy("first_index").collect()
    assert [(r["first_index"], r["last_index"], r["token_count"], r["break_reason"]) for r in got] == [(0, 1, 20, "rejected"), (3, 3, 10, "gap"), (5, 5, 10, "doc_end")]
    assert got[0]["text"] == "t0\n\nt1"


def test_cosine_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 8))
    x[7] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = vectors.cosine_neighbours(df, df.where("id % 10 = 0"), "id", "v", 3, block=5).collect()
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    for q in range(0, 120, 10):
        score = np.round(unit @ unit[q], 9)
        score[[q, 7]] = -2
        want = sorted(range(120), key=lambda i: (-score[i], i))[:3]
        assert [r["id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query"] == q] == want


def test_principal_components_match_numpy(spark):
    x = np.random.default_rng(2).normal(size=(80, 5)) * np.array([5, 3, 1, 1, 1])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = np.array([[r["pc1"], r["pc2"]] for r in vectors.principal_components(df, "id", "v").orderBy("id").collect()])
    _, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    want = (x - x.mean(axis=0)) @ axes[:, [-1, -2]]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-8)
    assert vectors.principal_components(df.limit(2), "id", "v").where("pc1 <> 0").count() == 0


@pytest.mark.parametrize(("value", "want"), [("2020", 2020), ("1970", None), ("1850", None), ("x", None), (None, None)])
def test_year(spark, value, want):
    df = spark.createDataFrame([(value,)], "y string")
    assert df.select(T.year_of(F.col("y"))).first()[0] == want


def test_turns_are_parsed(spark):
    from loam.session import ship

    ship(spark)
    rows = ["[{'from': 'human', 'value': 'hi'}, {'from': 'gpt', 'value': ''}, {'role': 'x', 'content': 'yo'}]", "broken [", None]
    got = [r["t"] for r in spark.createDataFrame([(r,) for r in rows], "s string").select(readers.parse_turns("s").alias("t")).collect()]
    assert [[(t["role"], t["content"]) for t in x] for x in got] == [[("human", "hi"), ("x", "yo")], [], []]


def test_formats(spark):
    rows = [(b"%PDF-1.4", "a.bin"), (b"PK\x03\x04zzzz", "b.docx"), (b"PK\x03\x04zzzz", "b"), (b"<!DOCTYPE html>", "c"), (b"plain", "d.TXT"), (b"", "e")]
    got = [r["f"] for r in spark.createDataFrame(rows, "c binary, p string").select(readers.format_of(F.col("c"), F.col("p")).alias("f")).collect()]
    assert got == ["pdf", "docx", "zip", "html", "txt", None]


def test_stages_are_reused(spark):
    folder = scratch_path(spark, "run")
    run = Run(spark, folder).add("double", lambda df, by: df.withColumn("v", F.col("id") * by), by=2).add("keep", lambda df, least: df.where(F.col("v") >= least), least=4)
    rows, done = run.execute(spark.range(5), "five")
    assert rows.count() == 3 and not any(x["reused"] for x in done)
    assert all(x["reused"] for x in run.execute(spark.range(5), "five")[1])
    assert [x["reused"] for x in run.execute(spark.range(5), "five", force_from="keep")[1]] == [True, False]
    assert [x["stage"] for x in run.execute(spark.range(5), "other", until="double")[1]] == ["double"]


def test_stream_keeps_first_of_each_text(spark, tmp_path):
    base = f"file://{tmp_path}"
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string").coalesce(1).write.parquet(f"{base}/in")
    stream = lambda: ingest.dedup_into(ingest.stream_of(spark, f"{base}/in", "doc_id long, text string"), f"{base}/store", f"{base}/check")
    stream().awaitTermination()
    spark.createDataFrame([(4, "b"), (5, "c")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream().awaitTermination()
    assert sorted(r["doc_id"] for r in spark.read.parquet(f"{base}/store").collect()) == [1, 2, 5]
