"""The second round of deduplication against a plain version, and the recall of near-duplicates at known edits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loam.operators import fingerprints, minhash


def _rows(spark, run, items):
    """items: (doc_id, source, text, score, alive, written_at)."""
    rows = spark.createDataFrame(items, "doc_id long, source string, text string, score double, alive boolean, at string")
    c = F.col
    group = F.when(c("source") == "chat", "sft").otherwise("cpt")
    rights = F.when(c("source") == "closed", "unknown").otherwise("open")
    priority = F.when(c("source") == "best", 0).otherwise(3)
    return fingerprints.of_documents(rows, "text", group, c("source"), c("score"), priority, rights, c("alive"), c("at")).withColumn("run", F.lit(run))


def _plain(rows, threshold=0.8):
    """The verdict by comparing all pairs."""
    latest = {}
    for r in sorted(rows, key=lambda r: (r["written_at"], r["run"])):
        latest[r["dedup_group"], r["doc_id"]] = r
    out = {k: ("dropped", None, None) for k, r in latest.items() if not r["alive"]}
    out |= {k: ("rights", None, None) for k, r in latest.items() if r["alive"] and r["rights"] != "open"}
    for group in {k[0] for k in latest}:
        docs = sorted((r for k, r in latest.items() if k[0] == group and k not in out), key=lambda r: (r["priority"], -r["score"], r["doc_id"]))
        root = list(range(len(docs)))
        sigs = [None if r["minhash"] is None else np.frombuffer(r["minhash"], "<u4") for r in docs]
        for i in range(len(docs)):
            for j in range(i + 1, len(docs)):
                close = sigs[i] is not None and sigs[j] is not None and (sigs[i] == sigs[j]).mean() >= threshold
                if docs[i]["sha"] == docs[j]["sha"] or close:
                    low, high = sorted((root[i], root[j]))
                    root = [low if x == high else x for x in root]
        for j, r in enumerate(docs):
            exact = any(docs[i]["sha"] == r["sha"] for i in range(j))
            out[group, r["doc_id"]] = ("kept", None, None) if root[j] == j else ("duplicate", "exact" if exact else "fuzzy", docs[root[j]]["doc_id"])
    return out


def test_verdict_by_brute_force(spark, tmp_path):
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)) for _ in range(6)]
    def edited(t, n):
        w = t.split()
        for i in rng.sample(range(len(w)), n):
            w[i] = f"e{rng.randrange(10**6)}"
        return " ".join(w)

    first = [(i, rng.choice(["best", "other", "closed", "chat"]), edited(base[i % 6], rng.choice([0, 0, 1, 60])), float(rng.randrange(3)), True, "2024-01-01") for i in range(48)]
    first += [(100, "other", "too short", 1.0, True, "2024-01-01"), (101, "other", "too short", 1.0, True, "2024-01-01"), (102, "other", None, 1.0, True, "2024-01-01")]
    later = [(i, s, t, x, i % 3 != 0, "2024-02-01") for i, s, t, x, _, _ in first if i % 5 == 0]
    store = f"{tmp_path}/store"
    fingerprints.write_run(_rows(spark, "a", first).drop("run"), store, "a")
    fingerprints.write_run(_rows(spark, "b", later).drop("run"), store, "b")
    fingerprints.write_run(_rows(spark, "b", later).drop("run"), store, "b")
    rows = fingerprints.read_store(spark, store)
    assert rows.count() == len(first) + len(later)
    got = fingerprints.verdict(rows, enforce=("open",), block=4).collect()
    assert {(r["dedup_group"], r["doc_id"]): (r["verdict"], r["dup_kind"], r["dup_of"]) for r in got} == _plain(rows.collect())
    sizes = {r["family_id"]: r["family_size"] for r in got if r["verdict"] in ("kept", "duplicate")}
    assert sum(sizes.values()) == sum(r["verdict"] in ("kept", "duplicate") for r in got)
    totals = fingerprints.stats(fingerprints.verdict(rows, enforce=("open",))).collect()
    assert sum(r["exact"] + r["fuzzy"] for r in totals) == sum(r["verdict"] == "duplicate" for r in got)


def test_empty_store(spark):
    empty = spark.createDataFrame([], f"{fingerprints.COLUMNS}, run string")
    assert fingerprints.verdict(empty).count() == 0


@pytest.mark.parametrize(("edits", "least"), [(0.0, 1.0), (0.01, 0.9), (0.02, 0.5)])
def test_recall_of_edited_copies(spark, edits, least):
    """40 texts of 400 words, each with a copy whose words are changed here and there; nothing unrelated is linked."""
    rng = random.Random(11)
    docs = []
    for i in range(40):
        words = [f"s{rng.randrange(3000)}" for _ in range(400)]
        docs.append((2 * i, " ".join(words)))
        for at in rng.sample(range(400), round(400 * edits)):
            words[at] = f"n{rng.randrange(10**6)}"
        docs.append((2 * i + 1, " ".join(words)))
    got = {r["doc_id"]: r["representative"] for r in minhash.families(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text").collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(40)) >= least * 40
    assert all(rep in (i, i - 1) for i, rep in got.items())
