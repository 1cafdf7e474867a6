"""Families of near-duplicates against all pairs of every bucket, with groups whose smallest id is the odd one out."""

import random

import pandas as pd

from loam.operators import minhash


SEEDS = [16, 21, 22, 31, 38, 47, 48, 49, 50, 57, 61, 65, 68, 76, 81, 86, 88, 100, 101, 107]


def _texts(seeds: list[int], size: int = 120) -> list[tuple[int, str]]:
    """For each seed eight variants of a text, the first three changed most; the smallest id splits the family if only it is compared."""
    rows = []
    for seed in seeds:
        rng = random.Random(seed)
        for i in range(8):
            words = [f"w{seed}x{at}" for at in range(size)]
            for at in rng.sample(range(size), 2 if i < 3 else 1):
                words[at] = f"e{seed}v{i}x{at}"
            rows.append((1000 * seed + i, " ".join(words)))
    return rows


def _linked(rows: list[tuple[int, str]], centre_only: bool = False, threshold: float = 0.8) -> dict[int, int]:
    """Smallest id reached over all pairs of all buckets, or over the pairs with each bucket's smallest id."""
    signs = {i: minhash.signature(t) for i, t in rows}
    raw = pd.Series([s.astype("<u4").tobytes() for s in signs.values()])
    buckets, root = {}, {i: i for i in signs}
    for i, keys in zip(signs, minhash.band_keys.func(raw), strict=True):
        for key in enumerate(keys):
            buckets.setdefault(key, []).append(i)
    for members in buckets.values():
        for at, a in enumerate(members[:1] if centre_only else members):
            for b in members[at + 1 :]:
                if (signs[a] == signs[b]).mean() >= threshold:
                    low, high = sorted((root[a], root[b]))
                    root = {k: low if v == high else v for k, v in root.items()}
    return root


def test_smallest_id_is_the_odd_one_out(spark):
    rows = _texts(SEEDS)
    want = _linked(rows)
    assert all(_linked(_texts([seed])) != _linked(_texts([seed]), centre_only=True) for seed in SEEDS)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for blocks in ({}, {"block": 2}):
        got = minhash.families(docs, "doc_id", "text", **blocks).collect()
        assert {r["doc_id"]: r["representative"] for r in got} == want
