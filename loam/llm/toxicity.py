"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

A linear model over hashed words is trained, with numpy, from confirmed toxic documents (P) and unlabelled ones
(U) with the risk  prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)):  where the second part turns negative, the
step goes the other way. The class prior is the share of toxic rows among all usable labels. The margin is then
turned into a probability by Platt scaling on bounded samples of labelled rows of both kinds, weighted to the class
prior. The toxic rows' margins are out of fold: each comes from a model that was trained without the fold it is in.

A document is a set of words (A-Z lower-cased, runs of letters and digits) and of the beginnings of words, hashed
to 2^BITS buckets. Only those that are clearly more frequent in P than in U (telling_words) get a
weight, and an L1 step keeps the weights sparse, so the length of a document doesn't drive its score. Scores read
nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm.sampling import hash_order, thinned
from loam.llm.textcodes import ALNUM, mix, small_batches, word_and_stem_hashes
from loam.session import ship

BITS, MIN_DOCS, LEVEL = 20, 4, 4.5
#: Bytes of the beginnings of words that count as words too: stems tell where endings vary.
STEMS = (4, 5, 6)
#: Bounds on the documents that the model is fitted on: confirmed toxic, unlabelled, and of each kind for the scaling.
POSITIVE_ROWS, UNLABELLED_ROWS, SCALE_ROWS = 2000, 6000, 2000
#: Parts of the toxic rows; each is scored, for the scaling, by a model of the others.
FOLDS = 3


def document_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each document's words and stems, and the n + 1 offsets of the documents."""
    words, at, stems = word_and_stem_hashes(texts, ALNUM, STEMS)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at)).astype(np.uint64) << np.uint64(BITS)
    parts = [owner | words >> np.uint64(64 - BITS)]
    for codes in stems:
        some = codes != 0
        parts.append(owner[some] | codes[some] >> np.uint64(64 - BITS))
    both = np.unique(np.concatenate(parts))
    rows = (both >> np.uint64(BITS)).astype(np.int64)
    return (both & np.uint64((1 << BITS) - 1)).astype(np.int64), np.searchsorted(rows, np.arange(len(at)))


@dataclass
class Rows:
    """Sets of buckets, one after the other."""

    bucket: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(parts: list[np.ndarray]) -> Rows:
        return Rows(np.concatenate(parts) if parts else np.zeros(0, np.int64), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64))

    def __len__(self) -> int:
        return len(self.offset) - 1

    def take(self, rows: np.ndarray) -> Rows:
        return Rows.of([self.bucket[self.offset[i] : self.offset[i + 1]] for i in rows])

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.offset))

    def only(self, live: np.ndarray) -> Rows:
        """The sets without buckets that aren't live."""
        keep = live[self.bucket]
        return Rows(self.bucket[keep], np.concatenate([[0], np.cumsum(np.bincount(self.owner[keep], minlength=len(self)))]).astype(np.int64))

    @property
    def share(self) -> np.ndarray:
        """1 / root of the size: a document's margin is the sum of its words' weights over that root."""
        return 1 / np.sqrt(np.maximum(np.diff(self.offset), 1))

    def without_copies(self) -> Rows:
        """The sets without those that agree with an earlier one in a pair of min-hashes: near copies of it, mostly."""
        if not len(self.bucket):
            return self
        solid = np.flatnonzero(np.diff(self.offset))
        x, seen, keep = self.bucket.astype(np.uint64) + np.uint64(1), set(), np.ones(len(self), bool)
        low = [np.minimum.reduceat(mix(x * f), self.offset[solid]) for f in mix(np.arange(1, 7, dtype=np.uint64)) | np.uint64(1)]
        for row, i in enumerate(solid.tolist()):
            pairs = [(k, int(low[k][row]), int(low[k + 1][row])) for k in (0, 2, 4)]
            keep[i] = not any(p in seen for p in pairs)
            seen.update(pairs)
        return self.take(np.flatnonzero(keep))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return self.share * np.bincount(self.owner, weights[self.bucket], minlength=len(self))

    def gradient(self, slope: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.bucket, (slope * self.share)[self.owner], minlength=size)


def telling_words(positive: Rows, unlabelled: Rows, prior: float, level: float = LEVEL) -> np.ndarray:
    """Buckets that speak for P: more frequent than in U by level standard errors, and toxic in three of five cases.

    A share prior of U is toxic, so prior * share in P / share in U is the chance that a document of U with the word
    is toxic; ordinary words, whatever their frequency, are near the prior.
    """
    p, u = (np.bincount(r.bucket, minlength=1 << BITS) for r in (positive, unlabelled))
    in_p, in_u, share = p / len(positive), u / len(unlabelled), (p + u) / (len(positive) + len(unlabelled))
    error = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / len(positive) + 1 / len(unlabelled)))
    return np.flatnonzero((in_p - in_u >= level * error) & (prior * in_p >= 0.6 * in_u) & (p + u >= MIN_DOCS))


def fit_nnpu(positive: Rows, unlabelled: Rows, prior: float, steps: int = 500, batch: int = 512, rate: float = 0.05, l1: float = 1e-3, seed: int = 11) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and live buckets of a linear model under the non-negative PU risk with the sigmoid loss (Adam)."""
    live = np.zeros(1 << BITS, bool)
    live[telling_words(positive, unlabelled, prior)] = True
    n = int(live.sum())
    place = np.cumsum(live) - 1
    w = np.zeros(n + 1)  # the last one is the bias
    m, v = np.zeros_like(w), np.zeros_like(w)
    draw = np.random.default_rng(seed)
    packed = [Rows(place[r.bucket], r.offset) for r in (positive.only(live), unlabelled.only(live))]
    for step in range(1, steps + 1):
        parts = [r.take(draw.integers(0, len(r), min(batch, len(r)))) for r in packed]
        z_p, z_u = (r.dot(w) + w[-1] for r in parts)
        s_p, s_u = (1 / (1 + np.exp(-np.clip(z, -40, 40))) for z in (z_p, z_u))
        slope_p, slope_u = s_p * (1 - s_p) / len(z_p), s_u * (1 - s_u) / len(z_u)
        if s_u.mean() - prior * s_p.mean() >= 0:  # the loss of calling z negative is s(z), of calling it positive s(-z)
            g_p, g_u = -2 * prior * slope_p, slope_u
        else:
            g_p, g_u = prior * slope_p, -slope_u
        g = parts[0].gradient(g_p, n + 1) + parts[1].gradient(g_u, n + 1)
        g[n] = g_p.sum() + g_u.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w[:n] = np.sign(w[:n]) * np.maximum(np.abs(w[:n]) - l1, 0)
    out = np.zeros(1 << BITS)
    out[live] = w[:n]
    return out, float(w[-1]), live


def fit_scale(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Platt's a, b of 1 / (1 + exp(-(a z + b))) by Newton steps, with his smoothed targets."""
    if not len(margin) or label.min() == label.max():
        return 1.0, 0.0
    pos, neg = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, w = np.stack([margin, np.ones_like(margin)], 1), np.zeros(2)
    for _ in range(60):
        chance = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (weight * (chance - target)) + np.array([1e-3, 0]) * w
        h = (x * (weight * np.maximum(chance * (1 - chance), 1e-9))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    scale: tuple[float, float]
    live: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        bucket, at = document_words(texts)
        z = Rows(bucket, at).only(self.live).dot(self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * z + self.scale[1], -40, 40)))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in small_batches(whole, "text"):
            bucket, at = document_words(batch.column("text"))
            sets = [bucket[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("h"), pa.array(sets, pa.binary())], names=["kind", "h", "words"])


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    positive_rows: int = POSITIVE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS, scale_rows: int = SCALE_ROWS,
) -> Model:
    """A model of the rows where usable (a condition on the id) holds.

    Without a confirmed toxic or without an unlabelled document the model scores every text with the prior.
    A document of several labels is toxic if one of them says so; null labels and ids are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.where(usable & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    known = known.select("id", (F.col("label") > 0).cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    n_docs = docs.where(usable).select(F.count(F.lit(1))).first()[0]
    empty = Model(np.zeros(1 << BITS), float(np.log((prior + 1e-6) / (1 - prior + 1e-6))), (1.0, 0.0), np.zeros(1 << BITS, bool))
    if not sizes.get(1) or not n_docs:
        return empty

    def bounded(df: DataFrame, kind: str, rows: int, seed: int) -> DataFrame:
        return df.select("id", F.lit(kind).alias("kind"), hash_order(F.col("id"), seed).alias("h")).orderBy("h", "id").limit(rows)

    toxic, clean = known.where("label = 1"), known.where("label = 0")
    pool = docs.where(usable).select(F.col(id_col).alias("id")).where("id is not null")
    # The pool is thinned a little wider than needed, as labelled documents leave it again.
    unlabelled = thinned(pool, F.col("id"), 3 * unlabelled_rows, {None: n_docs}, seed=3).join(labels.select(F.col(id_col).alias("id")).distinct(), "id", "left_anti")
    picked = bounded(thinned(toxic, F.col("id"), positive_rows, {None: sizes[1]}, seed=2), "p", positive_rows, 2)
    picked = picked.unionByName(bounded(unlabelled, "u", unlabelled_rows, 3))
    if sizes.get(0):
        picked = picked.unionByName(bounded(thinned(clean, F.col("id"), scale_rows, {None: sizes[0]}, seed=5), "0", scale_rows, 5))
    texts = docs.where(usable).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most positive_rows + unlabelled_rows + scale_rows ids are broadcast.
    rows = texts.join(F.broadcast(picked), "id").select("kind", "h", "text").mapInArrow(_sets, "kind string, h long, words binary")
    got = rows.orderBy("kind", "h", "words").limit(2 * (positive_rows + unlabelled_rows + scale_rows)).toArrow()
    kinds = np.array(got["kind"].to_pylist())
    sets = [np.frombuffer(x.as_buffer(), "<u4").astype(np.int32) for x in got["words"]]
    del got
    part = {k: Rows.of([sets[i] for i in np.flatnonzero(kinds == k)]) for k in ("p", "u", "0")}
    del sets
    if not len(part["p"]):
        return empty
    if not len(part["u"]):  # every document is labelled: the labelled ones stand for the unlabelled
        part["u"] = Rows.of([*(part[k].bucket[a:b] for k in ("p", "0") for a, b in zip(part[k].offset[:-1], part[k].offset[1:], strict=True))])
    unlabelled_sets = part["u"].without_copies()
    weights, bias, live = fit_nnpu(part["p"].without_copies(), unlabelled_sets, prior)
    clean_margin = part["0"].only(live).dot(weights) + bias
    return Model(weights, bias, out_of_fold_scale(part["p"], unlabelled_sets, clean_margin, prior), live)


def out_of_fold_scale(positive: Rows, unlabelled: Rows, clean_margin: np.ndarray, prior: float, folds: int = FOLDS) -> tuple[float, float]:
    """Platt's a, b from the margins of clean rows and the out-of-fold margins of toxic ones.

    Copies of a row are in its fold: the folds are made of the rows left by without_copies(). With fewer rows than folds
    the margin itself is the log-odds.
    """
    positive = positive.without_copies()
    if len(positive) < folds or not len(clean_margin):
        return 1.0, 0.0
    number, margins = np.arange(len(positive)) % folds, []
    for fold in range(folds):
        weights, bias, live = fit_nnpu(positive.take(np.flatnonzero(number != fold)), unlabelled, prior)
        margins.append(positive.take(np.flatnonzero(number == fold)).only(live).dot(weights) + bias)
    toxic_margin = np.concatenate(margins)
    margin = np.concatenate([toxic_margin, clean_margin])
    label = np.repeat([1.0, 0.0], [len(toxic_margin), len(clean_margin)])
    weight = np.where(label == 1, prior / len(toxic_margin), (1 - prior) / len(clean_margin)) * len(label)
    return fit_scale(margin, label, weight)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with the probability of being toxic; a column of that name is replaced.

    Defined results: null counts as empty, and the empty text has the score of a document without words.
    """
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c != name]
    inner = [f"c{i}" for i in range(len(kept))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, inner, strict=True)])
    spot = inner[kept.index(text_col)]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, spot):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.scores(batch.column(spot)))], names=[*inner, "x"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    return plain.mapInArrow(run, f"{schema}, x double").toDF(*kept, name)
