"""Quality by co-training on two views of a document.

The text view sees hashed 1- to 3-grams of character classes (upper, lower, digit, blank, each sign) and a few
shares; the metadata view sees the source, the language tag, their pair and the length class, all hashed. Each view
has a logistic regression of its own. In every round both score a pool of unlabelled documents, and the most
confident of each, in the classes' shares, join the *other* view's training set as pseudo-labels. At the end each
view is calibrated (Platt) on labelled rows kept aside, and the calibrated log-odds are combined by a logistic
regression on the same rows, so that a view that tells nothing gets no say.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm.grams import gram_counts, shapes
from loam.llm.sampling import hash_order, thinned
from loam.llm.textcodes import small_batches
from loam.session import ship

TEXT_BITS, META_BITS, ORDERS = 11, 10, (1, 2, 3)
#: Bounds on the rows that the model is fitted on: labelled (two thirds teach, one third calibrates), unlabelled.
LABELLED_ROWS, POOL_ROWS, ROUNDS, PER_ROUND = 3000, 6000, 5, 300
_TABLE = shapes()


@dataclass
class Rows:
    """Sparse rows, one after the other: buckets and their values."""

    bucket: np.ndarray
    value: np.ndarray
    offset: np.ndarray
    size: int

    def __len__(self) -> int:
        return len(self.offset) - 1

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.offset))

    def take(self, rows: np.ndarray) -> Rows:
        count = np.diff(self.offset)[rows]
        at = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        place = np.repeat(self.offset[:-1][rows] - at[:-1], count) + np.arange(at[-1])
        return Rows(self.bucket[place], self.value[place], at, self.size)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, self.value * weights[self.bucket], minlength=len(self))

    def gradient(self, slope: np.ndarray) -> np.ndarray:
        return np.bincount(self.bucket, self.value * np.repeat(slope, np.diff(self.offset)), minlength=self.size)


def text_view(texts: list[str]) -> Rows:
    """Rows of square roots of gram shares, each of length about 1; empty texts give empty rows."""
    parts, sizes = [(np.zeros(0, np.int64), np.zeros(0))], np.zeros(len(texts), np.int64)
    for first, row, bucket, count in gram_counts(texts, TEXT_BITS, ORDERS, _TABLE, lower=False):
        total = np.bincount(row, count) if len(row) else np.zeros(0)
        parts.append((bucket, np.sqrt(count / total[row])))
        own = np.bincount(row)
        sizes[first : first + len(own)] = own
    bucket, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Rows(bucket.astype(np.int16), value.astype(np.float32), np.concatenate([[0], np.cumsum(sizes)]), 1 << TEXT_BITS)


def meta_columns(lang: Column, source: Column, n_chars: Column) -> Column:
    """Hashed metadata features; nulls are a value of their own."""
    lang, source = F.coalesce(lang.cast("string"), F.lit("")), F.coalesce(source.cast("string"), F.lit(""))
    size = F.coalesce(F.floor(F.log2(F.greatest(n_chars.cast("double"), F.lit(0.0)) + 1)), F.lit(-1)).cast("string")
    parts = [F.concat_ws("\x01", F.lit(kind), *cols) for kind, cols in (("l", [lang]), ("s", [source]), ("ls", [lang, source]), ("n", [size]), ("ln", [lang, size]))]
    return F.array(*[F.pmod(F.xxhash64(p), F.lit(1 << META_BITS)).cast("int") for p in parts])


def meta_view(buckets: list[list[int]]) -> Rows:
    """Rows of equal values; a bucket that a row has twice counts once."""
    rows = [sorted(set(x)) for x in buckets]
    at = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)
    bucket = np.fromiter((b for x in rows for b in x), np.int16, int(at[-1]))
    return Rows(bucket, np.full(len(bucket), 0.45, np.float32), at, 1 << META_BITS)


def fit_logistic(x: Rows, y: np.ndarray, start: np.ndarray | None = None, l2: float = 1e-3, steps: int = 120, rate: float = 0.2, batch: int = 1024, seed: int = 5) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression, by Adam on mini-batches."""
    w = np.zeros(x.size + 1) if start is None else start.copy()
    m, v, draw = np.zeros_like(w), np.zeros_like(w), np.random.default_rng(seed)
    for t in range(1, steps + 1):
        rows = np.sort(draw.choice(len(y), batch, replace=False)) if len(y) > batch else np.arange(len(y))
        part = x.take(rows) if len(rows) < len(y) else x
        error = _chance(part.dot(w) + w[-1]) - y[rows]
        g = np.append(part.gradient(error) / len(rows) + l2 * w[:-1], error.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * min(1.0, 3 * (1 - (t - 1) / steps)) / (1 - 0.9**t) * m / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _margin(x: Rows, w: np.ndarray) -> np.ndarray:
    return x.dot(w) + w[-1]


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def newton(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """A small logistic regression (bias last) with smoothed targets."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, w = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    keep = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(50):
        chance = _chance(x @ w)
        step = np.linalg.solve((x * np.maximum(chance * (1 - chance), 1e-9)[:, None]).T @ x + np.diag(keep), x.T @ (chance - target) + keep * w)
        w = w - np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    scale_text: np.ndarray
    scale_meta: np.ndarray
    joint: np.ndarray

    def scores(self, texts: list[str], buckets: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of good quality: text view, metadata view, both."""
        a = _margin(text_view(texts), self.text) * self.scale_text[0] + self.scale_text[1]
        b = _margin(meta_view(buckets), self.meta) * self.scale_meta[0] + self.scale_meta[1]
        return _chance(a), _chance(b), _chance(a * self.joint[0] + b * self.joint[1] + self.joint[2])


def co_train(views: tuple[Rows, Rows], y: np.ndarray, n: int, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the two views after rounds of exchanging confident pseudo-labels.

    The first n rows of the views are labelled with y; the rest are the pool.
    """
    given: list[dict[int, float]] = [{}, {}]
    share = float(y.mean())
    pool = [x.take(np.arange(n, len(x))) for x in views]

    def fitted(start: list[np.ndarray | None], steps: int) -> list[np.ndarray]:
        out = []
        for view, extra, w in zip(views, given, start, strict=True):
            rows = np.concatenate([np.arange(n), n + np.fromiter(extra, np.int64, len(extra))])
            out.append(fit_logistic(view.take(rows), np.concatenate([y, np.fromiter(extra.values(), float, len(extra))]), w, steps=steps))
        return out

    weights = fitted([None, None], 120)
    for _ in range(rounds):
        for i in (0, 1):
            other = given[1 - i]
            free = np.array([r for r in range(len(pool[0])) if r not in other], int)
            if not len(free):
                continue
            order = free[np.argsort(_margin(pool[i], weights[i])[free], kind="stable")]
            low = max(1, round(per_round * (1 - share)))
            for r in order[:low].tolist():
                other[r] = 0.0
            for r in order[max(low, len(order) - max(1, per_round - low)) :].tolist():
                other[r] = 1.0
        weights = fitted(weights, 40)
    return weights[0], weights[1]


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The values of a binary column, one after the other, as numbers."""
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in column if len(x.as_buffer()))])


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    labelled_rows: int = LABELLED_ROWS, pool_rows: int = POOL_ROWS,
) -> Model:
    """A model of the rows where usable (a condition on the id) holds.

    docs needs the columns lang, source and n_chars besides the id and the text. Without labels of both kinds the
    model gives every document the share of good labels. A document of several labels is good if all say so.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.where(usable & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"))
    known = known.select("id", (F.col("label") > 0).cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    share = (sizes.get(1, 0) + 0.5) / (total + 1)
    n_docs = docs.where(usable).select(F.count(F.lit(1))).first()[0]
    zero = lambda bits: np.zeros((1 << bits) + 1)
    plain = Model(zero(TEXT_BITS), zero(META_BITS), *[np.array([0.0, np.log(share / (1 - share))])] * 2, np.array([1.0, 0.0, 0.0]))
    if len(sizes) < 2 or not n_docs:
        return plain

    def bounded(df: DataFrame, rows: int, seed: int, size: int, *cols: Column) -> DataFrame:
        df = thinned(df, F.col("id"), rows, {None: size}, seed=seed)
        return df.select("id", hash_order(F.col("id"), seed).alias("h"), *cols).orderBy("h", "id").limit(rows)

    pool = docs.where(usable).select(F.col(id_col).alias("id")).where("id is not null")
    picked = bounded(known, labelled_rows, 6, total, F.col("label"))
    wide = thinned(pool, F.col("id"), 3 * pool_rows, {None: n_docs}, seed=7).join(labels.select(F.col(id_col).alias("id")).distinct(), "id", "left_anti")
    picked = picked.unionByName(wide.select("id", hash_order(F.col("id"), 7).alias("h"), F.lit(-1).alias("label")).orderBy("h", "id").limit(pool_rows))
    rows = docs.where(usable).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), meta_columns(F.col("lang"), F.col("source"), F.col("n_chars")).alias("meta"))

    def views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, "text"):
                x = text_view([t or "" for t in batch.column("text").to_pylist()])
                grams = [(x.bucket[a:b].tobytes(), x.value[a:b].astype(np.float16).tobytes()) for a, b in zip(x.offset[:-1].tolist(), x.offset[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label"), batch.column("h"), batch.column("meta"), *(pa.array(v, pa.binary()) for v in zip(*grams, strict=True))], names=["label", "h", "meta", "buckets", "shares"]
                )

    # At most labelled_rows + pool_rows ids are broadcast, and so many rows of at most 2^TEXT_BITS entries come back.
    got = rows.join(F.broadcast(picked), "id").select("label", "h", "text", "meta").mapInArrow(views, "label int, h long, meta array<int>, buckets binary, shares binary")
    got = got.orderBy("label", "h", "buckets", "shares").limit(2 * (labelled_rows + pool_rows)).toArrow()
    label, h = got["label"].to_numpy(), got["h"].to_numpy()
    meta = meta_view(got["meta"].to_pylist())
    sizes = [pc.binary_length(got["buckets"]).to_numpy() // 2]
    text = Rows(_joined(got["buckets"], np.int16), _joined(got["shares"], np.float16).astype(np.float32), np.concatenate([[0], np.cumsum(*sizes)]).astype(np.int64), 1 << TEXT_BITS)
    del got
    order = np.argsort(h, kind="stable")
    own = order[label[order] >= 0]
    teach, kept = own[np.arange(len(own)) % 3 != 0], own[np.arange(len(own)) % 3 == 0]
    if len(set(label[teach])) < 2 or len(set(label[kept])) < 2:
        return plain
    used = np.concatenate([teach, np.flatnonzero(label < 0)])
    w_text, w_meta = co_train((text.take(used), meta.take(used)), label[teach].astype(float), len(teach))
    y = label[kept].astype(float)
    z = [_margin(text.take(kept), w_text), _margin(meta.take(kept), w_meta)]
    scale = [newton(v[:, None], y) for v in z]
    # A view that gets its sign turned by the calibration rows tells nothing.
    scale = [s if s[0] > 0 else np.array([0.0, np.log(share / (1 - share))]) for s in scale]
    joint = newton(np.column_stack([v * s[0] + s[1] for v, s in zip(z, scale, strict=True)]), y)
    return Model(w_text, w_meta, *scale, joint)


def score(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str, str] = ("score_text", "score_meta", "score")) -> DataFrame:
    """docs with three probabilities of good quality; columns of the same names are replaced.

    Defined results: null counts as empty; an empty text has the text view's score of no grams; null metadata are
    values of their own.
    """
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c not in names]
    inner = [f"c{i}" for i in range(len(kept))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, inner, strict=True)], meta_columns(F.col("lang"), F.col("source"), F.col("n_chars")).alias("meta"))
    spot = inner[kept.index(text_col)]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, spot, 1 << 20):
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    got = shared.value.scores([t or "" for t in part.column(spot).to_pylist()], part.column("meta").to_pylist())
                    yield pa.RecordBatch.from_arrays([*(part.column(n) for n in inner), *(pa.array(g.astype(float)) for g in got)], names=[*inner, "x", "y", "z"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema if f.name != "meta")
    return plain.mapInArrow(run, f"{schema}, x double, y double, z double").toDF(*kept, *names)
