"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies of the hashed n-grams are counted over all rows that may be learnt from; the weights are
fitted with follow-the-regularised-leader (FTRL-Proximal, elastic net: the L1 part keeps them sparse) on a
bounded sample of TRAIN_ROWS of those rows, equally many for each language; a fifth of the sample is held back
for the temperature that calibrates the scores. Prediction reads nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm.grams import gram_counts, letters_only
from loam.llm.sampling import hash_order, thinned
from loam.llm.textcodes import small_batches
from loam.session import ship

BITS, ORDERS = 14, (1, 2, 3)
#: Bounds of the fit: the labelled rows that the weights are fitted on, and the languages (the most frequent ones).
TRAIN_ROWS, MAX_LANGUAGES = 4000, 300
_LETTER = regex.compile(r"\p{L}")
_TABLE = letters_only()


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)))
        for first, row, bucket, count in gram_counts(texts, BITS, ORDERS, _TABLE, lower=True):
            value = _tfidf(row, bucket, count, self.idf)
            n = int(row[-1]) + 1 if len(row) else 0
            for k in range(len(self.languages)):
                out[first : first + n, k] += np.bincount(row, value * self.weights[bucket, k], minlength=n)
        return out + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language and its calibrated probability; und and 0 without a letter."""
        known = [bool(x) and _LETTER.search(x) is not None and bool(self.languages) for x in texts]
        score = np.zeros(len(texts))
        names = ["und"] * len(texts)
        some = np.flatnonzero(known)
        if len(some):
            chance = _softmax(self.logits([texts[i] for i in some]) / self.temperature)
            best = chance.argmax(axis=1)
            score[some] = chance[np.arange(len(some)), best]
            for i, k in zip(some.tolist(), best.tolist(), strict=True):
                names[i] = self.languages[k]
        return names, score


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _tfidf(row: np.ndarray, bucket: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """(1 + log tf) * idf, each document scaled to length 1."""
    value = (1 + np.log(count)) * idf[bucket]
    norm = np.sqrt(np.bincount(row, value * value)) if len(row) else np.zeros(0)
    return value / np.maximum(norm[row], 1e-12)


def fit_ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, size: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of (buckets, values, class) examples by FTRL-Proximal with an elastic-net penalty."""
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def weights(at) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) > l1, w, 0.0)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            bucket, value, label = examples[i]
            at, x = np.append(bucket, size), np.append(value, 1.0)[:, None]
            w = weights(at)
            chance = _softmax((x * w).sum(axis=0)[None, :])[0]
            chance[label] -= 1
            g = x * chance[None, :]
            root = np.sqrt(n[at] + g * g)
            z[at] += g - (root - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(slice(None))
    return w[:size], w[size]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood."""
    if not len(labels):
        return 1.0
    steps = np.exp(np.linspace(np.log(0.02), np.log(20), 140))
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in steps]
    return float(steps[int(np.argmin(loss))])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of a task; bucket -1 has its number of documents."""
    total, docs = np.zeros(1 << BITS, np.int64), 0
    for whole in batches:
        for batch in small_batches(whole, "text"):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            docs += len(texts)
            for _, _, bucket, _ in gram_counts(texts, BITS, ORDERS, _TABLE, lower=True):
                total += np.bincount(bucket, minlength=len(total))
    if docs:
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], docs))], names=["bucket", "n"])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in small_batches(whole, "text"):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            buckets, counts = [b""] * len(texts), [b""] * len(texts)
            for first, row, bucket, count in gram_counts(texts, BITS, ORDERS, _TABLE, lower=True):
                last = int(row[-1]) + 1 if len(row) else 0
                cuts = np.searchsorted(row, np.arange(1, last))
                for i, (x, y) in enumerate(zip(np.split(bucket, cuts), np.split(count, cuts), strict=True)):
                    buckets[first + i], counts[first + i] = x.astype("<u2").tobytes(), y.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("lang"), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())], names=["h", "lang", "buckets", "counts"]
            )


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS, max_languages: int = MAX_LANGUAGES) -> Model:
    """A model of the rows where usable holds and the language and the text aren't null.

    It learns the max_languages most frequent languages, the first by name on ties; a text in any other gets the
    likeliest of them. Without usable rows the model knows no language and predicts und.
    """
    spark = docs.sparkSession
    ship(spark)
    data = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    data = data.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["n"] for r in data.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()}
    counted = dict(data.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False, name=None))
    total = counted.pop(-1, 0)
    df = np.zeros(1 << BITS)
    if counted:
        df[list(counted)] = list(counted.values())
    idf = np.log((1 + total) / (1 + df)) + 1
    languages = sorted(sizes)
    if not languages:
        return Model([], idf, np.zeros((1 << BITS, 0)), np.zeros(0), 1.0)
    picked = thinned(data, F.col("id"), rows, sizes, F.col("lang")).select(hash_order(F.col("id"), 1).alias("h"), "lang", "text")
    sample = picked.mapInArrow(_examples, "h long, lang string, buckets binary, counts binary").orderBy("h", "lang").limit(rows).toArrow()
    examples = []
    for lang, bucket, count in zip(sample["lang"].to_pylist(), sample["buckets"], sample["counts"], strict=True):
        bucket, count = np.frombuffer(bucket.as_buffer(), "<u2").astype(np.int64), np.frombuffer(count.as_buffer(), "<u4")
        examples.append((bucket, _tfidf(np.zeros(len(bucket), np.int64), bucket, count, idf), languages.index(lang)))
    held = [e for i, e in enumerate(examples) if i % 5 == 0]
    weights, bias = fit_ftrl([e for i, e in enumerate(examples) if i % 5], len(languages), 1 << BITS)
    logits = np.array([(weights[b] * v[:, None]).sum(axis=0) + bias for b, v, _ in held]).reshape(len(held), len(languages))
    return Model(languages, idf, weights, bias, fit_temperature(logits, np.array([k for _, _, k in held], int)))


def identify(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with the predicted language and the score; columns of the same names are replaced.

    Defined results: und with score 0 if the text is null or has no letter.
    """
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c not in names]
    inner = [f"c{i}" for i in range(len(kept))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, inner, strict=True)])
    spot = inner[kept.index(text_col)]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, spot):
                lang, score = shared.value.predict(batch.column(spot).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*inner, "x", "y"])

    return plain.mapInArrow(run, f"{schema}, x string, y double").toDF(*kept, *names)


def identified(docs: DataFrame, usable: Column, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with an identified language (not und, score of min_score at least), columns as they were.

    Defined results: rows whose text is null or has no letter go; if nothing can be learnt from, all rows go, as no
    language is known; an empty table gives an empty one.
    """
    model = train(docs, usable, id_col, text_col)
    names = ("__lang_pred", "__lang_score")
    found = identify(docs, model, text_col, names)
    return found.where((F.col(names[0]) != "und") & (F.col(names[1]) >= min_score)).drop(*names)
