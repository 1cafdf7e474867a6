"""The numpy fits against plain versions."""

import math
import random

import numpy as np
import pytest

from loam.llm import grams, language_id, quality, toxicity


def _ftrl(examples, classes, size, epochs, alpha, beta, l1, l2):
    """FTRL-Proximal, one weight at a time, in the order of the operator's generator."""
    z, n = {}, {}

    def weight(j, k):
        a = z.get((j, k), 0.0)
        return 0.0 if abs(a) <= l1 else -(a - math.copysign(l1, a)) / ((beta + math.sqrt(n.get((j, k), 0.0))) / alpha + l2)

    draw = np.random.default_rng(7)
    for _ in range(epochs):
        for i in draw.permutation(len(examples)):
            buckets, values, label = examples[i]
            features = [*zip(buckets.tolist(), values.tolist(), strict=True), (size, 1.0)]
            w = {(j, k): weight(j, k) for j, _ in features for k in range(classes)}
            logits = [sum(v * w[j, k] for j, v in features) for k in range(classes)]
            top = max(logits)
            e = [math.exp(x - top) for x in logits]
            for j, v in features:
                for k in range(classes):
                    g = v * (e[k] / sum(e) - (k == label))
                    old = n.get((j, k), 0.0)
                    z[j, k] = z.get((j, k), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[j, k]
                    n[j, k] = old + g * g
    return [[weight(j, k) for k in range(classes)] for j in range(size + 1)]


def test_ftrl_by_brute_force():
    rng = np.random.default_rng(3)
    examples = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4), int(rng.integers(3))) for _ in range(40)]
    weights, bias = language_id.fit_ftrl(examples, 3, 12, epochs=2, alpha=0.5, beta=1.0, l1=0.05, l2=0.1)
    plain = np.array(_ftrl(examples, 3, 12, 2, 0.5, 1.0, 0.05, 0.1))
    assert np.allclose(weights, plain[:12]) and np.allclose(bias, plain[12]) and (plain[:12] == 0).any()


def test_temperature_is_the_best_of_a_fine_grid():
    rng = np.random.default_rng(5)
    logits, labels = rng.normal(size=(300, 4)) * 3, rng.integers(0, 4, 300)
    loss = lambda t: -np.mean([x[k] / t - math.log(sum(math.exp(v / t) for v in x)) for x, k in zip(logits, labels, strict=True)])
    best = language_id.fit_temperature(logits, labels)
    assert loss(best) <= min(loss(t) for t in np.exp(np.linspace(np.log(0.1), np.log(20), 400))) + 1e-3


def _rows(sets):
    return toxicity.Rows.of([np.array(sorted(s), np.int32) for s in sets])


def _risk(w, bias, positive, unlabelled, prior):
    """The non-negative risk with the sigmoid loss, document by document."""
    def outputs(sets):
        return [sum(w.get(b, 0.0) for b in s) / math.sqrt(max(1, len(s))) + bias for s in sets]

    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    p, u = outputs(positive), outputs(unlabelled)
    up = prior * np.mean([sigmoid(-z) for z in p])
    rest = np.mean([sigmoid(z) for z in u]) - prior * np.mean([sigmoid(z) for z in p])
    return up + max(0.0, rest)


def test_nnpu_finds_the_words_and_lowers_the_risk():
    rng = random.Random(2)
    common = list(range(100, 160))
    positive = [{1, 2, *rng.sample(common, 8)} for _ in range(60)]
    unlabelled = [set(rng.sample(common, 9)) | ({1, 2} if i % 20 == 0 else set()) for i in range(400)]
    weights, bias, live = toxicity.fit_nnpu(_rows(positive), _rows(unlabelled), 0.05)
    assert set(np.flatnonzero(live)) == {1, 2}
    p, u = [s & {1, 2} for s in positive], [s & {1, 2} for s in unlabelled]
    learnt = _risk({1: weights[1], 2: weights[2]}, bias, p, u, 0.05)
    assert learnt < 0.3 * _risk({}, 0.0, p, u, 0.05) and learnt <= min(_risk({1: a, 2: a}, b, p, u, 0.05) for a in (0.0, 0.5, 1.0) for b in (-1.0, 0.0)) + 1e-6


def test_sparse_products():
    rng = np.random.default_rng(1)
    dense = (rng.random((7, 30)) < 0.3).astype(float)
    rows = _rows([set(np.flatnonzero(r)) for r in dense])
    share = 1 / np.sqrt(np.maximum(dense.sum(axis=1), 1))
    w, slope = rng.normal(size=30), rng.normal(size=7)
    assert np.allclose(rows.dot(w), share * (dense @ w)) and np.allclose(rows.gradient(slope, 30), (slope * share) @ dense)
    value = dense * rng.random(dense.shape)
    other = quality.Rows(np.nonzero(value)[1], value[np.nonzero(value)], np.concatenate([[0], np.cumsum((value > 0).sum(axis=1))]), 30)
    assert np.allclose(other.dot(w), value @ w) and np.allclose(other.gradient(slope), slope @ value)
    some = np.array([5, 0, 0, 3])
    assert np.allclose(other.take(some).dot(w), value[some] @ w)


@pytest.mark.parametrize("weighted", [False, True])
def test_platt_scaling_is_at_a_minimum(weighted):
    rng = np.random.default_rng(8)
    label = (rng.random(400) < 0.3).astype(float)
    margin = label * 2 + rng.normal(size=400)
    weight = np.where(label == 1, 0.1, 1.3) if weighted else np.ones(400)
    a, b = toxicity.fit_scale(margin, label, weight)
    pos, neg = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))

    def loss(a, b):
        z = a * margin + b
        return float((weight * (np.logaddexp(0, z) - target * z)).sum()) + 0.5e-3 * a * a

    assert all(loss(a, b) <= loss(a + x, b + y) + 1e-9 for x in (-0.01, 0, 0.01) for y in (-0.01, 0, 0.01))
    if not weighted:
        assert np.allclose(quality.newton(margin[:, None], label), [a, b], atol=0.05)


def test_scaling_is_out_of_fold():
    rng = random.Random(4)
    common = list(range(100, 160))
    positive = _rows([{1, 2, *rng.sample(common, 8), 1000 + i} for i in range(60)])
    unlabelled = _rows([set(rng.sample(common, 9)) for _ in range(300)])
    a, b = toxicity.out_of_fold_scale(positive, unlabelled, np.full(50, -1.0), 0.1)
    assert a > 0 and toxicity.out_of_fold_scale(positive.take(np.array([0])), unlabelled, np.full(50, -1.0), 0.1) == (1.0, 0.0)


def test_logistic_fit_by_plain_descent():
    rng = np.random.default_rng(6)
    dense = (rng.random((200, 8)) < 0.4) * rng.random((200, 8))
    y = (dense @ rng.normal(size=8) * 3 + 0.2 * rng.normal(size=200) > 0).astype(float)
    rows = quality.Rows(np.nonzero(dense)[1], dense[np.nonzero(dense)], np.concatenate([[0], np.cumsum((dense > 0).sum(axis=1))]), 8)
    w = np.zeros(9)
    for _ in range(20_000):
        error = 1 / (1 + np.exp(-(dense @ w[:8] + w[8]))) - y
        w -= 0.5 * np.append(error @ dense / 200 + 1e-2 * w[:8], error.mean())
    assert np.allclose(quality.fit_logistic(rows, y, l2=1e-2, steps=3000, rate=0.05), w, atol=0.05)


def test_co_training_by_brute_force():
    rng = np.random.default_rng(9)

    def view(bits):
        dense = np.column_stack([bits, 1 - bits]) * (0.6 + 0.4 * rng.random((len(bits), 2)))
        return quality.Rows(np.nonzero(dense)[1], dense[np.nonzero(dense)], np.concatenate([[0], np.cumsum((dense > 0).sum(axis=1))]), 2)

    truth = rng.integers(0, 2, 120).astype(float)
    views = (view(truth), view(np.where(rng.random(120) < 0.1, 1 - truth, truth)))
    n, y = 30, truth[:30]
    given, fit = [{}, {}], lambda start, steps: [quality.fit_logistic(v.take(np.array([*range(n), *(n + r for r in e)])), np.array([*y, *e.values()]), w, steps=steps) for v, e, w in zip(views, given, start, strict=True)]
    weights, per, low = fit([None, None], 120), 10, max(1, round(10 * (1 - y.mean())))
    for _ in range(2):
        for i in (0, 1):
            scores = sorted((quality._margin(views[i].take(np.array([n + r])), weights[i])[0], r) for r in range(90) if r not in given[1 - i])
            for _, r in scores[:low]:
                given[1 - i][r] = 0.0
            for _, r in scores[max(low, len(scores) - max(1, per - low)) :]:
                given[1 - i][r] = 1.0
        weights = fit(weights, 40)
    got = quality.co_train(views, y, n, rounds=2, per_round=per)
    assert all(np.allclose(a, b) for a, b in zip(got, weights, strict=True))


def test_grams_reach_over_the_cuts_of_long_texts():
    rng = random.Random(1)
    text = "".join(rng.choice("abc  \nÉß") for _ in range(5000))
    count = lambda: [(f, r.tolist(), b.tolist(), c.tolist()) for f, r, b, c in grams.gram_counts([text, "x"], 10, (1, 2, 3), grams.letters_only(), True)]
    whole, old = count(), grams.CHARS
    for size in (7, 64, 1000):
        grams.CHARS = size
        try:
            cut = count()
        finally:
            grams.CHARS = old
        assert cut[0][2:] == _first_of(whole)


def _first_of(whole):
    """Buckets and counts of the first document of a joint count."""
    (_, rows, buckets, counts) = whole[0]
    n = sum(r == 0 for r in rows)
    return (buckets[:n], counts[:n])
