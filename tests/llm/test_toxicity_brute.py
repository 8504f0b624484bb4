"""Toxicity: scores and the first training step against plain loops."""

import math

import numpy as np
import pytest

from cofan.llm import toxicity

CLEAN = [["a sunny day", "day"], ["good", "day"], ["good", "garden"], ["tree"]]
TOXIC = [["idiot", "day"], ["idiot", "moron"], ["moron", "good"]]


def buckets(word):
    who, where = toxicity.bags([word])
    return where[who == 0]


def test_bags_hold_the_word_and_its_code_point_grams():
    for word in ("a", "idiot", "straße", "日本語"):
        marked = "<" + word + ">"
        assert len(buckets(word)) == 1 + sum(max(len(marked) - n + 1, 0) for n in (3, 4, 5))
    assert set(buckets("idiot")[1:]) & set(buckets("idiots")[1:])


def test_scores_equal_plain_loops():
    rng = np.random.default_rng(2)
    model = toxicity.Model(rng.normal(size=(toxicity.BUCKETS, toxicity.DIM)), rng.normal(size=(toxicity.DIM, 2)), np.array([0.3, -0.2]))
    tests = ["What an idiot", "", "1 2 3", "straße Straße", "a " * 5000 + "b"]
    for text, got in zip(tests, model.scores(tests)):
        odds = [sum(model.bucket[k] for k in buckets(w)) / len(buckets(w)) + model.bias for w in toxicity.words_of(text)]
        assert got == pytest.approx(max((1 / (1 + math.exp(-z)) for z in odds), default=0.0), rel=1e-9)


def test_first_step_follows_the_numerical_gradient():
    """A text is toxic unless each of its words is clean; classes weigh the same."""
    docs, y = CLEAN + TOXIC, [0] * len(CLEAN) + [1] * len(TOXIC)
    words = sorted({x for d in docs for x in d})
    used = sorted({int(k) for x in words for k in buckets(x)})
    at = {x: [used.index(k) for k in buckets(x)] for x in words}
    rng = np.random.default_rng(11)
    e = rng.normal(0, 0.05, (toxicity.BUCKETS, toxicity.DIM)).astype(np.float32).astype(float)[used]
    w = rng.normal(0, 0.5, (toxicity.DIM, 2)).astype(np.float32).astype(float)
    b = np.array([0.0, -5.0])

    def loss(e, w, b):
        s, total = e @ (w[:, 1] - w[:, 0]), 0.0
        for d, t in zip(docs, y):
            clean = 0.0
            for x in d:
                clean -= math.log1p(math.exp(s[at[x]].mean() + b[1] - b[0]))
            total += (-math.log(-math.expm1(clean)) if t else -clean) * 0.5 / (sum(y) if t else len(y) - sum(y))
        return total

    def slope(k, place):
        up, down = ([p.copy() for p in (e, w, b)] for _ in range(2))
        up[k][place] += 1e-4
        down[k][place] -= 1e-4
        return (loss(*up) - loss(*down)) / 2e-4

    params = []
    for k, p in enumerate((e, w, b)):
        g = np.array([slope(k, place) for place in np.ndindex(p.shape)]).reshape(p.shape)
        assert np.abs(g).min() > 1e-7
        params.append(p - 0.05 * np.sign(g))  # Adam's first step
    model = toxicity.train(docs, y, steps=1)
    want = params[0] @ (params[1][:, 1] - params[1][:, 0])
    assert np.allclose(model.bucket[used], want, atol=1e-3) and model.bias == pytest.approx(params[2][1] - params[2][0], abs=1e-4)
