"""FTRL-proximal regression against a plain loop over coordinates."""

import math
import random

import numpy as np
import pytest

from rowloom.llm.linear import Ftrl, fit


def plain(rows, labels, how):
    """Weights by feature and the bias, one coordinate at a time."""
    seen = {}
    for f, _ in rows:
        for x in f:
            seen[x] = seen.get(x, 0) + 1
    z, n = {}, {}
    base = (sum(labels) + 1) / (len(labels) + 2)
    bias, bias_n = math.log(base / (1 - base)), 0.0

    def weight(x):
        zi = z.get(x, 0.0)
        if abs(zi) <= how.l1:
            return 0.0
        rate = (how.beta + math.sqrt(n.get(x, 0.0))) / how.alpha
        return (math.copysign(how.l1, zi) - zi) / (rate + how.l2)

    for _ in range(how.epochs):
        for (f, v), y in zip(rows, labels):
            known = [(x, value) for x, value in zip(f, v) if seen[x] >= how.min_rows]
            w = {x: weight(x) for x, _ in known}
            error = 1 / (1 + math.exp(-(bias + sum(w[x] * value for x, value in known)))) - y
            for x, value in known:
                g = error * value
                old = n.get(x, 0.0)
                n[x] = old + g * g
                z[x] = z.get(x, 0.0) + g - (math.sqrt(n[x]) - math.sqrt(old)) / how.alpha * w[x]
            bias_n += error * error
            bias -= how.alpha / (how.beta + math.sqrt(bias_n)) * error
    return bias, {x: w for x in z if (w := weight(x))}


@pytest.mark.parametrize("how", [Ftrl(), Ftrl(alpha=0.5, l1=0.2, l2=0.1, epochs=5, min_rows=1), Ftrl(l1=500.0)])
def test_weights_match_a_plain_loop(how):
    rng = random.Random(2)
    rows, labels = [], []
    for _ in range(150):
        y = rng.random() < 0.4
        words = rng.sample(range(60), 12) + ([100 + rng.randrange(3)] if y else [200 + rng.randrange(3)])
        f = np.unique(np.array(words, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        rows.append((f, np.array([rng.choice([1.0, 0.5, 2.0]) for _ in f])))
        labels.append(int(y))
    got = fit(rows, labels, how)
    bias, weights = plain([(f.tolist(), v.tolist()) for f, v in rows], labels, how)
    assert got.bias == pytest.approx(bias)
    assert got.hashes.tolist() == sorted(weights)
    assert got.values.tolist() == pytest.approx([weights[x] for x in sorted(weights)])
    if how.l1 == 500.0:
        assert not weights
    else:
        assert weights


def test_no_rows_give_no_weights():
    none = fit([], [], Ftrl())
    assert none.bias == 0.0 and len(none.hashes) == 0
    one = fit([(np.empty(0, np.uint64), np.empty(0))], [1], Ftrl())
    assert len(one.hashes) == 0 and one.bias > 0
