"""The line field of operator 4 against its definition: every labelling of short documents enumerated."""

import itertools

import numpy as np
import pytest

from tabprep.llm import quality as q

LENGTHS = np.array([3, 0, 1, 5])  # a document without lines, one of a single line


def _case(seed=3):
    rng = np.random.default_rng(seed)
    lines = int(LENGTHS.sum())
    features = rng.integers(0, 40, (lines, q.PER_LINE))
    theta = rng.normal(0, 0.4, 3 * (q.N_FEATURES + 1) + 4)
    return features, rng.integers(0, 2, lines), theta, np.array([1.0, 2.0, 0.25, 3.0])


def _labellings(theta, features, lengths):
    """Per document: (labelling, unnormalised log probability) of every labelling."""
    w, pair = theta[:-4].reshape(3, -1), theta[-4:].reshape(2, 2)
    at, out = 0, []
    for n in lengths:
        own = [w[0][f].sum() + w[0][-1] for f in features[at:at + n]]
        for i in range(n):
            own[i] += w[1][features[at + i - 1]].sum() if i else w[1][-1]
            own[i] += w[2][features[at + i + 1]].sum() if i + 1 < n else w[2][-1]
        out.append([(y, sum(s for s, k in zip(own, y) if k) + sum(pair[a, b] for a, b in zip(y, y[1:])))
                    for y in itertools.product((0, 1), repeat=int(n))])
        at += n
    return out


def _loss(theta, features, lengths, state, weight, l2):
    at, total = 0, 0.0
    for n, ys, wt in zip(lengths, _labellings(theta, features, lengths), weight):
        norm = np.logaddexp.reduce([s for _, s in ys])
        total -= wt * (dict(ys)[tuple(state[at:at + n])] - norm)
        at += n
    return total / (weight * lengths).sum() + l2 / 2 * theta @ theta


def test_marginals_equal_enumeration():
    features, _, theta, _ = _case()
    p, both = q.forward_backward(q.emissions(features, LENGTHS, theta[:-4].reshape(3, -1)), LENGTHS, theta[-4:].reshape(2, 2))
    lines, pairs = [], []
    for n, ys in zip(LENGTHS, _labellings(theta, features, LENGTHS)):
        prob = np.exp(np.array([s for _, s in ys]) - np.logaddexp.reduce([s for _, s in ys]))
        lines += [sum(pr for (y, _), pr in zip(ys, prob) if y[i]) for i in range(n)]
        pairs += [[[sum(pr for (y, _), pr in zip(ys, prob) if y[i - 1:i + 1] == (a, b)) for b in (0, 1)] for a in (0, 1)]
                  for i in range(1, n)]
    assert p == pytest.approx(np.array(lines), abs=1e-12)
    assert both == pytest.approx(np.array(pairs), abs=1e-12)


def test_gradient_is_that_of_one_weighted_likelihood():
    features, state, theta, weight = _case()
    g = q._gradient(theta, features, LENGTHS, state, weight, 0.01)
    used = np.unique(features)
    places = [*used[:8], q.N_FEATURES, *(q.N_FEATURES + 1 + used[:8]), 2 * q.N_FEATURES + 1, 3 * q.N_FEATURES + 2, *range(-4, 0)]
    for k in places:
        step = np.zeros_like(theta)
        step[k] = 1e-5
        slope = (_loss(theta + step, features, LENGTHS, state, weight, 0.01)
                 - _loss(theta - step, features, LENGTHS, state, weight, 0.01)) / 2e-5
        assert g[k] == pytest.approx(slope, abs=1e-7), k


def test_a_long_document_of_small_weight_does_not_rule_the_pairs():
    rng = np.random.default_rng(5)
    lengths = np.array([400, *[4] * 25])
    state = np.concatenate([np.arange(400) % 2, np.repeat(rng.integers(0, 2, 25), 4)])  # alternating; constant
    features = rng.integers(0, q.N_FEATURES, (500, q.PER_LINE))
    weight = np.array([1 / 400, *[1 / 4] * 25])
    pair = q.train_field(features, lengths, state, weight, l2=1.0)[-4:].reshape(2, 2)
    assert pair[0, 0] + pair[1, 1] > pair[0, 1] + pair[1, 0]


def test_repeated_ids_do_not_widen_the_sample(spark, monkeypatch):
    """2,000 copies of two ids: training gets one text of each."""
    rows = [(i % 2, f"line {i % 7}\nanother line of words {i % 3}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    seen = []
    real = q.train_field
    monkeypatch.setattr(q, "train_field", lambda f, lengths, *a, **k: seen.append(len(lengths)) or real(f, lengths, *a, **k))
    first, again = q.fit(docs, labels), q.fit(docs.repartition(7), labels)
    assert seen == [2, 2, 2, 2]
    assert np.array_equal(first[0], again[0])  # whatever the partitions
