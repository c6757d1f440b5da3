"""Proposals from finished trials against random draws on a fixed surface."""

import math
import threading
import time

import numpy as np
import pytest

from tabprep.operators import proposals
from tabprep.operators.training import SearchSpace

BOUNDS = {k: getattr(SearchSpace(), k) for k in ("eta", "min_child_weight", "alpha", "max_depth", "num_round")}


def _surface(p):
    """One peak of 1 at eta 0.12, alpha 0.7, depth 7; the other two hardly matter."""
    return math.exp(-((p["eta"] - 0.12) / 0.1) ** 2 - ((p["alpha"] - 0.7) / 0.5) ** 2 - ((p["max_depth"] - 7) / 2) ** 2) \
        - 1e-4 * p["min_child_weight"] - 1e-6 * p["num_round"]


def _best(seed, workers, maximize=True, n=50):
    sign = 1 if maximize else -1
    done = proposals.search(lambda i, p: sign * _surface(p), BOUNDS, n, maximize, workers, seed, SearchSpace().sample(4, seed))
    assert len(done) == n
    return max(sign * v for _, v in done)


@pytest.mark.parametrize("workers", [1, 4])
def test_better_median_than_random(workers):
    informed = [_best(s, workers) for s in range(25)]
    random = [max(_surface(p) for p in SearchSpace().sample(50, s)) for s in range(25)]
    assert np.median(informed) > np.median(random) + 0.1
    assert [_best(s, workers, maximize=False) for s in range(3)] == informed[:3]


def test_timing_does_not_matter():
    def slow(i, p):
        time.sleep(0.002 * ((i * 7) % 5))
        return _surface(p)

    runs = [proposals.search(f, BOUNDS, 30, True, 4, 9, SearchSpace().sample(4, 9)) for f in (slow, lambda i, p: _surface(p))]
    assert runs[0] == runs[1]


def test_workers_run_at_once_and_errors_stop_the_search():
    meet = threading.Barrier(3, timeout=20)  # passes only if three trials run together
    proposals.search(lambda i, p: meet.wait() * 0.0, BOUNDS, 6, True, 3, 1)

    def broken(i, p):
        if i == 2:
            raise RuntimeError("trial")
        return 0.0
    with pytest.raises(RuntimeError):
        proposals.search(broken, BOUNDS, 10, True, 2, 1)


def test_odd_values_and_bounds():
    rng = np.random.default_rng(0)
    bounds = {"a": (1.0, 1.0), "k": (3, 3), "b": (0, 2), "x": (-1.0, 1.0)}
    finished = []
    for i in range(40):
        p = proposals.propose(bounds, finished, True, rng)
        assert p["a"] == 1.0 and p["k"] == 3 and p["b"] in (0, 1, 2) and -1 <= p["x"] <= 1
        finished.append((p, [None, float("nan"), 1.0][i % 3]))
    # beyond the bounds, as an adjusting hook may set them
    proposals.propose(bounds, [({"a": 5.0, "k": 9, "b": 7, "x": 4.0}, 0.5)] * 5, False, rng)


def test_density_integrates_to_one():
    d = proposals._Density(np.array([0.0, 0.2, 0.2, 0.9]))
    x = (np.arange(20000) + 0.5) / 20000
    assert np.exp(d.log(x)).mean() == pytest.approx(1.0, abs=1e-4)
    draws = d.draw(np.random.default_rng(1), 20000)
    assert np.histogram(draws, 10, (0, 1))[0] / 20000 == pytest.approx(
        [np.exp(d.log(x[k * 2000:(k + 1) * 2000])).mean() / 10 for k in range(10)], abs=0.015)
