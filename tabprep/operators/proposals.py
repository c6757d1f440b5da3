"""Trial proposals informed by finished trials: tree-structured Parzen
estimators (Bergstra et al., "Algorithms for Hyper-Parameter Optimization",
NIPS 2011).

Finished trials are split into the better ``GOOD`` share and the rest.  Each
side gives every parameter a density: truncated normals around its trials,
as wide as the gaps to their neighbours, and a uniform part.  Of ``CANDIDATES``
draws from the good density the one with the largest ratio of both densities is tried next.

A trial may start as soon as the trial ``parallelism`` places before it, and
all earlier ones, have ended, and is proposed from these alone: workers stay
busy, and the proposals depend on the seed and the number of workers, not on timing.
Only parameters and metric values are held on the driver, a row a trial.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np

from tabprep.functions.normal import np_norm_cdf, np_norm_ppf

GOOD, CANDIDATES, STARTUP = 0.25, 24, 4


class _Density:
    """A density over [0, 1]: normals around the points, cut at the ends, and a uniform of one point's weight."""

    def __init__(self, points: np.ndarray):
        self.at = np.sort(points)
        edge = np.concatenate([[0.0], self.at, [1.0]])
        gaps = np.maximum(np.diff(edge)[:-1], np.diff(edge)[1:])
        self.width = np.clip(gaps, 1.0 / (2 + len(points)), 1.0)
        self.low, self.high = np_norm_cdf((0 - self.at) / self.width), np_norm_cdf((1 - self.at) / self.width)

    def draw(self, rng, n: int) -> np.ndarray:
        which, u = rng.integers(0, len(self.at) + 1, n), rng.uniform(size=n)
        near = which < len(self.at)
        out, k = u.copy(), which[near]
        q = np.clip(self.low[k] + u[near] * (self.high[k] - self.low[k]), 1e-12, 1 - 1e-12)
        out[near] = np.clip(self.at[k] + self.width[k] * np_norm_ppf(q), 0.0, 1.0)
        return out

    def log(self, x: np.ndarray) -> np.ndarray:
        z = (x[:, None] - self.at) / self.width
        part = np.exp(-z * z / 2) / (math.sqrt(2 * math.pi) * self.width * (self.high - self.low))
        return np.log((part.sum(axis=1) + 1.0) / (len(self.at) + 1))


def propose(bounds: dict, finished: list, maximize: bool, rng, running: list = ()) -> dict:
    """Parameters to try next.

    ``bounds``: name -> (low, high), whole numbers for a parameter of whole
    numbers.  ``finished``: (parameters, value) of each ended trial; values
    that are null or NaN count as the worst.  ``running``: parameters of trials that have not ended;
    they count with the rest, so that workers do not try the same place.  Without a finished trial the draw is uniform.
    """
    worst = -math.inf
    value = [worst if v is None or math.isnan(v) else (v if maximize else -v) for _, v in finished]
    order = sorted(range(len(finished)), key=lambda i: (-value[i], i))
    cut = math.ceil(GOOD * len(order))
    out = {}
    for name, (low, high) in bounds.items():
        whole = isinstance(low, int) and isinstance(high, int)
        span = (high + 1 - low) if whole else (high - low)

        def scaled(p):
            x = (p[name] - low + (0.5 if whole else 0.0)) / span if span else 0.5
            return min(max(x, 0.0), 1.0)

        good = _Density(np.array([scaled(finished[i][0]) for i in order[:cut]]))
        rest = _Density(np.array([scaled(finished[i][0]) for i in order[cut:]] + [scaled(p) for p in running]))
        x = good.draw(rng, CANDIDATES)
        if whole:  # candidates of one whole number are one
            x = (np.minimum(np.floor(x * span), span - 1) + 0.5) / span
        best = float(x[np.argmax(good.log(x) - rest.log(x))])
        out[name] = int(low + min(math.floor(best * span), span - 1)) if whole else float(low + best * span)
    return out


def search(objective: Callable, bounds: dict, n_trials: int, maximize: bool, parallelism: int = 1, seed: int = 42,
           first: list | None = None, adjust: Callable | None = None) -> list:
    """(parameters, value) of each of ``n_trials`` trials, in order.

    ``objective(i, parameters)`` runs in one of ``parallelism`` threads.  The
    trials of ``first`` are given; an error in a trial stops the search.
    """
    first = first or []
    done: list = []
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        running: list = []
        try:
            for i in range(n_trials):
                if len(running) >= max(1, parallelism):  # oldest first: its end and all before it are known
                    p, future = running.pop(0)
                    done.append((p, future.result()))
                if i < len(first):
                    p = first[i]
                else:
                    p = propose(bounds, done, maximize, np.random.default_rng([seed, i]), [q for q, _ in running])
                    p = adjust(p) if adjust else p
                running.append((p, pool.submit(objective, i, p)))
            done += [(p, future.result()) for p, future in running]
        finally:
            for _, future in running:
                future.cancel()
    return done


__all__ = ["propose", "search"]
