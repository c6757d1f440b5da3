"""Pairwise-complete Pearson correlations of any number of columns.

Each pair of columns uses the rows in which both are present.  A task adds up
counts, sums, squares and products of its rows as matrices (Arrow batches,
numpy); Spark adds the tasks' matrices by (group, pair).  What is collected
has a row per group and pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SUMS = ("sum_1", "sum_a", "sum_b", "sum_aa", "sum_bb", "sum_ab")


def pairwise_moments(df: DataFrame, values: str, group: str) -> DataFrame:
    """(group, i, j and the sums of 1, a, b, aa, bb, ab) of the array column ``values``; NaN is missing, i < j.

    Values should be centred beforehand where their mean is far from 0.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for pdf in batches:
            for g, part in pdf.groupby(group, dropna=False):
                v = np.array(part[values].tolist(), dtype=float)
                there = ~np.isnan(v)
                v, m = np.where(there, v, 0.0), there.astype(float)
                own = np.stack([m.T @ m, v.T @ m, m.T @ v, (v * v).T @ m, m.T @ (v * v), v.T @ v])
                sums[g] = sums[g] + own if g in sums else own
        for g, own in sums.items():
            i, j = np.triu_indices(own.shape[1], 1)
            yield pd.DataFrame({group: pd.Series([g] * len(i)), "i": i, "j": j,
                                **{name: own[s][i, j] for s, name in enumerate(_SUMS)}})

    kind = df.schema[group].dataType.simpleString()
    rows = df.select(group, values).mapInPandas(
        run, f"{group} {kind}, i int, j int, " + ", ".join(f"{s} double" for s in _SUMS))
    return rows.groupBy(group, "i", "j").agg(*[F.sum(s).alias(s) for s in _SUMS])


def correlations(moments: DataFrame) -> dict:
    """Group -> symmetric matrix; NaN where a pair has no spread or no common row."""
    group = moments.columns[0]
    out: dict = {}
    pdf = moments.toPandas()
    for g, part in pdf.groupby(group, dropna=False):
        k = int(part["j"].max()) + 1
        m = np.eye(k)
        n, x, y, xx, yy, xy = (part[s].to_numpy() for s in _SUMS)
        with np.errstate(invalid="ignore", divide="ignore"):
            a, b = xx / n - (x / n) ** 2, yy / n - (y / n) ** 2
            # a spread within rounding of nothing is none
            a, b = np.where(a > 1e-13 * xx / n, a, np.nan), np.where(b > 1e-13 * yy / n, b, np.nan)
            r = (xy / n - x / n * y / n) / np.sqrt(a * b)
        i, j = part["i"].to_numpy(), part["j"].to_numpy()
        m[i, j] = m[j, i] = np.clip(r, -1, 1)
        out[g] = m
    return out
