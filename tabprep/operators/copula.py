"""Gaussian-copula synthesizer (Patki, Wedge & Veeramachaneni, "The
Synthetic Data Vault", DSAA 2016), conditional on the label.

Fit, per class: a quantile grid per numeric column (``percentile_approx``),
level frequencies per categorical column, null rates, and the
pairwise-complete correlation of the normal scores - aggregates whose results
are bounded by classes x columns x grid size, classes x levels and classes x
columns squared.  Missing values take no part in a correlation; they are drawn
apart, at each column's null rate.

Text columns with more levels than may reach the driver (``max_levels``) keep
their frequencies as a stored table of intervals (``functions.intervals``): a
row's normal score comes from a join on (class, value), a generated value
from the interval that holds the row's uniform.  The values are the same either way.

Generate from ``spark.range(n)``: the class of a row is a hash draw on its id,
the normals come from a counter-based hash of (seed, column, id), correlated
by the class's Cholesky factor and mapped back through the marginals in
Arrow batches.  A row depends on its id only, not on batches or partitions.
One definition holds for any number of rows and columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.hashing import np_uniform, range_partitions, stream_key
from tabprep.functions.intervals import cumulate, draw_values
from tabprep.functions.names import qcol, require_columns
from tabprep.functions.normal import np_norm_cdf, np_norm_ppf
from tabprep.operators import stats
from tabprep.operators.correlation import correlations, pairwise_moments
from tabprep.operators.features import NUMERIC_TYPES, as_category, split_types
from tabprep.operators.synth import SYNTH_ID, class_draw
from tabprep.session import store

_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
#: ``percentile_approx`` columns per aggregate: a few dozen buffers a group stay in memory.
GRID_COLUMNS = 32


@dataclass
class CopulaSynthesizer:
    label: str
    seed: int = 42
    columns: list = field(default_factory=list)
    grid_size: int = 101
    accuracy: int = 10_000
    correlated: bool = True
    max_levels: int = 200_000  # (class, column, level) frequencies that may reach the driver; other columns' stay a table

    def fit(self, df: DataFrame, counts: dict | None = None) -> "FittedCopula":
        require_columns(df, [self.label])
        cols = self.columns or [c for c in df.columns if c != self.label]
        numeric, categorical = split_types(df, cols)
        y = qcol(self.label)
        if counts is None:
            counts = stats.class_counts(df, self.label)
        if None in counts:
            raise ValueError("null labels cannot be synthesized")
        labels = sorted(counts)
        probs = [i / (self.grid_size - 1) for i in range(self.grid_size)]
        grids, nulls = {}, {}
        for at in range(0, len(numeric), GRID_COLUMNS):
            some = numeric[at:at + GRID_COLUMNS]
            aggs = []
            for i, c in enumerate(some):
                x = _number(df, c)
                aggs += [F.percentile_approx(x, probs, self.accuracy).alias(f"g{i}"),
                         F.avg(x.isNull().cast("double")).alias(f"z{i}")]
            for r in df.groupBy(y.alias("y")).agg(*aggs).collect():  # a row a class
                for i, c in enumerate(some):
                    grids[(r["y"], c)] = np.asarray(r[f"g{i}"] or [0.0], dtype=float)
                    nulls[(r["y"], c)] = float(r[f"z{i}"] or 0.0)
        # level frequencies; null is a level
        levels, tables = {}, {}
        if categorical:
            freq = store(df.select(y.alias("y"), F.explode(F.array(*[
                F.struct(F.lit(i).alias("i"), as_category(df, c).alias("v"))
                for i, c in enumerate(categorical)])).alias("e"))
                .groupBy("y", "e.i", "e.v").agg(F.count(F.lit(1)).alias("n")), "levels")
            few, room = [], self.max_levels
            for r in freq.groupBy("i").count().orderBy("count", "i").collect():  # a row a column
                room -= r["count"]
                if room >= 0:
                    few.append(r["i"])
            found: dict = {}
            for r in freq.where(F.col("i").isin(few)).collect():  # at most max_levels rows
                found.setdefault((r["y"], categorical[r["i"]]), []).append((r["v"], r["n"]))
            for key, pairs in found.items():
                pairs.sort(key=lambda t: (t[0] is None, t[0] if t[0] is not None else ""))
                n = np.array([n for _, n in pairs], dtype=float)
                levels[key] = (np.asarray([v for v, _ in pairs], dtype=object), np.cumsum(n) / n.sum())
            for i in set(range(len(categorical))) - set(few):
                tables[categorical[i]] = store(cumulate(freq.where(F.col("i") == i), ["y"], "v"), "levels")
        fitted = FittedCopula(self.label, numeric, categorical, counts, grids, nulls, levels, {}, self.seed,
                              {c: df.schema[c].dataType for c in cols}, df.schema[self.label].dataType, tables)
        if self.correlated and len(cols) > 1:
            fitted.chol = {lab: _psd_cholesky(m) for lab, m in fitted.correlations(df).items() if lab in set(labels)}
        return fitted


def _number(df: DataFrame, c: str):
    if isinstance(df.schema[c].dataType, T.BooleanType):
        return qcol(c).cast("double")
    return stats.clean_double(c)


def _psd_cholesky(m: np.ndarray) -> np.ndarray:
    """Cholesky factor of the nearest usable correlation matrix (unknown pairs: 0)."""
    m = np.nan_to_num(m, nan=0.0)
    np.fill_diagonal(m, 1.0)
    w, v = np.linalg.eigh(m)
    fixed = (v * np.clip(w, 1e-6, None)) @ v.T
    d = np.sqrt(np.diag(fixed))
    return np.linalg.cholesky(fixed / np.outer(d, d) + 1e-9 * np.eye(len(m)))


def _by_class(labels: list, y: np.ndarray):
    """(label, row positions) of the classes present."""
    code = pd.Categorical(y, categories=labels).codes
    order = np.argsort(code, kind="stable")
    edge = np.searchsorted(code[order], np.arange(len(labels) + 1))
    for i, lab in enumerate(labels):
        if edge[i + 1] > edge[i]:
            yield lab, order[edge[i]:edge[i + 1]]


@dataclass
class FittedCopula:
    label: str
    numeric: list
    categorical: list
    counts: dict
    grids: dict
    nulls: dict
    levels: dict
    chol: dict
    seed: int
    types: dict
    label_type: T.DataType
    tables: dict = field(default_factory=dict)  # column -> intervals of its levels, for columns of many levels

    @property
    def labels(self):
        return sorted(self.counts)

    def normal_scores(self, df: DataFrame) -> DataFrame:
        """(y, z): the normal score of each value under its class's marginals; missing values are NaN."""
        numeric, categorical, labels, tabled = self.numeric, self.categorical, self.labels, set(self.tables)
        shared = df.sparkSession.sparkContext.broadcast((self.grids, {
            key: {v: hi - (hi - lo) / 2 for v, lo, hi in zip(vals, [0.0, *cum[:-1]], cum) if v is not None}
            for key, (vals, cum) in self.levels.items()}))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grids, middle = shared.value
            for pdf in batches:
                z = np.full((len(pdf), len(numeric) + len(categorical)), np.nan)
                for lab, rows in _by_class(labels, pdf["y"].to_numpy()):
                    for a, c in enumerate(numeric):
                        x, g = pdf[f"x{a}"].to_numpy(dtype=float)[rows], grids[(lab, c)]
                        last = max(len(g) - 1, 1)
                        i = np.clip(np.searchsorted(g, x, side="right"), 1, last)
                        lo, hi = g[i - 1], g[np.minimum(i, len(g) - 1)]
                        with np.errstate(invalid="ignore", divide="ignore"):
                            part = np.where(hi > lo, (x - lo) / (hi - lo), 0.5)
                        u = np.clip((i - 1 + np.clip(part, 0, 1)) / last, 1e-4, 1 - 1e-4)
                        z[rows, a] = np.where(np.isnan(x), np.nan, np_norm_ppf(u))
                    for j, c in enumerate(categorical):
                        u = pdf[f"c{j}"].iloc[rows]  # of a column of many levels: already the middle
                        u = (u if c in tabled else u.map(middle.get((lab, c), {}))).to_numpy(dtype=float)
                        z[rows, len(numeric) + j] = np.where(
                            np.isnan(u), np.nan, np_norm_ppf(np.clip(np.nan_to_num(u, nan=0.5), 1e-4, 1 - 1e-4)))
                yield pd.DataFrame({"y": pdf["y"], "z": list(z)})

        y = qcol(self.label)
        rows = df.select(y.alias("y"), *[_number(df, c).alias(f"x{a}") for a, c in enumerate(numeric)],
                         *[as_category(df, c).alias(f"c{j}") for j, c in enumerate(categorical)])
        for j, c in enumerate(categorical):
            if c in tabled:  # one row a level and class, so only the rows' side can be skewed: left to the skew join
                middles = self.tables[c].select(F.col("y").alias("_y"), F.col("v").alias("_v"),
                                                ((F.col("lo") + F.col("hi")) / 2 / F.col("total")).alias("_u"))
                rows = rows.join(middles, (F.col("y") == F.col("_y")) & (F.col(f"c{j}") == F.col("_v")), "left") \
                    .withColumn(f"c{j}", F.col("_u")).drop("_y", "_v", "_u")
        return rows.mapInPandas(run, f"y {self.label_type.simpleString()}, z array<double>")

    def correlations(self, df: DataFrame) -> dict:
        """Class -> pairwise-complete correlation matrix of the normal scores (NaN: undefined)."""
        return correlations(pairwise_moments(self.normal_scores(df), "z", "y"))

    def generate(self, spark, n: int, materialize: bool = True) -> DataFrame:
        """``n`` synthetic rows, in the columns' own types.

        With ``materialize`` (default) they are written once into the session's
        shared folder, as several readers follow (union, training, report).
        """
        out = self._generate(spark, n)
        return store(out, "copula") if materialize else out

    def _generate(self, spark, n: int) -> DataFrame:
        labels, numeric, categorical, label, tabled = self.labels, self.numeric, self.categorical, self.label, set(self.tables)
        k = len(numeric) + len(categorical)
        ends = np.cumsum([self.counts[y] for y in labels]).tolist()
        ids = spark.range(0, n, numPartitions=range_partitions(spark, n)) \
            .select("id", class_draw(ends[-1], self.seed, "class", F.col("id")).alias("_draw"))
        shared = spark.sparkContext.broadcast((self.grids, self.nulls, self.levels, self.chol))
        normal = [stream_key(self.seed, "e", j) for j in range(k)]
        missing = [stream_key(self.seed, "null", c) for c in numeric]
        whole = [not isinstance(self.types[c], _FRACTIONAL) for c in numeric]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grids, nulls, levels, chol = shared.value
            for pdf in batches:
                at = pdf["id"].to_numpy().astype(np.uint64)
                of = np.searchsorted(ends, pdf["_draw"].to_numpy(), side="right")
                e = np.column_stack([np_norm_ppf(np_uniform(s, at)) for s in normal]) if k else np.zeros((len(at), 0))
                numbers = np.full((len(at), len(numeric)), np.nan)
                texts = np.full((len(at), len(categorical)), None, dtype=object)
                uniforms = np.zeros((len(at), len(categorical)))  # of columns of many levels
                for i, rows in _by_class(list(range(len(labels))), of):
                    lab = labels[i]
                    u = np_norm_cdf(e[rows] @ chol[lab].T if lab in chol else e[rows])
                    for a, c in enumerate(numeric):
                        g = grids[(lab, c)]
                        place = u[:, a] * (len(g) - 1)
                        lo = np.clip(np.floor(place).astype(int), 0, max(len(g) - 2, 0))
                        v = g[lo] + (place - lo) * (g[np.minimum(lo + 1, len(g) - 1)] - g[lo])
                        v = np.round(v) if whole[a] else v
                        numbers[rows, a] = np.where(np_uniform(missing[a], at[rows]) < nulls[(lab, c)], np.nan, v)
                    for j, c in enumerate(categorical):
                        if c in tabled:
                            uniforms[rows, j] = u[:, len(numeric) + j]
                            continue
                        vals, cum = levels.get((lab, c), (np.array([None], dtype=object), np.ones(1)))
                        pick = np.searchsorted(cum, u[:, len(numeric) + j], side="right")
                        texts[rows, j] = vals[np.minimum(pick, len(vals) - 1)]
                out = {"id": pdf["id"], "_class": of}
                out |= {f"x{a}": pd.array(numbers[:, a], "Float64") for a in range(len(numeric))}
                out |= {f"c{j}": uniforms[:, j] if c in tabled else texts[:, j] for j, c in enumerate(categorical)}
                frame = pd.DataFrame(out)
                for a in range(len(numeric)):  # missing is null, not NaN
                    frame[f"x{a}"] = frame[f"x{a}"].mask(np.isnan(numbers[:, a]))
                yield frame

        schema = ", ".join(["id long, _class int", *(f"x{a} double" for a in range(len(numeric))),
                            *(f"c{j} {'double' if c in tabled else 'string'}" for j, c in enumerate(categorical))])
        names = F.array(*[F.lit(v) for v in labels])
        rows = ids.mapInPandas(run, schema).withColumn(
            "_y", F.element_at(names, F.col("_class") + 1).cast(self.label_type)).drop("_class")
        for j, c in enumerate(categorical):
            if c in tabled:
                of = self.tables[c].withColumnRenamed("y", "_y")
                rows = draw_values(rows, of, ["_y"], F.col(f"c{j}"), "v", "_drawn").drop(f"c{j}") \
                    .withColumnRenamed("_drawn", f"c{j}")
        outs = [self._typed(F.col(f"x{a}"), c) for a, c in enumerate(numeric)] \
            + [F.col(f"c{j}").alias(c) for j, c in enumerate(categorical)]
        return rows.select(F.col("id").alias(SYNTH_ID), *outs, F.col("_y").alias(label))

    def _typed(self, x, c: str):
        kind = self.types[c]
        if isinstance(kind, T.BooleanType):
            return (x >= 0.5).alias(c)
        return x.cast(kind if isinstance(kind, NUMERIC_TYPES) else T.DoubleType()).alias(c)


__all__ = ["CopulaSynthesizer", "FittedCopula"]
