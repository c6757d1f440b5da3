"""Dependence between columns of any kinds, and principal components, of real and synthetic rows.

Pairs of text columns are measured by Cramér's V, a text and a number by the
correlation ratio, two numbers by Pearson's correlation; each over the rows in
which both are present.  All contingency tables come from one keyed aggregate
over the long form (pair, level, level): partial sums before the shuffle, so a
frequent level is a row a task, and levels stay in Spark however many they are.
What is collected has a row per pair of columns.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.operators import stats
from tabprep.operators.features import as_category, split_types
from tabprep.operators.quality import correlation_matrix, pair_correlations, quality_by_column
from tabprep.session import store

#: Spread below this share of the squares is rounding.
_NOTHING = 1e-13


def _means(df: DataFrame, numeric: list) -> list[float]:
    if not numeric:
        return []
    row = df.agg(*[F.avg(stats.clean_double(c)).alias(f"m{i}") for i, c in enumerate(numeric)]).first()
    return [float(m) if m is not None else 0.0 for m in row]


def contingency(df: DataFrame, categorical: list, numeric: list) -> DataFrame:
    """(i, j, a, b, n, s, ss): rows of each pair of levels, and of each level with sums of a number.

    ``i`` and ``j`` number the columns, text first.  ``b`` is a level where j is a
    text column, else null; ``s`` and ``ss`` add up the centred number and its square.
    """
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    texts = [F.struct(F.lit(i).alias("i"), as_category(df, c).alias("v"), no_number.alias("x")) for i, c in enumerate(categorical)]
    numbers = [F.struct(F.lit(len(categorical) + j).alias("i"), no_text.alias("v"), (stats.clean_double(c) - F.lit(m)).alias("x"))
               for j, (c, m) in enumerate(zip(numeric, _means(df, numeric)))]
    there = lambda e: e["v"].isNotNull() | e["x"].isNotNull()
    wide = df.select(F.filter(F.array(*texts), there).alias("texts"), F.filter(F.array(*texts, *numbers), there).alias("cells"))
    pairs = wide.select(F.explode("texts").alias("p"), "cells") \
        .select("p", F.explode("cells").alias("q")).where("q.i > p.i")
    return pairs.groupBy(F.col("p.i").alias("i"), F.col("q.i").alias("j"), F.col("p.v").alias("a"), F.col("q.v").alias("b")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("q.x").alias("s"), F.sum(F.col("q.x") * F.col("q.x")).alias("ss"))


def _cramers_v(cells: DataFrame) -> DataFrame:
    """(i, j, n, value), from the sum of n * n / na / nb over the cells.

    Cells are brought together by the levels of the pair's side with more of them
    (about), so a key has at most as many cells as the other side has levels; the
    other side's totals are partial sums, however many cells a level has.
    """
    more = cells.groupBy("i", "j").agg((F.approx_count_distinct("a") > F.approx_count_distinct("b")).alias("turn"))  # a row a pair
    pick = lambda x, y: F.when(F.col("turn"), F.col(x)).otherwise(F.col(y))
    n = F.col("n").cast("double")
    many = Window.partitionBy("i", "j", "many")
    met = cells.join(F.broadcast(more), ["i", "j"]).select("i", "j", pick("b", "a").alias("few"), pick("a", "b").alias("many"), "n") \
        .withColumn("total", F.sum("n").over(many)).withColumn("first", F.row_number().over(many.orderBy("few")) == 1)
    sums = met.groupBy("i", "j", "few").agg(F.sum("n").alias("n"), F.sum(n * n / F.col("total")).alias("q"),
                                            F.count_if("first").alias("own"))
    free = F.least(F.count(F.lit(1)), F.sum("own")) - 1
    return sums.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum(F.col("q") / F.col("n")).alias("q"), free.alias("free")).select(
        "i", "j", "n", F.when(F.col("free") > 0, F.sqrt(F.greatest(F.col("q") - 1, F.lit(0.0)) / F.col("free"))).alias("value"))


def _correlation_ratio(cells: DataFrame) -> DataFrame:
    sums = cells.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"),
                                       F.sum(F.col("s") * F.col("s") / F.col("n")).alias("own"))
    mean = F.col("s") * F.col("s") / F.col("n")
    spread, between = F.col("ss") - mean, F.greatest(F.col("own") - mean, F.lit(0.0))
    return sums.select("i", "j", "n", F.when(spread > _NOTHING * F.col("ss"), F.sqrt(F.least(between / spread, F.lit(1.0))))
                       .alias("value"))


def associations(df: DataFrame, columns: list) -> DataFrame:
    """(column_a, column_b, kind, value), a row per pair of columns; the value is null where undefined.

    Undefined: no row with both, fewer than two levels of a text, no spread of a number.
    """
    numeric, categorical = split_types(df, columns)
    names, c = categorical + numeric, len(categorical)
    found: dict = {}
    if categorical and len(names) > 1:
        cells = store(contingency(df, categorical, numeric), "contingency")
        for part in (_cramers_v(cells.where(F.col("j") < c)), _correlation_ratio(cells.where(F.col("j") >= c))):
            found.update({(r["i"], r["j"]): r["value"] for r in part.collect()})  # a row a pair of columns
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    if len(numeric) > 1:
        found.update(zip([(i, j) for i, j in pairs if i >= c], pair_correlations(df, numeric)))
    kind = lambda i, j: "cramers_v" if j < c else "correlation_ratio" if i < c else "correlation"
    return df.sparkSession.createDataFrame([(names[i], names[j], kind(i, j), found.get((i, j))) for i, j in pairs],
                                           "column_a string, column_b string, kind string, value double")


def compare_associations(real: DataFrame, synth: DataFrame, columns: list) -> DataFrame:
    """(column_a, column_b, kind, real, synthetic, difference); an undefined association counts as 0.

    Differences are scaled to 0-1: a correlation spans two units, the others one.
    """
    a = associations(real, columns).withColumnRenamed("value", "real")
    b = associations(synth, columns).select("column_a", "column_b", F.col("value").alias("synthetic"))
    apart = F.abs(F.coalesce("real", F.lit(0.0)) - F.coalesce("synthetic", F.lit(0.0)))
    return a.join(b, ["column_a", "column_b"]).select(
        "column_a", "column_b", "kind", "real", "synthetic",
        F.when(F.col("kind") == "correlation", apart / 2).otherwise(apart).alias("difference"))


def association_similarity(real: DataFrame, synth: DataFrame, columns: list) -> DataFrame:
    """One row: association_similarity (0-100; null with fewer than two columns)."""
    return compare_associations(real, synth, columns).agg((100.0 * (1.0 - F.avg("difference"))).alias("association_similarity"))


# ------------------------------------------------------------------ principal components

class Components:
    """The leading principal components of the numeric columns of a table.

    Axes of the pairwise-complete correlation matrix (undefined pairs: 0), each
    with its largest loading positive; a missing value takes its column's mean.
    """

    def __init__(self, df: DataFrame, columns: list, k: int = 2):
        self.numeric, _ = split_types(df, columns)
        self.means = _means(df, self.numeric)
        row = df.agg(*[F.stddev_pop(stats.clean_double(c)).alias(f"s{i}") for i, c in enumerate(self.numeric)]).first() \
            if self.numeric else []
        self.spreads = [float(s) if s else 1.0 for s in row]
        m = np.nan_to_num(correlation_matrix(df, self.numeric), nan=0.0)
        np.fill_diagonal(m, 1.0)
        values, axes = np.linalg.eigh(m) if len(m) else (np.zeros(0), np.zeros((0, 0)))
        order = np.argsort(-values, kind="stable")[:k]
        self.shares = [float(v) / len(m) for v in values[order]]
        self.axes = [a * (1.0 if a[np.argmax(np.abs(a))] > 0 else -1.0) for a in axes.T[order]]

    @property
    def names(self) -> list[str]:
        return [f"component_{i + 1}" for i in range(len(self.axes))]

    def project(self, df: DataFrame) -> DataFrame:
        """A column per component, in one projection."""
        scaled = F.array(*[F.coalesce((stats.clean_double(c) - F.lit(m)) / F.lit(s), F.lit(0.0))
                           for c, m, s in zip(self.numeric, self.means, self.spreads)])

        def along(axis) -> Column:
            weights = F.array(*[F.lit(float(w)) for w in axis])
            return F.aggregate(F.zip_with(scaled, weights, lambda x, w: x * w), F.lit(0.0), lambda t, x: t + x)

        return df.select(*[along(a).alias(n) for n, a in zip(self.names, self.axes)])


def compare_components(real: DataFrame, synth: DataFrame, columns: list, k: int = 2, bins: int = 20) -> DataFrame:
    """(component, share, js_distance): how apart both tables lie along the real rows' components."""
    own = Components(real, columns, k)
    if not own.axes:
        return real.sparkSession.createDataFrame([], "component string, share double, js_distance double")
    shares = F.create_map(*[F.lit(x) for pair in zip(own.names, own.shares) for x in pair])
    return quality_by_column(own.project(real), own.project(synth), own.names, bins) \
        .select(F.col("column").alias("component"), F.try_element_at(shares, F.col("column")).alias("share"), "js_distance")


__all__ = ["Components", "association_similarity", "associations", "compare_associations", "compare_components", "contingency"]
