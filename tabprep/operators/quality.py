"""Synthetic-quality report: per-column Jensen-Shannon distances and the
difference of pairwise correlations, scaled to 0-100."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.operators import stats
from tabprep.operators.correlation import correlations, pairwise_moments
from tabprep.operators.features import as_category, split_types


def _js_distance(p: Column, q: Column) -> Column:
    """Per-bin terms of the base-2 Jensen-Shannon divergence (sum, then sqrt)."""
    m = (p + q) / 2
    tp = F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    tq = F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)
    return 0.5 * tp + 0.5 * tq


def quality_by_column(real: DataFrame, synth: DataFrame, columns: list, bins: int = 20) -> DataFrame:
    """Per column: Jensen-Shannon distance between real and synthetic
    distributions (numeric: ``bins`` equal-width bins over the real range, one
    more on each side for synthetic values beyond it; categorical: levels).
    Missing values are a cell of their own, apart from any level's text.

    Both tables are read in long form (column index, value), so the plan does
    not grow with the number of columns; the per-column histograms are
    partial aggregates keyed by (column, cell)."""
    numeric, categorical = split_types(real, columns)
    names = numeric + categorical
    nn = len(numeric)

    def long(df):
        return df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), stats.clean_double(c).alias("x"),
                     F.lit(None).cast("string").alias("s")) for i, c in enumerate(numeric)] + [
            F.struct(F.lit(nn + j).alias("i"), F.lit(None).cast("double").alias("x"),
                     as_category(df, c).alias("s")) for j, c in enumerate(categorical)])).alias("e")) \
            .select("e.i", "e.x", "e.s")

    lo_w = {}
    if numeric:
        for r in long(real).where(F.col("i") < nn).groupBy("i").agg(
                F.min("x").alias("lo"), F.max("x").alias("hi")).collect():
            lo, hi = r["lo"], r["hi"]
            lo_w[r["i"]] = (lo if lo is not None else 0.0,
                            (hi - lo) if (lo is not None and hi is not None and hi > lo) else 1.0)
    lo_arr = F.array(*[F.lit(float(lo_w.get(i, (0.0, 1.0))[0])) for i in range(nn)] or [F.lit(0.0)])
    w_arr = F.array(*[F.lit(float(lo_w.get(i, (0.0, 1.0))[1])) for i in range(nn)] or [F.lit(1.0)])

    def cells(df, side):
        i = F.col("i")
        lo, width = F.try_element_at(lo_arr, i + 1), F.try_element_at(w_arr, i + 1)
        share = (F.col("x") - lo) / width
        b = F.when(share < 0, -1).when(share > 1, bins).otherwise(F.least(F.floor(share * bins), F.lit(bins - 1)))
        cell = F.when(i < nn, b.cast("string")).otherwise(F.col("s"))
        return long(df).select("i", cell.isNull().alias("missing"), F.coalesce(cell, F.lit("")).alias("cell")) \
            .groupBy("i", "missing", "cell").agg(F.count(F.lit(1)).alias(side))

    joined = cells(real, "n_real").join(cells(synth, "n_synth"), ["i", "missing", "cell"], "full_outer") \
        .fillna(0, ["n_real", "n_synth"])
    # totals by an aggregate of their own: a window would put all cells of a column in one task
    totals = joined.groupBy("i").agg(F.sum("n_real").alias("t_real"), F.sum("n_synth").alias("t_synth"))
    # try_divide: an empty side (e.g. zero generated rows) gives null shares
    probs = joined.join(F.broadcast(totals), "i").select(  # a row a column
        "i", F.try_divide("n_real", "t_real").alias("p"), F.try_divide("n_synth", "t_synth").alias("q"))
    name_arr = F.array(*[F.lit(c) for c in names])
    js = F.sum(_js_distance(F.col("p"), F.col("q")))
    # undefined (null) when either side has no rows
    return probs.groupBy("i").agg(F.when(js.isNotNull(), F.sqrt(F.greatest(js, F.lit(0.0))))
                                  .alias("js_distance")) \
        .select(F.element_at(name_arr, F.col("i") + 1).alias("column"), "js_distance",
                F.when(F.col("i") < nn, "numeric").otherwise("categorical").alias("kind"))


def correlation_matrix(df: DataFrame, numeric: list) -> np.ndarray:
    """Pearson correlations, each over the rows where both columns are present; NaN where undefined."""
    if len(numeric) < 2:
        return np.eye(len(numeric))
    means = df.agg(*[F.avg(stats.clean_double(c)).alias(f"m{i}") for i, c in enumerate(numeric)]).first()
    centred = df.select(F.lit(0).alias("g"), F.array(*[
        F.coalesce(stats.clean_double(c) - F.lit(float(means[f"m{i}"] or 0.0)), F.lit(float("nan")))
        for i, c in enumerate(numeric)]).alias("v"))
    m = correlations(pairwise_moments(centred, "v", "g")).get(0)
    return np.full((len(numeric), len(numeric)), np.nan) if m is None else m


def pair_correlations(df: DataFrame, numeric: list) -> list:
    """Upper triangle of ``correlation_matrix``; None where undefined."""
    m = correlation_matrix(df, numeric)
    pairs = [(a, b) for a in range(len(numeric)) for b in range(a + 1, len(numeric))]
    return [None if np.isnan(m[a, b]) else float(m[a, b]) for a, b in pairs]


def quality_summary(real: DataFrame, synth: DataFrame, columns: list, bins: int = 20,
                    by_column: DataFrame | None = None) -> DataFrame:
    """One row: column_similarity, correlation_similarity, overall (0-100)."""
    by_col = quality_by_column(real, synth, columns, bins) if by_column is None else by_column
    numeric, _ = split_types(real, columns)
    col_score = by_col.agg((100.0 * (1.0 - F.avg("js_distance"))).alias("column_similarity"))
    corr_sim = 100.0
    if len(numeric) > 1:
        diffs = [abs((a or 0.0) - (b or 0.0)) for a, b in
                 zip(pair_correlations(real, numeric), pair_correlations(synth, numeric))]
        corr_sim = 100.0 * (1.0 - sum(diffs) / len(diffs) / 2.0)
    return col_score.select("column_similarity", F.lit(corr_sim).alias("correlation_similarity"),
                            ((F.col("column_similarity") + F.lit(corr_sim)) / 2).alias("overall"))
