"""Fitted statistics: exact medians, population moments, category levels,
class counts.  Each is one (or a few) partial-aggregate passes whose output
is bounded by the number of columns, levels or classes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.functions.ranks import sorted_rank
from tabprep.session import store


def clean_double(name: str):
    """Column as double with NaN mapped to null (NaN means missing)."""
    x = qcol(name).cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def exact_medians(df: DataFrame, cols: list[str], accuracy: int = 10_000,
                  collect_limit: int = 50_000) -> dict:
    """Exact median per column (nulls skipped; mean of the two middle values
    for an even count), without holding a column's values in one task.
    See ``fit_columns``."""
    return fit_columns(df, cols, {}, accuracy=accuracy, collect_limit=collect_limit)["medians"]


@dataclass(eq=False)
class LevelTable:
    """The sorted levels of a column with too many for the driver: (level, code), codes from 0."""
    table: DataFrame
    n: int

    def __len__(self) -> int:
        return self.n


def level_tables(pairs: DataFrame, counts: dict) -> dict:
    """Column index -> LevelTable, for ``counts`` {column index: levels}, from distinct (i, s) rows.

    One distributed ranking serves all these columns; nothing but their sizes reaches the driver.
    """
    wanted = pairs.where(F.col("i").isin(sorted(counts)) & F.col("s").isNotNull()).select("i", "s")
    ranked = store(sorted_rank(wanted, ["i", "s"]), "levels")
    starts = {r["i"]: r["r"] for r in ranked.groupBy("i").agg(F.min("_rank").alias("r")).collect()}  # a row a column
    return {i: LevelTable(ranked.where(F.col("i") == i).select(F.col("s").alias("level"), (F.col("_rank") - start).alias("code")), counts[i])
            for i, start in starts.items()}


def _levels(pairs: DataFrame, names: list, max_levels: int, first: int = 0) -> dict:
    """Column -> sorted list of levels, or a LevelTable beyond ``max_levels``, from distinct (i, s) rows; ``first`` is the index of the first name."""
    counts = {r["i"]: r["n"] for r in pairs.where(F.col("s").isNotNull()).groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = sorted(i for i, n in counts.items() if n <= max_levels)
    levels: dict = {c: [] for c in names}
    for r in pairs.where(F.col("i").isin(few) & F.col("s").isNotNull()).select("i", "s").collect():  # max_levels rows a column
        levels[names[r["i"] - first]].append(r["s"])
    levels = {c: sorted(v) for c, v in levels.items()}
    many = {i: n for i, n in counts.items() if n > max_levels}
    if many:
        levels |= {names[i - first]: t for i, t in level_tables(pairs, many).items()}
    return levels


GRID = 1000  # narrowing grid: 1001 sketch points per column and level


def fit_columns(df: DataFrame, numeric: list[str], categorical: dict, max_levels: int = 10_000,
                accuracy: int = 10_000, collect_limit: int = 50_000) -> dict:
    """Medians, imputed moments and category levels in as few scans as possible.

    ``categorical`` maps a name to the (already null-filled) string expression.

    Every pass works on the long form ``(column index, value)`` and groups by
    the column index, so the generated code does not grow with the number of
    columns (a 100-column table is one small aggregate, not 400 of them).

    Scan 1: per numeric column the row count, non-null count, mean,
    population variance and approximate distinct count.  The mean /
    population std of the column *after* median imputation follow exactly
    from these and the median (the parallel-variance formula).

    Median: a value window [lo, hi] around the two middle ranks.  Each
    narrowing level reads a 1001-point ``percentile_approx`` grid of the
    current window (per column), keeps the grid points bracketing the middle
    ranks, and counts rows below / inside the new window exactly, shrinking
    it ~500x.  Columns with few distinct values, and windows of at most
    ``collect_limit`` rows, skip to the last scan.

    Last scan: one ``groupBy(column, value)`` gives both the (value, count)
    pairs inside each median window and the distinct levels of every
    categorical column; a hot value collapses map-side.  The middle ranks are
    found by a running count per column in Spark, so only two values per
    column reach the driver, and the category levels of columns with at most
    ``max_levels``; those of others stay a table (``LevelTable``).
    """
    xs = {c: clean_double(c) for c in numeric}
    state, medians, first = {}, {}, {}
    N = None
    if numeric:
        long = _long(df, [xs[c] for c in numeric])
        rows = long.groupBy("i").agg(
            F.count(F.lit(1)).alias("N"), F.count("x").alias("n"), F.avg("x").alias("m"),
            F.var_pop("x").alias("v"), F.approx_count_distinct("x", 0.05).alias("d")).collect()
        first = {numeric[r["i"]]: r for r in rows}
        N = int(rows[0]["N"]) if rows else 0
    for c in numeric:
        n = int(first[c]["n"]) if c in first else 0
        if n == 0:
            medians[c] = None
            continue
        # what is collected are (value, count) pairs: a column with few
        # distinct values (counts, codes, flags) needs no narrowing at all
        few = first[c]["d"] <= collect_limit // 2
        state[c] = dict(n=n, k1=(n + 1) // 2, k2=n // 2 + 1, lo=None, hi=None, below=0,
                        inside=0 if few else n)

    while any(s_["inside"] > collect_limit for s_ in state.values()):
        large = [c for c, s_ in state.items() if s_["inside"] > collect_limit]
        long = _long(df, [xs[c] for c in large])
        inw = _window_expr(large, state)
        probs = [j / GRID for j in range(GRID + 1)]
        grids = {r["i"]: r["q"] for r in long.where(inw).groupBy("i").agg(
            F.percentile_approx("x", probs, accuracy).alias("q")).collect()}
        for i, c in enumerate(large):
            s_ = state[c]
            q = grids[i]
            mg = s_.setdefault("margin", 2)
            j_lo = max(0, int((s_["k1"] - s_["below"]) / s_["inside"] * GRID) - mg)
            j_hi = min(GRID, int((s_["k2"] - s_["below"]) / s_["inside"] * GRID) + mg + 1)
            s_["new"] = (q[j_lo], q[j_hi])
        lo_arr = F.array(*[F.lit(float(state[c]["new"][0])) for c in large])
        hi_arr = F.array(*[F.lit(float(state[c]["new"][1])) for c in large])
        lo, hi = F.try_element_at(lo_arr, F.col("i") + 1), F.try_element_at(hi_arr, F.col("i") + 1)
        cnts = {r["i"]: r for r in long.groupBy("i").agg(
            F.count_if(F.col("x") < lo).alias("b"),
            F.count_if((F.col("x") >= lo) & (F.col("x") <= hi)).alias("w")).collect()}
        for i, c in enumerate(large):
            s_ = state[c]
            lo_v, hi_v = s_.pop("new")
            below, inside = int(cnts[i]["b"]), int(cnts[i]["w"])
            if not (below < s_["k1"] and below + inside >= s_["k2"]):
                # the bracket missed the middle ranks (sketch error): widen it
                s_["margin"] *= 4
                if s_["margin"] > GRID // 4:
                    raise RuntimeError(f"median window of {c!r} did not narrow")
            elif inside < s_["inside"]:
                s_.update(lo=lo_v, hi=hi_v, below=below, inside=inside)
            else:
                # bracketed but no smaller: ties (a hot value fills the window),
                # so the window holds few distinct values - collect its pairs
                s_.update(lo=lo_v, hi=hi_v, below=below, inside=0)

    num_cols = list(state)
    cat_names = list(categorical)
    entries = []
    for i, c in enumerate(num_cols):
        entries.append(F.struct(F.lit(i).alias("i"), xs[c].alias("v"),
                                F.lit(None).cast("string").alias("s")))
    for j, c in enumerate(cat_names):
        entries.append(F.struct(F.lit(len(num_cols) + j).alias("i"), F.lit(None).cast("double").alias("v"),
                                categorical[c].alias("s")))
    levels: dict = {c: [] for c in cat_names}
    if entries:
        long = df.select(F.explode(F.array(*entries)).alias("e")).select("e.i", "e.v", "e.s")
        keep = F.col("i") >= len(num_cols)
        if num_cols:
            keep = keep | _window_expr(num_cols, state, "v")
        pairs = long.where(keep).groupBy("i", "v", "s").agg(F.count(F.lit(1)).alias("c")) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        try:
            nn = len(num_cols)
            if cat_names:
                levels = _levels(pairs.where(F.col("i") >= nn), cat_names, max_levels, nn)
            if num_cols:
                medians.update(_window_middles(pairs.where(F.col("i") < nn), num_cols, state))
        finally:
            pairs.unpersist()

    moments = {}
    for c in numeric:
        med = medians[c]
        if med is None:
            continue
        n_nn, m, v = int(first[c]["n"]), first[c]["m"], first[c]["v"]
        n_miss = N - n_nn
        mean = (n_nn * m + n_miss * med) / N
        m2 = n_nn * v + n_nn * (m - mean) ** 2 + n_miss * (med - mean) ** 2
        moments[c] = (mean, math.sqrt(max(m2, 0.0) / N))
    return {"medians": medians, "moments": moments, "levels": levels}


def _long(df: DataFrame, exprs: list) -> DataFrame:
    """(i, x) rows: the i-th expression's value for every input row."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), e.alias("x")) for i, e in enumerate(exprs)])).alias("e")) \
        .select("e.i", "e.x")


def _window_expr(cols: list, state: dict, value: str = "x"):
    """Per-row test 'value inside its column's current window' on the long
    form (column index ``i``; indices past ``cols`` get a null bound)."""
    x = F.col(value)
    if all(state[c]["lo"] is None for c in cols):
        return x.isNotNull()
    idx = F.col("i") + 1
    lo = F.try_element_at(F.array(*[F.lit(state[c]["lo"]).cast("double") for c in cols]), idx)
    hi = F.try_element_at(F.array(*[F.lit(state[c]["hi"]).cast("double") for c in cols]), idx)
    return x.isNotNull() & (lo.isNull() | ((x >= lo) & (x <= hi)))


def _window_middles(pairs: DataFrame, cols: list, state: dict) -> dict:
    """Median of each column from its window's (value, count) pairs.

    A running count per column (a window partitioned by column over at most
    ``collect_limit`` pairs each) finds the values at the two middle ranks in
    Spark; only those (two rows per column) reach the driver."""
    below = F.element_at(F.array(*[F.lit(int(state[c]["below"])) for c in cols]), F.col("i") + 1)
    k1 = F.element_at(F.array(*[F.lit(int(state[c]["k1"])) for c in cols]), F.col("i") + 1)
    k2 = F.element_at(F.array(*[F.lit(int(state[c]["k2"])) for c in cols]), F.col("i") + 1)
    w = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = pairs.select("i", "v", "c", (below + F.sum("c").over(w)).alias("cum"))
    hit1 = (F.col("cum") - F.col("c") < k1) & (k1 <= F.col("cum"))
    hit2 = (F.col("cum") - F.col("c") < k2) & (k2 <= F.col("cum"))
    rows = cum.where(hit1 | hit2).select("i", "v", hit1.alias("h1"), hit2.alias("h2")).collect()
    v1, v2 = {}, {}
    for r in rows:
        if r["h1"]:
            v1[r["i"]] = r["v"]
        if r["h2"]:
            v2[r["i"]] = r["v"]
    out = {}
    for i, c in enumerate(cols):
        a, b = v1.get(i), v2.get(i)
        out[c] = a if a == b else (a + b) / 2.0
    return out


def approx_medians(df: DataFrame, cols: list[str], accuracy: int = 10_000) -> dict:
    if not cols:
        return {}
    row = df.agg(*[F.percentile_approx(clean_double(c), 0.5, accuracy).alias(f"m{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(cols)}


def mean_std_pop(df: DataFrame, exprs: dict) -> dict:
    """Mean and population std of each named expression, one pass."""
    if not exprs:
        return {}
    aggs = []
    names = list(exprs)
    for i, c in enumerate(names):
        aggs += [F.avg(exprs[c]).alias(f"a{i}"), F.stddev_pop(exprs[c]).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"a{i}"], row[f"s{i}"]) for i, c in enumerate(names)}


def distinct_levels(df: DataFrame, exprs: dict, max_levels: int = 10_000) -> dict:
    """Sorted distinct values of each string expression: column -> list, or LevelTable beyond ``max_levels``.

    Stacks (column, value) pairs and de-duplicates with a partial aggregate;
    a hot value collapses map-side.
    """
    if not exprs:
        return {}
    names = list(exprs)
    pairs = (df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), exprs[c].alias("s")) for i, c in enumerate(names)])).alias("e"))
        .select("e.i", "e.s").distinct()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _levels(pairs, names, max_levels)
    finally:
        pairs.unpersist()


def class_counts(df: DataFrame, label: str) -> dict:
    """``{label_value: count}`` (null labels counted under None); a row a class reaches the driver."""
    rows = df.groupBy(qcol(label).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["y"]: int(r["n"]) for r in rows}
