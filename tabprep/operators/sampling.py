"""Row order, exact-size splits and minority over-sampling.

Every random choice is a function of ``md5(seed|key)``, so results do not
depend on partitioning or retries.  Split membership is decided by
comparing a row's hash with a per-class threshold hash (the k-th smallest),
found by ``hash_cutoffs`` without sorting the table: the final split column
is a narrow projection.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.hashing import hash_key, hash_uniform, range_partitions
from tabprep.functions.names import qcol, require_columns
from tabprep.functions.ranks import hash_cutoffs, hash_rank, prefix_counts, sorted_rank
from tabprep.operators.stats import class_counts
from tabprep.session import store

SPLIT = "split"
#: Strata whose thresholds may stand in the plan as literals; more become a joined table.
LITERAL_STRATA = 64
#: Rows of a threshold table that may be broadcast; rows of a sample that one task may sort.
BROADCAST_STRATA, TOP_ROWS = 500_000, 10_000


# ---------------------------------------------------------------- D1

def shuffle_rows(df: DataFrame, key: str, seed: int = 42, position: str | None = None) -> DataFrame:
    """Rows in a seeded pseudo-random order (a distributed range sort).

    With ``position``, a column of that name holds each row's 1-based place,
    so that the order outlives a shuffle.
    """
    if position is not None:
        h = "_shuffle_h"
        df = hash_rank(df.withColumn(h, hash_key(seed, qcol(key))), h, rank_col=position).drop(h)
        return df.orderBy(qcol(position))
    return df.orderBy(hash_key(seed, qcol(key)), qcol(key))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The n rows with the smallest hash: a seeded sample of exactly n rows.

    Up to TOP_ROWS rows are a top-n (one job); more are a filter by the n-th
    smallest hash (``hash_cutoffs``), so no task holds the sample however large n is.
    The rows are the same either way.
    """
    h = "_sample_h"
    hashed = df.withColumn(h, hash_key(seed, qcol(key)))
    if n <= 0:
        return df.limit(0)
    if n <= TOP_ROWS:
        return hashed.orderBy(h).limit(n).drop(h)
    level1 = prefix_counts(hashed, h, None).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if (level1.agg(F.sum("_n")).first()[0] or 0) <= n:
            return df
        cut = hash_cutoffs(hashed, h, {0: [n]}, first_level=level1)[(0, n)]
    finally:
        level1.unpersist()
    return hashed.where(F.col(h) <= F.lit(cut)).drop(h)


# ---------------------------------------------------------------- quotas

def approximate_mode(counts: dict, n_draws: int) -> dict:
    """Per-class allocation of ``n_draws`` by largest remainder.

    Floors of ``count * n_draws / total``; the leftover draws go to the
    classes with the largest remainders, ties to the smaller label.
    """
    total = sum(counts.values())
    labels = sorted(counts)
    cont = {y: counts[y] * n_draws / total for y in labels}
    floored = {y: math.floor(cont[y]) for y in labels}
    need = n_draws - sum(floored.values())
    rank = {y: i for i, y in enumerate(labels)}
    order = sorted(labels, key=lambda y: (-(cont[y] - floored[y]), rank[y]))
    for y in order[:need]:
        floored[y] += 1
    return floored


def _check_strata(counts: dict, n_train: int, n_test: int) -> None:
    _check_strata_sizes(min(counts.values()), len(counts), n_train, n_test)


def _check_strata_sizes(least: int, classes: int, n_train: int, n_test: int) -> None:
    if least < 2:
        raise ValueError("the least populated class has only 1 member; "
                         "stratified splitting needs at least 2 per class")
    if n_train < classes or n_test < classes:
        raise ValueError(f"split sizes ({n_train}, {n_test}) must be at least the "
                         f"number of classes ({classes})")


def split_quotas(counts: dict, test_size: float = 0.20, val_size: float = 0.25,
                 has_test: bool = False, has_val: bool = False,
                 stratified: bool = True) -> dict:
    """``{class: (n_test, n_val)}``; whatever is left of a class is train.

    Test takes ``ceil(test_size * n)`` rows, validation ``ceil(val_size * rest)``
    of the remainder.  Without stratification ``counts`` has one class.
    """
    cur = dict(counts)
    test = {y: 0 for y in cur}
    val = {y: 0 for y in cur}
    for size, flag, target in ((test_size, has_test, test), (val_size, has_val, val)):
        if flag:
            continue
        n = sum(cur.values())
        n_out = math.ceil(size * n)
        n_keep = n - n_out
        if stratified:
            _check_strata(cur, n_keep, n_out)
            keep = approximate_mode(cur, n_keep)
        else:
            if n_out >= n or n_out <= 0:
                raise ValueError(f"split of {n} rows leaves an empty side")
            keep = {y: cur[y] - n_out for y in cur}
        for y in cur:
            target[y] = cur[y] - keep[y]
            cur[y] = keep[y]
    return {y: (test[y], val[y]) for y in counts}


# ---------------------------------------------------------------- D2, D3

def split_exact(df: DataFrame, key: str, seed: int = 42, stratify: str | None = None,
                test_size: float = 0.20, val_size: float = 0.25, has_test: bool = False,
                has_val: bool = False, split_col: str = SPLIT) -> DataFrame:
    """Tag each row ``train`` / ``validation`` / ``test`` with exact sizes.

    ``key`` must be unique.  Sizes follow ceil(.20 n) then ceil(.25 rest),
    per class (largest-remainder quotas) when ``stratify`` is given.
    """
    require_columns(df, [key] + ([stratify] if stratify else []))
    h = "_split_h"
    hashed = df.withColumn(h, hash_key(seed, qcol(key)))
    if stratify:
        few = df.select(qcol(stratify).alias("y")).distinct().limit(LITERAL_STRATA + 1).count()
        if few > LITERAL_STRATA:
            return _split_many(df, hashed, h, stratify, test_size, val_size, has_test, has_val, split_col)
    # one scan gives both the class sizes and the first md5-prefix level
    level1 = prefix_counts(hashed, h, stratify).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = level1.groupBy("_g").agg(F.sum("_n").alias("n")).collect()  # a row a class
        counts = {r["_g"]: int(r["n"]) for r in rows}
        if stratify and None in counts:
            raise ValueError(f"null values in stratification column {stratify!r}")
        if not counts:
            raise ValueError("cannot split an empty table")
        quotas = split_quotas(counts, test_size, val_size, has_test, has_val,
                              stratified=stratify is not None)
        wanted = {y: [t, t + v] for y, (t, v) in quotas.items()}
        cut = hash_cutoffs(hashed, h, wanted, group_col=stratify, first_level=level1)
    finally:
        level1.unpersist()
    return hashed.withColumn(split_col, _split_expr(F.col(h), quotas, cut, stratify)).drop(h)


def class_quotas(classes: DataFrame, test_size: float = 0.20, val_size: float = 0.25, has_test: bool = False,
                 has_val: bool = False) -> DataFrame:
    """(y, n_test, n_val) for any number of classes (y, n): ``split_quotas`` without a class list on the driver.

    A side's quotas are floors of each class's share, and one more for the classes with the
    largest remainders, which a distributed ranking finds.
    """
    cur = store(classes.select("y", "n", F.col("n").alias("_left"), F.lit(0).cast("long").alias("n_test"),
                               F.lit(0).cast("long").alias("n_val")), "strata")
    for size, given, target in ((test_size, has_test, "n_test"), (val_size, has_val, "n_val")):
        if given:
            continue
        s = cur.agg(F.sum("_left").alias("n"), F.min("_left").alias("least"), F.count(F.lit(1)).alias("k")).first()
        n_out = math.ceil(size * s["n"])
        _check_strata_sizes(s["least"], s["k"], s["n"] - n_out, n_out)
        share = F.col("_left") * F.lit(s["n"] - n_out) / F.lit(s["n"])
        cur = cur.withColumn("_floor", F.floor(share)).withColumn("_part", share - F.floor(share))
        need = s["n"] - n_out - cur.agg(F.sum("_floor")).first()[0]
        ranked = sorted_rank(cur, [F.col("_part").desc(), F.col("y")])
        keep = F.col("_floor") + (F.col("_rank") <= need).cast("long")
        cur = ranked.withColumn(target, F.col("_left") - keep).withColumn("_left", keep).drop("_floor", "_part", "_rank")
    return cur.select("y", "n_test", "n_val")


def _split_many(df: DataFrame, hashed: DataFrame, h: str, stratify: str, test_size: float, val_size: float, has_test: bool,
                has_val: bool, split_col: str) -> DataFrame:
    """Rows ranked by hash within their class, compared with the class's joined quota."""
    classes = store(df.groupBy(qcol(stratify).alias("y")).agg(F.count(F.lit(1)).alias("n")), "strata")
    if classes.where("y IS NULL").limit(1).count():
        raise ValueError(f"null values in stratification column {stratify!r}")
    quotas = class_quotas(classes, test_size, val_size, has_test, has_val).toDF("_q_y", "_q_test", "_q_val")
    n = classes.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()
    quotas = F.broadcast(quotas) if n["k"] <= BROADCAST_STRATA else quotas
    ranked = hash_rank(hashed, h, group_cols=[stratify], rank_col="_split_rank", n=n["n"]) \
        .join(quotas, qcol(stratify) == F.col("_q_y"))
    return ranked.withColumn(split_col, F.when(F.col("_split_rank") <= F.col("_q_test"), "test").when(
        F.col("_split_rank") <= F.col("_q_test") + F.col("_q_val"), "validation").otherwise("train")) \
        .select(*[qcol(c) for c in df.columns], split_col)


def _split_expr(h: Column, quotas: dict, cut: dict, stratify: str | None) -> Column:
    if stratify is None:
        t, v = quotas[0]
        return (F.when(h <= F.lit(cut[(0, t)]), "test")
                .when(h <= F.lit(cut[(0, t + v)]), "validation").otherwise("train"))
    y = qcol(stratify)
    t_map = F.create_map(*[x for c, (t, v) in quotas.items() for x in (F.lit(c), F.lit(cut[(c, t)]))])
    v_map = F.create_map(*[x for c, (t, v) in quotas.items() for x in (F.lit(c), F.lit(cut[(c, t + v)]))])
    return (F.when(h <= F.element_at(t_map, y), "test")
            .when(h <= F.element_at(v_map, y), "validation").otherwise("train"))


# ---------------------------------------------------------------- D4

def split_with_files(df: DataFrame, key: str, test_df: DataFrame | None = None,
                     val_df: DataFrame | None = None, seed: int = 42,
                     stratify: str | None = None, split_col: str = SPLIT) -> DataFrame:
    """Use supplied test / validation rows instead of cutting them from ``df``."""
    main = split_exact(df, key, seed, stratify, has_test=test_df is not None,
                       has_val=val_df is not None, split_col=split_col)
    out = main
    if test_df is not None:
        out = out.unionByName(test_df.withColumn(split_col, F.lit("test")), allowMissingColumns=True)
    if val_df is not None:
        out = out.unionByName(val_df.withColumn(split_col, F.lit("validation")),
                              allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- D5

DRAW = "oversample_draw"


def oversample_plan(counts: dict, ratio: float = 1.0) -> tuple:
    """(minority, majority, rows to add) for a binary label."""
    classes = [c for c in counts if c is not None]
    if len(classes) != 2 or None in counts:
        raise ValueError(f"over-sampling to a ratio needs exactly two classes, got {sorted(map(str, counts))}")
    major = max(sorted(classes), key=lambda c: counts[c])
    minor = [c for c in classes if c != major][0]
    k = int(counts[major] * ratio - counts[minor])
    if k < 0:
        raise ValueError("the ratio would remove minority rows; increase it")
    return minor, major, k


def oversample(df: DataFrame, label: str, key: str, ratio: float = 1.0, seed: int = 42,
               mode: str = "random", counts: dict | None = None) -> DataFrame:
    """Keep every row and add ``int(ratio * n_major) - n_minor`` minority copies.

    ``random``: draws with replacement; draw ``i`` takes the minority row whose
    hash rank is ``1 + floor(u(seed, i) * n_minor)`` (an equi-join on rank).
    ``even``: draw ``i`` takes rank ``1 + i % n_minor``, so every minority row
    is copied ``k // n_minor`` times and the rows with the smallest hashes once more.
    Added rows carry ``oversample_draw`` (null on original rows).  Pass
    ``counts`` (label -> rows) if already known to skip the counting scan.
    """
    require_columns(df, [label, key])
    if counts is None:
        counts = class_counts(df, label)
    minor, _, k = oversample_plan(counts, ratio)
    n_minor = counts[minor]
    base = df.withColumn(DRAW, F.lit(None).cast("bigint"))
    if k == 0:
        return base
    minority = df.where(qcol(label) == F.lit(minor))
    h = "_os_h"
    spark = df.sparkSession
    draws = spark.range(0, k, numPartitions=range_partitions(spark, k))
    if mode == "even":
        # copies come from the range, not from the few tasks that hold the minority rows
        draws = draws.select((F.floor(F.col("id") / n_minor) + 1).cast("bigint").alias(DRAW),
                             (F.col("id") % n_minor + 1).alias("_os_rank"))
    elif mode == "random":
        draws = draws.select(F.col("id").alias(DRAW),
                             (F.floor(hash_uniform(seed, F.lit("draw"), F.col("id")) * F.lit(n_minor))
                              + 1).cast("long").alias("_os_rank"))
    else:
        raise ValueError(f"unknown over-sampling mode {mode!r}")
    ranked = hash_rank(minority.withColumn(h, hash_key(seed, qcol(key))), h, rank_col="_os_rank", n=n_minor).drop(h)
    added = draws.join(ranked, "_os_rank").drop("_os_rank")
    return base.unionByName(added.select(*[qcol(c) for c in base.columns]))
