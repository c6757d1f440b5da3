"""Boosted-tree training, scoring and hyper-parameter search.

Each trial is a distributed fit, by default of second-order boosted trees
(``boosting``), or of Spark ML's (``engine="mllib"``); trials run concurrently
from a small driver thread pool (``parallelism``), which is how several
Spark jobs share one cluster.  The trial table is a DataFrame, so picking
the winner is the same top-1 operator as everywhere else.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.operators import boosting, metrics, proposals
from tabprep.operators.publish import best_trial

CLASSIFICATION_METRICS = ("auc", "aucpr", "precision", "recall", "f1")
REGRESSION_METRICS = ("mse", "mae", "rmse", "R2")


@dataclass
class SearchSpace:
    """Ranges of the searched parameters (the defaults are fixed values: the
    ranges that the job specs were written for).

    ``alpha`` is the L1 term of the leaves and ``min_child_weight`` the least
    hessian of a child; Spark ML's trees have no ``alpha`` and take the latter as a
    number of rows.
    """
    eta: tuple = (0.0, 1.0)
    min_child_weight: tuple = (1.0, 10.0)
    alpha: tuple = (0.0, 2.0)
    max_depth: tuple = (1, 10)
    num_round: tuple = (100, 500)

    def sample(self, n_trials: int, seed: int = 42, adjust=None) -> list[dict]:
        rng = np.random.default_rng(seed)
        out = []
        for _ in range(n_trials):
            p = {
                "eta": float(rng.uniform(*self.eta)),
                "min_child_weight": float(rng.uniform(*self.min_child_weight)),
                "alpha": float(rng.uniform(*self.alpha)),
                "max_depth": int(rng.integers(self.max_depth[0], self.max_depth[1] + 1)),
                "num_round": int(rng.integers(self.num_round[0], self.num_round[1] + 1)),
            }
            out.append(adjust(p) if adjust else p)
        return out


def spark_params(p: dict, seed: int = 42) -> dict:
    return {
        "stepSize": min(1.0, max(float(p["eta"]), 1e-3)),   # Spark requires (0, 1]
        "maxDepth": int(p["max_depth"]),
        "maxIter": int(p["num_round"]),
        "minInstancesPerNode": max(1, int(round(p["min_child_weight"]))),
        "seed": seed,
    }


def fit_model(train: DataFrame, task: str, params: dict, features_col: str = "features",
              label_col: str = "label", seed: int = 42, engine: str = "second_order"):
    """A fitted model.  ``params`` are those of ``SearchSpace``; ``booster``, ``rate_drop``,
    ``reg_lambda``, ``base_score`` and ``max_bins`` may be added for second-order trees."""
    if engine == "second_order":
        p = boosting.BoostParams(**{"seed": seed, **{k: v for k, v in params.items() if v is not None}})
        p.eta, p.max_depth, p.num_round = float(p.eta), int(p.max_depth), int(p.num_round)
        return boosting.fit(train, task, p, features_col, label_col)
    if engine != "mllib":
        raise ValueError(f"unknown engine {engine!r}")
    kw = spark_params(params, seed)
    if task == "classification":
        est = GBTClassifier(featuresCol=features_col, labelCol=label_col, **kw)
    else:
        est = GBTRegressor(featuresCol=features_col, labelCol=label_col, lossType="squared", **kw)
    return est.fit(train.withColumn(label_col, qcol(label_col).cast("double")))


def load_model(path: str, task: str, engine: str = "second_order"):
    if engine == "second_order":
        return boosting.BoostedTrees.load(SparkSession.getActiveSession(), path)
    return (GBTClassificationModel if task == "classification" else GBTRegressionModel).load(path)


def score(model, df: DataFrame, task: str, out: str = "score", hard_labels: bool = False,
          features_col: str = "features") -> DataFrame:
    """Probability of class 1 (classification) or the prediction (regression)."""
    if isinstance(model, boosting.BoostedTrees):
        s = model.predict(F.col(features_col))
        return df.withColumn(out, (s >= 0.5).cast("double") if hard_labels and task == "classification" else s)
    scored = model.transform(df)
    if task == "classification" and not hard_labels:
        s = vector_to_array(F.col(model.getProbabilityCol()))[1]
    else:
        s = F.col(model.getPredictionCol())
    return scored.withColumn(out, s.cast("double"))


def evaluate(scored: DataFrame, task: str, metric, label_col: str = "label",
             score_col: str = "score") -> float:
    """Metric of a scored DataFrame.  ``metric`` is a report key, or any
    callable ``metric(scored_df) -> float`` (a custom metric that runs its
    own Spark aggregate)."""
    if callable(metric):
        v = metric(scored)
    elif task == "classification":
        if metric not in CLASSIFICATION_METRICS:
            raise ValueError(f"unknown classification metric {metric!r}")
        v = metrics.classification_metrics(scored, label_col, score_col)[metric]
    else:
        if metric not in REGRESSION_METRICS:
            raise ValueError(f"unknown regression metric {metric!r}")
        v = metrics.regression_report(scored, label_col, score_col).select(metric).first()[0]
    return float("nan") if v is None else float(v)


def _is_cached(df: DataFrame) -> bool:
    lvl = df.storageLevel
    return bool(lvl.useMemory or lvl.useDisk)


@dataclass
class TuningResult:
    trials: DataFrame
    best_params: dict
    best_value: float


def tune(train: DataFrame, valid: DataFrame, task: str, metric, maximize: bool,
         space: SearchSpace | None = None, n_trials: int = 6, parallelism: int = 2,
         seed: int = 42, adjust=None, features_col: str = "features", label_col: str = "label",
         hard_labels: bool = False, cache_inputs: bool = True, informed: bool = True) -> TuningResult:
    """Seeded search: fit each trial on ``train``, score ``valid``.

    The first ``STARTUP`` trials are random draws of the space; later ones are
    proposed from finished trials (``proposals``), or drawn too if not ``informed``.
    Each of the ``parallelism`` workers has its own pool of the FAIR scheduler.

    With ``cache_inputs`` the inputs are cached for the trials unless they
    already are; pass False when the caller manages their caching."""
    spark = train.sparkSession
    space = space or SearchSpace()
    drawn = space.sample(min(n_trials, proposals.STARTUP) if informed else n_trials, seed, adjust)
    names = ("eta", "min_child_weight", "alpha", "max_depth", "num_round")
    # cache the inputs for the trials unless the caller already did (then the
    # caller also owns the unpersist)
    own = [d for d in (train, valid) if cache_inputs and not _is_cached(d)]
    for d in own:
        d.persist(StorageLevel.MEMORY_AND_DISK)

    def objective(i, p):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{i % max(1, parallelism)}")
        model = fit_model(train, task, p, features_col, label_col, seed)
        return evaluate(score(model, valid, task, hard_labels=hard_labels), task, metric, label_col)

    try:
        found = proposals.search(objective, {k: getattr(space, k) for k in names}, n_trials, maximize, parallelism, seed,
                                 drawn, adjust)
        rows = [(i, *[p[k] for k in names], value) for i, (p, value) in enumerate(found)]
    finally:
        for d in own:
            d.unpersist()
    table = spark.createDataFrame(
        [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows],
        "trial int, eta double, min_child_weight double, alpha double, max_depth int, "
        "num_round int, value double")
    best = best_trial(table, "value", maximize).first()
    if best is None:
        raise ValueError("no trial produced a metric value")
    best_params = {k: best[k] for k in names}
    return TuningResult(table, best_params, float(best["value"]))


def utility_score(synthetic: DataFrame, valid: DataFrame, fitted, label: str, task: str, metric: str,
                  maximize: bool, space: SearchSpace | None = None, n_trials: int = 6,
                  parallelism: int = 2, seed: int = 42) -> float:
    """Downstream quality of synthetic rows: tune on them, score real validation rows."""
    tr = fitted.transform(synthetic.withColumnRenamed(label, "label"), keep=["label"], assemble=True)
    va = fitted.transform(valid.withColumnRenamed(label, "label"), keep=["label"], assemble=True)
    return tune(tr, va, task, metric, maximize, space, n_trials, parallelism, seed).best_value


#: Searched settings of each synthesizer.
GENERATOR_SETTINGS = {"independent": (), "copula": ("grid_size", "correlated"), "trees": ("max_depth", "min_rows", "max_bins")}


@dataclass
class GeneratorSearch:
    trials: DataFrame
    best: dict
    fitted: object   # the winner, ready to generate
    source: object   # the GenerationSource it was fitted on


def tune_generator(spark, source, valid: DataFrame, fitted, label: str, task: str, metric, maximize: bool,
                   n_trials: int = 16, parallelism: int = 4, inner_trials: int = 6, seed: int = 42,
                   inner_space: SearchSpace | None = None, adjust=None) -> GeneratorSearch:
    """Random search over synthesizer settings, each scored by ``utility_score``
    of as many synthetic rows as ``source`` (a ``GenerationSource``) has.

    Works on the over-sampled source of ``balance`` and on continuous labels.
    Trials run as concurrent Spark jobs; the trial table has one row each.
    """
    rng = np.random.default_rng(seed)
    configs = []
    for _ in range(n_trials):
        cfg = {"mode": str(rng.choice(["independent", "copula", "trees"])),
               "grid_size": int(rng.choice([21, 51, 101])),
               "correlated": bool(rng.integers(0, 2)),
               "max_depth": int(rng.integers(3, 11)),
               "min_rows": int(np.exp(rng.uniform(np.log(5), np.log(200)))),
               "max_bins": int(rng.choice([32, 64, 128]))}
        configs.append(adjust(cfg) if adjust else cfg)

    def fit(i: int):
        cfg = configs[i]
        opts = {k: cfg[k] for k in GENERATOR_SETTINGS[cfg["mode"]]}
        return source.fit(cfg["mode"], seed + i, **opts)

    def run(i: int):
        generated = source.generate(fit(i), spark, source.n_rows)
        value = utility_score(generated, valid, fitted, label, task, metric, maximize, inner_space,
                              inner_trials, 1, seed)
        cfg = configs[i]
        own = {k: cfg[k] for k in GENERATOR_SETTINGS[cfg["mode"]]}  # null: a setting that the mode does not have
        return (i, cfg["mode"], *[own.get(k) for k in ("grid_size", "correlated", "max_depth", "min_rows", "max_bins")],
                None if math.isnan(value) else value)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(run, range(n_trials)))
    trials = spark.createDataFrame(rows, "trial int, mode string, grid_size int, correlated boolean, max_depth int, "
                                         "min_rows int, max_bins int, value double")
    best = best_trial(trials, "value", maximize).first()
    if best is None:
        raise ValueError("no generator trial produced a metric value")
    return GeneratorSearch(trials, configs[best["trial"]], fit(best["trial"]), source)


def generator_search(spark, train: DataFrame, valid: DataFrame, fitted, label: str, key: str,
                     task: str, metric: str, maximize: bool, n_trials: int = 16,
                     parallelism: int = 4, seed: int = 42, inner_space: SearchSpace | None = None,
                     inner_trials: int = 6, adjust=None, strategy: str = "augment",
                     target_balance: float = 1.0) -> DataFrame:
    """Trial table (trial, mode, the modes' settings, value) of ``tune_generator``."""
    from tabprep.operators.synthesizer import generation_source
    source = generation_source(train, label, key, strategy, target_balance, seed, task == "classification")
    return tune_generator(spark, source, valid, fitted, label, task, metric, maximize, n_trials, parallelism,
                          inner_trials, seed, inner_space, adjust).trials


def params_table(spark, params: dict) -> DataFrame:
    """Best parameters as a one-row DataFrame (saved next to the model)."""
    return spark.createDataFrame([tuple(params.values())], list(params.keys()))


__all__ = ["SearchSpace", "fit_model", "score", "evaluate", "tune", "utility_score",
           "generator_search", "tune_generator", "GeneratorSearch", "load_model", "params_table"]
