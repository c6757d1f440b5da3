"""Second-order boosted trees against a direct re-implementation on arrays."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabprep.operators import boosting, training


def by_definition(x, y, task, p, drop=None):
    """All cuts at all distinct values, row by row sums; (predictions, trees' weights)."""
    base = 0.0 if task == "classification" else 0.5
    soft = lambda g: np.sign(g) * max(abs(g) - p.alpha, 0)
    score = lambda g, h: soft(g) ** 2 / (h + p.reg_lambda)
    leaves, weights, rng = [], [], np.random.default_rng(p.seed)
    for _ in range(p.num_round):
        dropped = np.flatnonzero(rng.random(len(leaves)) < p.rate_drop) if p.booster == "dart" else []
        margin = base + sum((w * v for i, (w, v) in enumerate(zip(weights, leaves)) if i not in set(dropped)), np.zeros(len(y)))
        if task == "classification":
            prob = 1 / (1 + np.exp(-margin))
            g, h = prob - y, prob * (1 - prob)
        else:
            g, h = margin - y, np.ones(len(y))
        value = np.zeros(len(y))

        def grow(rows, depth):
            G, H = g[rows].sum(), h[rows].sum()
            best = (1e-6, None, None)
            if depth < p.max_depth:
                for f in range(x.shape[1]):
                    for cut in np.unique(x[:, f])[1:]:
                        left = rows[x[rows, f] < cut]
                        gl, hl = g[left].sum(), h[left].sum()
                        if hl >= p.min_child_weight and H - hl >= p.min_child_weight:
                            gain = score(gl, hl) + score(G - gl, H - hl) - score(G, H)
                            if gain > best[0] + 1e-9:
                                best = (gain, f, cut)
            if best[1] is None:
                value[rows] = -p.eta * soft(G) / (H + p.reg_lambda)
                return
            right = x[rows, best[1]] >= best[2]
            grow(rows[~right], depth + 1), grow(rows[right], depth + 1)

        grow(np.arange(len(y)), 0)
        k = len(dropped)
        leaves.append(value)
        for i in dropped:
            weights[i] *= k / (k + p.eta)
        weights.append(1 / (k + p.eta) if k else 1.0)
    margin = base + sum(w * v for w, v in zip(weights, leaves))
    return (1 / (1 + np.exp(-margin)) if task == "classification" else margin), weights


def frame(spark, x, y):
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    names = [f"x{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame(rows, ["id", *names, "label"]).repartition(3)
    return VectorAssembler(inputCols=names, outputCol="features").transform(df)


def table(n=120, seed=0):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(-3, 4, n), rng.normal(size=n).round(1), (rng.random(n) < 0.3).astype(int), np.zeros(n)], 1).astype(float)
    y = x[:, 0] * x[:, 2] + np.sin(3 * x[:, 1]) + 0.3 * rng.normal(size=n)
    return x, y


@pytest.mark.parametrize("task", ["regression", "classification"])
@pytest.mark.parametrize("more", [{"alpha": 0.0}, {"alpha": 0.5, "min_child_weight": 4.0}, {"alpha": 2.0, "reg_lambda": 0.0},
                                  {"booster": "dart", "rate_drop": 0.5}])
def test_fits_equal_the_definition(spark, task, more, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)  # margins are stored in between
    x, y = table()
    y = (y > 0).astype(float) if task == "classification" else y
    p = boosting.BoostParams(**{"eta": 0.4, "max_depth": 3, "num_round": 4, "min_child_weight": 1.0, "max_bins": 200, **more})
    df = frame(spark, x, y)
    model = boosting.fit(df, task, p)
    got = [r["s"] for r in df.withColumn("s", model.predict(F.col("features"))).orderBy("id").select("s").collect()]
    want, weights = by_definition(x, y, task, p)
    np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)
    assert model.weights == pytest.approx(weights)


def test_dropout_belongs_to_its_booster(spark):
    x, y = table(80)
    df = frame(spark, x, y)
    p = {"eta": 0.5, "max_depth": 2, "num_round": 3}
    plain, given = (training.fit_model(df, "regression", {**p, "rate_drop": r}) for r in (0.0, 0.9))
    assert plain.trees == given.trees and given.weights == [1.0] * 3


def test_blocks_of_features_and_sparse_vectors(spark, monkeypatch):
    """One-hot columns as sparse vectors, their slots dealt to several groups, give the trees of dense columns."""
    rng = np.random.default_rng(2)
    level, extra = rng.integers(0, 30, 300), rng.normal(size=300).round(2)
    y = (level % 7 == 0) * 2.0 + extra
    sparse = spark.createDataFrame(
        [(i, Vectors.sparse(31, [int(k), 30], [1.0, float(e)]) if e else Vectors.sparse(31, [int(k)], [1.0]), float(v))
         for i, (k, e, v) in enumerate(zip(level, extra, y))], ["id", "features", "label"])
    dense = sparse.rdd.map(lambda r: (r["id"], Vectors.dense(r["features"].toArray()), r["label"])).toDF(["id", "features", "label"])
    p = boosting.BoostParams(eta=0.3, max_depth=4, num_round=3, max_bins=500)
    whole = boosting.fit(dense, "regression", p)
    monkeypatch.setattr(boosting, "BLOCK_SLOTS", 10)
    parts = boosting.fit(sparse, "regression", p)
    assert [t.feature for t in parts.trees] == [t.feature for t in whole.trees]
    x = np.zeros((300, 31))
    x[np.arange(300), level], x[:, 30] = 1.0, extra
    want, _ = by_definition(x, y, "regression", p)
    got = [r["s"] for r in sparse.withColumn("s", parts.predict(F.col("features"))).orderBy("id").select("s").collect()]
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_quantile_bins_on_many_values(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 1))
    y = (x[:, 0] > 0.7).astype(float)
    df = frame(spark, x, y)
    model = boosting.fit(df, "classification", boosting.BoostParams(eta=1.0, max_depth=1, num_round=1, max_bins=32))
    assert len(boosting.find_bins(df, "features", 32).cuts[0]) <= 33
    assert abs(model.trees[0].cut[0] - 0.7) < 0.1


def test_alpha_matters_in_a_trial_table(spark):
    x, y = table(200, 5)
    df = frame(spark, x, (y > 0).astype(float))
    alphas = iter([0.0, 40.0])
    fixed = lambda p: {**p, "eta": 0.3, "max_depth": 2, "num_round": 3, "min_child_weight": 1.0, "alpha": next(alphas)}
    trials = training.tune(df, df, "classification", "auc", True, n_trials=2, parallelism=1, adjust=fixed).trials.orderBy("trial").collect()
    assert [t["alpha"] for t in trials] == [0.0, 40.0] and trials[0]["value"] > 0.8 > trials[1]["value"]


def test_model_survives_saving(spark, tmp_path):
    x, y = table(60)
    df = frame(spark, x, y)
    model = training.fit_model(df, "regression", {"eta": 0.3, "max_depth": 2, "num_round": 3, "alpha": 0.1})
    model.write().overwrite().save(str(tmp_path / "m"))
    again = training.load_model(str(tmp_path / "m"), "regression")
    assert again == model
    with pytest.raises(ValueError, match="empty"):
        training.fit_model(df.limit(0), "regression", {"eta": 0.3, "max_depth": 2, "num_round": 1})
