"""Property tests: quotas and plans (pure Python, hypothesis), metrics
against a brute-force re-implementation of their definitions, and result
independence from input partitioning."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabprep.operators import metrics, sampling
from tabprep.operators.synthesizer import IndependentSynthesizer


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(0, 9), st.integers(2, 500), min_size=2, max_size=6))
def test_split_quotas_properties(counts):
    n = sum(counts.values())
    try:
        q = sampling.split_quotas(counts)
    except ValueError:
        return  # too few rows per class for a stratified split
    n_test = math.ceil(0.2 * n)
    assert sum(t for t, _ in q.values()) == n_test
    assert sum(v for _, v in q.values()) == math.ceil(0.25 * (n - n_test))
    for y, (t, v) in q.items():
        assert 0 <= t and 0 <= v and t + v <= counts[y]
        # each class's test share is within one row of proportional
        assert abs(t - counts[y] * n_test / n) <= 1 + 1e-9


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 1000), st.integers(1, 1000), st.floats(0.05, 1.0))
def test_oversample_plan(a, b, ratio):
    counts = {0: a, 1: b}
    try:
        minor, major, k = sampling.oversample_plan(counts, ratio)
    except ValueError:
        assert int(max(a, b) * ratio - min(a, b)) < 0
        return
    assert k == int(counts[major] * ratio - counts[minor]) >= 0


def _brute(y, s):
    """The metric definitions written out directly over sorted thresholds."""
    y, s = np.asarray(y), np.asarray(s, dtype=float)
    P, N = y.sum(), (1 - y).sum()
    ts = np.unique(s)[::-1]
    tp = np.array([y[s >= t].sum() for t in ts])
    fp = np.array([(1 - y)[s >= t].sum() for t in ts])
    prec = tp / (tp + fp)
    rec = tp / P
    ap = np.sum(np.diff(np.concatenate([[0], rec])) * prec)
    fpr, tpr = np.concatenate([[0], fp / N]), np.concatenate([[0], tp / P])
    auc = np.sum(np.diff(fpr) * (tpr[1:] + tpr[:-1]) / 2)
    keep = ~((prec == 0) & (rec == 0))
    f1 = np.where(keep, 2 * (prec * rec) / np.where(prec + rec > 0, prec + rec, 1), -1)
    best = max(range(len(ts)), key=lambda i: (f1[i], -ts[i]))
    return auc, ap, f1[best], ts[best]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 9)), min_size=4, max_size=40))
def test_classification_report_matches_brute_force(spark, pairs):
    y = [a for a, _ in pairs]
    if len(set(y)) < 2:
        return
    s = [b / 10 for _, b in pairs]   # few distinct scores: many ties
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    r = metrics.classification_report(df, "y", "s").first()
    auc, ap, f1, t = _brute(y, s)
    assert r["auc"] == pytest.approx(auc, abs=1e-12)
    assert r["aucpr"] == pytest.approx(ap, abs=1e-12)
    assert r["f1"] == pytest.approx(f1, abs=1e-12) and r["threshold"] == t


def test_oversample_and_synth_independent_of_partitioning(spark, sf):
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic")
    a = sampling.oversample(lab.repartition(3), "quality", "doc_id")
    b = sampling.oversample(lab.repartition(11), "quality", "doc_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_acctbal", "c_mktsegment")
    g1 = IndependentSynthesizer("c_mktsegment", ["c_custkey"]).fit(c.repartition(2)).generate(spark, 700)
    g2 = IndependentSynthesizer("c_mktsegment", ["c_custkey"]).fit(c.repartition(9)).generate(spark, 700)
    assert g1.exceptAll(g2).count() == 0


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), min_size=2, max_size=30))
def test_regression_report_matches_numpy(spark, pairs):
    y = np.array([a for a, _ in pairs], dtype=float)
    p = np.array([b for _, b in pairs], dtype=float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    r = metrics.regression_report(df, "y", "p").first()
    e = y - p
    assert r["mse"] == pytest.approx(np.mean(e ** 2), abs=1e-12)
    assert r["mae"] == pytest.approx(np.mean(np.abs(e)), abs=1e-12)
    assert r["mse_std"] == pytest.approx(np.std(e ** 2), abs=1e-9)
    assert r["rmse_std"] == pytest.approx(np.std(np.abs(e)), abs=1e-9)
    sst, sse = np.sum((y - y.mean()) ** 2), np.sum(e ** 2)
    r2 = (1 - sse / sst) if sst != 0 else (1.0 if sse == 0 else 0.0)
    assert r["R2"] == pytest.approx(r2, abs=1e-12)
    d2 = (y - y.mean()) ** 2
    ok = d2 != 0
    want_std = np.std(1 - (e[ok] ** 2) / d2[ok]) if ok.any() else None
    if want_std is None:
        assert r["R2_std"] is None
    else:
        assert r["R2_std"] == pytest.approx(want_std, rel=1e-9, abs=1e-9)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=25),
       st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), min_size=1, max_size=25))
def test_preprocessor_matches_direct_definition(spark, xs, ks):
    from tabprep.operators.features import TabularPreprocessor
    n = min(len(xs), len(ks))
    rows = [(i, None if xs[i] is None else float(xs[i]), ks[i]) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, x double, k string")
    fitted = TabularPreprocessor(["x", "k"]).fit(df)
    got = {r["id"]: r for r in fitted.transform(df, keep=["id"]).collect()}
    vals = np.array([r[1] for r in rows if r[1] is not None])
    if len(vals) == 0:
        assert "x" in fitted.dropped
        return
    med = float(np.median(vals))
    filled = np.array([med if r[1] is None else r[1] for r in rows])
    mu, sd = filled.mean(), filled.std()
    sd = sd if sd > 10 * np.finfo(float).eps else 1.0
    levels = sorted({r[2] if r[2] is not None else "missing" for r in rows})
    assert [lv for _, lvs in fitted.categorical for lv in lvs] == levels
    for i, r in enumerate(rows):
        assert got[r[0]]["num__x"] == pytest.approx((filled[i] - mu) / sd, abs=1e-9)
        k = r[2] if r[2] is not None else "missing"
        for lv in levels:
            assert got[r[0]][f"cat__k_{lv}"] == (1.0 if lv == k else 0.0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=300), st.integers(5, 60))
def test_exact_median_with_ties_and_narrowing(spark, xs, limit):
    from tabprep.operators.stats import exact_medians
    df = spark.createDataFrame([(None if v is None else float(v),) for v in xs], "x double")
    got = exact_medians(df, ["x"], accuracy=1000, collect_limit=limit)["x"]
    vals = [v for v in xs if v is not None]
    assert got == (float(np.median(vals)) if vals else None)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 400)), min_size=50, max_size=400))
def test_exact_median_narrowing_many_values(spark, xs):
    from tabprep.operators.stats import exact_medians
    df = spark.createDataFrame([(None if v is None else float(v),) for v in xs], "x double")
    got = exact_medians(df, ["x"], accuracy=5000, collect_limit=10)["x"]
    vals = [v for v in xs if v is not None]
    assert got == (float(np.median(vals)) if vals else None)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=12, max_size=200), st.integers(0, 10**6))
def test_stratified_split_matches_brute_force(spark, ys, seed):
    import hashlib
    rows = [(i * 7919 + 3, y) for i, y in enumerate(ys)]
    counts = {}
    for _, y in rows:
        counts[y] = counts.get(y, 0) + 1
    try:
        quotas = sampling.split_quotas(counts)
    except ValueError:
        return
    df = spark.createDataFrame(rows, "key long, y int")
    got = {r["key"]: r["split"] for r in sampling.split_exact(df, "key", seed, "y").collect()}
    for y in counts:
        keys = sorted((k for k, yy in rows if yy == y),
                      key=lambda k: hashlib.md5(f"{seed}|{k}".encode()).hexdigest())
        t, v = quotas[y]
        for pos, k in enumerate(keys):
            want = "test" if pos < t else "validation" if pos < t + v else "train"
            assert got[k] == want


@settings(max_examples=6, deadline=None)
@given(st.integers(2, 40), st.integers(41, 120), st.integers(0, 10**6))
def test_random_oversample_matches_brute_force(spark, n_min, n_maj, seed):
    import hashlib
    rows = [(k, 1) for k in range(n_min)] + [(1000 + k, 0) for k in range(n_maj)]
    df = spark.createDataFrame(rows, "key long, y int")
    out = sampling.oversample(df, "y", "key", 1.0, seed, mode="random")
    got = sorted((r["oversample_draw"], r["key"]) for r in out.where("oversample_draw is not null").collect())
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    ranked = sorted(range(n_min), key=lambda k: md5(f"{seed}|{k}"))
    want = []
    for i in range(n_maj - n_min):
        u = int(md5(f"{seed}|draw|{i}")[:13], 16) / 2 ** 52
        want.append((i, ranked[math.floor(u * n_min)]))
    assert got == want


def test_hot_value_skew(spark):
    """A third of the rows share one class, one score and one numeric value."""
    from tabprep.operators.stats import exact_medians
    n = 3000
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        y = 1 if hot else (i % 7 == 0) * 1
        s = 0.5 if hot else ((i * 37) % 101) / 101
        x = 42.0 if hot else float((i * 13) % 997)
        rows.append((i, y, s, x))
    df = spark.createDataFrame(rows, "key long, y int, s double, x double")
    ys, ss = [r[1] for r in rows], [r[2] for r in rows]
    r = metrics.classification_report(df, "y", "s").first()
    auc, ap, f1, t = _brute(ys, ss)
    assert r["auc"] == pytest.approx(auc, abs=1e-12) and r["aucpr"] == pytest.approx(ap, abs=1e-12)
    assert exact_medians(df, ["x"], accuracy=1000, collect_limit=50)["x"] == float(np.median([r[3] for r in rows]))
    counts = {0: ys.count(0), 1: ys.count(1)}
    q = sampling.split_quotas(counts)
    got = {(g["y"], g["split"]): g["count"] for g in
           sampling.split_exact(df, "key", stratify="y").groupBy("y", "split").count().collect()}
    for y, (tq, vq) in q.items():
        assert got[(y, "test")] == tq and got[(y, "validation")] == vq
    over = sampling.oversample(df, "y", "key")
    minor = min(counts, key=counts.get)
    assert over.where("oversample_draw is not null").count() == max(counts.values()) - counts[minor]
