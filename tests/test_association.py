import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabprep.operators import metrics
from tabprep.operators.association import (Components, association_similarity, associations, compare_associations,
                                           compare_components)


def _v(a, b):
    both = a.notna() & b.notna()
    k = pd.crosstab(a[both], b[both]).to_numpy(float)
    expected = np.outer(k.sum(1), k.sum(0)) / k.sum()
    return np.sqrt(((k - expected) ** 2 / expected).sum() / k.sum() / (min(k.shape) - 1))


def _eta(a, x):
    both = a.notna() & x.notna()
    a, x = a[both], x[both]
    own = x.groupby(a).transform("mean")
    return np.sqrt(((own - x.mean()) ** 2).sum() / ((x - x.mean()) ** 2).sum())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    n = 3000
    a = rng.choice(["x", "y", "hot"], n, p=[0.1, 0.2, 0.7])  # one level holds most rows
    x = rng.standard_normal(n) + (a == "x") * 2 + 1e6
    b = np.where(rng.random(n) < 0.6, a, rng.choice(["p", "q"], n))
    pdf = pd.DataFrame({"a": a, "b.c": b, "one": "same", "x": x, "y": x * 2 + rng.standard_normal(n), "flat": 3.0})
    pdf.loc[rng.random(n) < 0.1, "a"] = None
    pdf.loc[rng.random(n) < 0.1, "x"] = np.nan
    return pdf


def test_associations_against_pandas(spark, rows):
    df = spark.createDataFrame(rows).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    found = {(r["column_a"], r["column_b"]): r["value"] for r in associations(df, list(rows.columns)).collect()}
    assert len(found) == 15
    assert found["a", "b.c"] == pytest.approx(_v(rows["a"], rows["b.c"]))
    assert found["a", "x"] == pytest.approx(_eta(rows["a"], rows["x"]))
    assert found["b.c", "y"] == pytest.approx(_eta(rows["b.c"], rows["y"]))
    assert found["x", "y"] == pytest.approx(rows["x"].corr(rows["y"]))
    # one level, no spread: undefined, or nothing to explain
    assert found["a", "one"] is None and found["a", "flat"] is None and found["x", "flat"] is None
    assert found["one", "x"] == pytest.approx(0)


def test_no_rows_and_few_columns(spark, rows):
    df = spark.createDataFrame(rows).select("a", F.col("`b.c`").alias("b"), "x")
    none = associations(df.limit(0), ["a", "b", "x"]).collect()
    assert len(none) == 3 and all(r["value"] is None for r in none)
    assert associations(df, ["x"]).count() == 0
    assert association_similarity(df, df, ["x"]).first()[0] is None
    assert compare_components(df, df, ["a"]).count() == 0


def test_dependence_that_is_lost_shows(spark, rows):
    real = spark.createDataFrame(rows.dropna()[["a", "b.c", "x", "y"]].rename(columns={"b.c": "b"}))
    shuffled = spark.createDataFrame(rows.dropna()[["a", "b.c", "x", "y"]].rename(columns={"b.c": "b"})
                                     .apply(lambda s: s.sample(frac=1, random_state=len(s.name) + ord(s.name[0])).to_numpy()))
    same = association_similarity(real, real, ["a", "b", "x", "y"]).first()[0]
    lost = association_similarity(real, shuffled, ["a", "b", "x", "y"]).first()[0]
    assert same == pytest.approx(100) and lost < 80
    apart = {(r["column_a"], r["column_b"]): r["difference"]
             for r in compare_associations(real, shuffled, ["a", "b", "x", "y"]).collect()}
    assert apart["a", "b"] > 0.3
    of = {r["component"]: r["js_distance"] for r in compare_components(real, shuffled, ["x", "y"]).collect()}
    assert of["component_2"] > 0.3  # the line of x and y is gone
    assert max(r["js_distance"] for r in compare_components(real, real, ["x", "y"]).collect()) == pytest.approx(0)


def test_components_against_numpy(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((2000, 4)) @ rng.standard_normal((4, 4))
    df = spark.createDataFrame(pd.DataFrame(v, columns=list("abcd")))
    own = Components(df, list("abcd"), k=3)
    z = (v - v.mean(0)) / v.std(0)
    values, axes = np.linalg.eigh(np.corrcoef(v.T))
    assert own.shares == pytest.approx(list(values[::-1][:3] / 4))
    got = own.project(df).toPandas().to_numpy()
    for i in range(3):
        expected = z @ axes[:, ::-1][:, i]
        assert abs(np.corrcoef(np.sort(np.abs(got[:, i])), np.sort(np.abs(expected)))[0, 1]) == pytest.approx(1)
        assert got[:, i].var() == pytest.approx(values[::-1][i])


@pytest.mark.parametrize("parts", [1, 7])
def test_reports_equal_single_reports(spark, parts):
    rng = np.random.default_rng(parts)
    y = rng.integers(0, 2, 500)
    pdf = pd.DataFrame({"y": y, "ties": np.round(rng.random(500) + y, 1), "fine": rng.random(500) + y / 2, "s.0": 1.0})
    df = spark.createDataFrame(pdf).repartition(parts)
    for r in metrics.classification_reports(df, "y", ["ties", "fine", "s.0"]).collect():
        one = metrics.classification_report(df, "y", r["score_column"]).first().asDict()
        for name, value in one.items():
            assert r[name] == (pytest.approx(value) if not isinstance(value, list) else value), (r["score_column"], name)


def test_reports_of_one_class_no_rows_and_missing_scores(spark):
    df = spark.createDataFrame([(1, 0.2, 0.1), (1, 0.4, None)], "y int, a double, b double")
    r = metrics.classification_reports(df, "y", ["a"]).first()
    assert r["auc"] is None and r["aucpr"] == 1.0 and r["tp"] == 2
    assert metrics.classification_reports(df.limit(0), "y", ["a", "b"]).count() == 0
    with pytest.raises(metrics.UnscoredRows):
        metrics.classification_reports(df, "y", ["a", "b"])


def test_few_levels_against_many_bring_few_cells_together(spark, tmp_path):
    """Cells of a pair meet by the side with more levels, in either order of the columns."""
    from tabprep.operators import association

    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"few": rng.choice(["x", "y"], 4000, p=[0.9, 0.1]), "many": rng.integers(0, 900, 4000).astype(str)})
    df = spark.createDataFrame(pdf)
    for order in (["few", "many"], ["many", "few"]):
        found = associations(df, order).first()
        assert found["value"] == pytest.approx(_v(pdf["few"], pdf["many"]))
        plan = association._cramers_v(association.contingency(df, order, []))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Window") >= 1 and "few" in plan
        joins = [x for x in plan.splitlines() if "Join" in x]
        assert all("rightHint=(strategy=broadcast)" in x for x in joins)  # no level's cells are shuffled to one task
