import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabprep.functions.ranks import running_totals_desc
from tabprep.operators import metrics


def _df(spark, ys, ss):
    return spark.createDataFrame(list(zip(ys, ss)), "y int, s double")


def test_auc_and_average_precision_with_ties(spark):
    r = metrics.classification_report(_df(spark, [0, 0, 1, 1, 1, 0], [.1, .4, .35, .8, .4, .2]), "y", "s").first()
    assert r["auc"] == pytest.approx(0.8333333, abs=1e-6)
    assert r["aucpr"] == pytest.approx(0.8055556, abs=1e-6)


def test_f1_tie_goes_to_lowest_threshold(spark):
    r = metrics.classification_report(
        _df(spark, [1, 0, 0, 1, 0, 0], [.9, .8, .7, .6, .2, .1]), "y", "s").first()
    assert r["threshold"] == 0.6
    assert r["f1"] == pytest.approx(2 / 3)
    assert r["confusion_matrix"] == [[2, 2], [0, 2]]


def test_one_class_gives_null_auc(spark):
    r = metrics.classification_report(_df(spark, [1, 1, 1, 1], [.1, .2, .3, .4]), "y", "s").first()
    assert r["auc"] is None and r["aucpr"] == pytest.approx(1.0)
    r0 = metrics.classification_report(_df(spark, [0, 0, 0, 0], [.1, .2, .3, .4]), "y", "s").first()
    assert r0["auc"] is None


def test_regression_report(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 4.0), (4.0, 4.0)], "y double, p double")
    r = metrics.regression_report(df, "y", "p").first()
    assert (r["mse"], r["mae"], r["rmse"]) == (0.25, 0.25, 0.5)
    assert r["R2"] == pytest.approx(0.8)
    assert r["mse_std"] == pytest.approx(0.4330127, abs=1e-6)
    assert r["rmse_std"] == r["mae_std"]


def test_regression_y_equals_mean(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    r = metrics.regression_report(df, "y", "p").first()
    assert r["R2_std"] is not None


def test_running_totals_buckets_equal_plain_window(spark, sf):
    d = spark.read.parquet(f"{sf}/orders.parquet")
    per = (d.groupBy(F.round(F.col("o_totalprice") / 1000).alias("s"))
           .agg(F.count(F.lit(1)).alias("a"), F.sum(F.lit(2)).alias("b")))
    got = running_totals_desc(per, "s", {"a": "ca", "b": "cb"}, rows_per_bucket=20)
    w = Window.orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    want = per.select("s", F.sum("a").over(w).alias("ca"), F.sum("b").over(w).alias("cb"))
    assert got.select("s", "ca", "cb").exceptAll(want).count() == 0
    assert got.count() == per.count()


def test_binary_only(spark):
    with pytest.raises(ValueError):
        metrics.classification_report(_df(spark, [0, 1, 2], [.1, .2, .3]), "y", "s")


def test_unscored_rows_are_refused(spark):
    base = _df(spark, [0, 0, 1, 1, 1, 0], [.1, .4, .35, .8, .4, .2])
    extra = spark.createDataFrame([(1, float("nan")), (0, None)], "y int, s double")
    rows = base.unionByName(extra)
    assert tuple(metrics.score_coverage(rows, "s").first()) == (8, 2)
    with pytest.raises(metrics.UnscoredRows, match="2 rows"):
        metrics.classification_report(rows, "y", "s")
    with pytest.raises(metrics.UnscoredRows, match="2 rows"):
        metrics.classification_metrics(rows, "y", "s")
    with pytest.raises(metrics.UnscoredRows, match="2 rows"):
        metrics.regression_report(rows, "y", "s")
    assert metrics.classification_metrics(base, "y", "s")["tp"] > 0
