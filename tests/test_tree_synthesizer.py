"""Columns drawn in turn from the leaves of trees over the columns before them."""

import pytest
from pyspark.sql import functions as F

from tabprep.operators.association import compare_associations
from tabprep.operators.synthesizer import CopulaSynthesizer, TreeSynthesizer, augment_training


def _ring(spark, n=4000):
    """k tells whether |x| < 1: no rank correlation shows it; z is a sum with a threshold; s is sometimes missing."""
    x = (F.col("id") * 37 % n) / F.lit(n / 4.0) - 2.0
    return spark.range(n).select(
        (F.col("id") % 3).cast("int").alias("y"), x.alias("x"), F.when(F.abs(x) < 1, "in").otherwise("out").alias("k"),
        F.when(x > 0.5, 10).otherwise(F.when(F.col("id") % 3 == 2, 5)).alias("z"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.date_add(F.lit("2020-01-01"), (F.col("id") % 4).cast("int"))).alias("s"))


def test_rules_are_kept_that_the_copula_misses(spark):
    df = _ring(spark).cache()
    fitted = TreeSynthesizer("y", seed=3, min_rows=5).fit(df)
    got = fitted.generate(spark, 3000).cache()
    assert got.count() == 3000 and got.select("synth_id").distinct().count() == 3000
    assert {c: t for c, t in got.dtypes if c != "synth_id"} == dict(df.dtypes)
    agree = lambda g: g.where((F.abs("x") < 1) == (F.col("k") == "in")).count() / g.count()
    assert agree(got) > 0.98
    assert agree(CopulaSynthesizer("y", seed=3).fit(df.drop("s")).generate(spark, 3000)) < 0.7
    # z follows x and the class; both its values and its absence
    wrong = got.where(~F.col("z").eqNullSafe(F.when(F.col("x") > 0.5, 10).otherwise(F.when(F.col("y") == 2, 5))))
    assert wrong.count() < 60
    assert got.join(df.select("s").distinct(), got["s"].eqNullSafe(df["s"]), "left_anti").count() == 0
    assert 0.15 < got.where("s is null").count() / 3000 < 0.25
    assert {r["y"]: r["count"] > 850 for r in got.groupBy("y").count().collect()} == {0: True, 1: True, 2: True}
    worst = compare_associations(df, got, ["x", "k", "z"]).agg(F.max("difference")).first()[0]
    assert worst < 0.1
    got.unpersist(), df.unpersist()


def test_rows_depend_on_their_id_only(spark):
    fitted = TreeSynthesizer("y", seed=3).fit(_ring(spark, 600))
    few = {tuple(r) for r in fitted.generate(spark, 100).collect()}
    assert few <= {tuple(r) for r in fitted.generate(spark, 400).collect()}


def test_odd_tables(spark):
    rows = [(0, 1.0, None, "a", True), (0, float("nan"), None, None, False), (1, None, None, "b c", None), (1, 1.0, None, "a", True)]
    df = spark.createDataFrame(rows, "`the label` int, `a.b` double, nothing string, `t``x` string, flag boolean")
    got = TreeSynthesizer("the label", min_rows=1).fit(df).generate(spark, 200)
    assert got.columns == ["synth_id", "a.b", "nothing", "t`x", "flag", "the label"]
    out = got.collect()
    assert len(out) == 200 and {r["nothing"] for r in out} == {None}
    assert {r["t`x"] for r in out} <= {"a", None, "b c"} and {r["flag"] for r in out} <= {True, False, None}
    assert TreeSynthesizer("the label").fit(df.select("`the label`")).generate(spark, 5).columns == ["synth_id", "the label"]
    one = spark.createDataFrame([(7, "same", 2.5)] * 3, "y int, t string, x double")
    assert {tuple(r)[1:] for r in TreeSynthesizer("y").fit(one).generate(spark, 9).collect()} == {("same", 2.5, 7)}
    with pytest.raises(ValueError):
        TreeSynthesizer("y").fit(one.limit(0))
    with pytest.raises(ValueError):
        TreeSynthesizer("t").fit(spark.createDataFrame([(None, 1.0)], "t string, x double"))


def test_many_levels_stay_a_table(spark):
    """A text column of a level a row: all of its levels are drawn, at most max_levels are features."""
    df = spark.range(3000).select((F.col("id") % 2).alias("y"), F.concat(F.lit("t"), "id").alias("t"), (F.col("id") % 2 * 10.0).alias("x"))
    fitted = TreeSynthesizer("y", max_levels=5).fit(df)
    assert all(len(e.levels) <= 5 for e in fitted.codes)
    got = fitted.generate(spark, 3000)
    assert got.select("t").distinct().count() > 1500 and got.where(F.col("x") != F.col("y") * 10).count() == 0


def test_augment_with_trees(spark):
    df = _ring(spark, 900).withColumn("key", F.col("x") * 1000)
    out = augment_training(spark, df.where("y < 2"), "y", "key", "augment", 0.5, synthesizer="trees")
    assert {r["origin"]: r["count"] for r in out.groupBy("origin").count().collect()} == {"real": 600, "synthetic": 300}


def test_rows_alike_are_one_point_of_the_same_tree(spark, monkeypatch):
    import numpy as np

    from tabprep.operators import tree_synthesizer as ts

    rng = np.random.default_rng(4)
    rows = [("ab"[i % 2], int(q), "low" if q < 5 else "high", float(q * 3 + i % 2)) for i, q in enumerate(rng.integers(0, 12, 900))]
    df = spark.createDataFrame(rows, "y string, q int, band string, x double")
    seen, fit = [], ts.TreeSynthesizer._tree
    monkeypatch.setattr(ts.TreeSynthesizer, "_tree", lambda self, number, n, weighted: seen.append(weighted) or fit(self, number, n, weighted))
    own = ts.TreeSynthesizer("y", max_depth=4).fit(df)
    assert seen == [True] * 3
    for table in own.tables:
        totals = [r[0] for r in table.groupBy("leaf").agg({"total": "max"}).select("max(total)").collect()]
        assert min(totals) >= 20 and sum(totals) == 900
    few = ts.TreeSynthesizer("y").fit(df.limit(30))
    assert all(m.depth == 0 for m in few.models)
