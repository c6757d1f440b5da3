import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabprep.operators.correlation import correlations, pairwise_moments
from tabprep.operators.synth import union_real_synthetic
from tabprep.operators.synthesizer import (CopulaSynthesizer, IndependentSynthesizer, augment_training,
                                           pair_correlations, quality_by_column, quality_summary)


def test_union_missing_column(spark):
    real = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    synth = spark.createDataFrame([(3,), (4,)], "a int")
    out = union_real_synthetic(real, synth).orderBy("a").collect()
    assert [(r["a"], r["b"]) for r in out] == [(1, "x"), (2, "y"), (3, None), (4, None)]


def test_independent_keeps_class_sizes_and_values(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_nationkey", "c_mktsegment")
    fitted = IndependentSynthesizer("c_mktsegment", ["c_custkey"], columns=["c_nationkey"]).fit(c)
    gen = fitted.generate(spark, 3000)
    assert gen.count() == 3000
    # every generated value exists in its class
    pairs = c.select("c_mktsegment", "c_nationkey").distinct()
    assert gen.join(pairs, ["c_mktsegment", "c_nationkey"], "left_anti").count() == 0
    shares = {r["c_mktsegment"]: r["count"] for r in gen.groupBy("c_mktsegment").count().collect()}
    assert len(shares) == 5 and min(shares.values()) > 450


def test_copula_keeps_correlation(spark):
    base = spark.range(4000).select(
        (F.col("id") % 2).cast("int").alias("y"),
        F.randn(1).alias("a"))
    df = base.withColumn("b", F.col("a") * 2 + F.randn(2) * 0.3) \
        .withColumn("k", F.when(F.col("a") > 0, "hi").otherwise("lo"))
    fitted = CopulaSynthesizer("y", seed=5).fit(df)
    gen = fitted.generate(spark, 4000)
    real_corr = df.stat.corr("a", "b")
    gen_corr = gen.stat.corr("a", "b")
    assert abs(real_corr - gen_corr) < 0.05
    # the categorical column follows the numeric one it was derived from.  A
    # two-level category has normal scores +-0.67, so its copula correlation
    # with `a` is about 0.8 and the expected sign agreement is
    # 1 - arccos(0.8) / pi = 0.795 (independence would give 0.5).
    agree = gen.where((F.col("a") > 0) == (F.col("k") == "hi")).count() / 4000
    assert agree > 0.75
    q = quality_summary(df, gen, ["a", "b", "k"]).first()
    assert q["overall"] > 85


def test_quality_identical_is_zero(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    rows = quality_by_column(o, o, ["o_totalprice", "o_orderstatus"]).collect()
    assert all(r["js_distance"] == pytest.approx(0.0, abs=1e-12) for r in rows)


def test_augment_strategies(spark):
    df = spark.createDataFrame([(i, 0 if i < 16 else 1, float(i % 5), "ab"[i % 2]) for i in range(20)],
                               "key long, y int, x double, s string")
    none = augment_training(spark, df, "y", "key", None)
    assert none.count() == 20
    bal = augment_training(spark, df, "y", "key", "balance")
    counts = {r["origin"]: r["count"] for r in bal.groupBy("origin").count().collect()}
    assert counts == {"real": 20, "oversampled": 12, "synthetic": 32}
    rep = augment_training(spark, df, "y", "key", "replace")
    assert rep.count() == 20 and {r["origin"] for r in rep.collect()} == {"synthetic"}
    with pytest.raises(ValueError):
        augment_training(spark, df, "y", "key", "other")


def test_wide_copula_path(spark):
    base = spark.range(6000).select((F.col("id") % 3).cast("int").alias("y"), F.randn(3).alias("a"),
                                    F.col("id"))
    cols = {f"n{i}": F.col("a") * (i % 3) + F.randn(10 + i) for i in range(8)}
    cols["cnt"] = (F.abs(F.col("a")) * 3).cast("int")
    cols["k"] = F.when(F.col("id") % 10 == 0, None).when(F.col("a") > 0, "hi").otherwise("lo")
    cols["m"] = F.when(F.col("id") % 5 == 0, None).otherwise(F.col("a"))
    df = base.withColumns(cols).drop("id", "a")
    fitted = CopulaSynthesizer("y", seed=11).fit(df)
    gen = fitted.generate(spark, 6000)
    assert gen.count() == 6000
    assert dict(gen.dtypes)["cnt"] == "int" and dict(gen.dtypes)["k"] == "string"
    assert abs(df.stat.corr("n1", "n2") - gen.stat.corr("n1", "n2")) < 0.05
    null_rate = gen.where(F.col("m").isNull()).count() / 6000
    assert 0.15 < null_rate < 0.25
    assert {r["k"] for r in gen.select("k").distinct().collect()} == {"hi", "lo", None}
    assert {r["y"] for r in gen.select("y").distinct().collect()} == {0, 1, 2}
    # same seed, same rows, whatever the partitioning
    again = fitted.generate(spark, 6000)
    assert gen.exceptAll(again).count() == 0


def test_quality_summary_wide_matches_pairwise(spark):
    base = spark.range(3000).select(F.randn(4).alias("a"))
    df = base.withColumns({f"n{i}": F.col("a") * (i % 3) + F.randn(30 + i) for i in range(12)})
    names = [f"n{i}" for i in range(12)]
    got = pair_correlations(df, names)
    want = [df.stat.corr(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    assert got == pytest.approx(want, abs=1e-9)
    q = quality_summary(df, df, names).first()
    assert q["correlation_similarity"] == pytest.approx(100.0)


def test_independent_keeps_types_and_any_number_of_values(spark):
    d = spark.range(4000).selectExpr(
        "id", "id % 2 as y", "concat('text ', id) as t", "cast(id as decimal(12,2)) / 4 as amount",
        "id % 3 = 0 as flag", "date_add(date'2024-01-01', cast(id % 90 as int)) as day",
        "cast(id * 0.1 as float) as f", "if(id % 5 = 0, null, cast(id as int)) as n")
    gen = IndependentSynthesizer("y", ["id"]).fit(d).generate(spark, 3000)
    assert dict(gen.dtypes) == {"synth_id": "bigint", **{c: k for c, k in d.dtypes if c != "id"}}
    for c in ("t", "amount", "day", "f", "n", "flag"):  # values come from the class's own rows
        assert gen.select("y", c).exceptAll(gen.select("y", c).join(d.select("y", c).distinct(), ["y", c], "left_semi")
                                            .unionByName(gen.select("y", c).where(F.col(c).isNull()))).count() == 0
    assert gen.select("t").distinct().count() > 1800
    assert 0.15 < gen.where("n is null").count() / 3000 < 0.25


def test_copula_takes_no_part_of_missing_values(spark):
    """Correlations are those of the complete pairs, at any width; types are kept."""
    base = spark.range(6000).withColumn("a", F.randn(1)).withColumn("u", F.rand(2))
    df = base.select("id", F.lit(1).alias("y"), "a", (F.col("a") + 0.02 * F.randn(3)).alias("full"),
                     F.when(F.col("u") > 0.6, F.col("a") + 0.02 * F.randn(3)).alias("b"), (F.col("a") > 0).alias("flag"),
                     F.col("a").cast("decimal(10,3)").alias("dec")).checkpoint()
    wide = df.withColumns({f"n{i}": F.rand(i) for i in range(9)})
    for d in (df, wide):
        fitted = CopulaSynthesizer("y").fit(d.drop("id"))
        m = fitted.correlations(d)[1]
        names = fitted.numeric
        assert m[names.index("a"), names.index("b")] > 0.98
        gen = fitted.generate(spark, 6000)
        assert dict(gen.dtypes) == {"synth_id": "bigint", **{c: k for c, k in d.dtypes if c != "id"}}
        both = gen.where("b is not null")
        assert both.stat.corr("a", "b") > 0.95 and abs(both.count() / 6000 - 0.4) < 0.05
    out = augment_training(spark, df.withColumn("y", (F.col("id") % 10 < 3).cast("int")), "y", "id", "augment", synthesizer="copula")
    assert out.where("origin = 'synthetic'").count() == 6000


def test_correlations_of_pairs(spark):
    df = spark.range(3000).select(F.lit("g").alias("g"), F.array(*[
        F.when(F.rand(i) > 0.3, F.randn(40 + i % 2) + F.randn(50 + i)).otherwise(float("nan")) for i in range(12)]).alias("v")).checkpoint()
    m = correlations(pairwise_moments(df, "v", "g"))["g"]
    x = pd.DataFrame(df.toPandas()["v"].tolist())
    assert np.allclose(m, x.corr().to_numpy(), atol=1e-9)


def test_quality_with_empty_synthetic_side(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_totalprice", "o_orderstatus")
    rows = quality_by_column(o, o.limit(0), ["o_totalprice", "o_orderstatus"]).collect()
    assert len(rows) == 2 and all(r["js_distance"] is None for r in rows)


@pytest.mark.parametrize("mode", ["independent", "copula"])
def test_regression_augment_synthesizes_the_label(spark, sf, mode):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        (F.monotonically_increasing_id()).alias("k"), (F.col("l_extendedprice") / 1000).alias("price"),
        "l_quantity", "l_returnflag").limit(3000)
    li = li.checkpoint()
    out = augment_training(spark, li, "price", "k", "augment", synthesizer=mode, conditional=False)
    counts = {r["origin"]: r["count"] for r in out.groupBy("origin").count().collect()}
    assert counts == {"real": 3000, "synthetic": 3000}
    syn = out.where(F.col("origin") == "synthetic")
    assert syn.where(F.col("price").isNull()).count() == 0
    assert syn.select("price").distinct().count() > 100       # a continuous label, not classes
    with pytest.raises(ValueError):
        augment_training(spark, li, "price", "k", "balance", conditional=False)
