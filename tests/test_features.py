import math

import pytest
from pyspark.sql import functions as F

from tabprep.operators import features, stats
from tabprep.sources.csv import read_csv


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert stats.exact_medians(df, ["x"]) == {"x": 2.5}


def test_median_refinement_matches_exact(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    o = o.withColumn("x", F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_totalprice")))
    want = o.select(F.median("x")).first()[0]
    # force several narrowing levels with a tiny collect limit
    got = stats.exact_medians(o, ["x"], accuracy=200, collect_limit=50)["x"]
    assert got == pytest.approx(want, rel=0, abs=1e-9)
    even = o.where(F.col("o_orderkey") % 2 == 0)
    assert stats.exact_medians(even, ["x"], accuracy=200, collect_limit=50)["x"] == pytest.approx(
        even.select(F.median("x")).first()[0], abs=1e-9)


def test_scale_population_std_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], "x double, c double")
    fitted = features.TabularPreprocessor(["x", "c"]).fit(df)
    (_, med, mean, std), (_, _, cmean, cstd) = fitted.numeric
    assert std == pytest.approx(3.5355339, abs=1e-6)
    assert cstd == 0.0
    later = spark.createDataFrame([(4.0, 5.0), (4.0, 6.0)], "x double, c double")
    out = [r["num__c"] for r in fitted.transform(later).collect()]
    assert out == [0.0, 1.0]


def test_onehot_levels_and_unknown(spark):
    fit = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    fitted = features.TabularPreprocessor(["k"]).fit(fit)
    assert fitted.categorical == [("k", ["a", "b", "missing"])]
    app = spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "k string")
    rows = [tuple(r) for r in fitted.transform(app).collect()]
    assert rows == [(1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 0.0), (0.0, 0.0, 1.0)]


def test_onehot_missing_never_fitted(spark):
    fitted = features.TabularPreprocessor(["k"]).fit(spark.createDataFrame([("a",), ("b",)], "k string"))
    rows = [tuple(r) for r in fitted.transform(spark.createDataFrame([(None,)], "k string")).collect()]
    assert rows == [(0.0, 0.0)]


def test_typed_csv(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("id,bmi,d,b,s\n1,N/A,2020-01-01,True,NA\n2,22.5,2020-01-02,False,\n3,30,2020-01-03,True,x\n")
    df = read_csv(spark, str(p))
    types = dict(df.dtypes)
    assert types == {"id": "bigint", "bmi": "double", "d": "string", "b": "boolean", "s": "string"}
    assert [r["bmi"] for r in df.orderBy("id").collect()] == [None, 22.5, 30.0]
    assert [r["s"] for r in df.orderBy("id").collect()] == [None, None, "x"]
    num, cat = features.split_types(df, ["bmi", "d", "b", "s"])
    assert num == ["bmi", "b"] and cat == ["d", "s"]


def test_all_null_column_leaves_features(spark):
    df = spark.createDataFrame([(None, 1.0)] * 3, "x double, y double")
    fitted = features.TabularPreprocessor(["x", "y"]).fit(df)
    assert fitted.dropped == ["x"]
    assert fitted.feature_names() == ["num__y"]


def test_label_codes_numeric_and_string(spark):
    num = spark.createDataFrame([(10,), (2,), (1,), (None,)], "y int")
    out = [r["c"] for r in num.withColumn("c", features.fit_label_encoding(num, "y").code()).collect()]
    assert out == [2, 1, 0, -1]
    s = spark.createDataFrame([("b",), ("a",), (None,)], "y string")
    out = [r["c"] for r in s.withColumn("c", features.fit_label_encoding(s, "y").code()).collect()]
    assert out == [1, 0, -1]


def test_names_with_punctuation(spark):
    df = spark.createDataFrame([(1.0, "x", 0), (3.0, "y", 1)], "`Loan Status` double, `a.b` string, `Bankrupt?` int")
    fitted = features.TabularPreprocessor(["Loan Status", "a.b"]).fit(df)
    out = fitted.transform(df, keep=["Bankrupt?"]).collect()
    assert len(out) == 2 and out[0]["num__Loan Status"] == -1.0


def test_case_only_duplicates_rejected(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.createDataFrame([(1, 2)], "Exited int, exited int")
        with pytest.raises(ValueError):
            features.TabularPreprocessor().fit(df)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_drop_is_exact_match(spark):
    df = spark.createDataFrame([(1, 2, 3, 0)] * 2, "id int, i int, d int, label int")
    kept = features.feature_columns(features.drop_columns(df, "id"), "label")
    assert kept == ["i", "d"]
    with pytest.raises(KeyError):
        features.drop_columns(df, ["nope"])


def test_preprocessor_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, None)], "x double, k string")
    fitted = features.TabularPreprocessor().fit(df)
    fitted.save(spark, str(tmp_path / "pre"))
    again = features.FittedPreprocessor.load(spark, str(tmp_path / "pre"))
    assert again.feature_names() == fitted.feature_names()
    assert [tuple(r) for r in again.transform(df).collect()] == [tuple(r) for r in fitted.transform(df).collect()]
    assert not math.isnan(fitted.numeric[0][1])


def test_wide_fit_long_form_matches_exact(spark):
    base = spark.range(4000).select("id", F.randn(1).alias("a"))
    cols = {f"n{i}": F.when(F.col("id") % (i + 3) == 0, None).otherwise(
        F.round(F.col("a") * (i % 4) + F.randn(20 + i), 2 if i % 2 else 6)) for i in range(30)}
    cols["hot"] = F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("a"))   # a third of rows tie
    df = spark.range(4000).select("id").join(base.withColumns(cols), "id").drop("a")
    names = [c for c in df.columns if c != "id"]
    got = stats.fit_columns(df, names, {}, collect_limit=100)
    want = df.agg(*[F.median(c).alias(c) for c in names]).first()
    for c in names:
        assert got["medians"][c] == pytest.approx(want[c], abs=1e-12), c
    mom = df.agg(*[F.avg(F.coalesce(F.col(c), F.lit(got["medians"][c]))).alias(c) for c in names]).first()
    for c in names:
        assert got["moments"][c][0] == pytest.approx(mom[c], rel=1e-12)


def test_sparse_one_hot_equals_dense(spark, sf):
    from pyspark.ml.functions import vector_to_array
    d = spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", F.when(F.col("doc_id") % 6 == 0, None).otherwise(F.col("lang")).alias("lang"),
        "source", "n_chars")
    fitted = features.TabularPreprocessor(["lang", "source", "n_chars"]).fit(
        d.where(F.col("source") != "src_03"))            # src_03 is unseen when fitting
    dense = fitted.transform(d, keep=["doc_id"], assemble=True)
    sparse = fitted.transform(d, keep=["doc_id"], assemble=True, sparse_levels=3)
    a = dense.select("doc_id", vector_to_array("features").alias("v"))
    b = sparse.select("doc_id", vector_to_array("features").alias("v"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    n = len(fitted.feature_names())
    assert len(a.first()["v"]) == n


def test_approximate_median_option(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_totalprice", "o_orderstatus")
    exact = features.TabularPreprocessor(["o_totalprice", "o_orderstatus"]).fit(o)
    approx = features.TabularPreprocessor(["o_totalprice", "o_orderstatus"], exact_median=False).fit(o)
    (_, m_exact, mu_e, sd_e), = exact.numeric
    (_, m_apx, mu_a, sd_a), = approx.numeric
    assert abs(m_apx - m_exact) / m_exact < 1e-3          # within the sketch's rank error
    assert mu_a == pytest.approx(mu_e, rel=1e-9) and sd_a == pytest.approx(sd_e, rel=1e-9)
    assert approx.categorical == exact.categorical


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_many_labels_take_one_pass_and_nulls_are_dealt(spark, monkeypatch, broadcast):
    from tabprep.operators import features

    monkeypatch.setattr(features, "BROADCAST_CLASSES", broadcast)
    rows = [(i, None if i % 3 == 0 else f"p{i % 200:03d}") for i in range(1200)]
    df = spark.createDataFrame(rows, "id int, part string")
    order = {v: i for i, v in enumerate(sorted({r[1] for r in rows if r[1]}))}
    out = features.encode_label(df, "part", "code")
    assert out.columns == ["id", "part", "code"]
    assert sorted(map(tuple, out.collect())) == sorted(((i, p, order.get(p, -1)) for i, p in rows), key=lambda r: r[0])
    if not broadcast:  # the rows without a label have a key of their own
        assert "_dealt" in out._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[1].splitlines()[0]
