"""Dictionaries and classes of any number: ranked and joined in Spark, equal to the small-table forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.functions.ranks import sorted_rank
from tabprep.operators import features, sampling, stats


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(3)
    # a third of the rows hold one level; nulls, an empty text, letters beyond ASCII and beyond 16 bits
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else ["", "é", "z", "😀", "Z"][i % 5] + str(int(rng.integers(0, 400))),
             ["a", "b"][i % 2], float(i % 9)) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, k string, s string, x double").repartition(5)


def test_sorted_rank_is_the_global_order(spark, wide):
    rows = sorted_rank(wide, [F.col("x").desc(), "id"]).select("_rank", "x", "id").orderBy("_rank").collect()
    assert [r["_rank"] for r in rows] == list(range(1, 3001))
    assert [(-r["x"], r["id"]) for r in rows] == sorted((-r["x"], r["id"]) for r in rows)


def test_levels_in_a_table_encode_like_levels_in_a_list(spark, wide, tmp_path):
    cols = ["x", "k", "s"]
    listed = features.TabularPreprocessor(cols).fit(wide)
    tabled = features.TabularPreprocessor(cols, max_levels=50).fit(wide)
    table = dict(tabled.categorical)["k"]
    assert isinstance(table, stats.LevelTable) and dict(tabled.categorical)["s"] == ["a", "b"]
    assert [r["level"] for r in table.table.orderBy("code").collect()] == dict(listed.categorical)["k"]
    assert tabled.n_features == listed.n_features == len(listed.feature_names())
    other = wide.unionByName(spark.createDataFrame([(9001, "never seen", "a", 1.0), (9002, None, "zz", None)], wide.schema))
    for model in (tabled, None):
        if model is None:  # saved and loaded
            tabled.save(spark, str(tmp_path / "pre"))
            model = features.FittedPreprocessor.load(spark, str(tmp_path / "pre"))
        a, b = ([(r["id"], r["features"].size, dict(zip(*_sparse(r["features"])))) for r in
                 m.transform(other, keep=["id"], assemble=True).orderBy("id").collect()] for m in (listed, model))
        assert a == b
    with pytest.raises(ValueError, match="level table"):
        tabled.feature_names()


def _sparse(v):
    x = v.toArray()
    return np.flatnonzero(x).tolist(), x[np.flatnonzero(x)].tolist()


def test_approximate_fit_has_the_same_levels(wide):
    exact, approx = (features.TabularPreprocessor(["k"], exact_median=e, max_levels=50).fit(wide).categorical[0][1] for e in (True, False))
    assert exact.table.orderBy("code").collect() == approx.table.orderBy("code").collect()


@pytest.mark.parametrize("column", ["k", "id"])
def test_label_codes_of_many_classes(wide, column):
    enc = features.fit_label_encoding(wide, column)
    want = {v: i for i, v in enumerate(sorted(r[0] for r in wide.select(column).distinct().collect() if r[0] is not None))}
    got = enc.apply(wide, "code").select(column, "code").collect()
    assert len(got) == 3000 and all(r["code"] == want.get(r[column], -1) for r in got)
    assert enc.classes == [] and len(enc.table) == len(want)
    with pytest.raises(ValueError, match="joined"):
        enc.code()


@pytest.mark.parametrize("given", [(False, False), (True, False), (False, True)])
def test_quotas_of_many_classes_equal_the_small_form(spark, given):
    rng = np.random.default_rng(1)
    counts = {int(i): int(n) for i, n in enumerate(rng.integers(5, 60, 300))} | {300: 4000}
    classes = spark.createDataFrame(list(counts.items()), "y int, n long").repartition(4)
    got = {r["y"]: (r["n_test"], r["n_val"]) for r in sampling.class_quotas(classes, 0.2, 0.25, *given).collect()}
    assert got == sampling.split_quotas(counts, 0.2, 0.25, *given)


def test_split_of_many_classes_has_exact_sizes_and_errors(spark):
    rows = [(i, i % 80) for i in range(80 * 12)] + [(10_000 + i, 80) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, y int")
    out = sampling.split_exact(df.repartition(3), "id", stratify="y")
    again = sampling.split_exact(df.repartition(8), "id", stratify="y")
    assert sorted(out.collect()) == sorted(again.collect()) and out.columns == ["id", "y", "split"]
    n = len(rows)
    size = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert size["test"] == -(-n // 5) and size["validation"] == -(-(n - size["test"]) // 4)
    with pytest.raises(ValueError, match="at least 2 per class"):
        sampling.split_exact(df.unionByName(spark.createDataFrame([(1 << 40, 99)], df.schema)), "id", stratify="y")
    with pytest.raises(ValueError, match="null values"):
        sampling.split_exact(df.unionByName(spark.createDataFrame([(1 << 40, None)], df.schema)), "id", stratify="y")
