"""Draws from frequency tables of any size, and the synthesizers that use them."""

import bisect

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.functions import intervals as iv
from tabprep.operators.copula import CopulaSynthesizer
from tabprep.operators import synth
from tabprep.operators.synthesizer import IndependentSynthesizer


def _counts(rng, n):
    """Two groups and a null one; one value holds a third of all positions, null is a value."""
    rows = [(g, f"v{i:05d}", int(rng.integers(1, 9))) for g in ("a", "b", None) for i in range(n)]
    return rows + [("a", "hot", 2 * n), ("b", None, 7), (None, None, 1)]


def _expected(rows, group, position):
    own = sorted([r for r in rows if r[0] == group], key=lambda r: (r[1] is None, r[1] or ""))
    ends = np.cumsum([r[2] for r in own]).tolist()
    if position is None or position < 0 or not own or position >= ends[-1]:
        return None, None
    at = bisect.bisect_right(ends, position)
    return own[at][1], own[at][2]


@pytest.mark.parametrize("width", [1, 7, 4096])
def test_look_up_equals_bisection(spark, monkeypatch, width):
    monkeypatch.setattr(iv, "WIDTH", width)
    rng = np.random.default_rng(width)
    rows = _counts(rng, 200)
    table = iv.cumulate(spark.createDataFrame(rows, "g string, v string, n long"), ["g"], "v")
    asked = [(i, [None, "a", "b", "other"][i % 4], None if i % 50 == 0 else int(rng.integers(-1, 1500))) for i in range(3000)]
    got = iv.look_up(spark.createDataFrame(asked, "id int, g string, p long"), table, ["g"], "p", "v", "out", "size").collect()
    assert len(got) == len(asked)
    for r in got:
        want = _expected(rows, r["g"], r["p"])
        assert (r["out"], r["size"]) == want, r


def test_buckets_widen_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(iv, "WIDTH", 1)
    monkeypatch.setattr(iv, "BUCKETS", 10)
    rows = [("x", 3), ("y", 10 ** 9), ("z", 1)]
    table = iv.cumulate(spark.createDataFrame(rows, "v string, n long"), [], "v")
    at = [0, 2, 3, 10 ** 9 + 2, 10 ** 9 + 3, 10 ** 9 + 4]
    got = iv.look_up(spark.createDataFrame([(p,) for p in at], "p long"), table, [], "p", "v", "v")
    assert [r["v"] for r in got.orderBy("p").collect()] == ["x", "x", "y", "y", "z", None]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "g string, v string, n long")
    some = spark.createDataFrame([("a", "v", 2)], "g string, v string, n long")
    draws = spark.createDataFrame([("a", 0.3), (None, 0.9)], "g string, u double")
    assert iv.cumulate(none, ["g"], "v").count() == 0
    assert [r["o"] for r in iv.draw_values(draws, iv.cumulate(none, ["g"], "v"), ["g"], F.col("u"), "v", "o").collect()] == [None, None]
    got = iv.draw_values(draws, iv.cumulate(some, ["g"], "v"), ["g"], F.col("u"), "v", "o").collect()
    assert {r["g"]: r["o"] for r in got} == {"a": "v", None: None}
    assert iv.draw_values(draws.limit(0), iv.cumulate(some, ["g"], "v"), ["g"], F.col("u"), "v", "o").count() == 0
    assert {r["o"] for r in iv.draw_values(draws, iv.cumulate(some, [], "v"), [], F.col("u"), "v", "o").collect()} == {"v"}


def _rows(spark, n=3000):
    return spark.range(n).select(
        (F.col("id") % 2).cast("int").alias("y"), F.randn(1).alias("a"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None)
        .otherwise(F.concat(F.lit("t"), (F.col("id") % 700).cast("string"))).alias("many"),
        F.when(F.col("id") % 5 < 2, "p").otherwise("q").alias("few"))


def test_copula_with_tables_equals_copula_with_dictionaries(spark):
    """The same scores, correlations and rows, whether levels are a dictionary or a table."""
    df = _rows(spark).cache()
    plain = CopulaSynthesizer("y", seed=5).fit(df)
    tabled = CopulaSynthesizer("y", seed=5, max_levels=10).fit(df)
    assert set(tabled.tables) == {"many"} and not plain.tables and set(c for _, c in tabled.levels) == {"few"}
    for lab in (0, 1):
        assert tabled.correlations(df)[lab] == pytest.approx(plain.correlations(df)[lab], abs=1e-9)
    a, b = (f.generate(spark, 4000).toPandas().sort_values("synth_id").reset_index(drop=True) for f in (plain, tabled))
    assert list(a.columns) == list(b.columns)
    for c in ("y", "few"):
        assert a[c].equals(b[c])
    assert np.allclose(a["a"], b["a"], equal_nan=True, atol=1e-9)
    assert (a["many"].fillna("") == b["many"].fillna("")).mean() > 0.999  # but for uniforms at an interval's very end
    assert 0.28 < (b["many"] == "hot").mean() < 0.39 and b["many"].isna().any()
    df.unpersist()


def test_copula_of_many_texts_takes_none_to_the_driver(spark):
    df = spark.range(30_000).select((F.col("id") % 2).cast("int").alias("y"), F.col("id").cast("string").alias("t"))
    fitted = CopulaSynthesizer("y", max_levels=100).fit(df)
    assert not fitted.levels and set(fitted.tables) == {"t"}
    got = fitted.generate(spark, 2000)
    assert got.count() == 2000 and got.where(F.col("t").cast("long") % 2 == F.col("y")).count() == 2000
    assert got.select("t").distinct().count() > 1800


def test_independent_of_many_classes_equals_few(spark, monkeypatch):
    df = spark.range(2000).select("id", (F.col("id") % 37).cast("string").alias("y"), (F.col("id") * 7 % 101).alias("x"))
    fitted = IndependentSynthesizer("y", ["id"], columns=["x"]).fit(df)
    few = {tuple(r) for r in fitted.generate(spark, 1500).collect()}
    monkeypatch.setattr(synth, "FEW_CLASSES", 5)
    assert {tuple(r) for r in fitted.generate(spark, 1500).collect()} == few and len(few) == 1500


@pytest.mark.parametrize("rows", [0, 300_000])
def test_few_intervals_are_broadcast_with_the_same_draws(spark, monkeypatch, rows):
    from tabprep.functions import intervals

    monkeypatch.setattr(intervals, "BROADCAST_ROWS", rows)
    counts = spark.createDataFrame([("a", "x", 5000), ("a", None, 4000), ("a", "z", 1), (None, "x", 7), ("b", "y", 1)], "g string, v string, n long")
    table = intervals.cumulate(counts, ["g"], "v")
    asked = [("a", 0), ("a", 4999), ("a", 5000), ("a", 5001), ("a", 9000), ("a", 9001), (None, 6), (None, 7), ("b", 0), ("c", 0), ("a", None)]
    draws = spark.createDataFrame([(i, *r) for i, r in enumerate(asked)], "i int, g string, p long")
    met = intervals.look_up(draws, table, ["g"], "p", "v", "drawn", "size")
    got = {r["i"]: (r["drawn"], r["size"]) for r in met.collect()}
    assert got == {0: ("x", 5000), 1: ("x", 5000), 2: ("z", 1), 3: (None, 4000), 4: (None, 4000), 5: (None, None), 6: ("x", 7),
                   7: (None, None), 8: ("y", 1), 9: (None, None), 10: (None, None)}
    assert ("_bucketh" in met._jdf.queryExecution().optimizedPlan().toString()) == (rows > 0)  # else a window over shuffled draws
