import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabprep.functions.hashing import hash_key
from tabprep.functions.ranks import hash_cutoffs, hash_rank
from tabprep.operators import sampling


@pytest.mark.parametrize("n", [10, 11, 101])
def test_split_sizes(spark, n):
    df = spark.range(n).select(F.col("id").alias("key"), (F.col("id") % 2).cast("int").alias("y"))
    out = sampling.split_exact(df, "key")
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    n_test = math.ceil(0.2 * n)
    n_val = math.ceil(0.25 * (n - n_test))
    assert counts == {"test": n_test, "validation": n_val, "train": n - n_test - n_val}
    assert out.select("key").distinct().count() == n


def test_split_strata_quotas_and_single_member_class(spark):
    ys = [0] * 90 + [1] * 9 + [2] * 1
    df = spark.createDataFrame(list(enumerate(ys)), "key long, y int")
    with pytest.raises(ValueError):
        sampling.split_exact(df, "key", stratify="y")
    ys = [0] * 90 + [1] * 10
    df = spark.createDataFrame(list(enumerate(ys)), "key long, y int")
    out = sampling.split_exact(df, "key", stratify="y")
    got = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert got == {(0, "test"): 18, (1, "test"): 2, (0, "validation"): 18, (1, "validation"): 2,
                   (0, "train"): 54, (1, "train"): 6}


def test_split_independent_of_partitioning(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus")
    a = sampling.split_exact(o.repartition(3), "o_orderkey", stratify="o_orderstatus")
    b = sampling.split_exact(o.repartition(17), "o_orderkey", stratify="o_orderstatus")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hash_cutoffs_refinement_equals_row_number(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus")
    h = o.withColumn("h", hash_key(7, "o_orderkey"))
    wanted = {"F": [1, 100, 2500], "O": [3, 4000], "P": [0, 17]}
    # tiny limits force two refinement levels
    cut = hash_cutoffs(h, "h", wanted, group_col="o_orderstatus", max_rank_rows=5, start_digits=1)
    ranked = h.withColumn("rk", F.row_number().over(Window.partitionBy("o_orderstatus").orderBy("h")))
    for (g, k), v in cut.items():
        if k == 0:
            assert v == ""
        else:
            assert ranked.where((F.col("o_orderstatus") == g) & (F.col("rk") == k)).first()["h"] == v


def test_hash_rank_buckets_equal_row_number(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_mktsegment")
    h = c.withColumn("h", hash_key(3, "c_custkey"))
    a = hash_rank(h, "h", ["c_mktsegment"], rank_col="rk", rows_per_bucket=10)
    b = h.withColumn("rk", F.row_number().over(Window.partitionBy("c_mktsegment").orderBy("h")))
    assert a.select("c_custkey", "rk").exceptAll(b.select("c_custkey", "rk")).count() == 0


@pytest.mark.parametrize("mode", ["random", "even"])
def test_oversample_counts(spark, mode):
    df = spark.createDataFrame([(i, 0 if i < 8 else 1) for i in range(10)], "key long, y int")
    out = sampling.oversample(df, "y", "key", 1.0, mode=mode)
    assert out.where(F.col("oversample_draw").isNotNull()).count() == 6
    assert out.where(F.col("oversample_draw").isNull()).exceptAll(df.withColumn(
        "oversample_draw", F.lit(None).cast("bigint"))).count() == 0
    assert set(r["y"] for r in out.where(F.col("oversample_draw").isNotNull()).collect()) == {1}
    half = sampling.oversample(df, "y", "key", 0.5, mode=mode)
    assert half.where(F.col("oversample_draw").isNotNull()).count() == 2
    with pytest.raises(ValueError):
        sampling.oversample(df, "y", "key", 0.1, mode=mode)
    three = spark.createDataFrame([(i, i % 3) for i in range(9)], "key long, y int")
    with pytest.raises(ValueError):
        sampling.oversample(three, "y", "key", 1.0, mode=mode)


def test_sample_rows_exact_n(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    assert sampling.sample_rows(p, "p_partkey", 37).count() == 37


def test_duplicate_key_at_boundary_is_an_error(spark):
    # every key twice; 22 rows -> the test cut is at rank 5, between the two
    # copies of one key, so "hash <= threshold" would take 6 rows
    df = spark.range(22).select((F.col("id") % 11).alias("key"))
    with pytest.raises(ValueError, match="unique"):
        sampling.split_exact(df, "key")
