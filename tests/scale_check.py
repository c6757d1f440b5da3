"""Scale check (not collected by pytest): build a 12M-row table from the
sf0.1 lineitem (x20 copies with distinct keys), run the main operators with
their default thresholds - so the multi-bucket paths engage - and compare
with DuckDB.  Usage:  python tests/scale_check.py /tmp/<fresh scratch dir>
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tabprep.operators import features, metrics, sampling  # noqa: E402
from tabprep.operators.synthesizer import CopulaSynthesizer, IndependentSynthesizer  # noqa: E402
from tabprep.session import local_session  # noqa: E402


def build(spark, path, copies=20):
    li = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    li = li.withColumn("rid", F.monotonically_increasing_id())
    big = li.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    big = big.select(
        (F.col("rid") * copies + F.col("copy")).alias("row_key"),
        (F.col("l_quantity") + F.col("copy") % 3).alias("l_quantity"),
        (F.col("l_extendedprice") * (1 + F.col("copy") / 100.0)).alias("l_extendedprice"),
        "l_discount", "l_returnflag",
        F.when(F.col("copy") % 7 == 0, None).otherwise(F.date_format("l_shipdate", "yyyy")).alias("ship_year"))
    big = big.withColumn("y", (F.col("l_returnflag") == "R").cast("int")).withColumn(
        "score", F.col("l_discount") * 5 + (F.xxhash64("row_key") % 1000000) / 2e6 + F.col("y") * 0.1)
    big.repartition(32).write.mode("overwrite").parquet(path)


def main(scratch):
    spark = local_session(8)
    path = f"{scratch}/big.parquet"
    if not os.path.exists(path):
        build(spark, path)
    df = spark.read.parquet(path)
    out = {}

    def tm(name, f):
        t = time.time()
        r = f()
        out[name] = round(time.time() - t, 2)
        return r

    def noop(d):
        d.write.format("noop").mode("overwrite").save()
        return d

    sp = tm("split_stratified", lambda: noop(sampling.split_exact(df, "row_key", stratify="l_returnflag")))
    fitted = tm("preprocessor_fit", lambda: features.TabularPreprocessor(
        ["l_quantity", "l_extendedprice", "l_discount", "ship_year"]).fit(df))
    tm("oversample_random", lambda: noop(sampling.oversample(df.select("row_key", "y", "l_quantity"), "y", "row_key")))
    rep = tm("classification_report", lambda: metrics.classification_report(df, "y", "score").first())
    tm("copula_fit_generate", lambda: CopulaSynthesizer(
        "y", columns=["l_quantity", "l_extendedprice", "ship_year"]).fit(df).generate(spark, df.count()).count())
    tm("independent_synth", lambda: noop(IndependentSynthesizer(
        "y", ["row_key"], columns=["l_quantity", "ship_year"]).fit(df).generate(spark, df.count())))

    con = duckdb.connect()
    con.execute(f"CREATE VIEW big AS SELECT * FROM read_parquet('{path}/*.parquet')")
    med = con.execute("SELECT median(l_quantity), median(l_extendedprice) FROM big").fetchone()
    auc = con.execute("""
        WITH p AS (SELECT score t, sum(y) pos, count(*) - sum(y) neg FROM big GROUP BY score),
        c AS (SELECT *, sum(pos) OVER (ORDER BY t DESC) tp, sum(neg) OVER (ORDER BY t DESC) fp FROM p),
        tot AS (SELECT sum(pos) P, sum(neg) N FROM p)
        SELECT sum(neg * (2.0 * tp - pos)) / (2.0 * max(P) * max(N)),
               sum(pos * (tp / (tp + fp))) / max(P) FROM c, tot""").fetchone()
    sizes = {(r[0], r[1]): r[2] for r in sp.groupBy("l_returnflag", "split").count().collect()}
    n = {r[0]: r[1] for r in df.groupBy("l_returnflag").count().collect()}
    checks = {
        "medians_equal": [m for _, m, *_ in fitted.numeric[:2]] == list(med),
        "auc_close": abs(rep["auc"] - auc[0]) < 1e-9 and abs(rep["aucpr"] - auc[1]) < 1e-9,
        "split_sizes_exact": all(
            (sizes[(y, "test")], sizes[(y, "validation")]) == q
            for y, q in sampling.split_quotas(n).items()),
    }
    print(json.dumps({"rows": df.count(), "seconds": out, "checks": checks}))


if __name__ == "__main__":
    main(sys.argv[1])
