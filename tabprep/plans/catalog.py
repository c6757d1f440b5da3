"""Registered queries over the driver tables, each with its SQL twin.

Every query reads whole tables.  Missing values are injected by a fixed
rule (the tables have none), identically in the Spark query and the SQL.
Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.operators import features, metrics, sampling, stats
from tabprep.sources.csv import NA_TOKENS, infer_types, normalize_na

SEED = 42
R = 6


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def rnd(c, n=R):
    return F.round(c, n)


def sig4(c):
    """Round a positive double to 4 significant digits (null otherwise)."""
    e = F.floor(F.log10(c)) - 3
    return F.when(c > 0, F.round(c / F.pow(F.lit(10.0), e)) * F.pow(F.lit(10.0), e))


def _sql_list(vals) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


def _md5(col: str) -> str:
    return f"md5(concat_ws('|', '{SEED}', CAST({col} AS VARCHAR)))"


# ------------------------------------------------------------------ inputs with injected nulls

def orders_nulled(spark, d):
    o = t(spark, d, "orders")
    return o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, None)
                        .otherwise(F.col("o_totalprice")))


ORDERS_NULLED = ("(SELECT o_orderkey, o_orderstatus, o_orderpriority, "
                 "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice "
                 "FROM orders)")


def docs_labelled(spark, d):
    """documents x labels with n_chars and lang nulled by rule."""
    docs = t(spark, d, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 6 == 0, None).otherwise(F.col("lang")).alias("lang"),
        "source",
        F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("n_chars")).alias("n_chars"))
    return t(spark, d, "labels").select("doc_id", "quality").join(docs, "doc_id")


DOCS_LABELLED = ("(SELECT l.doc_id, l.quality, "
                 "CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE d.lang END AS lang, d.source, "
                 "CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE d.n_chars END AS n_chars "
                 "FROM labels l JOIN documents d ON l.doc_id = d.doc_id)")


def scored_labels(spark, d):
    """labels x documents with a deterministic score in [0, 1)."""
    return (t(spark, d, "labels").select("doc_id", "quality")
            .join(t(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
            .select("doc_id", F.col("quality").alias("y"),
                    ((F.col("n_chars") % 100).cast("double") / 100.0).alias("score")))


SCORED = ("(SELECT l.doc_id, l.quality AS y, CAST(d.n_chars % 100 AS DOUBLE) / 100.0::DOUBLE AS score "
          "FROM labels l JOIN documents d ON l.doc_id = d.doc_id)")


def lineitem_pred(spark, d):
    li = t(spark, d, "lineitem")
    return li.select((F.col("l_extendedprice") / 1000.0).alias("y"),
                     (F.col("l_quantity") * 1.5).alias("pred"))


LINEITEM_PRED = ("(SELECT l_extendedprice / 1000.0::DOUBLE AS y, l_quantity * 1.5::DOUBLE AS pred "
                 "FROM lineitem)")


# ------------------------------------------------------------------ A2: NA tokens

def q_normalize_na_tokens(spark, d):
    ev = t(spark, d, "events")
    m = F.col("event_id") % 9
    raw = (F.when(m == 0, "N/A").when(m == 1, "NA").when(m == 2, "").when(m == 3, "null")
           .otherwise(F.col("event_type")))
    val = F.when(F.col("event_id") % 13 == 0, "nan").otherwise(F.col("value").cast("string"))
    df = ev.select("event_id", raw.alias("event_type"), val.alias("value"))
    return infer_types(normalize_na(df))


SQL_NORMALIZE_NA_TOKENS = f"""
SELECT event_id,
       CASE WHEN raw IN ({_sql_list(NA_TOKENS)}) THEN NULL ELSE raw END AS event_type,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value
FROM (SELECT event_id, value,
             CASE event_id % 9 WHEN 0 THEN 'N/A' WHEN 1 THEN 'NA' WHEN 2 THEN '' WHEN 3 THEN 'null'
                  ELSE event_type END AS raw
      FROM events)
"""


# ------------------------------------------------------------------ B1-B3: drop and type

def q_drop_and_type_columns(spark, d):
    c = t(spark, d, "customer")
    c = features.drop_columns(c, ["c_name"])
    feats = features.feature_columns(c, "c_mktsegment")
    num, cat = features.split_types(c, feats)
    return c.select(*[qcol(x).cast("double").alias(x) for x in num],
                    *[features.as_category(c, x).alias(x) for x in cat], "c_mktsegment")


SQL_DROP_AND_TYPE_COLUMNS = """
SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
       CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment
FROM customer
"""


# ------------------------------------------------------------------ G1: union by name

def q_union_real_synthetic(spark, d):
    p = t(spark, d, "part")
    real = p.select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice",
                    F.lit("real").alias("origin"))
    synth = p.select("p_partkey", "p_brand", "p_type", "p_retailprice",
                     F.lit("synthetic").alias("origin"))
    from tabprep.operators.synth import union_real_synthetic
    return union_real_synthetic(real, synth)


SQL_UNION_REAL_SYNTHETIC = """
SELECT p_partkey, p_brand, p_type, p_size, p_retailprice, 'real' AS origin FROM part
UNION ALL BY NAME
SELECT p_partkey, p_brand, p_type, p_retailprice, 'synthetic' AS origin FROM part
"""


# ------------------------------------------------------------------ C2/H1, C3/H2

def q_impute_median(spark, d):
    o = orders_nulled(spark, d)
    med = stats.exact_medians(o, ["o_totalprice"])["o_totalprice"]
    return o.select("o_orderkey", rnd(F.coalesce(F.col("o_totalprice"), F.lit(med))).alias("o_totalprice"))


SQL_IMPUTE_MEDIAN = f"""
WITH b AS {ORDERS_NULLED}
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT median(o_totalprice) FROM b)), 6) AS o_totalprice
FROM b
"""


def q_standardize(spark, d):
    o = orders_nulled(spark, d)
    fitted = features.TabularPreprocessor(["o_totalprice"]).fit(o)
    out = fitted.transform(o, keep=["o_orderkey"])
    return out.select("o_orderkey", rnd(F.col("num__o_totalprice")).alias("num__o_totalprice"))


SQL_STANDARDIZE = f"""
WITH b AS {ORDERS_NULLED},
m AS (SELECT median(o_totalprice) AS med FROM b),
f AS (SELECT o_orderkey, coalesce(o_totalprice, med) AS v FROM b, m),
s AS (SELECT avg(v) AS mu, stddev_pop(v) AS sd FROM f)
SELECT o_orderkey, round((v - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS num__o_totalprice
FROM f, s
"""


# ------------------------------------------------------------------ H3/H4/C4

def _long(df: DataFrame, ids: list[str]) -> DataFrame:
    feats = [c for c in df.columns if c not in ids]
    return df.unpivot(ids, feats, "feature", "value")


def q_impute_constant_onehot(spark, d):
    docs = t(spark, d, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 6 == 0, None).otherwise(F.col("lang")).alias("lang"))
    fitted = features.TabularPreprocessor(["lang"]).fit(docs)
    return _long(fitted.transform(docs, keep=["doc_id"]), ["doc_id"])


SQL_IMPUTE_CONSTANT_ONEHOT = """
WITH b AS (SELECT doc_id, coalesce(CASE WHEN doc_id % 6 = 0 THEN NULL ELSE lang END, 'missing') AS lang
           FROM documents),
lv AS (SELECT DISTINCT lang AS level FROM b)
SELECT doc_id, 'cat__lang_' || level AS feature, CAST(lang = level AS DOUBLE) AS value
FROM b, lv
"""


# ------------------------------------------------------------------ H6: apply to unseen rows

def q_onehot_unseen(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    fitted = features.TabularPreprocessor(["o_orderstatus"]).fit(o.where(F.col("o_orderstatus") != "P"))
    return _long(fitted.transform(o, keep=["o_orderkey"]), ["o_orderkey"])


SQL_ONEHOT_UNSEEN = """
WITH lv AS (SELECT DISTINCT o_orderstatus AS level FROM orders WHERE o_orderstatus <> 'P')
SELECT o_orderkey, 'cat__o_orderstatus_' || level AS feature, CAST(o_orderstatus = level AS DOUBLE) AS value
FROM orders, lv
"""


# ------------------------------------------------------------------ C7

def q_encode_label(spark, d):
    c = t(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 11 == 0, None).otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"))
    enc = features.fit_label_encoding(c, "c_mktsegment")
    return c.withColumn("label_code", enc.code())


SQL_ENCODE_LABEL = """
WITH b AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS seg
           FROM customer),
lv AS (SELECT seg, CAST(dense_rank() OVER (ORDER BY seg) - 1 AS INTEGER) AS code
       FROM (SELECT DISTINCT seg FROM b WHERE seg IS NOT NULL))
SELECT b.c_custkey, b.seg AS c_mktsegment, CAST(coalesce(lv.code, -1) AS INTEGER) AS label_code
FROM b LEFT JOIN lv ON b.seg = lv.seg
"""


# ------------------------------------------------------------------ H5: full preprocessor

def q_preprocess_full(spark, d):
    df = docs_labelled(spark, d)
    enc = features.fit_label_encoding(df, "quality")
    fitted = features.TabularPreprocessor(["lang", "source", "n_chars"]).fit(df)
    out = fitted.transform(df.withColumn("quality", enc.code()), keep=["doc_id", "quality"])
    long = _long(out, ["doc_id", "quality"])
    return long.withColumn("value", rnd(F.col("value")))


SQL_PREPROCESS_FULL = f"""
WITH b AS {DOCS_LABELLED},
m AS (SELECT median(n_chars) AS med FROM b),
f AS (SELECT b.*, coalesce(CAST(n_chars AS DOUBLE), med) AS v,
             coalesce(lang, 'missing') AS lang_f, coalesce(source, 'missing') AS source_f FROM b, m),
s AS (SELECT avg(v) AS mu, stddev_pop(v) AS sd FROM f),
yl AS (SELECT quality, CAST(dense_rank() OVER (ORDER BY quality) - 1 AS INTEGER) AS code
       FROM (SELECT DISTINCT quality FROM b WHERE quality IS NOT NULL)),
lv AS (SELECT DISTINCT 'lang' AS col, lang_f AS level FROM f
       UNION ALL SELECT DISTINCT 'source' AS col, source_f AS level FROM f),
fy AS (SELECT f.*, CAST(coalesce(yl.code, -1) AS INTEGER) AS qcode FROM f LEFT JOIN yl ON f.quality = yl.quality)
SELECT doc_id, qcode AS quality, 'num__n_chars' AS feature,
       round((v - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS value
FROM fy, s
UNION ALL
SELECT doc_id, qcode AS quality, 'cat__' || lv.col || '_' || lv.level AS feature,
       CAST((CASE WHEN lv.col = 'lang' THEN lang_f ELSE source_f END) = lv.level AS DOUBLE) AS value
FROM fy, lv
"""


# ------------------------------------------------------------------ D1, G7

def q_shuffle_rows(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return sampling.shuffle_rows(c, "c_custkey", SEED, position="position")


SQL_SHUFFLE_ROWS = f"""
SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY {_md5('c_custkey')}) AS position
FROM customer
"""


def q_sample_rows(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")
    return sampling.sample_rows(p, "p_partkey", 100, SEED)


SQL_SAMPLE_ROWS = f"""
SELECT p_partkey, p_brand, p_retailprice FROM part
ORDER BY {_md5('p_partkey')}, p_partkey LIMIT 100
"""


# ------------------------------------------------------------------ D2, D3, D4

def q_split_random(spark, d):
    o = t(spark, d, "orders").select("o_orderkey")
    return sampling.split_exact(o, "o_orderkey", SEED)


SQL_SPLIT_RANDOM = f"""
WITH h AS (SELECT o_orderkey, {_md5('o_orderkey')} AS hk FROM orders),
q AS (SELECT count(*) AS n, CAST(ceil(0.2::DOUBLE * count(*)) AS BIGINT) AS t FROM h),
q2 AS (SELECT t, CAST(ceil(0.25::DOUBLE * (n - t)) AS BIGINT) AS v FROM q),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY hk) AS rk FROM h)
SELECT o_orderkey,
       CASE WHEN rk <= t THEN 'test' WHEN rk <= t + v THEN 'validation' ELSE 'train' END AS split
FROM r, q2
"""


def stratified_split_sql(source: str, key: str, label: str, out_cols: str) -> str:
    """SQL twin of the stratified exact split (largest-remainder quotas)."""
    return f"""
WITH h AS (SELECT *, {label} AS y_, {_md5(key)} AS hk FROM {source} src),
c AS (SELECT y_, count(*) AS n FROM h GROUP BY y_),
t1 AS (SELECT CAST(sum(n) AS BIGINT) AS tot, CAST(ceil(0.2::DOUBLE * sum(n)) AS BIGINT) AS n_out FROM c),
a1 AS (SELECT y_, n, CAST(n * (tot - n_out) AS DOUBLE) / tot AS cont,
              floor(CAST(n * (tot - n_out) AS DOUBLE) / tot) AS fl, tot - n_out AS n_keep FROM c, t1),
b1 AS (SELECT *, row_number() OVER (ORDER BY cont - fl DESC, y_) AS pos,
              n_keep - sum(fl) OVER () AS need FROM a1),
k1 AS (SELECT y_, n, CAST(fl AS BIGINT) + CASE WHEN pos <= need THEN 1 ELSE 0 END AS m FROM b1),
t2 AS (SELECT CAST(sum(m) AS BIGINT) AS tot, CAST(ceil(0.25::DOUBLE * sum(m)) AS BIGINT) AS n_out FROM k1),
a2 AS (SELECT y_, n, m, CAST(m * (tot - n_out) AS DOUBLE) / tot AS cont,
              floor(CAST(m * (tot - n_out) AS DOUBLE) / tot) AS fl, tot - n_out AS n_keep FROM k1, t2),
b2 AS (SELECT *, row_number() OVER (ORDER BY cont - fl DESC, y_) AS pos,
              n_keep - sum(fl) OVER () AS need FROM a2),
q AS (SELECT y_, n - m AS t, m - (CAST(fl AS BIGINT) + CASE WHEN pos <= need THEN 1 ELSE 0 END) AS v FROM b2),
r AS (SELECT *, row_number() OVER (PARTITION BY y_ ORDER BY hk) AS rk FROM h)
SELECT {out_cols},
       CASE WHEN rk <= t THEN 'test' WHEN rk <= t + v THEN 'validation' ELSE 'train' END AS split
FROM r JOIN q ON r.y_ = q.y_
"""


def q_split_stratified(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.split_exact(o, "o_orderkey", SEED, stratify="o_orderstatus")


SQL_SPLIT_STRATIFIED = stratified_split_sql("orders", "o_orderkey", "o_orderstatus",
                                            "o_orderkey, o_orderstatus")


def q_split_stratified_labels(spark, d):
    df = docs_labelled(spark, d).select("doc_id", "quality", "lang")
    return sampling.split_exact(df, "doc_id", SEED, stratify="quality")


SQL_SPLIT_STRATIFIED_LABELS = stratified_split_sql(
    DOCS_LABELLED, "doc_id", "quality", "doc_id, quality, lang")


def q_split_with_test_file(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    main = c.where(F.col("c_mktsegment") != "BUILDING")
    test = c.where(F.col("c_mktsegment") == "BUILDING")
    return sampling.split_with_files(main, "c_custkey", test_df=test, seed=SEED)


SQL_SPLIT_WITH_TEST_FILE = f"""
WITH h AS (SELECT c_custkey, c_mktsegment, {_md5('c_custkey')} AS hk FROM customer
           WHERE c_mktsegment <> 'BUILDING'),
q AS (SELECT CAST(ceil(0.25::DOUBLE * count(*)) AS BIGINT) AS v FROM h),
r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY hk) AS rk FROM h)
SELECT c_custkey, c_mktsegment, CASE WHEN rk <= v THEN 'validation' ELSE 'train' END AS split FROM r, q
UNION ALL
SELECT c_custkey, c_mktsegment, 'test' AS split FROM customer WHERE c_mktsegment = 'BUILDING'
"""


# ------------------------------------------------------------------ C5, D5, G3

def q_class_counts(spark, d):
    counts = stats.class_counts(t(spark, d, "labels"), "quality")
    return spark.createDataFrame(sorted(counts.items()), "quality int, n_rows bigint")


SQL_CLASS_COUNTS = "SELECT quality, CAST(count(*) AS BIGINT) AS n_rows FROM labels GROUP BY quality"

_OS_HEAD = f"""
WITH c AS (SELECT quality AS y, count(*) AS n FROM labels GROUP BY quality),
mj AS (SELECT y, n FROM c ORDER BY n DESC, y LIMIT 1),
k AS (SELECT c.y AS ym, c.n AS nm,
             CAST(trunc((SELECT n FROM mj) * 1.0::DOUBLE - c.n) AS BIGINT) AS k
      FROM c WHERE c.y <> (SELECT y FROM mj)),
ranked AS (SELECT l.doc_id, l.quality, l.toxic,
                  row_number() OVER (ORDER BY {_md5('l.doc_id')}) AS rk
           FROM labels l WHERE l.quality = (SELECT ym FROM k))
"""


def q_oversample_random(spark, d):
    lab = t(spark, d, "labels").select("doc_id", "quality", "toxic")
    return sampling.oversample(lab, "quality", "doc_id", 1.0, SEED, mode="random")


SQL_OVERSAMPLE_RANDOM = _OS_HEAD + f""",
dr AS (SELECT i AS oversample_draw,
              CAST(floor(('0x' || substr(md5(concat_ws('|', '{SEED}', 'draw', CAST(i AS VARCHAR))), 1, 13))::BIGINT
                         / 4503599627370496.0::DOUBLE * nm) AS BIGINT) + 1 AS rk
       FROM (SELECT unnest(range(k)) AS i, nm FROM k))
SELECT doc_id, quality, toxic, CAST(NULL AS BIGINT) AS oversample_draw FROM labels
UNION ALL
SELECT ranked.doc_id, ranked.quality, ranked.toxic, dr.oversample_draw FROM dr JOIN ranked ON dr.rk = ranked.rk
"""


def q_oversample_even(spark, d):
    lab = t(spark, d, "labels").select("doc_id", "quality", "toxic")
    return sampling.oversample(lab, "quality", "doc_id", 1.0, SEED, mode="even")


SQL_OVERSAMPLE_EVEN = _OS_HEAD + """,
cp AS (SELECT ranked.*, k // nm + CASE WHEN rk <= k % nm THEN 1 ELSE 0 END AS copies FROM ranked, k)
SELECT doc_id, quality, toxic, CAST(NULL AS BIGINT) AS oversample_draw FROM labels
UNION ALL
SELECT doc_id, quality, toxic, CAST(unnest(range(1, copies + 1)) AS BIGINT) AS oversample_draw
FROM cp WHERE copies > 0
"""


def q_row_budget(spark, d):
    up = q_oversample_even(spark, d)
    from tabprep.operators.synth import row_budget
    n = up.agg(F.count(F.lit(1)).alias("n_source"))
    return n.select("n_source", row_budget(F.col("n_source"), 1.0).alias("n_generate"),
                    row_budget(F.col("n_source"), 0.37).alias("n_generate_partial"))


SQL_ROW_BUDGET = f"""
WITH up AS ({SQL_OVERSAMPLE_EVEN})
SELECT CAST(count(*) AS BIGINT) AS n_source,
       CAST(floor(count(*) * 1.0::DOUBLE) AS BIGINT) AS n_generate,
       CAST(floor(count(*) * 0.37::DOUBLE) AS BIGINT) AS n_generate_partial
FROM up
"""


# ------------------------------------------------------------------ E1-E4, C6, C10, C11

def q_pr_curve(spark, d):
    curve, P, N = metrics.pr_curve(scored_labels(spark, d), "y", "score")
    return curve.select("threshold", "pos", "neg", "tp", "fp", rnd(F.col("precision")).alias("precision"),
                        rnd(F.col("recall")).alias("recall"),
                        (~((F.col("precision") == 0) & (F.col("recall") == 0))).alias("kept"))


_CURVE = f"""
WITH s AS {SCORED},
p AS (SELECT score AS threshold, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
             CAST(sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM s GROUP BY score),
tot AS (SELECT CAST(sum(pos) AS BIGINT) AS P, CAST(sum(neg) AS BIGINT) AS N FROM p),
c AS (SELECT p.*, CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
             CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp FROM p),
cv AS (SELECT c.*, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
              CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) AS recall, P, N FROM c, tot)
"""

SQL_PR_CURVE = _CURVE + """
SELECT threshold, pos, neg, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall,
       NOT (precision = 0 AND recall = 0) AS kept
FROM cv
"""

_BEST = """
best AS (SELECT threshold, (2 * (precision * recall)) / (precision + recall) AS f1, precision, recall,
                tp, fp, P, N
         FROM cv WHERE NOT (precision = 0 AND recall = 0)
         ORDER BY f1 DESC, threshold ASC LIMIT 1)
"""


def q_best_f1(spark, d):
    curve, P, N = metrics.pr_curve(scored_labels(spark, d), "y", "score")
    b = metrics.best_f1(curve, P, N)
    return b.select("threshold", rnd(F.col("f1")).alias("f1"), rnd(F.col("precision")).alias("precision"),
                    rnd(F.col("recall")).alias("recall"), "tn", "fp", "fn", "tp")


SQL_BEST_F1 = _CURVE + "," + _BEST + """
SELECT threshold, round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall,
       CAST(N - fp AS BIGINT) AS tn, fp, CAST(P - tp AS BIGINT) AS fn, tp
FROM best
"""


def q_roc_auc(spark, d):
    curve, P, N = metrics.pr_curve(scored_labels(spark, d), "y", "score")
    return metrics.auc_terms(curve, P, N).select(rnd(F.col("auc")).alias("auc"))


_AUC = """
au AS (SELECT sum(CAST(neg AS DOUBLE) * (2.0::DOUBLE * tp - pos)) / (2.0::DOUBLE * max(P) * max(N)) AS auc,
              sum(CAST(pos AS DOUBLE) * precision) / max(P) AS aucpr FROM cv)
"""

SQL_ROC_AUC = _CURVE + "," + _AUC + "SELECT round(auc, 6) AS auc FROM au"


def q_average_precision(spark, d):
    curve, P, N = metrics.pr_curve(scored_labels(spark, d), "y", "score")
    return metrics.auc_terms(curve, P, N).select(rnd(F.col("aucpr")).alias("aucpr"))


SQL_AVERAGE_PRECISION = _CURVE + "," + _AUC + "SELECT round(aucpr, 6) AS aucpr FROM au"


def q_classification_report(spark, d):
    r = metrics.classification_report(scored_labels(spark, d), "y", "score")
    return r.select(rnd(F.col("auc")).alias("auc"), rnd(F.col("aucpr")).alias("aucpr"),
                    rnd(F.col("precision")).alias("precision"), rnd(F.col("recall")).alias("recall"),
                    rnd(F.col("f1")).alias("f1"), "threshold", "tn", "fp", "fn", "tp")


SQL_CLASSIFICATION_REPORT = _CURVE + "," + _BEST + "," + _AUC + """
SELECT round(auc, 6) AS auc, round(aucpr, 6) AS aucpr, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1, threshold,
       CAST(N - fp AS BIGINT) AS tn, fp, CAST(P - tp AS BIGINT) AS fn, tp
FROM best, au
"""


# ------------------------------------------------------------------ C8, C9, C12

def q_regression_report(spark, d):
    r = metrics.regression_report(lineitem_pred(spark, d), "y", "pred")
    return r.select(*[rnd(F.col(c)).alias(c) for c in
                      ("mse", "mae", "rmse", "R2", "mse_std", "mae_std", "rmse_std")],
                    # ill-conditioned: rows with y within ulps of the mean give ratios
                    # of 1e6..1e10, so the last digits follow the summation order of
                    # the mean; compare 4 significant digits
                    sig4(F.col("R2_std")).alias("R2_std"))


SQL_REGRESSION_REPORT = f"""
WITH b AS {LINEITEM_PRED},
m AS (SELECT avg(y) AS ybar FROM b),
e AS (SELECT (y - pred) * (y - pred) AS e2, abs(y - pred) AS ae, (y - ybar) * (y - ybar) AS d2 FROM b, m),
a AS (SELECT avg(e2) AS mse, avg(ae) AS mae, stddev_pop(e2) AS mse_std, stddev_pop(ae) AS mae_std,
             sum(e2) AS sse, sum(d2) AS sst,
             stddev_pop(CASE WHEN d2 <> 0 THEN 1.0::DOUBLE - e2 / d2 END) AS r2_std FROM e)
SELECT round(mse, 6) AS mse, round(mae, 6) AS mae, round(sqrt(mse), 6) AS rmse,
       round(CASE WHEN sst <> 0 THEN 1.0::DOUBLE - sse / sst WHEN sse = 0 THEN 1.0 ELSE 0.0 END, 6) AS "R2",
       round(mse_std, 6) AS mse_std, round(mae_std, 6) AS mae_std, round(mae_std, 6) AS rmse_std,
       CASE WHEN r2_std > 0 THEN round(r2_std / power(10, floor(log10(r2_std)) - 3))
                                 * power(10, floor(log10(r2_std)) - 3) END AS "R2_std"
FROM a
"""


# ------------------------------------------------------------------ F1, F2, H10

TRIAL_COEFS = [1.0, 1.25, 1.5, 1.75, 2.0]


def q_best_trial(spark, d):
    from tabprep.operators.publish import best_trial
    li = t(spark, d, "lineitem").select((F.col("l_extendedprice") / 1000.0).alias("y"), "l_quantity")
    grid = F.array(*[F.struct(F.lit(i).alias("trial"), F.lit(c).alias("coef"))
                     for i, c in enumerate(TRIAL_COEFS)])
    trials = (li.select("y", "l_quantity", F.explode(grid).alias("g"))
              .select("y", "l_quantity", "g.trial", "g.coef")
              .groupBy("trial", "coef")
              .agg(F.avg((F.col("y") - F.col("coef") * F.col("l_quantity")) ** 2).alias("mse")))
    best = best_trial(trials, "mse", maximize=False)
    return best.select("trial", "coef", rnd(F.col("mse")).alias("mse"))


SQL_BEST_TRIAL = f"""
WITH g AS (SELECT * FROM (VALUES {", ".join(f"({i}, {c}::DOUBLE)" for i, c in enumerate(TRIAL_COEFS))}) v(trial, coef)),
tr AS (SELECT trial, coef, avg(power(l_extendedprice / 1000.0::DOUBLE - coef * l_quantity, 2)) AS mse
       FROM lineitem, g GROUP BY trial, coef)
SELECT CAST(trial AS INTEGER) AS trial, coef, round(mse, 6) AS mse FROM tr ORDER BY mse ASC, trial ASC LIMIT 1
"""


def q_metric_gate(spark, d):
    from tabprep.operators.publish import gate
    rep = metrics.report_struct(metrics.regression_report(lineitem_pred(spark, d), "y", "pred"),
                                names=("mse", "mae", "rmse", "R2"))
    return gate(rep, "rmse", 6.0, maximize=False).select(
        "metric", rnd(F.col("value")).alias("value"), "threshold", "passed")


SQL_METRIC_GATE = f"""
WITH b AS {LINEITEM_PRED}
SELECT 'rmse' AS metric, round(sqrt(avg((y - pred) * (y - pred))), 6) AS value, 6.0::DOUBLE AS threshold,
       sqrt(avg((y - pred) * (y - pred))) <= 6.0 AS passed
FROM b
"""


# ------------------------------------------------------------------ flagship

def flagship(spark, d):
    """documents x labels -> label codes -> fitted preprocessor -> exact
    stratified split -> per split: rows, positives and mean of each encoded
    numeric feature."""
    df = docs_labelled(spark, d)
    enc = features.fit_label_encoding(df, "quality")
    df = df.withColumn("quality", enc.code())
    split = sampling.split_exact(df, "doc_id", SEED, stratify="quality")
    fitted = features.TabularPreprocessor(["lang", "source", "n_chars"]).fit(
        split.where(F.col("split") == "train"))
    enc_rows = fitted.transform(split, keep=["doc_id", "quality", "split"])
    return (enc_rows.groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("quality").alias("n_positive"),
                 rnd(F.avg("num__n_chars")).alias("mean_num__n_chars"))
            .withColumn("n_features", F.lit(len(fitted.feature_names()))))


# ------------------------------------------------------------------ G5, G6, G7

def _u_sql(salt: str, id_col: str) -> str:
    return (f"(('0x' || substr(md5(concat_ws('|', '{SEED}', '{salt}', CAST({id_col} AS VARCHAR))), 1, 13))::BIGINT"
            f" / 4503599627370496.0::DOUBLE)")


def q_synth_independent(spark, d):
    from tabprep.operators.synthesizer import IndependentSynthesizer
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    fitted = IndependentSynthesizer("c_mktsegment", ["c_custkey"], SEED,
                                    columns=["c_nationkey", "c_acctbal"]).fit(c)
    n = sum(fitted.counts.values())
    return fitted.generate(spark, n)


SQL_SYNTH_INDEPENDENT = f"""
WITH src AS (SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer),
cc AS (SELECT c_mktsegment AS y, count(*) AS n FROM src GROUP BY c_mktsegment),
cum AS (SELECT y, n, sum(n) OVER (ORDER BY y) - n AS lo, sum(n) OVER (ORDER BY y) AS hi FROM cc),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM cc),
ids AS (SELECT unnest(range(total)) AS synth_id FROM tot),
cls AS (SELECT synth_id, CAST(floor({_u_sql('class', 'synth_id')} * total) AS BIGINT) AS r FROM ids, tot),
dc AS (SELECT cls.synth_id, cum.y, cum.n FROM cls JOIN cum ON cls.r >= cum.lo AND cls.r < cum.hi),
ranked AS (SELECT src.*, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {_md5('c_custkey')}) AS rk
           FROM src)
SELECT dc.synth_id, a.c_nationkey, b.c_acctbal, dc.y AS c_mktsegment
FROM dc
JOIN ranked a ON a.c_mktsegment = dc.y
             AND a.rk = CAST(floor({_u_sql('c_nationkey', 'dc.synth_id')} * dc.n) AS BIGINT) + 1
JOIN ranked b ON b.c_mktsegment = dc.y
             AND b.rk = CAST(floor({_u_sql('c_acctbal', 'dc.synth_id')} * dc.n) AS BIGINT) + 1
"""


def q_synth_sample_report(spark, d):
    """G7: the 50 synthetic rows with the smallest hash of their id."""
    gen = q_synth_independent(spark, d)
    return sampling.sample_rows(gen, "synth_id", 50, SEED)


SQL_SYNTH_SAMPLE_REPORT = f"""
WITH g AS ({SQL_SYNTH_INDEPENDENT})
SELECT * FROM g ORDER BY {_md5('synth_id')}, synth_id LIMIT 50
"""


def q_synth_copula(spark, d):
    from tabprep.operators.synthesizer import CopulaSynthesizer
    o = t(spark, d, "orders").select("o_orderstatus", "o_totalprice", "o_orderpriority",
                                     F.dayofyear("o_orderdate").alias("o_dayofyear"))
    fitted = CopulaSynthesizer("o_orderstatus", SEED).fit(o)
    return fitted.generate(spark, sum(fitted.counts.values()))


def q_synth_quality(spark, d):
    from tabprep.operators.synthesizer import quality_by_column
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    real = o.where(F.col("o_orderkey") % 2 == 0)
    synth = o.where(F.col("o_orderkey") % 2 == 1)
    q = quality_by_column(real, synth, ["o_totalprice", "o_orderstatus", "o_orderpriority"])
    return q.select("column", "kind", rnd(F.col("js_distance")).alias("js_distance"))


def _cells_sql(src: str, side: str) -> str:
    return f"""
  SELECT '{side}' AS side, 'o_totalprice' AS col,
         CASE WHEN o_totalprice IS NULL THEN 'null' WHEN o_totalprice < lo THEN 'below' WHEN o_totalprice > hi THEN 'above'
              ELSE CAST(CAST(least(floor((o_totalprice - lo) / (CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END) * 20), 19)
                        AS BIGINT) AS VARCHAR) END AS cell FROM {src}, mm
  UNION ALL SELECT '{side}', 'o_orderstatus', coalesce(o_orderstatus, 'null') FROM {src}
  UNION ALL SELECT '{side}', 'o_orderpriority', coalesce(o_orderpriority, 'null') FROM {src}"""


SQL_SYNTH_QUALITY = f"""
WITH r AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0),
s AS (SELECT * FROM orders WHERE o_orderkey % 2 = 1),
mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM r),
cells AS ({_cells_sql('r', 'real')} UNION ALL {_cells_sql('s', 'synth')}),
cnt AS (SELECT col, cell, sum(CASE WHEN side = 'real' THEN 1 ELSE 0 END) AS nr,
               sum(CASE WHEN side = 'synth' THEN 1 ELSE 0 END) AS ns FROM cells GROUP BY col, cell),
pr AS (SELECT col, CAST(nr AS DOUBLE) / sum(nr) OVER (PARTITION BY col) AS p,
              CAST(ns AS DOUBLE) / sum(ns) OVER (PARTITION BY col) AS q FROM cnt)
SELECT col AS "column", CASE WHEN col = 'o_totalprice' THEN 'numeric' ELSE 'categorical' END AS kind,
       round(sqrt(greatest(sum(0.5 * CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                             + 0.5 * CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END), 0)), 6)
         AS js_distance
FROM pr GROUP BY col
"""


def q_augment_training(spark, d):
    """G2-G4: documents x labels, train split, balance strategy (over-sample
    then synthesize), union with origin tags."""
    from tabprep.operators.synthesizer import augment_training
    df = docs_labelled(spark, d).select("doc_id", "quality", "lang", "source", "n_chars")
    train = sampling.split_exact(df, "doc_id", SEED, stratify="quality") \
        .where(F.col("split") == "train").drop("split")
    return augment_training(spark, train, "quality", "doc_id", "balance", 1.0, 1.0, SEED)


EXTRA = {
    "synth_independent": (q_synth_independent, SQL_SYNTH_INDEPENDENT),
    "synth_sample_report": (q_synth_sample_report, SQL_SYNTH_SAMPLE_REPORT),
    "synth_copula": (q_synth_copula, None),
    "synth_quality": (q_synth_quality, SQL_SYNTH_QUALITY),
    "augment_training": (q_augment_training, None),
}


# ------------------------------------------------------------------ I1-I9, F1-F3 (rows only)

def q_train_score_gate(spark, d):
    """The whole job on documents x labels: balance + synthesize, tune GBT
    (small search space: 2 trials of 5-10 rounds), refit, report on the
    test split, gate on average precision."""
    from tabprep.operators.training import SearchSpace
    from tabprep.plans.workflow import run_workflow
    from tabprep.spec import TabularSpec
    df = docs_labelled(spark, d).select("doc_id", "quality", "lang", "source", "n_chars")
    spec = TabularSpec(target_column="quality", ml_task="classification", key_column="doc_id",
                       ml_eval_metric="aucpr", ml_metric_threshold=0.0, strategy="balance")
    space = SearchSpace(max_depth=(2, 4), num_round=(5, 10))
    res = run_workflow(spark, df, spec, space=space, n_trials=2, parallelism=2)
    from tabprep.operators.publish import gate
    flat = res.report
    rep = flat.select(metrics.metrics_struct(flat).alias("metrics"), rnd(F.col("auc")).alias("auc"),
                      rnd(F.col("f1")).alias("f1"), "tn", "fp", "fn", "tp")
    return gate(rep, spec.ml_eval_metric, spec.ml_metric_threshold, spec.maximize,
                keep=["auc", "f1", "tn", "fp", "fn", "tp"])


EXTRA["train_score_gate"] = (q_train_score_gate, None)


# ------------------------------------------------------------------ B9, C10 at a threshold

def q_confusion_at_threshold(spark, d):
    """Hard labels at the best-F1 threshold, counted row by row."""
    sc = scored_labels(spark, d)
    curve, P, N = metrics.pr_curve(sc, "y", "score")
    t_best = metrics.best_f1(curve, P, N).first()["threshold"]
    return metrics.confusion_at(sc, "y", "score", t_best).select(
        F.lit(t_best).alias("threshold"), "tn", "fp", "fn", "tp")


SQL_CONFUSION_AT_THRESHOLD = _CURVE + "," + _BEST + f""",
s2 AS {SCORED}
SELECT max(best.threshold) AS threshold,
       CAST(count(*) FILTER (WHERE y = 0 AND score < best.threshold) AS BIGINT) AS tn,
       CAST(count(*) FILTER (WHERE y = 0 AND score >= best.threshold) AS BIGINT) AS fp,
       CAST(count(*) FILTER (WHERE y = 1 AND score < best.threshold) AS BIGINT) AS fn,
       CAST(count(*) FILTER (WHERE y = 1 AND score >= best.threshold) AS BIGINT) AS tp
FROM s2, best
"""


# ------------------------------------------------------------------ H5/H6 fitted on train rows only

def q_preprocess_fit_train(spark, d):
    """Fit the preprocessor on the train split only (no test leakage), then
    encode every row; long form."""
    df = docs_labelled(spark, d).select("doc_id", "quality", "lang", "n_chars")
    split = sampling.split_exact(df, "doc_id", SEED, stratify="quality")
    fitted = features.TabularPreprocessor(["lang", "n_chars"]).fit(split.where(F.col("split") == "train"))
    long = _long(fitted.transform(split, keep=["doc_id", "split"]), ["doc_id", "split"])
    return long.withColumn("value", rnd(F.col("value")))


SQL_PREPROCESS_FIT_TRAIN = f"""
WITH sp AS ({stratified_split_sql(DOCS_LABELLED, "doc_id", "quality", "doc_id, lang, n_chars")}),
tr AS (SELECT * FROM sp WHERE split = 'train'),
m AS (SELECT median(n_chars) AS med FROM tr),
mom AS (SELECT avg(coalesce(CAST(n_chars AS DOUBLE), med)) AS mu,
               stddev_pop(coalesce(CAST(n_chars AS DOUBLE), med)) AS sd FROM tr, m),
lv AS (SELECT DISTINCT coalesce(lang, 'missing') AS level FROM tr)
SELECT doc_id, split, 'num__n_chars' AS feature,
       round((coalesce(CAST(n_chars AS DOUBLE), med) - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS value
FROM sp, m, mom
UNION ALL
SELECT doc_id, split, 'cat__lang_' || level AS feature,
       CAST(coalesce(lang, 'missing') = level AS DOUBLE) AS value
FROM sp, lv
"""


# ------------------------------------------------------------------ G6 summary

def q_synth_quality_summary(spark, d):
    from tabprep.operators.synthesizer import quality_summary
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    real = o.where(F.col("o_orderkey") % 2 == 0)
    synth = o.where(F.col("o_orderkey") % 2 == 1)
    q = quality_summary(real, synth, ["o_custkey", "o_totalprice", "o_orderstatus"])
    return q.select(*[rnd(F.col(c)).alias(c) for c in q.columns])


def _cells2_sql(src: str, side: str) -> str:
    parts = []
    for c in ("o_custkey", "o_totalprice"):
        parts.append(f"""
  SELECT '{side}' AS side, '{c}' AS col,
         CASE WHEN {c} IS NULL THEN 'null' WHEN {c} < lo_{c} THEN 'below' WHEN {c} > hi_{c} THEN 'above'
              ELSE CAST(CAST(least(floor((CAST({c} AS DOUBLE) - lo_{c})
                  / (CASE WHEN hi_{c} > lo_{c} THEN hi_{c} - lo_{c} ELSE 1.0 END) * 20), 19) AS BIGINT)
                  AS VARCHAR) END AS cell FROM {src}, mm""")
    parts.append(f"\n  SELECT '{side}', 'o_orderstatus', coalesce(o_orderstatus, 'null') FROM {src}")
    return " UNION ALL".join(parts)


SQL_SYNTH_QUALITY_SUMMARY = f"""
WITH r AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0),
s AS (SELECT * FROM orders WHERE o_orderkey % 2 = 1),
mm AS (SELECT CAST(min(o_custkey) AS DOUBLE) AS lo_o_custkey, CAST(max(o_custkey) AS DOUBLE) AS hi_o_custkey,
              min(o_totalprice) AS lo_o_totalprice, max(o_totalprice) AS hi_o_totalprice FROM r),
cells AS ({_cells2_sql('r', 'real')} UNION ALL {_cells2_sql('s', 'synth')}),
cnt AS (SELECT col, cell, sum(CASE WHEN side = 'real' THEN 1 ELSE 0 END) AS nr,
               sum(CASE WHEN side = 'synth' THEN 1 ELSE 0 END) AS ns FROM cells GROUP BY col, cell),
pr AS (SELECT col, CAST(nr AS DOUBLE) / sum(nr) OVER (PARTITION BY col) AS p,
              CAST(ns AS DOUBLE) / sum(ns) OVER (PARTITION BY col) AS q FROM cnt),
js AS (SELECT col, sqrt(greatest(sum(0.5 * CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                                    + 0.5 * CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END), 0)) AS d
       FROM pr GROUP BY col),
cs AS (SELECT 100.0 * (1.0 - avg(d)) AS column_similarity FROM js),
cr AS (SELECT 100.0 * (1.0 - abs((SELECT corr(o_custkey, o_totalprice) FROM r)
                               - (SELECT corr(o_custkey, o_totalprice) FROM s)) / 2.0) AS correlation_similarity)
SELECT round(column_similarity, 6) AS column_similarity, round(correlation_similarity, 6) AS correlation_similarity,
       round((column_similarity + correlation_similarity) / 2, 6) AS overall
FROM cs, cr
"""

EXTRA["confusion_at_threshold"] = (q_confusion_at_threshold, SQL_CONFUSION_AT_THRESHOLD)
EXTRA["preprocess_fit_train"] = (q_preprocess_fit_train, SQL_PREPROCESS_FIT_TRAIN)
EXTRA["synth_quality_summary"] = (q_synth_quality_summary, SQL_SYNTH_QUALITY_SUMMARY)


# ------------------------------------------------------------------ parameter variants

def q_oversample_even_half(spark, d):
    """Over-sample the minority class to half the majority (ratio 0.5)."""
    lab = t(spark, d, "labels").select("doc_id", "quality", "toxic")
    return sampling.oversample(lab, "quality", "doc_id", 0.5, SEED, mode="even")


SQL_OVERSAMPLE_EVEN_HALF = _OS_HEAD.replace("* 1.0::DOUBLE", "* 0.5::DOUBLE") + """,
cp AS (SELECT ranked.*, k // nm + CASE WHEN rk <= k % nm THEN 1 ELSE 0 END AS copies FROM ranked, k)
SELECT doc_id, quality, toxic, CAST(NULL AS BIGINT) AS oversample_draw FROM labels
UNION ALL
SELECT doc_id, quality, toxic, CAST(unnest(range(1, copies + 1)) AS BIGINT) AS oversample_draw
FROM cp WHERE copies > 0
"""


def q_split_stratified_segments(spark, d):
    """Five-class stratified split (customer market segments)."""
    c = t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return sampling.split_exact(c, "c_custkey", SEED, stratify="c_mktsegment")


SQL_SPLIT_STRATIFIED_SEGMENTS = stratified_split_sql("customer", "c_custkey", "c_mktsegment",
                                                     "c_custkey, c_mktsegment")

EXTRA["oversample_even_half"] = (q_oversample_even_half, SQL_OVERSAMPLE_EVEN_HALF)
EXTRA["split_stratified_segments"] = (q_split_stratified_segments, SQL_SPLIT_STRATIFIED_SEGMENTS)


def q_synth_copula_class_counts(spark, d):
    """Class sizes of copula-generated orders: the class of row i is drawn
    from the real class shares with the md5 uniform of (seed, 'class', i)."""
    from tabprep.operators.synthesizer import CopulaSynthesizer
    o = t(spark, d, "orders").select("o_orderstatus", "o_totalprice", "o_orderpriority")
    fitted = CopulaSynthesizer("o_orderstatus", SEED).fit(o)
    gen = fitted.generate(spark, sum(fitted.counts.values()))
    return gen.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


SQL_SYNTH_COPULA_CLASS_COUNTS = f"""
WITH cc AS (SELECT o_orderstatus AS y, count(*) AS n FROM orders GROUP BY o_orderstatus),
cum AS (SELECT y, sum(n) OVER (ORDER BY y) - n AS lo, sum(n) OVER (ORDER BY y) AS hi FROM cc),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM cc),
ids AS (SELECT unnest(range(total)) AS synth_id FROM tot),
cls AS (SELECT CAST(floor({_u_sql('class', 'synth_id')} * total) AS BIGINT) AS r FROM ids, tot)
SELECT cum.y AS o_orderstatus, CAST(count(*) AS BIGINT) AS n_rows
FROM cls JOIN cum ON cls.r >= cum.lo AND cls.r < cum.hi GROUP BY cum.y
"""

EXTRA["synth_copula_class_counts"] = (q_synth_copula_class_counts, SQL_SYNTH_COPULA_CLASS_COUNTS)


def q_augment_origin_counts(spark, d):
    """Rows per (origin, class) after the balance strategy: the train split,
    the over-sampled copies, and the synthetic rows' class draw."""
    return q_augment_training(spark, d).groupBy("origin", "quality") \
        .agg(F.count(F.lit(1)).alias("n_rows"))


SQL_AUGMENT_ORIGIN_COUNTS = f"""
WITH sp AS ({stratified_split_sql(DOCS_LABELLED, "doc_id", "quality", "doc_id, quality")}),
c AS (SELECT quality AS y, count(*) AS n FROM sp WHERE split = 'train' GROUP BY quality),
mj AS (SELECT y, n FROM c ORDER BY n DESC, y LIMIT 1),
k AS (SELECT c.y AS ym, CAST(trunc((SELECT n FROM mj) * 1.0::DOUBLE - c.n) AS BIGINT) AS k
      FROM c WHERE c.y <> (SELECT y FROM mj)),
c2 AS (SELECT c.y, c.n + coalesce((SELECT k FROM k WHERE k.ym = c.y), 0) AS n FROM c),
cum AS (SELECT y, sum(n) OVER (ORDER BY y) - n AS lo, sum(n) OVER (ORDER BY y) AS hi FROM c2),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM c2),
ids AS (SELECT unnest(range(CAST(floor(total * 1.0::DOUBLE) AS BIGINT))) AS synth_id FROM tot),
cls AS (SELECT CAST(floor({_u_sql('class', 'synth_id')} * total) AS BIGINT) AS r FROM ids, tot),
syn AS (SELECT cum.y, count(*) AS n FROM cls JOIN cum ON cls.r >= cum.lo AND cls.r < cum.hi GROUP BY cum.y)
SELECT 'real' AS origin, y AS quality, CAST(n AS BIGINT) AS n_rows FROM c
UNION ALL SELECT 'oversampled', ym, k FROM k WHERE k > 0
UNION ALL SELECT 'synthetic', y, CAST(n AS BIGINT) FROM syn
"""

EXTRA["augment_origin_counts"] = (q_augment_origin_counts, SQL_AUGMENT_ORIGIN_COUNTS)


# ------------------------------------------------------------------ registry

# query name -> (Spark builder, SQL twin or None for a rows-only check)
REGISTRY = {
    "normalize_na_tokens": (q_normalize_na_tokens, SQL_NORMALIZE_NA_TOKENS),
    "drop_and_type_columns": (q_drop_and_type_columns, SQL_DROP_AND_TYPE_COLUMNS),
    "union_real_synthetic": (q_union_real_synthetic, SQL_UNION_REAL_SYNTHETIC),
    "impute_median": (q_impute_median, SQL_IMPUTE_MEDIAN),
    "standardize": (q_standardize, SQL_STANDARDIZE),
    "impute_constant_onehot": (q_impute_constant_onehot, SQL_IMPUTE_CONSTANT_ONEHOT),
    "onehot_unseen": (q_onehot_unseen, SQL_ONEHOT_UNSEEN),
    "encode_label": (q_encode_label, SQL_ENCODE_LABEL),
    "preprocess_full": (q_preprocess_full, SQL_PREPROCESS_FULL),
    "shuffle_rows": (q_shuffle_rows, SQL_SHUFFLE_ROWS),
    "sample_rows": (q_sample_rows, SQL_SAMPLE_ROWS),
    "split_random": (q_split_random, SQL_SPLIT_RANDOM),
    "split_stratified": (q_split_stratified, SQL_SPLIT_STRATIFIED),
    "split_stratified_labels": (q_split_stratified_labels, SQL_SPLIT_STRATIFIED_LABELS),
    "split_with_test_file": (q_split_with_test_file, SQL_SPLIT_WITH_TEST_FILE),
    "class_counts": (q_class_counts, SQL_CLASS_COUNTS),
    "oversample_random": (q_oversample_random, SQL_OVERSAMPLE_RANDOM),
    "oversample_even": (q_oversample_even, SQL_OVERSAMPLE_EVEN),
    "row_budget": (q_row_budget, SQL_ROW_BUDGET),
    "pr_curve": (q_pr_curve, SQL_PR_CURVE),
    "best_f1": (q_best_f1, SQL_BEST_F1),
    "roc_auc": (q_roc_auc, SQL_ROC_AUC),
    "average_precision": (q_average_precision, SQL_AVERAGE_PRECISION),
    "classification_report": (q_classification_report, SQL_CLASSIFICATION_REPORT),
    "regression_report": (q_regression_report, SQL_REGRESSION_REPORT),
    "best_trial": (q_best_trial, SQL_BEST_TRIAL),
    "metric_gate": (q_metric_gate, SQL_METRIC_GATE),
}
REGISTRY.update(EXTRA)


# ------------------------------------------------------------------ A1: typing of text columns

def q_infer_column_types(spark, d):
    """Orders as text, one column per kind of content; the types found."""
    key = F.col("o_orderkey")
    text = t(spark, d, "orders").select(
        key.cast("string").alias("whole"), F.col("o_totalprice").cast("string").alias("fraction"),
        F.col("o_orderstatus").alias("letter"), F.concat((key % 9).cast("string"), F.lit("d")).alias("suffixed"),
        F.when(key % 2 == 0, "True").otherwise("false").alias("flag"), F.lit(None).cast("string").alias("missing"),
        F.when(key % 3 == 0, None).otherwise(F.concat((key % 7).cast("string"), F.lit("e2"))).alias("scientific"),
        F.when(key % 5 == 0, "x1").otherwise(key.cast("string")).alias("mixed"))
    return spark.createDataFrame(infer_types(text).dtypes, "column string, type string")


_TYPING = {"whole": "CAST(o_orderkey AS VARCHAR)", "fraction": "CAST(o_totalprice AS VARCHAR)", "letter": "o_orderstatus",
           "suffixed": "(o_orderkey % 9) || 'd'", "flag": "CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'false' END",
           "missing": "CAST(NULL AS VARCHAR)",
           "scientific": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 7) || 'e2' END",
           "mixed": "CASE WHEN o_orderkey % 5 = 0 THEN 'x1' ELSE CAST(o_orderkey AS VARCHAR) END"}
SQL_INFER_COLUMN_TYPES = "\nUNION ALL\n".join(f"""
SELECT '{name}' AS "column", CASE WHEN count(v) = 0 THEN 'double'
  WHEN bool_and(v IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false')) THEN 'boolean'
  WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]+')) THEN 'bigint'
  WHEN bool_and(regexp_full_match(v, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')) THEN 'double'
  ELSE 'string' END AS type FROM (SELECT {sql} AS v FROM orders)""" for name, sql in _TYPING.items())


# ------------------------------------------------------------------ C11, C12: unscored rows

def q_score_coverage(spark, d):
    y = scored_labels(spark, d)
    lost = F.when(F.col("doc_id") % 11 == 0, None).when(F.col("doc_id") % 13 == 0, float("nan")).otherwise(F.col("score"))
    return metrics.score_coverage(y.withColumn("score", lost), "score")


SQL_SCORE_COVERAGE = f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (doc_id % 11 = 0 OR doc_id % 13 = 0) AS BIGINT) AS n_unscored FROM {SCORED}
"""


# ------------------------------------------------------------------ D4, H5: supplied files take no part in a fit

def q_supplied_file_statistics(spark, d):
    """Encoders of a job whose test file lies far outside the train source, and holds text for numbers."""
    from tabprep.plans.workflow import prepare
    from tabprep.session import scratch_path
    from tabprep.spec import TabularSpec
    o = orders_nulled(spark, d).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    main = o.where(F.col("o_orderkey") % 4 != 0)
    test = o.where(F.col("o_orderkey") % 4 == 0).withColumn(
        "o_totalprice", (F.col("o_totalprice") + 1e9).cast("string"))
    spec = TabularSpec(target_column="o_orderstatus", key_column="o_orderkey", seed=SEED)
    fitted = prepare(spark, main, spec, scratch_path(spark, "job"), test_df=test)
    rows = [(c, float(median), float(mean), float(std)) for c, median, mean, std in fitted.numeric]
    return spark.createDataFrame(rows, "feature string, median double, mean double, std double").select(
        "feature", rnd(F.col("median")).alias("median"), rnd(F.col("mean")).alias("mean"), rnd(F.col("std"), 4).alias("std"))


SQL_SUPPLIED_FILE_STATISTICS = f"""
WITH m AS (SELECT o_totalprice AS x FROM {ORDERS_NULLED} WHERE o_orderkey % 4 <> 0),
k AS (SELECT median(x) AS med FROM m)
SELECT 'o_totalprice' AS feature, round(any_value(med), 6) AS median, round(avg(coalesce(x, med)), 6) AS mean,
       round(stddev_pop(coalesce(x, med)), 4) AS std FROM m, k
"""


# ------------------------------------------------------------------ G6: pairwise-complete correlations at any width

_WIDE = 12


def _wide_column(i: int) -> str:
    """The same expression in Spark SQL and DuckDB: a mix of two columns, missing by rule."""
    return (f"CASE WHEN l_orderkey % {i + 3} = 0 THEN NULL ELSE "
            f"l_quantity * {i % 4} + l_extendedprice * {(i * 7) % 5} / 1000 + (l_partkey % {11 + i}) END")


def q_quality_summary_wide(spark, d):
    from tabprep.operators.synthesizer import pair_correlations
    li = t(spark, d, "lineitem").select("l_linenumber", *[
        F.expr(_wide_column(i)).cast("double").alias(f"c{i}") for i in range(_WIDE)])
    names = [f"c{i}" for i in range(_WIDE)]
    r = pair_correlations(li, names)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    return spark.createDataFrame([(a, b, None if v is None else float(v)) for (a, b), v in zip(pairs, r)],
                                 "a string, b string, r double").select("a", "b", rnd(F.col("r")).alias("r"))


SQL_QUALITY_SUMMARY_WIDE = "WITH w AS (SELECT " + ", ".join(
    f"CAST({_wide_column(i)} AS DOUBLE) AS c{i}" for i in range(_WIDE)) + " FROM lineitem)\n" + "\nUNION ALL\n".join(
    f"SELECT 'c{i}' AS a, 'c{j}' AS b, round(corr(c{i}, c{j}), 6) AS r FROM w" for i in range(_WIDE) for j in range(i + 1, _WIDE))


# ------------------------------------------------------------------ I1, I2, I7: one boosting step has a closed form

def _stump_rows(spark, d):
    """A feature of 7 values, a regression target and a binary label, from whole lineitem."""
    li = t(spark, d, "lineitem")
    x = F.col("l_linenumber").cast("double")
    y = F.col("l_quantity") + F.when(F.col("l_linenumber") >= 4, 20.0).otherwise(0.0)
    return li.select(x.alias("x"), y.cast("double").alias("y"), (y > 30).cast("double").alias("b"))


def _stump(spark, d, task: str, label: str):
    from pyspark.ml.feature import VectorAssembler
    from tabprep.operators import training
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(_stump_rows(spark, d))
    params = {"eta": 1.0, "max_depth": 1, "num_round": 1, "min_child_weight": 1.0}
    model = training.fit_model(rows, task, params, label_col=label, seed=SEED, engine="mllib")
    values = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows.select("x").distinct())
    return training.score(model, values, task).select("x", rnd(F.col("score")).alias("score"))


def q_stump_regression(spark, d):
    return _stump(spark, d, "regression", "y")


def q_stump_classification(spark, d):
    return _stump(spark, d, "classification", "b")


def _stump_sql(target: str, score: str) -> str:
    return f"""
WITH s AS (SELECT CAST(l_linenumber AS DOUBLE) AS x, CAST({target} AS DOUBLE) AS y FROM
  (SELECT l_linenumber, l_quantity + CASE WHEN l_linenumber >= 4 THEN 20.0 ELSE 0.0 END AS q FROM lineitem)),
v AS (SELECT DISTINCT x FROM s),
c AS (SELECT v.x AS cut, sum(s.y) FILTER (s.x <= v.x) AS sl, count(*) FILTER (s.x <= v.x) AS nl,
      sum(s.y) FILTER (s.x > v.x) AS sr, count(*) FILTER (s.x > v.x) AS nr FROM s, v GROUP BY v.x),
b AS (SELECT * FROM c WHERE nr > 0 ORDER BY sl * sl / nl + sr * sr / nr DESC, cut LIMIT 1)
SELECT v.x, round({score}, 6) AS score FROM (SELECT v.x, CASE WHEN v.x <= cut THEN sl / nl ELSE sr / nr END AS f FROM v, b) v
"""


SQL_STUMP_REGRESSION = _stump_sql("q", "f")
# the first tree fits labels of -1 and 1; the probability is 1 / (1 + exp(-2 f))
SQL_STUMP_CLASSIFICATION = _stump_sql("CASE WHEN q > 30 THEN 1 ELSE -1 END", "1 / (1 + exp(-2 * f))")

# ------------------------------------------------------------------ G2, G4: value-level twins of the strategies

def _train_labelled(spark, d):
    df = docs_labelled(spark, d).select("doc_id", "quality", "lang", "source", "n_chars")
    return sampling.split_exact(df, "doc_id", SEED, stratify="quality").where(F.col("split") == "train").drop("split")


def q_replace_training(spark, d):
    """The replace strategy: synthetic rows only, drawn per class and column from the train rows."""
    from tabprep.operators.synthesizer import augment_training
    return augment_training(spark, _train_labelled(spark, d), "quality", "doc_id", "replace", 1.0, 1.0, SEED)


_DRAWN = ("lang", "source", "n_chars")
_TRAIN_SQL = ("tr AS (SELECT doc_id, quality, lang, source, n_chars FROM ("
              + stratified_split_sql(DOCS_LABELLED, "doc_id", "quality", "doc_id, quality, lang, source, n_chars")
              + ") x WHERE split = 'train')")


def _synthetic_sql() -> str:
    """CTEs from ``src`` (rows with ``draw``) to ``syn``: as many synthetic rows."""
    joins = "\n".join(f"JOIN ranked t_{c} ON t_{c}.quality = dc.y AND t_{c}.rk = CAST(floor({_u_sql(c, 'dc.synth_id')} * dc.n) AS BIGINT) + 1"
                      for c in _DRAWN)
    return f"""
cc AS (SELECT quality AS y, count(*) AS n FROM src GROUP BY quality),
cum AS (SELECT y, n, sum(n) OVER (ORDER BY y) - n AS lo, sum(n) OVER (ORDER BY y) AS hi FROM cc),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM cc),
ids AS (SELECT unnest(range(total)) AS synth_id FROM tot),
cls AS (SELECT synth_id, CAST(floor({_u_sql('class', 'synth_id')} * total) AS BIGINT) AS r FROM ids, tot),
dc AS (SELECT cls.synth_id, cum.y, cum.n FROM cls JOIN cum ON cls.r >= cum.lo AND cls.r < cum.hi),
ranked AS (SELECT src.*, row_number() OVER (PARTITION BY quality ORDER BY
  md5(concat_ws('|', '{SEED}', CAST(doc_id AS VARCHAR), CAST(draw AS VARCHAR)))) AS rk FROM src),
syn AS (SELECT dc.synth_id, {', '.join(f't_{c}.{c}' for c in _DRAWN)}, dc.y AS quality, 'synthetic' AS origin FROM dc
{joins})"""


SQL_REPLACE_TRAINING = f"""
WITH {_TRAIN_SQL}, src AS (SELECT *, CAST(NULL AS BIGINT) AS draw FROM tr), {_synthetic_sql()}
SELECT * FROM syn
"""
SQL_AUGMENT_TRAINING = f"""
WITH {_TRAIN_SQL},
c AS (SELECT quality AS y, count(*) AS n FROM tr GROUP BY quality),
mj AS (SELECT y, n FROM c ORDER BY n DESC, y LIMIT 1),
k AS (SELECT c.y AS ym, c.n AS nm, CAST(trunc((SELECT n FROM mj) * 1.0::DOUBLE - c.n) AS BIGINT) AS k FROM c WHERE c.y <> (SELECT y FROM mj)),
mr AS (SELECT tr.*, row_number() OVER (ORDER BY {_md5('doc_id')}) AS rk FROM tr WHERE quality = (SELECT ym FROM k)),
dr AS (SELECT i AS draw, CAST(floor({_u_sql('draw', 'i')} * nm) AS BIGINT) + 1 AS rk FROM (SELECT unnest(range(k)) AS i, nm FROM k)),
src AS (SELECT *, CAST(NULL AS BIGINT) AS draw FROM tr UNION ALL
  SELECT doc_id, quality, lang, source, n_chars, draw FROM dr JOIN mr USING (rk)), {_synthetic_sql()}
SELECT doc_id, quality, lang, source, n_chars, CASE WHEN draw IS NULL THEN 'real' ELSE 'oversampled' END AS origin,
  CAST(NULL AS BIGINT) AS synth_id FROM src
UNION ALL SELECT CAST(NULL AS BIGINT), quality, lang, source, n_chars, origin, synth_id FROM syn
"""


# ------------------------------------------------------------------ C7, D3 with thousands of classes

def q_split_many_classes(spark, d):
    """A stratum per customer: thousands of classes, thresholds joined as a table."""
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    often = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n >= 10").select("o_custkey")
    return sampling.split_exact(o.join(often, "o_custkey").select("o_orderkey", "o_custkey"), "o_orderkey", SEED,
                                stratify="o_custkey")


SQL_SPLIT_MANY_CLASSES = stratified_split_sql(
    "(SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN "
    "(SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 10))",
    "o_orderkey", "o_custkey", "o_orderkey, o_custkey")


def q_encode_many_labels(spark, d):
    """Label codes of the part key's text: thousands of classes."""
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 13 == 0, None).otherwise(
        F.concat(F.lit("part "), F.col("l_partkey").cast("string"))).alias("part"))
    return features.encode_label(li, "part", "code")


SQL_ENCODE_MANY_LABELS = """
WITH b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE 'part ' || l_partkey END AS part FROM lineitem),
lv AS (SELECT part, CAST(row_number() OVER (ORDER BY part) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT part FROM b WHERE part IS NOT NULL))
SELECT b.l_orderkey, b.l_linenumber, b.part, coalesce(lv.code, -1) AS code FROM b LEFT JOIN lv ON b.part = lv.part
"""

REGISTRY.update({
    "replace_training": (q_replace_training, SQL_REPLACE_TRAINING),
    "augment_training": (q_augment_training, SQL_AUGMENT_TRAINING),
    "split_many_classes": (q_split_many_classes, SQL_SPLIT_MANY_CLASSES),
    "encode_many_labels": (q_encode_many_labels, SQL_ENCODE_MANY_LABELS),
    "infer_column_types": (q_infer_column_types, SQL_INFER_COLUMN_TYPES),
    "score_coverage": (q_score_coverage, SQL_SCORE_COVERAGE),
    "supplied_file_statistics": (q_supplied_file_statistics, SQL_SUPPLIED_FILE_STATISTICS),
    "quality_summary_wide": (q_quality_summary_wide, SQL_QUALITY_SUMMARY_WIDE),
    "stump_regression": (q_stump_regression, SQL_STUMP_REGRESSION),
    "stump_classification": (q_stump_classification, SQL_STUMP_CLASSIFICATION),
})

from tabprep.plans import catalog_more  # noqa: E402  (uses the helpers above)

REGISTRY.update(catalog_more.REGISTRY)
