"""Further registered queries, each with its SQL twin: CSV records and second-order boosting."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabprep.functions.hashing import hash_uniform
from tabprep.functions.intervals import cumulate, draw_values
from tabprep.operators import features, metrics, training
from tabprep.operators.association import associations, compare_associations
from tabprep.operators.synthesizer import IndependentSynthesizer, TreeSynthesizer
from tabprep.plans import catalog as c
from tabprep.session import scratch_path
from tabprep.sources.csv import NA_TOKENS, read_csv
from tabprep.sources.tables import write_csv

REGISTRY: dict = {}

# ------------------------------------------------------------------ A1, A3: records of any content

_ODD_TEXT = """CASE WHEN doc_id % 3 = 0 THEN concat('say "', text, '", then', chr(13), chr(10), 'and \\\\', chr(10), chr(10))
  WHEN doc_id % 11 = 0 THEN 'NA' ELSE text END"""


def q_csv_roundtrip(spark, d):
    """Whole texts with quotes, separators, breaks and backslashes, written as CSV, read back and typed."""
    docs = c.t(spark, d, "documents").selectExpr("doc_id", f"{_ODD_TEXT} AS text", "lang", "source", "n_chars")
    path = scratch_path(spark, "csv")
    write_csv(docs, path, mode="error")
    back = read_csv(spark, path)
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("length"), "lang", "source", "n_chars")


_NA = f"IN ({c._sql_list(NA_TOKENS)})"
SQL_CSV_ROUNDTRIP = f"""
WITH o AS (SELECT doc_id, {_ODD_TEXT.replace(chr(92) * 2, chr(92))} AS text, lang, source, n_chars FROM documents),
n AS (SELECT doc_id, CASE WHEN text {_NA} THEN NULL ELSE text END AS text, CASE WHEN lang {_NA} THEN NULL ELSE lang END AS lang,
  CASE WHEN source {_NA} THEN NULL ELSE source END AS source, n_chars FROM o)
SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS length, lang, source, n_chars FROM n
"""
REGISTRY["csv_roundtrip"] = (q_csv_roundtrip, SQL_CSV_ROUNDTRIP)

# ------------------------------------------------------------------ I1, I2, I5: two rounds have a closed form

ALPHAS, ETA, LAMBDA = (0.0, 0.5, 2.0), 0.5, 1.0


def _two_rounds(spark, d, task: str, label: str):
    """Scores of every feature value after two rounds of depth 1, for three L1 terms."""
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(c._stump_rows(spark, d))
    values = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows.select("x").distinct())
    out = None
    for alpha in ALPHAS:
        params = {"eta": ETA, "max_depth": 1, "num_round": 2, "min_child_weight": 1.0, "alpha": alpha, "reg_lambda": LAMBDA}
        model = training.fit_model(rows, task, params, label_col=label)
        part = training.score(model, values, task).select(F.lit(alpha).alias("alpha"), "x", F.round("score", 7).alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def _two_rounds_sql(target: str, start: str, gradient: str, hessian: str, score: str) -> str:
    soft = lambda g: f"sign({g}) * greatest(abs({g}) - alpha, 0)"
    part = lambda g, h: f"pow({soft(g)}, 2) / ({h} + {LAMBDA})"
    leaf = lambda g, h: f"-{ETA} * {soft(g)} / ({h} + {LAMBDA})"
    steps = []
    for r in range(2):
        steps.append(f"""
e{r} AS (SELECT *, {gradient} AS g, {hessian} AS h FROM m{r}),
k{r} AS (SELECT alpha, c.x AS cut, sum(g) FILTER (e.x < c.x) AS gl, sum(h) FILTER (e.x < c.x) AS hl, sum(g) AS gt, sum(h) AS ht
  FROM e{r} e, (SELECT DISTINCT x FROM s) c WHERE c.x > (SELECT min(x) FROM s) GROUP BY alpha, c.x),
b{r} AS (SELECT * FROM k{r} QUALIFY row_number() OVER (PARTITION BY alpha
  ORDER BY {part('gl', 'hl')} + {part('(gt - gl)', '(ht - hl)')} DESC, cut) = 1),
m{r + 1} AS (SELECT alpha, x, n, sy, m + CASE WHEN x < cut THEN {leaf('gl', 'hl')} ELSE {leaf('(gt - gl)', '(ht - hl)')} END AS m
  FROM m{r} JOIN b{r} USING (alpha))""")
    return f"""
WITH s AS (SELECT CAST(l_linenumber AS DOUBLE) AS x, count(*) AS n, sum(CAST({target} AS DOUBLE)) AS sy FROM
  (SELECT l_linenumber, l_quantity + CASE WHEN l_linenumber >= 4 THEN 20.0 ELSE 0.0 END AS q FROM lineitem) GROUP BY 1),
a AS (SELECT unnest([{', '.join(map(str, ALPHAS))}])::DOUBLE AS alpha),
m0 AS (SELECT alpha, x, n, sy, {start} AS m FROM s, a),{','.join(steps)}
SELECT alpha, x, round({score}, 7) AS score FROM m2
"""


REGISTRY["boosted_regression"] = (lambda spark, d: _two_rounds(spark, d, "regression", "y"),
                                  _two_rounds_sql("q", "0.5", "n * m - sy", "n", "m"))
REGISTRY["boosted_classification"] = (lambda spark, d: _two_rounds(spark, d, "classification", "b"), _two_rounds_sql(
    "CASE WHEN q > 30 THEN 1 ELSE 0 END", "0.0", "n / (1 + exp(-m)) - sy", "n / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m)))", "1 / (1 + exp(-m))"))

# ------------------------------------------------------------------ C4, H4, H5: a level per part, no dictionary on the driver

def q_onehot_every_part(spark, d):
    """Where each line's part stands in its one-hot vector; fitted on half of the orders, so some parts are unknown."""
    li = c.t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 13 == 0, None).otherwise(
        F.concat(F.lit("part "), F.col("l_partkey").cast("string"))).alias("part"), "l_quantity")
    fitted = features.TabularPreprocessor(["l_quantity", "part"], max_levels=100).fit(li.where("l_orderkey % 2 = 0"))
    encoded = fitted.transform(li, keep=["l_orderkey", "l_linenumber"], assemble=True)
    # a sparse vector as text: (size,[places],[values])
    text = F.col("features").cast("string")
    places = F.split(F.regexp_extract(text, r"\[([0-9,]*)\]", 1), ",")
    last = F.element_at(places, -1).try_cast("int")
    return encoded.select("l_orderkey", "l_linenumber", F.regexp_extract(text, r"^\((\d+),", 1).cast("long").alias("n_features"),
                          F.when(last > 0, last).alias("place"))


SQL_ONEHOT_EVERY_PART = """
WITH b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 13 = 0 THEN 'missing' ELSE 'part ' || l_partkey END AS part FROM lineitem),
v AS (SELECT part, CAST(row_number() OVER (ORDER BY part) AS INTEGER) AS place FROM (SELECT DISTINCT part FROM b WHERE l_orderkey % 2 = 0))
SELECT b.l_orderkey, b.l_linenumber, (SELECT count(*) + 1 FROM v) AS n_features, v.place FROM b LEFT JOIN v USING (part)
"""
REGISTRY["onehot_every_part"] = (q_onehot_every_part, SQL_ONEHOT_EVERY_PART)

# ------------------------------------------------------------------ G6: association of columns of any kinds

_TEXTS, _NUMBERS = ("flag", "mode", "part"), ("quantity", "price", "tax")
_MIXED = {"l_orderkey": "l_orderkey", "flag": "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_returnflag END", "mode": "l_linestatus",
          "part": "concat('part ', CAST(l_partkey AS {text}))", "quantity": "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_quantity END",
          "price": "l_extendedprice", "tax": "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_tax END"}
_MIXED_SQL = "SELECT " + ", ".join(f"{e.format(text='VARCHAR')} AS {n}" for n, e in _MIXED.items()) + " FROM lineitem"


def _mixed(spark, d):
    return c.t(spark, d, "lineitem").select(*[F.expr(e.format(text="STRING")).alias(n) for n, e in _MIXED.items()])


def q_associations(spark, d):
    """Every pair of three text columns (one with a level per part) and three numbers, all with missing values or ties."""
    found = associations(_mixed(spark, d), [*_TEXTS, *_NUMBERS])
    return found.select("column_a", "column_b", "kind", F.round("value", 6).alias("value"))


def _v_sql(a: str, b: str, rows: str = "m") -> str:
    return f"""SELECT '{a}' AS column_a, '{b}' AS column_b, 'cramers_v' AS kind, (
  WITH k AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {rows} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2),
  w AS (SELECT n, sum(n) OVER (PARTITION BY a) AS na, sum(n) OVER (PARTITION BY b) AS nb FROM k)
  SELECT sqrt(greatest((SELECT sum(CAST(n AS DOUBLE) * n / na / nb) FROM w) - 1, 0)
    / (least((SELECT count(DISTINCT a) FROM k), (SELECT count(DISTINCT b) FROM k)) - 1))) AS value"""


def _eta_sql(a: str, x: str, rows: str = "m") -> str:
    return f"""SELECT '{a}' AS column_a, '{x}' AS column_b, 'correlation_ratio' AS kind, (
  WITH k AS (SELECT {a} AS a, CAST({x} AS DOUBLE) AS x FROM {rows} WHERE {a} IS NOT NULL AND {x} IS NOT NULL),
  w AS (SELECT avg(x) OVER (PARTITION BY a) AS own, avg(x) OVER () AS mean, x FROM k)
  SELECT sqrt(sum((own - mean) * (own - mean)) / sum((x - mean) * (x - mean))) FROM w) AS value"""


def _r_sql(x: str, y: str, rows: str = "m") -> str:
    return f"SELECT '{x}' AS column_a, '{y}' AS column_b, 'correlation' AS kind, " \
        f"(SELECT corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)) FROM {rows}) AS value"


def _pairs_sql(rows: str = "m") -> str:
    names = [*_TEXTS, *_NUMBERS]
    parts = []
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            parts.append((_v_sql if b in _TEXTS else _eta_sql if a in _TEXTS else _r_sql)(a, b, rows))
    return " UNION ALL ".join(parts)


SQL_ASSOCIATIONS = f"""
WITH m AS ({_MIXED_SQL})
SELECT column_a, column_b, kind, round(value, 6) AS value FROM ({_pairs_sql()})
"""
REGISTRY["associations"] = (q_associations, SQL_ASSOCIATIONS)


def q_association_differences(spark, d):
    """The pairs of the lines of even orders against those of odd ones, as of real against synthetic rows."""
    rows = _mixed(spark, d)
    found = compare_associations(rows.where("l_orderkey % 2 = 0"), rows.where("l_orderkey % 2 = 1"), [*_TEXTS, *_NUMBERS])
    return found.select("column_a", "column_b", "kind", *[F.round(x, 6).alias(x) for x in ("real", "synthetic", "difference")])


SQL_ASSOCIATION_DIFFERENCES = f"""
WITH m AS ({_MIXED_SQL}),
e AS (SELECT * FROM m WHERE l_orderkey % 2 = 0), o AS (SELECT * FROM m WHERE l_orderkey % 2 = 1),
r AS ({_pairs_sql("e")}), s AS ({_pairs_sql("o")})
SELECT column_a, column_b, r.kind, round(r.value, 6) AS "real", round(s.value, 6) AS synthetic,
  round(abs(coalesce(r.value, 0) - coalesce(s.value, 0)) / CASE WHEN r.kind = 'correlation' THEN 2 ELSE 1 END, 6) AS difference
FROM r JOIN s USING (column_a, column_b)
"""
REGISTRY["association_differences"] = (q_association_differences, SQL_ASSOCIATION_DIFFERENCES)

# ------------------------------------------------------------------ E1-E4, C6, C8: reports of many score columns in one pass

_SCORES = {"by_price": "l_extendedprice", "by_quantity": "l_quantity", "falling": "-l_extendedprice",
           "constant": "0.5 + 0 * l_tax", "coarse": "floor(l_extendedprice / 20000)"}


def q_reports_of_scores(spark, d):
    """Five score columns of every line: best F1, areas and confusion counts of each."""
    li = c.t(spark, d, "lineitem").select(F.expr("CAST(l_returnflag = 'R' AS INT)").alias("y"),
                                          *[F.expr(f"CAST({e} AS DOUBLE)").alias(n) for n, e in _SCORES.items()])
    out = metrics.classification_reports(li, "y", list(_SCORES))
    return out.select("score_column", *[F.round(x, 8).alias(x) for x in ("threshold", "f1", "auc", "aucpr")], "tn", "fp", "fn", "tp")


_LONG = " UNION ALL ".join(f"SELECT '{n}' AS score_column, CAST({e} AS DOUBLE) AS s, y FROM l" for n, e in _SCORES.items())
SQL_REPORTS_OF_SCORES = f"""
WITH l AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
p AS (SELECT score_column, s, sum(y) AS pos, sum(1 - y) AS neg FROM ({_LONG}) GROUP BY 1, 2),
k AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY score_column) AS np,
  sum(neg) OVER (PARTITION BY score_column) AS nn FROM p WINDOW w AS (PARTITION BY score_column ORDER BY s DESC)),
f AS (SELECT *, tp / (tp + fp) AS pr, tp / np AS re FROM k),
g AS (SELECT *, CASE WHEN pr = 0 AND re = 0 THEN NULL ELSE 2 * (pr * re) / (pr + re) END AS f1 FROM f),
b AS (SELECT * FROM g WHERE f1 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY score_column ORDER BY f1 DESC, s) = 1),
a AS (SELECT score_column, sum(CAST(neg AS DOUBLE) * (2 * tp - pos)) / (2.0 * max(np) * max(nn)) AS auc,
  sum(pos * pr) / max(np) AS aucpr FROM g GROUP BY 1)
SELECT score_column, round(s, 8) AS threshold, round(f1, 8) AS f1, round(auc, 8) AS auc, round(aucpr, 8) AS aucpr,
  CAST(nn - fp AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(np - tp AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp
FROM b JOIN a USING (score_column)
"""
REGISTRY["reports_of_scores"] = (q_reports_of_scores, SQL_REPORTS_OF_SCORES)

# ------------------------------------------------------------------ G5: draws from frequencies of any number of values and classes

_PART_LEVEL = """CASE WHEN l_orderkey % 3 = 0 THEN 'part 0' WHEN l_orderkey % 13 = 0 THEN NULL
  ELSE concat('part ', CAST(l_partkey AS {text})) END"""


def q_inverse_distribution(spark, d):
    """A part for every order, drawn from the parts of the lines of its status (one part holds a third of them)."""
    freq = c.t(spark, d, "lineitem").selectExpr("l_linestatus AS status", f"{_PART_LEVEL.format(text='STRING')} AS part") \
        .groupBy("status", "part").agg(F.count(F.lit(1)).alias("n"))
    draws = c.t(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return draw_values(draws, cumulate(freq, ["status"], "part"), ["status"], hash_uniform(c.SEED, F.lit("part"), F.col("o_orderkey")),
                       "part", "drawn_part")


SQL_INVERSE_DISTRIBUTION = f"""
WITH f AS (SELECT l_linestatus AS status, {_PART_LEVEL.format(text='VARCHAR')} AS part, count(*) AS n FROM lineitem GROUP BY 1, 2),
i AS (SELECT status, part, sum(n) OVER w AS hi, sum(n) OVER w - n AS lo FROM f
  WINDOW w AS (PARTITION BY status ORDER BY part NULLS LAST)),
t AS (SELECT status, max(hi) AS total FROM i GROUP BY 1),
o AS (SELECT o_orderkey, o_orderstatus AS status, {c._u_sql('part', 'o_orderkey')} AS u FROM orders),
p AS (SELECT o_orderkey, o.status, CAST(floor(u * total) AS BIGINT) AS position FROM o LEFT JOIN t USING (status))
SELECT p.o_orderkey, p.status, i.part AS drawn_part
FROM p LEFT JOIN i ON i.status = p.status AND p.position >= i.lo AND p.position < i.hi
"""
REGISTRY["inverse_distribution"] = (q_inverse_distribution, SQL_INVERSE_DISTRIBUTION)


def q_synth_many_classes(spark, d):
    """As many synthetic orders as real ones, each customer being a class."""
    o = c.t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    fitted = IndependentSynthesizer("o_custkey", ["o_orderkey"], c.SEED, columns=["o_totalprice", "o_orderstatus"]).fit(o)
    return fitted.generate(spark, sum(fitted.counts.values()))


SQL_SYNTH_MANY_CLASSES = f"""
WITH cc AS (SELECT o_custkey AS y, count(*) AS n FROM orders GROUP BY 1),
cum AS (SELECT y, n, sum(n) OVER (ORDER BY y) - n AS lo, sum(n) OVER (ORDER BY y) AS hi FROM cc),
ids AS (SELECT unnest(range((SELECT count(*) FROM orders))) AS synth_id),
r AS (SELECT synth_id, CAST(floor({c._u_sql('class', 'synth_id')} * (SELECT count(*) FROM orders)) AS BIGINT) AS position FROM ids),
dc AS (SELECT r.synth_id, cum.y, cum.n FROM r JOIN cum ON r.position >= cum.lo AND r.position < cum.hi),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {c._md5('o_orderkey')}) AS rk FROM orders)
SELECT dc.synth_id, a.o_totalprice, b.o_orderstatus, dc.y AS o_custkey
FROM dc JOIN ranked a ON a.o_custkey = dc.y AND a.rk = CAST(floor({c._u_sql('o_totalprice', 'dc.synth_id')} * dc.n) AS BIGINT) + 1
JOIN ranked b ON b.o_custkey = dc.y AND b.rk = CAST(floor({c._u_sql('o_orderstatus', 'dc.synth_id')} * dc.n) AS BIGINT) + 1
"""
REGISTRY["synth_many_classes"] = (q_synth_many_classes, SQL_SYNTH_MANY_CLASSES)

# ------------------------------------------------------------------ G5, I9: dependences kept by trees

_BAND = "CASE WHEN l_quantity = 25 THEN NULL WHEN l_quantity < 10 OR l_quantity >= 40 THEN 'edge' ELSE 'middle' END"


def q_synth_trees(spark, d):
    """Synthetic lines by class: how many, those that break the rule between quantity and band, and values that no real line has."""
    li = c.t(spark, d, "lineitem").select("l_returnflag", "l_quantity", F.expr(_BAND).alias("band"), "l_partkey")
    fitted = TreeSynthesizer("l_returnflag", c.SEED).fit(li)
    rows = fitted.generate(spark, sum(fitted.counts.values()))
    real = li.select(F.col("l_partkey").alias("p")).distinct()
    return rows.join(real, F.col("l_partkey") == F.col("p"), "left").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("band").eqNullSafe(F.expr(_BAND))).alias("n_broken"),
        F.count_if(F.col("p").isNull()).alias("n_unknown_parts"))


# broken rules and unknown values are none by the definition of the leaves
SQL_SYNTH_TREES = f"""
WITH cc AS (SELECT l_returnflag AS y, count(*) AS n FROM lineitem GROUP BY 1),
cum AS (SELECT y, sum(n) OVER (ORDER BY y) - n AS lo, sum(n) OVER (ORDER BY y) AS hi FROM cc),
ids AS (SELECT unnest(range((SELECT count(*) FROM lineitem))) AS synth_id),
r AS (SELECT CAST(floor({c._u_sql('class', 'synth_id')} * (SELECT count(*) FROM lineitem)) AS BIGINT) AS position FROM ids)
SELECT y AS l_returnflag, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_broken, CAST(0 AS BIGINT) AS n_unknown_parts
FROM r JOIN cum ON r.position >= cum.lo AND r.position < cum.hi GROUP BY y
"""
REGISTRY["synth_trees"] = (q_synth_trees, SQL_SYNTH_TREES)
