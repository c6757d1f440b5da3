"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Target words per source: the weights share ``amount`` times all words; a
   target stops at ``max_repeat`` times its source's words and the excess is
   shared again by weight (water-filling, in closed form over the sources).
2. Copies per document: every document of a source is drawn
   ``floor(target / words)`` times.  The rest of the target is filled by first
   fit: in the source's hash order each document is taken once more if its
   words still fit, so what is left of the target is less than any document
   passed over.  No rows are sorted for that: the longest run that fits ends at
   one hash, found by sums per hash prefix (a hot source is one more sum);
   what is too large for the gap then left is filtered out, the next run follows, and
   so on (some ten rounds, for all sources at once).
3. Blocks: the draws of a source are dealt at random (by hash) to blocks of
   about ``block_words`` words.  The tree splits the vector of block counts
   per source: a node hands its left half of the output shards a
   multivariate-hypergeometric draw of its blocks, the right half the rest.
   Each shard thus has an exact quota of every source's blocks; its blocks
   are the next ones in the source's order, so shards are disjoint and
   together hold every draw.
4. Within a shard, rows are put in a hash order (``order``).

The driver holds one row per source and the quota of each (source, shard).

Defined cases: null or blank text has no words and always fits; null is a source
of its own, last in order; rows of one source and id (of one text, where the id is null)
are drawn alike, so they are one group in the first fit, whose words are their sum; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.hashing import hash_key, uniform_from_hex
from tabprep.functions.names import qcol
from tabprep.llm.common import SPACE, literal_table, row, small_side, store, table, word_count

SEED, WEIGHTS, AMOUNT, MAX_REPEAT = 7, (5, 2, 1), 1.5, 2.0
SHARDS, BLOCK_WORDS = 8, 4096
PREFIX, ROWS_AT_CUT = 3, 200_000


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, amount=AMOUNT,
            max_repeat=MAX_REPEAT) -> dict[str | None, float]:
    """Words to take per source: min(max_repeat * size, level * weight), the
    level such that they add up to ``amount`` times all words."""
    names = sorted((s for s, _ in sizes if s is not None)) + [None] * any(s is None for s, _ in sizes)
    size = dict(sizes)
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    want = amount * sum(size.values())
    by_cap = sorted(names, key=lambda s: max_repeat * size[s] / weight[s])
    full, rest, level = 0.0, sum(weight.values()), math.inf
    for s in by_cap:
        level = (want - full) / rest
        if level <= max_repeat * size[s] / weight[s]:
            break
        full, rest, level = full + max_repeat * size[s], rest - weight[s], math.inf
    return {s: min(max_repeat * size[s], level * weight[s]) for s in names}


def split_quotas(blocks: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """(shards x sources) block quotas: a binary tree of hypergeometric draws."""
    if n_shards == 1:
        return blocks[None, :]
    rng = np.random.default_rng([seed, n_shards, int(blocks.sum())])
    left = n_shards // 2
    take = int(blocks.sum()) * left // n_shards
    drawn = rng.multivariate_hypergeometric(blocks, take, method="marginals")
    return np.vstack([split_quotas(drawn, left, 2 * seed + 1),
                      split_quotas(blocks - drawn, n_shards - left, 2 * seed + 2)])


def _small(df: DataFrame, n: int) -> DataFrame:
    """One row a source: broadcast while that is small, else Spark's choice."""
    return F.broadcast(df) if n <= 100_000 else df


def _cut(docs: DataFrame, rest: DataFrame, n_sources: int) -> dict[int, tuple[str, float]]:
    """source index -> (last hash of the prefix that fits in its rest, words in it)."""
    digits, state = PREFIX, None
    while True:
        prefix = F.substring("_hash", 1, digits)
        rows = docs.join(rest, "_s").where("_rest > 0")
        if state is not None:  # only the interval that holds the cut
            rows = rows.join(state, "_s").where(F.col("_hash").startswith(F.col("_at")))
        else:
            rows = rows.withColumn("_base", F.lit(0.0))
        sums = rows.groupBy("_s", "_rest", "_base", prefix.alias("_p")).agg(
            F.sum("size").alias("_w"), F.count(F.lit(1)).alias("_n"))
        run = Window.partitionBy("_s").orderBy("_p")  # at most 16 ** PREFIX rows a source
        over = sums.withColumn("_cum", F.col("_base") + F.sum("_w").over(run)).where("_cum > _rest") \
            .groupBy("_s").agg(F.min(F.struct("_p", "_cum", "_w", "_n", "_rest")).alias("c")).select("_s", "c.*")
        at = over.collect()  # one row a source
        if not at or max(r["_n"] for r in at) <= ROWS_AT_CUT or digits >= 32 - PREFIX:
            break
        state = _small(literal_table(docs.sparkSession, [(r["_s"], r["_p"], r["_cum"] - r["_w"]) for r in at],
                                     "_s int, _at string, _base double"), n_sources)
        digits += PREFIX
    if not at:
        return {}
    last = _small(literal_table(docs.sparkSession, [(r["_s"], r["_p"], r["_cum"] - r["_w"], r["_rest"]) for r in at],
                                "_s int, _at string, _base double, _rest double"), n_sources)
    inside = docs.join(last, "_s").where(F.col("_hash").startswith(F.col("_at")))
    run = Window.partitionBy("_s").orderBy("_hash")  # at most ROWS_AT_CUT rows
    fits = inside.withColumn("_cum", F.col("_base") + F.sum("size").over(run)).where("_cum <= _rest") \
        .groupBy("_s").agg(F.max(F.struct("_hash", "_cum")).alias("c")).select("_s", "c.*").collect()
    cut = {r["_s"]: (r["_p"], r["_cum"] - r["_w"]) for r in at}  # nothing of the interval fits
    return cut | {r["_s"]: (r["_hash"], r["_cum"]) for r in fits}


def _runs(groups: DataFrame, gaps: dict[int, float]) -> dict[int, list[tuple]]:
    """source index -> (after, last hash, most words) of each run of the first fit.

    A run takes the groups between its hashes that have no more words than the gap
    before it; those it passes over exceed every later gap.  Each run takes at
    least one group or ends the source's search.
    """
    found: dict[int, list[tuple]] = {}
    left = {i: ("", gap) for i, gap in gaps.items() if gap >= 1}  # sizes are whole words
    while left:
        state = _small(literal_table(groups.sparkSession, [(i, c, g) for i, (c, g) in left.items()],
                                     "_s int, _after string, _rest double"), len(left))
        fit = groups.join(state, "_s").where((F.col("_hash") > F.col("_after")) & (F.col("size") <= F.col("_rest"))) \
            .select("_s", "_hash", "size")
        cut = _cut(fit, state.select("_s", "_rest"), len(left))
        for i, (after, gap) in left.items():
            found.setdefault(i, []).append((after, cut[i][0] if i in cut else "~", gap))  # "~": all that fit
        left = {i: (c, left[i][1] - w) for i, (c, w) in cut.items() if left[i][1] - w >= 1}
    return found


def mix(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights=WEIGHTS,
        amount: float = AMOUNT, max_repeat: float = MAX_REPEAT, n_shards: int = SHARDS,
        block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target`` and ``shards``: the output shard of each draw."""
    spark = df.sparkSession
    df = df.drop("size", "source_size", "target", "shards")
    of_text = F.concat(F.lit("text "), F.md5(F.coalesce(qcol(text).cast("string"), F.lit(""))))
    sized = df.select(row(df), qcol(source).cast("string").alias("_name"), word_count(qcol(text)).alias("size"),
                      hash_key(seed, F.coalesce(qcol(key).cast("string"), of_text)).alias("_hash"))
    groups = store(sized.groupBy("_name", "_hash").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("_n")), "mix-sizes")
    # one row a source
    sizes = [(r[0], r[1] or 0) for r in groups.groupBy("_name").agg(F.sum("size")).collect()]
    want = targets(sizes, weights, amount, max_repeat)
    names, n = list(want), len(want)
    size = dict(sizes)
    full = {s: min(int(want[s] // size[s]), math.floor(max_repeat)) if size[s] else 1 for s in names}
    rest = {s: want[s] - full[s] * size[s] if size[s] else 0.0 for s in names}
    index = _small(literal_table(spark, [(i, s, size[s], want[s], full[s], rest[s]) for i, s in enumerate(names)],
                                 "_s int, _source string, source_size long, target double, _full int, _rest double"), n)
    # rows whose words are not those of their group
    several = small_side(groups.where("_n > 1").select(F.col("_name").alias("_n2"), F.col("_hash").alias("_h2"),
                                                      F.col("size").alias("_of_group")), "mix-repeated")
    docs = sized.join(index, sized["_name"].eqNullSafe(index["_source"])) \
        .join(several, (F.col("_hash") == F.col("_h2")) & F.col("_name").eqNullSafe(F.col("_n2")), "left")
    narrow = groups.join(index.select("_s", "_source"), F.col("_source").eqNullSafe(F.col("_name"))) \
        .select("_s", "_hash", "size").where("size > 0")
    runs = _runs(narrow, {i: rest[s] for i, s in enumerate(names)})

    # the tree over block counts
    blocks = np.array([max(1, math.ceil(want[s] / block_words)) for s in names], dtype=np.int64)
    quotas = split_quotas(blocks, n_shards, seed) if n else np.zeros((n_shards, 0), dtype=np.int64)
    ends = quotas.cumsum(axis=0)
    plan = _small(literal_table(
        spark, [(i, *([x[k] for x in runs.get(i, [])] for k in range(3)), int(blocks[i]), [int(e) for e in ends[:, i]])
                for i in range(n)],
        "_s int, _after array<string>, _upto array<string>, _most array<double>, _blocks int, _ends array<int>"), n)
    docs = docs.join(plan, "_s")
    words = F.coalesce("_of_group", "size")
    taken = F.exists(F.arrays_zip("_after", "_upto", "_most"), lambda x: (F.col("_hash") > x["_after"])
                     & (F.col("_hash") <= x["_upto"]) & (words <= x["_most"]))
    extra = (F.col("_rest") > 0) & ((words == 0) | taken)
    copies = F.col("_full") + extra.cast("int")
    block = lambda c: F.floor(uniform_from_hex(F.md5(F.concat_ws("|", F.lit("block"), c.cast("string"), "_hash")))
                              * F.col("_blocks"))
    shard = lambda c: F.size(F.filter(F.col("_ends"), lambda e: e <= block(c)))
    draws = F.when(copies > 0, F.transform(F.sequence(F.lit(1), copies), shard)).otherwise(F.array().cast("array<int>"))
    return docs.select("_row.*", "size", "source_size", "target", draws.alias("shards"))


def mixed_rows(df: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """One row per draw, with its output ``shard`` and place (``order``) in it."""
    drawn = mix(df.drop("shard", "order"), seed=seed, **options)
    key = qcol(options.get("key", "doc_id"))
    rows = drawn.select(row(drawn.drop("shards")), key.alias("_key"), F.posexplode("shards").alias("_copy", "shard"))
    return rows.select("_row.*", "shard", hash_key(f"{seed}-order", "shard", "_copy", "_key").alias("order"))


def write_mix(df: DataFrame, path: str, **options) -> None:
    """The mix as Parquet: a folder per output shard, rows in shuffled order."""
    (mixed_rows(df, **options).repartition("shard", F.substring("order", 1, 2))
     .sortWithinPartitions("shard", "order").drop("order").write.partitionBy("shard").parquet(path))


def op2_hypergeometric_mix(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken and draws of every document."""
    drawn = mix(table(spark, sf_dir, "documents"))
    draws = F.size("shards")
    return drawn.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"),
                        (F.col("size") * draws).alias("taken"), draws.alias("draws"))


SQL_OP2 = f"""
WITH RECURSIVE d AS (SELECT doc_id, source,
    md5(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, ''))))) AS h,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS s_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM s),
c AS (SELECT *, 2.0 * s_size / weight AS r, 1.5 * sum(s_size) OVER () AS want,
    coalesce(sum(2.0 * s_size) OVER (ORDER BY 2.0 * s_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
    sum(weight) OVER (ORDER BY 2.0 * s_size / weight DESC, source DESC ROWS UNBOUNDED PRECEDING) AS rest FROM w),
l AS (SELECT arg_min((want - full_before) / rest, r) FILTER ((want - full_before) / rest <= r) AS level FROM c),
t AS (SELECT source, s_size, least(2.0 * s_size, level * weight)::DOUBLE AS target FROM c, l),
f AS (SELECT *, CASE WHEN s_size = 0 THEN 1 ELSE CAST(floor(target / s_size) AS INT) END AS whole,
    CASE WHEN s_size = 0 THEN 0 ELSE target - floor(target / s_size) * s_size END AS rest FROM t),
o AS MATERIALIZED (SELECT coalesce(source, '') || CASE WHEN source IS NULL THEN 'n' ELSE 's' END AS src, h, CAST(sum(size) AS BIGINT) AS g,
    row_number() OVER (PARTITION BY source ORDER BY h) AS k FROM d GROUP BY source, h),
r AS (SELECT coalesce(source, '') || CASE WHEN source IS NULL THEN 'n' ELSE 's' END AS src, CAST(0 AS BIGINT) AS k, rest AS gap, '' AS h, false AS took
    FROM f WHERE rest > 0
  UNION ALL SELECT r.src, o.k, CASE WHEN o.g <= r.gap THEN r.gap - o.g ELSE r.gap END, o.h, o.g <= r.gap
    FROM r JOIN o ON o.src = r.src AND o.k = r.k + 1)
SELECT d.doc_id, d.size, f.s_size AS source_size, round(f.target, 6) AS target,
  d.size * (whole + CASE WHEN coalesce(took, false) THEN 1 ELSE 0 END) AS taken,
  CAST(whole + CASE WHEN coalesce(took, false) THEN 1 ELSE 0 END AS INT) AS draws
FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source
LEFT JOIN r ON r.k > 0 AND r.h = d.h AND r.src = coalesce(d.source, '') || CASE WHEN d.source IS NULL THEN 'n' ELSE 's' END
"""
