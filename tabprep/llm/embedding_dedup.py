"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products.

Vectors are compared only under equal labels.  Equal vectors are one point
with a multiplicity, so a very common vector is a sum, not a group.  Per
label, spherical k-means (fitted on a bounded sample, ``SAMPLE`` rows) gives
about one cell per ``CELL`` points; every point is indexed in its nearest
cell, its home.

Pairs across cells are not lost: for a pair at distance d with homes a and b
the two margins ``x.(a - b)`` and ``y.(b - a)`` add up to at most
``d * |a - b|``, so one of the two points has at most half of it, and a point
visits every cell to which its margin is that small.  Recall is therefore 1;
well-separated clusters have few visitors, unclustered vectors many.

A cell's home points (in blocks of ``ROWS``) meet its points (in blocks of
``COLUMNS``) as matrix products.  A block pair gives sums of links and a
spanning forest of its links, never the pairs themselves.

Defined cases: null labels and vectors that are null, empty, zero or hold
null or non-finite components link with nothing and are their own component;
vectors of different lengths do not link; repeated rows count as further
equal vectors; rows of one id with different vectors are told apart, each with its own
links; a null id is never the smallest, and a component without any id has a null one;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.hashing import hash_uniform
from tabprep.functions.names import qcol
from tabprep.llm.common import list_array, row, store, table
from tabprep.llm.components import components

COSINE, CELL, MAX_CELLS, SAMPLE, ROWS, COLUMNS, SEED = 0.93, 2000, 1024, 40_000, 1024, 4096, 11


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = SEED) -> np.ndarray:
    """Unit centres of unit rows; an emptied cell restarts at the worst-fitting row."""
    rng = np.random.default_rng(seed)
    c = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))]
    for _ in range(rounds):
        fit = x @ c.T
        own = fit.argmax(axis=1)
        best = fit[np.arange(len(x)), own]
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        norm = np.linalg.norm(sums, axis=1)
        empty = norm < 1e-12
        sums[empty] = x[np.argsort(best)[:empty.sum()]]
        c = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return c


def _vector(name: str):
    """As doubles, with one zero (-0.0 becomes 0.0), so that equal vectors are equal bits."""
    return F.transform(qcol(name).cast("array<double>"), lambda x: x + F.lit(0.0))


def _points(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """One row per distinct usable vector of a label: its number, smallest id and multiplicity."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.select(qcol(key).cast("long").alias("id"), qcol(label).cast("string").alias("label"),
                            _vector(vector).alias("v")) \
        .where(F.col("label").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    return store(usable.groupBy("label", "v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
                 .withColumn("label", F.concat_ws("|", F.size("v").cast("string"), "label"))
                 .withColumn("point", F.monotonically_increasing_id()), "points")  # storing fixes the numbers


def _centres(points: DataFrame, cell: int, sample: int) -> dict[str, np.ndarray]:
    """Label -> centres, for the labels that need more than one cell."""
    large = {r["label"]: r["count"] for r in points.groupBy("label").count().where(F.col("count") > cell).collect()}
    if not large:
        return {}
    share = min(1.0, sample / sum(large.values()))
    rows = points.where(F.col("label").isin(sorted(large)) if len(large) < 1000 else F.lit(True)) \
        .where(hash_uniform(SEED, "point") < share).select("label", "v", "point").toPandas().sort_values(["label", "point"])
    out = {}
    for label, part in rows.groupby("label"):
        if label in large and len(part) > 1:
            x = np.array(part["v"].tolist())
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            out[label] = spherical_kmeans(x, min(MAX_CELLS, math.ceil(large[label] / cell)))
    return out


def _homes(points: DataFrame, centres: dict[str, np.ndarray], distance: float) -> DataFrame:
    """Points as unit vectors with home cell and visited cells."""
    shared = points.sparkSession.sparkContext.broadcast(centres)  # at most MAX_CELLS a label, rows / CELL in all

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = {k: np.linalg.norm(c[:, None] - c[None], axis=2) if len(c) <= 256 else None
                 for k, c in shared.value.items()}
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            vectors = [v.values.to_numpy() for v in batch.column(1)]
            unit = [v / np.linalg.norm(v) if np.isfinite(v @ v) and v @ v > 0 else _scaled(v) for v in vectors]
            home, visits = np.zeros(len(labels), np.int64), [np.zeros(0, np.int64)] * len(labels)
            for label in set(labels.tolist()) & shared.value.keys():
                c, mine = shared.value[label], np.flatnonzero(labels == label)
                fit = np.array([unit[i] for i in mine]) @ c.T
                own = fit.argmax(axis=1)
                home[mine] = own
                for i, f, a in zip(mine.tolist(), fit, own):
                    gap = apart[label][a] if apart[label] is not None else np.linalg.norm(c - c[a], axis=1)
                    near = f[a] - f <= distance / 2 * gap + 1e-9
                    near[a] = False
                    visits[i] = np.flatnonzero(near)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), list_array(unit, pa.float64()), batch.column(2), batch.column(3),
                pa.array(home, pa.int32()), list_array(visits, pa.int32())],
                ["label", "v", "point", "copies", "home", "visits"])

    return store(points.select("label", "v", "point", "copies").mapInArrow(
        run, "label string, v array<double>, point long, copies long, home int, visits array<int>"), "homes")


def _scaled(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()
    return v / np.linalg.norm(v)


def _forest(rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable over the links (rows[i], columns[i]) among n nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[rows], root[columns])
        new = root.copy()
        np.minimum.at(new, rows, low)
        np.minimum.at(new, columns, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = COSINE, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """Every row's ``n_links``, ``component_id`` and whether it is ``kept``."""
    points = _points(vectors, key, vector, label)
    homes = _homes(points, _centres(points, cell, sample), math.sqrt(max(0.0, 2 - 2 * cosine)))
    at_home = homes.withColumn("cell", F.col("home"))
    present = at_home.unionByName(homes.withColumn("cell", F.explode("visits")))
    size = present.groupBy("label", "cell").agg(
        F.ceil(F.count_if(F.col("cell") == F.col("home")) / ROWS).cast("int").alias("row_blocks"),
        F.ceil(F.count(F.lit(1)) / COLUMNS).cast("int").alias("column_blocks"))
    deal = lambda n: F.pmod(F.xxhash64("point"), F.col(n)).cast("int")
    left = at_home.join(size, ["label", "cell"]).withColumn("i", deal("row_blocks")) \
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("column_blocks") - 1))).withColumn("side", F.lit(0))
    right = present.join(size.where("row_blocks > 0"), ["label", "cell"]).withColumn("j", deal("column_blocks")) \
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1))).withColumn("side", F.lit(1))
    blocks = left.unionByName(right).select("label", "cell", "i", "j", "side", "v", "point", "copies", "home", "visits")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        l, r = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if not len(l) or not len(r):
            return pd.DataFrame({"point": [], "links": [], "root": []}).astype("int64")
        here = int(pdf["cell"].iloc[0])
        a, b = np.array(l["v"].tolist()), np.array(r["v"].tolist())
        ids_a, ids_b = l["point"].to_numpy(), r["point"].to_numpy()
        n_a, n_b = l["copies"].to_numpy(), r["copies"].to_numpy()
        home_b, visits = r["home"].to_numpy(), [set(v) for v in l["visits"]]
        x, y = np.nonzero(a @ b.T >= cosine)
        ok = ids_a[x] != ids_b[y]
        x, y = x[ok], y[ok]
        guest = home_b[y] != here
        # both visit the other's home: the pair counts in the smaller cell only
        twice = np.array([h in visits[i] for i, h in zip(x[guest].tolist(), home_b[y[guest]].tolist())], bool)
        skip = np.zeros(len(x), bool)
        skip[np.flatnonzero(guest)[twice & (home_b[y[guest]] < here)]] = True
        count_a = np.bincount(x[~skip], n_b[y[~skip]], len(l))
        count_b = np.bincount(y[guest & ~skip], n_a[x[guest & ~skip]], len(r))
        nodes, place = np.unique(np.concatenate([ids_a, ids_b]), return_inverse=True)
        root = _forest(place[x], place[len(ids_a) + y], len(nodes))
        out = pd.DataFrame({"point": np.concatenate([ids_a, ids_b]),
                            "links": np.concatenate([count_a, count_b]).astype(np.int64),
                            "root": nodes[root[place]]})
        return out[(out["links"] > 0) | (out["root"] != out["point"])]

    found = store(blocks.groupBy("label", "cell", "i", "j").applyInPandas(
        compare, "point long, links long, root long"), "block-links")
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    comp = store(components(found.where("point != root").select("point", "root"))
                 .join(points.select(F.col("point").alias("node"), "least"), "node"), "vector-components")
    ids = comp.groupBy("component").agg(F.min("least").alias("smallest"))
    comp = comp.join(ids, "component").select(F.col("node").alias("point"), "smallest", F.lit(True).alias("in_one"))
    per_point = points.select("point", "copies", "label", "v", "least").join(links, "point", "left") \
        .join(comp, "point", "left").select(
        F.col("label").alias("_l"), F.col("v").alias("_v"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.when(F.col("in_one"), F.col("smallest")).otherwise(F.col("least")).alias("component_id"))
    vectors = vectors.drop("n_links", "component_id", "kept")
    wide = vectors.select(row(vectors), qcol(key).cast("long").alias("_id"), qcol(label).cast("string").alias("_label"),
                          _vector(vector).alias("_dv"))
    # rows that are no point find no partner: a null label has no group
    group = F.when(F.col("_label").isNotNull(), F.concat_ws("|", F.size("_dv").cast("string"), "_label"))
    joined = wide.join(per_point, (group == F.col("_l")) & (F.xxhash64("_dv") == F.xxhash64("_v"))
                       & (F.col("_dv") == F.col("_v")), "left")
    component = F.coalesce("component_id", "_id")
    return joined.select("_row.*", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), component.eqNullSafe(F.col("_id")).alias("kept"))


def op6_spherical_kmeans_dedup(spark, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    return near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


SQL_OP6 = f"""
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND list_count(v) = len(v)
  AND len(list_filter(v, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x),
r AS (SELECT vec_id AS x, vec_id AS y FROM e UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component FROM r GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component AS component_id, c.component = e.vec_id AS kept
FROM e LEFT JOIN n ON n.x = e.vec_id LEFT JOIN c ON c.x = e.vec_id
"""
