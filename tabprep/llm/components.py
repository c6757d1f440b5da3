"""Connected components of a link table, by alternating large and small stars.

(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014.)
Every round links each node's neighbours to the smallest of them; the
number of links never grows, and a node with very many links is a partial
aggregate and a join that Spark may split, never one group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import drop_stored, store


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the links ``(u, v)``; the component is its smallest node."""
    links = store(links.toDF("u", "v").where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    digest = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = digest(links)
    for _ in range(max_rounds):
        if not before[0]:
            break
        last, links = links, store(_small_star(_large_star(links)).distinct(), "stars")
        drop_stored(last)
        after = digest(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    # settled: every node is linked to its smallest node only
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(links.select("v", "v")).distinct()
