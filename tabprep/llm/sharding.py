"""Sharding by a k-d tree over metadata (DataFrame operations only).

Documents with equal texts form one point: its weight is their bytes, its
coordinates the smallest metadata values among them.  A node with ``k``
leaves takes the dimension along which its points spread widest (relative to
the whole table) and cuts it at the weighted quantile that gives each side
bytes in proportion to its leaves; recursion ends at one leaf, whose bytes
are near the target.

* The quantile is found by counting: each round sums the weights of at most
  ``2 ** DIGIT_BITS`` intervals of the node's order key and narrows to the
  one that holds the quantile.  Points are never sorted as a whole, and all
  nodes of a level share a round.  What reaches the driver is one row a node.
* The order key is the coordinate in 20 bits, then 40 bits of the text's
  hash, so ties on a coordinate (one source with a third of the rows) are
  cut as finely as any other value.
* A point above half a leaf is dealt in parts by a hash of its ids, so one
  huge group of copies neither unbalances a shard nor meets in one task.
* Slots number a shard's rows from 0.  They come from sums over buckets of
  rows, so no task holds a shard.

Defined cases: null text has 1 byte and crc null; null metadata sort first;
an empty table gives an empty result; repeated rows each get a slot; an
input column named like an output one is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.names import qcol
from tabprep.llm.common import literal_table, row, store, table

COORD_BITS, HASH_BITS, DIGIT_BITS = 20, 40, 12
KEY_BITS = COORD_BITS + HASH_BITS


def _as_number(df: DataFrame, name: str) -> Column:
    """A metadata value as a double in its own order; text by its first 6 bytes."""
    c = qcol(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        c = F.conv(head, 16, 10)
    elif isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType)):
        c = F.unix_seconds(c.cast("timestamp"))
    c = c.cast("double")
    return F.when(c.isNull() | F.isnan(c), F.lit(float("-inf"))).otherwise(c)


def kd_shards(df: DataFrame, text: str, dims: list[str], target_bytes: int | None = None,
              n_shards: int | None = None, key: str = "doc_id", tolerance: float = 1e-3,
              lean: bool = False) -> DataFrame:
    """``df`` with ``size``, ``text_crc32`` and ``shard``.

    Give ``target_bytes`` (leaves of about that size) or ``n_shards``.
    ``lean`` gives the key and the text's hash (``_h``) instead of ``df``'s columns.
    A node stops narrowing its cut when the interval holds less than
    ``tolerance`` of a leaf, which bounds the error of each cut.
    """
    spark = df.sparkSession
    df = df.drop("size", "text_crc32", "shard")
    sized = df.select(
        F.struct(qcol(key)).alias("_row") if lean else row(df),
        (F.coalesce(F.octet_length(qcol(text)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(qcol(text), "UTF-8")).alias("text_crc32"),
        F.xxhash64(qcol(text)).alias("_h"),
        F.hash(qcol(key)).alias("_salt"),
        *[_as_number(df, d).alias(f"_d{i}") for i, d in enumerate(dims)])
    group = ["_h", "text_crc32"]
    grouped = sized.groupBy(*group).agg(
        F.sum("size").alias("_w"), *[F.min(f"_d{i}").alias(f"_d{i}") for i in range(len(dims))])
    grouped = store(grouped, "kd-groups")
    finite = [F.when(F.col(f"_d{i}") > float("-inf"), F.col(f"_d{i}")) for i in range(len(dims))]
    stats = grouped.agg(F.sum("_w").alias("w"), *[F.min(c).alias(f"lo{i}") for i, c in enumerate(finite)],
                        *[F.max(c).alias(f"hi{i}") for i, c in enumerate(finite)]).first()
    total = stats["w"] or 0
    leaves = n_shards or max(1, math.ceil(total / target_bytes))
    leaf = max(1.0, total / leaves)

    # points: groups, the few above half a leaf in parts (at most 2 * leaves groups)
    parts = F.ceil(F.col("_w") / F.lit(leaf / 2)).cast("int")
    big = grouped.where(F.col("_w") > leaf / 2).select(*group, parts.alias("_parts"))
    points = grouped.withColumn("_n", F.when(F.col("_w") > leaf / 2, parts).otherwise(F.lit(1)))
    points = points.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    spread = []
    for i in range(len(dims)):
        lo, hi = stats[f"lo{i}"], stats[f"hi{i}"]
        width = (hi - lo) if lo is not None and hi > lo else 0.0
        c = (F.when(F.col(f"_d{i}") > float("-inf"),
                    (F.col(f"_d{i}") - F.lit(float(lo))) / F.lit(float(width))) if width else F.lit(0.0))
        spread.append(F.least(F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)))
    tie = F.shiftrightunsigned(F.xxhash64("_h", "_part"), 64 - HASH_BITS)
    assigned = store(points.select(
        *group, "_part", F.lit(0).alias("_node"), (F.col("_w") / F.col("_n")).alias("_w"),
        *[(F.shiftleft(F.floor(c * (2 ** COORD_BITS - 1)).cast("long"), HASH_BITS).bitwiseOR(tie)).alias(f"_k{i}")
          for i, c in enumerate(spread)]), "kd-points")

    nodes = {0: leaves}  # node -> leaves below it; a node is the number of its first leaf
    while any(k > 1 for k in nodes.values()):
        cuts = _cuts(assigned, nodes, len(dims), tolerance * leaf)
        assigned = _split(assigned, cuts, len(dims))
        nodes = {child: n for node, k in nodes.items()
                 for child, n in ([(node, k // 2), (node + k // 2, k - k // 2)] if k > 1 else [(node, 1)])}
        if len(cuts) > 256:  # many literals: cut the plan
            assigned = store(assigned, "kd-level")

    shard_of = assigned.select("_h", F.col("text_crc32").alias("_c"), "_part", F.col("_node").alias("shard"))
    rows = sized.join(F.broadcast(big.withColumnRenamed("text_crc32", "_c")),
                      (sized["_h"] == big["_h"]) & sized["text_crc32"].eqNullSafe(F.col("_c")), "left") \
        .select(sized["*"], F.coalesce(F.pmod(F.col("_salt"), F.col("_parts")), F.lit(0)).alias("_part"))
    joined = rows.join(shard_of, (rows["_h"] == shard_of["_h"]) & (rows["_part"] == shard_of["_part"])
                       & rows["text_crc32"].eqNullSafe(shard_of["_c"]))
    return joined.select("_row.*", *([rows["_h"]] if lean else []), "size", "text_crc32", "shard")


def _cuts(points: DataFrame, nodes: dict[int, int], n_dims: int, enough: float) -> dict[int, tuple]:
    """node -> (dimension, order key): points up to the key go left."""
    open_nodes = [n for n, k in nodes.items() if k > 1]
    coord = [F.shiftright(F.col(f"_k{i}"), HASH_BITS) for i in range(n_dims)]
    seen = {r["_node"]: r for r in points.groupBy("_node").agg(
        F.sum("_w").alias("w"), *[(F.max(c) - F.min(c)).alias(f"s{i}") for i, c in enumerate(coord)])
        .where(F.col("_node").isin(open_nodes) if len(open_nodes) <= 256 else F.lit(True)).collect()}
    state = {}  # node -> [dimension, bits known, prefix, weight left of the prefix, wanted left weight]
    done = {}
    for n in open_nodes:
        if n not in seen:  # no point fell here: any cut will do
            done[n] = (0, 0)
            continue
        r = seen[n]
        widest = max(range(n_dims), key=lambda i: r[f"s{i}"])
        state[n] = [widest, 0, 0, 0.0, r["w"] * (nodes[n] // 2) / nodes[n]]
    while state:
        spark = points.sparkSession
        rows = [(n, s[0], KEY_BITS - s[1], KEY_BITS - s[1] - DIGIT_BITS, s[2], s[3], s[4]) for n, s in state.items()]
        live = F.broadcast(literal_table(  # one row a node
            spark, rows, "_node int, _dim int, _hi int, _lo int, _prefix long, _left double, _want double"))
        at = F.element_at(F.array(*[F.col(f"_k{i}") for i in range(n_dims)]), F.col("_dim") + 1)
        inside = points.join(live, "_node").withColumn("_k", at) \
            .where(F.expr("shiftright(_k, _hi)") == F.col("_prefix"))
        sums = inside.groupBy("_node", "_left", "_want", F.expr("shiftright(_k, _lo)").alias("_p")) \
            .agg(F.sum("_w").alias("_w"))
        run = Window.partitionBy("_node").orderBy("_p")  # at most 2 ** DIGIT_BITS rows a node
        reached = sums.withColumn("_cum", F.col("_left") + F.sum("_w").over(run))
        at_cut = reached.where(F.col("_cum") >= F.col("_want") * (1 - 1e-12)).groupBy("_node").agg(
            F.min(F.struct("_p", "_w", "_cum")).alias("c")).select("_node", "c.*").collect()
        for r in at_cut:
            n, s = r["_node"], state[r["_node"]]
            bits = s[1] + DIGIT_BITS
            if r["_w"] <= enough or bits >= KEY_BITS:
                # the interval goes left as a whole or not at all, whichever is nearer
                left = r["_p"] if r["_cum"] - s[4] <= s[4] - (r["_cum"] - r["_w"]) else r["_p"] - 1
                done[n] = (s[0], ((left + 1) << (KEY_BITS - bits)) - 1)
                del state[n]
            else:
                state[n] = [s[0], bits, r["_p"], r["_cum"] - r["_w"], s[4]]
    return {n: (dim, cut, n + nodes[n] // 2) for n, (dim, cut) in done.items()}


def _split(points: DataFrame, cuts: dict[int, tuple], n_dims: int) -> DataFrame:
    """Move the points beyond their node's cut to the right child."""
    rows = [(n, dim, cut, right) for n, (dim, cut, right) in cuts.items()]
    live = F.broadcast(literal_table(points.sparkSession, rows, "_node int, _dim int, _cut long, _right int"))
    at = F.element_at(F.array(*[F.col(f"_k{i}") for i in range(n_dims)]), F.col("_dim") + 1)
    return points.join(live, "_node", "left").withColumn(
        "_node", F.when(at > F.col("_cut"), F.col("_right")).otherwise(F.col("_node"))
    ).drop("_dim", "_cut", "_right")


def add_slots(df: DataFrame, shard: str, order: list[str], rows_per_bucket: int = 50_000) -> DataFrame:
    """Number each shard's rows from 0, gapless.

    Rows are numbered within (shard, bucket of a hash of the order columns)
    and moved on by the rows of the shard's earlier buckets.
    """
    df = df.drop("slot")
    n = df.count()
    buckets = max(1, math.ceil(n / rows_per_bucket))
    by = [f"_o{i}" for i in range(len(order))]
    rows = df.select(row(df), qcol(shard).alias("_shard"), *[qcol(c).alias(o) for c, o in zip(order, by)],
                     F.pmod(F.xxhash64(*[qcol(c) for c in order]), F.lit(buckets)).alias("_b"))
    before = Window.partitionBy("_shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_shard", "_b").count().select(
        "_shard", "_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_shard", "_b").orderBy(*by)
    return rows.withColumn("_r", F.row_number().over(within) - 1).join(offsets, ["_shard", "_b"]).select(
        "_row.*", (F.col("_before") + F.col("_r")).cast("long").alias("slot"))


#: Production parameters: eight leaves over these attributes.
DIMS, SHARDS = ["n_chars", "source", "lang"], 8


def shard_documents(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Documents in near equal bytes: columns of the documents, size, text_crc32, shard and slot.

    Shards and slots are found on narrow rows; the texts are shuffled once, to meet them.
    """
    docs = docs.drop("size", "text_crc32", "shard", "slot")
    dims = [d for d in DIMS if d in docs.columns]
    keys = ["_id", "_h", "_crc"]
    # rows of one id and text are told apart by their number among their like
    nth = lambda *by: F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    found = add_slots(store(kd_shards(docs.select("doc_id", "text", *dims), "text", dims, n_shards=n_shards, lean=True),
                            "kd-shards"), "shard", ["doc_id", "text_crc32", "size"])
    narrow = found.select(F.col("doc_id").alias("_id"), "_h", F.col("text_crc32").alias("_crc"), "size", "shard", "slot") \
        .withColumn("_nth", nth("shard", "slot")).select(*[F.col(k).alias(k + "2") for k in (*keys, "_nth")], "size", "shard", "slot")
    wide = docs.select(row(docs), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"),
                       F.crc32(F.encode("text", "UTF-8")).alias("_crc")).withColumn("_nth", nth(F.xxhash64("_row")))
    same = (F.col("_h") == F.col("_h2")) & (F.col("_nth") == F.col("_nth2")) \
        & F.col("_id").eqNullSafe(F.col("_id2")) & F.col("_crc").eqNullSafe(F.col("_crc2"))
    return wide.join(narrow, same).select("_row.*", "size", F.col("_crc").alias("text_crc32"), "shard", "slot")


def op8_kd_tree_shards(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of all documents."""
    docs = table(spark, sf_dir, "documents")
    sharded = kd_shards(docs, "text", DIMS, n_shards=SHARDS, lean=True)
    slotted = add_slots(store(sharded, "kd-shards"), "shard", ["doc_id", "text_crc32", "size"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))
