"""Draws from frequency tables of any size: an inverse distribution as a join.

A table of (group, value, count) becomes one interval of positions a value:
``[lo, hi)`` in the order of the values, so that every position from 0 to
``total - 1`` belongs to one value, and a value's share of positions is its
frequency.  Neither the values nor the groups reach the driver.

A draw meets its interval by bucket, not by comparing it with all of them:
positions are cut in buckets, an interval is laid into each bucket it reaches,
and one sort per (group, bucket) of intervals and draws gives every draw the
last interval that starts at or before it.  A frequent value reaches many
buckets, so its draws are spread; a bucket holds at most as many intervals
as it is wide.  Where all intervals and buckets make a small table, it is
broadcast and the draws stay where they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.session import store

#: A bucket's least width in positions, and about the most buckets of a group.
WIDTH, BUCKETS = 4096, 100_000
#: Rows, and bytes of their values, of a table of intervals in buckets that may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 300_000, 16 << 20
_BEFORE = Window.unboundedPreceding, -1
_UPTO = Window.unboundedPreceding, Window.currentRow


def _names(groups: list) -> list:
    return [f"_g{i}" for i in range(len(groups))]


def cumulate(counts: DataFrame, groups: list, value: str, count: str = "n") -> DataFrame:
    """(groups, value, lo, hi, total): each value's interval within its group, by rising value, null last.

    ``counts`` holds one row per (group, value), with a count above zero.  The
    rows are range-partitioned by group and value and stored, which fixes each
    row's range; running counts are a window within a range plus the counts of
    the group's earlier ranges.  Null groups and values are groups and values
    like others; no rows give no intervals.
    """
    g = _names(groups)
    rising = [*g, F.col("_v").asc_nulls_last()]
    rows = store(counts.select(*[qcol(c).alias(a) for c, a in zip(groups, g)], qcol(value).alias("_v"),
                               qcol(count).cast("long").alias("_n"))
                 .repartitionByRange(*rising).sortWithinPartitions(*rising)
                 .withColumn("_part", F.shiftright(F.monotonically_increasing_id(), 33)), "intervals")
    own = Window.partitionBy(*(g or [F.lit(0)]))
    offsets = rows.groupBy(*g, "_part").agg(F.sum("_n").alias("_sum")).select(  # a row a range and group
        *[F.col(a).alias(f"{a}o") for a in g], F.col("_part").alias("_parto"), F.sum("_sum").over(own).alias("total"),
        F.coalesce(F.sum("_sum").over(own.orderBy("_part").rowsBetween(*_BEFORE)), F.lit(0)).alias("_off"))
    same = F.col("_part") == F.col("_parto")
    for a in g:
        same = same & F.col(a).eqNullSafe(F.col(f"{a}o"))
    within = Window.partitionBy(*g, "_part").orderBy(F.col("_v").asc_nulls_last()).rowsBetween(*_UPTO)
    return rows.join(offsets, same).withColumn("hi", F.col("_off") + F.sum("_n").over(within)).select(
        *[F.col(a).alias(c) for a, c in zip(g, groups)], F.col("_v").alias(value),
        (F.col("hi") - F.col("_n")).alias("lo"), "hi", "total")


def look_up(draws: DataFrame, intervals: DataFrame, groups: list, position: str, value: str, out: str,
            size: str | None = None) -> DataFrame:
    """``draws`` with, as ``out``, the value of the interval that holds their ``position`` (0-based, within ``groups``).

    ``intervals`` comes from ``cumulate`` and is read twice.  ``size`` names
    a column for the interval's number of positions.  Positions that are
    null or beyond the group's total, and draws of unknown groups, get null.
    """
    g = _names(groups)
    sizes = intervals.agg(F.max("total").alias("t"), F.count(F.lit(1)).alias("n"), F.sum(F.col("hi") - F.col("lo")).alias("s"),
                          F.max(F.octet_length(qcol(value).cast("string"))).alias("v")).first()
    width = max(WIDTH, math.ceil((sizes["t"] or 1) / BUCKETS))
    bucket = lambda p: F.floor(p / F.lit(width)).cast("long")
    row = F.struct(*[qcol(c) for c in draws.columns])
    asked = draws.select(*[qcol(c).alias(a) for c, a in zip(groups, g)], bucket(qcol(position)).alias("_bucket"),
                         qcol(position).cast("long").alias("_at"), F.lit(1).alias("_draw"), row.alias("_row"))
    starts = intervals.select(*[qcol(c).alias(a) for c, a in zip(groups, g)],
                              F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi") - 1))).alias("_bucket"), "lo",
                              F.struct(qcol(value).alias("v"), "lo", "hi").alias("_held"))
    n_starts = 2 * sizes["n"] + (sizes["s"] or 0) // width  # at most
    if n_starts <= BROADCAST_ROWS and n_starts * (sizes["v"] or 0) <= BROADCAST_BYTES:
        held = starts.select(*[F.col(a).alias(f"{a}h") for a in g], F.col("_bucket").alias("_bucketh"), "_held")
        same = (F.col("_bucket") == F.col("_bucketh")) & (F.col("_at") >= F.col("_held")["lo"]) & (F.col("_at") < F.col("_held")["hi"])
        for a in g:
            same = same & F.col(a).eqNullSafe(F.col(f"{a}h"))
        met = asked.join(F.broadcast(held), same, "left")  # disjoint intervals: at most one holds a draw
    else:
        starts = starts.withColumn("_at", F.greatest("lo", F.col("_bucket") * F.lit(width))).withColumn("_draw", F.lit(0)).drop("lo")
        # a bucket's intervals are disjoint: only the last that starts at or before a draw can hold it
        before = Window.partitionBy(*g, "_bucket").orderBy("_at", "_draw").rowsBetween(*_UPTO)
        met = starts.unionByName(asked, allowMissingColumns=True) \
            .withColumn("_held", F.last("_held", ignorenulls=True).over(before)).where("_draw = 1")
    inside = F.col("_at") < F.col("_held")["hi"]
    more = [F.when(inside, F.col("_held")["hi"] - F.col("_held")["lo"]).alias(size)] if size else []
    return met.select(*[F.col("_row").getField(c).alias(c) for c in draws.columns],
                      F.when(inside, F.col("_held")["v"]).alias(out), *more)


def draw_values(draws: DataFrame, intervals: DataFrame, groups: list, uniform: Column, value: str, out: str) -> DataFrame:
    """``draws`` with a value (``out``) of their group, drawn from its frequencies by ``uniform`` in [0, 1)."""
    g = _names(groups)
    if groups:
        totals = store(intervals.groupBy(*[qcol(c).alias(a) for c, a in zip(groups, g)]).agg(F.max("total").alias("_total")), "totals")
        if totals.count() <= BROADCAST_ROWS:  # a row a group
            totals = F.broadcast(totals)
        same = F.lit(True)
        for c, a in zip(groups, g):
            same = same & qcol(c).eqNullSafe(F.col(a))
        placed = draws.withColumn("_u", uniform).join(totals, same, "left").drop(*g)
    else:
        total = intervals.agg(F.max("total").alias("t")).first()["t"]
        placed = draws.withColumn("_u", uniform).withColumn("_total", F.lit(total).cast("long"))
    placed = placed.withColumn("_pos", F.least(F.floor(F.col("_u") * F.col("_total")).cast("long"), F.col("_total") - 1))
    return look_up(placed.drop("_u", "_total"), intervals, groups, "_pos", value, out).drop("_pos")


__all__ = ["cumulate", "look_up", "draw_values"]
