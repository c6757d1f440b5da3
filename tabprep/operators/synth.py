"""Real + synthetic rows: union, row budget, and the class draw shared by
the synthesizers (``synthesizer``, ``copula``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.hashing import hash_uniform, range_partitions
from tabprep.functions.intervals import cumulate, look_up


def union_real_synthetic(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Union all, aligned by name; a column missing on one side is null there."""
    return real.unionByName(synthetic, allowMissingColumns=True)


def row_budget(count: Column, factor: float) -> Column:
    """Rows to generate: ``floor(count * factor)``."""
    return F.floor(count.cast("double") * F.lit(float(factor))).cast("long")


SYNTH_ID = "synth_id"


def class_draw(total: int, seed, salt: str, ids: Column) -> Column:
    """A draw from 0 to total - 1 per generated row: a position among the real rows, in label order."""
    return F.floor(hash_uniform(seed, F.lit(salt), ids) * F.lit(int(total)))


def class_index(ends: list, seed, salt: str, ids: Column) -> Column:
    """0-based index (in sorted label order) of a generated row's class: the
    class whose cumulative-count interval (up to ``ends``) holds the row's draw."""
    r = class_draw(ends[-1], seed, salt, ids)
    table = F.array(*[F.lit(int(e)) for e in ends])
    return F.least(F.size(F.filter(table, lambda e: e <= r)), F.lit(len(ends) - 1))


def class_label(labels: list, ends: list, seed, salt: str, ids: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in labels]), class_index(ends, seed, salt, ids) + 1)


#: Classes that a plan holds as literals; more are a table that draws are joined to.
FEW_CLASSES = 64


def drawn_classes(spark, n: int, counts: dict, label_type: T.DataType, seed, out: str) -> DataFrame:
    """(``SYNTH_ID``, class as ``out``, ``_size``: the class's real rows) of ``n`` generated rows."""
    labels = sorted(counts)
    total = sum(counts.values())
    ids = spark.range(0, n, numPartitions=range_partitions(spark, n)).select(F.col("id").alias(SYNTH_ID))
    if len(labels) <= FEW_CLASSES:
        ends = [sum(counts[y] for y in labels[:i + 1]) for i in range(len(labels))]
        at = F.col("_class") + 1
        return ids.withColumn("_class", class_index(ends, seed, "class", F.col(SYNTH_ID))).select(
            SYNTH_ID, F.element_at(F.array(*[F.lit(v) for v in labels]), at).cast(label_type).alias(out),
            F.element_at(F.array(*[F.lit(int(counts[y])) for y in labels]), at).alias("_size"))
    classes = spark.createDataFrame([(y, counts[y]) for y in labels], T.StructType([
        T.StructField(out, label_type), T.StructField("n", T.LongType())]))  # a row a class
    drawn = ids.withColumn("_pos", class_draw(total, seed, "class", F.col(SYNTH_ID)))
    return look_up(drawn, cumulate(classes, [], out), [], "_pos", out, out, "_size").drop("_pos")
