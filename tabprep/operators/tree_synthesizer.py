"""Sequential tree synthesizer (Reiter, "Using CART to generate partially
synthetic public use microdata", Journal of Official Statistics, 2005).

Columns are drawn one after another.  Column ``j`` has a decision tree (Spark
ML's, fitted on all rows) with the label and the columns before it as
features; a synthetic row falls into one of its leaves, and its value is drawn from
the real values of that leaf by their frequency.  Rules, thresholds and other
dependences that rank correlations miss are kept, as the values of a leaf are.

The (leaf, value) frequencies are an aggregate and stay a stored table of
intervals whatever their number (``functions.intervals``): no value reaches
the driver.  The driver holds the trees (at most ``2 ** max_depth`` leaves a
column) and, as features, the ``max_levels`` most frequent levels of each text
column; rarer levels share the rest's features but are drawn like others.

Every column costs a tree fit and one pass over the rows generated so far,
which are stored after each column (and shuffled, where the leaves hold many
values).  Rows alike in the columns before are one weighted point of the fit, with
their number, or its mean (the spread within them is the same whatever the split);
once such rows are few, every row is a point.  Drawing depends on a
row's id only.

Defined cases: null is a value like others (a number's absence is a feature of
its own, and the mean stands in for it); a column with one value, and columns without
anything before them that tells, have a tree of one leaf; null labels raise; no
columns give the label alone; no rows raise, as there is nothing to draw from.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.hashing import hash_uniform
from tabprep.functions.intervals import cumulate, draw_values
from tabprep.functions.names import qcol, require_columns
from tabprep.operators import stats
from tabprep.operators.features import split_types
from tabprep.operators.synth import SYNTH_ID, drawn_classes
from tabprep.session import drop_stored, store


@dataclass
class _Encoding:
    """Features of a column: its number (with a stand-in) and absence, or one per frequent level."""
    kind: T.DataType
    mean: float | None = None
    levels: list = field(default_factory=list)

    def number(self, x: Column) -> Column:
        x = x.cast("double")
        return F.coalesce(F.when(~F.isnan(x), x), F.lit(self.mean))

    def features(self, x: Column) -> list:
        if self.mean is not None:
            known = x.cast("double")
            return [self.number(x), (known.isNull() | F.isnan(known)).cast("double")]
        return [x.cast("string").eqNullSafe(F.lit(v)).cast("double") for v in self.levels]

    def code(self, x: Column) -> Column:
        """Place of the level among the frequent ones, the number of these for others."""
        out = F.lit(float(len(self.levels)))
        for i, v in enumerate(self.levels):
            out = F.when(x.cast("string").eqNullSafe(F.lit(v)), F.lit(float(i))).otherwise(out)
        return out


@dataclass
class TreeSynthesizer:
    label: str
    seed: int = 42
    columns: list = field(default_factory=list)
    max_depth: int = 8
    min_rows: int = 20     # real rows of a leaf, at least
    max_levels: int = 31   # levels of a text column that are features
    max_bins: int = 64     # thresholds tried for a number

    def fit(self, df: DataFrame, counts: dict | None = None) -> "FittedTrees":
        require_columns(df, [self.label])
        cols = self.columns or [c for c in df.columns if c != self.label]
        if counts is None:
            counts = stats.class_counts(df, self.label)
        if None in counts:
            raise ValueError("null labels cannot be synthesized")
        if not counts:
            raise ValueError("no rows to draw from")
        names = [self.label, *cols]
        rows = store(df.select(*[qcol(c).alias(f"v{j}") for j, c in enumerate(names)]), "tree-rows")
        codes = self._encodings(rows, df, names)
        models, tables, n, alike = [], [], sum(counts.values()), True
        for j in range(1, len(names)):
            e, x = codes[j], F.col(f"v{j}")
            before, grouped = [f"v{i}" for i in range(j)], None
            if alike:
                kinds = rows.groupBy(*before, e.code(x).alias("target")).agg(F.count(F.lit(1)).alias("weight")) if e.mean is None \
                    else rows.groupBy(*before).agg(F.avg(e.number(x)).alias("target"), F.count(F.lit(1)).alias("weight"))
                grouped = store(kinds.withColumn("weight", F.col("weight").cast("double")), "tree-points")
                alike = 2 * grouped.count() <= n
            points = grouped if alike else rows.withColumn("target", e.number(x) if e.mean is not None else e.code(x))
            model = _leaves_only(self._tree(e.mean is not None, n, alike).fit(
                points.select(_vector(codes[:j]).alias("features"), "target", *(["weight"] if alike else []))))
            if grouped is not None:
                drop_stored(grouped)
            by_value = rows.groupBy(*before, f"v{j}").agg(F.count(F.lit(1)).alias("n")) if alike else rows.withColumn("n", F.lit(1))
            freq = model.transform(by_value.select(f"v{j}", "n", _vector(codes[:j]).alias("features"))) \
                .groupBy(F.col("leaf").cast("int").alias("leaf"), F.col(f"v{j}").alias("v")).agg(F.sum("n").alias("n"))
            models.append(model)
            tables.append(store(cumulate(freq, ["leaf"], "v"), "tree-leaves"))
        drop_stored(rows)
        return FittedTrees(self.label, cols, counts, codes, models, tables, self.seed, df.schema[self.label].dataType)

    def _tree(self, number: bool, n: int, weighted: bool):
        """An unfitted tree of ``n`` rows; weighted points must add up to ``min_rows`` rows a leaf."""
        common = dict(featuresCol="features", labelCol="target", maxDepth=self.max_depth, maxBins=self.max_bins,
                      seed=self.seed, maxMemoryInMB=512)
        if not weighted:
            common |= dict(minInstancesPerNode=self.min_rows)
        elif n < 2 * self.min_rows:
            common |= dict(maxDepth=0)  # too few for two leaves
        else:
            common |= dict(weightCol="weight", minWeightFractionPerNode=(self.min_rows - 0.5) / n)
        return DecisionTreeRegressor(**common) if number else DecisionTreeClassifier(**common)

    def _encodings(self, rows: DataFrame, df: DataFrame, names: list) -> list:
        numeric, _ = split_types(df, names)
        numbers = [j for j, c in enumerate(names) if c in set(numeric)]
        texts = [j for j in range(len(names)) if j not in numbers]
        means, levels = {}, {}
        if numbers:
            x = {j: F.col(f"v{j}").cast("double") for j in numbers}
            got = rows.agg(*[F.avg(F.when(~F.isnan(x[j]), x[j])).alias(f"m{j}") for j in numbers]).first()
            means = {j: float(got[f"m{j}"] or 0.0) for j in numbers}
        if texts:
            long = rows.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"v{j}").cast("string").alias("v"))
                                                   for j in texts])).alias("e")).select("e.*")
            most = Window.partitionBy("j").orderBy(F.desc("count"), "v")  # cut to the first rows before the shuffle
            top = long.groupBy("j", "v").count().withColumn("at", F.row_number().over(most)).where(F.col("at") <= self.max_levels)
            for r in top.orderBy("j", "at").collect():  # max_levels rows a column
                levels.setdefault(r["j"], []).append(r["v"])
        return [_Encoding(df.schema[c].dataType, means.get(j), levels.get(j, [])) for j, c in enumerate(names)]


def _vector(codes: list) -> Column:
    """Features of the label and the first columns (``v0``, ``v1``, ...)."""
    return array_to_vector(F.array(*[f for j, e in enumerate(codes) for f in e.features(F.col(f"v{j}"))]))


def _leaves_only(model):
    """A fitted tree whose transform adds only the leaf's number."""
    model.setLeafCol("leaf").setPredictionCol("")
    if model.hasParam("probabilityCol"):
        model.setProbabilityCol("").setRawPredictionCol("")
    return model


@dataclass
class FittedTrees:
    label: str
    columns: list
    counts: dict
    codes: list
    models: list
    tables: list
    seed: int
    label_type: T.DataType

    def generate(self, spark, n: int, materialize: bool = True) -> DataFrame:
        """``n`` rows in the columns' own types, stored (every column's step is)."""
        rows = drawn_classes(spark, n, self.counts, self.label_type, self.seed, "v0").drop("_size")
        held = None
        for j, (c, model, table) in enumerate(zip(self.columns, self.models, self.tables), start=1):
            at = model.transform(rows.withColumn("features", _vector(self.codes[:j]))).withColumn(
                "leaf", F.col("leaf").cast("int")).drop("features")
            u = hash_uniform(self.seed, F.lit(c), F.col(SYNTH_ID))
            done = store(draw_values(at, table, ["leaf"], u, "v", f"v{j}").drop("leaf"), "tree-draws")
            if held is not None:
                drop_stored(held)
            rows = held = done
        return rows.select(SYNTH_ID, *[F.col(f"v{j}").alias(c) for j, c in enumerate(self.columns, start=1)],
                           F.col("v0").alias(self.label))


__all__ = ["TreeSynthesizer", "FittedTrees"]
