"""Independent synthesizer and the augmentation step.

``independent`` draws every column from its class's empirical distribution:
draw ``j`` of column ``c`` copies the value of the class row whose hash rank
is ``1 + floor(u(seed, c, j) * n_class)``.  All columns are resolved by one
equi-join on (class, rank, column) of a long draw table with the long form of
the ranked rows, then a row's cells are collected: the work is linear in
rows times columns, whatever the values' types or number.  The Gaussian copula lives in ``copula``, the
quality report in ``quality``; both are re-exported here.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.hashing import hash_key, hash_uniform
from tabprep.functions.names import qcol, require_columns
from tabprep.functions.ranks import hash_rank
from tabprep.operators import stats
from tabprep.operators.copula import CopulaSynthesizer, FittedCopula  # noqa: F401
from tabprep.operators.quality import pair_correlations, quality_by_column, quality_summary  # noqa: F401
from tabprep.operators.synth import SYNTH_ID, drawn_classes, union_real_synthetic  # noqa: F401
from tabprep.operators.tree_synthesizer import FittedTrees, TreeSynthesizer  # noqa: F401
from tabprep.session import store


# ------------------------------------------------------------------ independent

@dataclass
class IndependentSynthesizer:
    label: str
    key_cols: list
    seed: int = 42
    columns: list = field(default_factory=list)

    def fit(self, df: DataFrame, counts: dict | None = None) -> "FittedIndependent":
        require_columns(df, [self.label, *self.key_cols])
        cols = self.columns or [c for c in df.columns if c != self.label and c not in self.key_cols]
        if counts is None:
            counts = stats.class_counts(df, self.label)
        if None in counts:
            raise ValueError("null labels cannot be synthesized")
        h = "_syn_h"
        hashed = df.withColumn(h, hash_key(self.seed, *[qcol(k) for k in self.key_cols]))
        ranked = hash_rank(hashed, h, group_cols=[self.label], rank_col="_syn_rank",
                           n=sum(counts.values()))
        # one row per (class, rank, column): a draw then meets one value, not a whole row
        types = {c: df.schema[c].dataType for c in cols}
        cells = ranked.select(qcol(self.label).alias("_syn_y"), "_syn_rank", F.explode(F.array(*[
            F.struct(F.lit(j).alias("_j"), _packed(qcol(c), types[c]).alias("_v")) for j, c in enumerate(cols)])).alias("e")) \
            .select("_syn_y", "_syn_rank", "e._j", "e._v")
        return FittedIndependent(self.label, cols, counts, cells, self.seed, types, df.schema[self.label].dataType)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _packed(x: Column, kind: T.DataType) -> Column:
    """A value as (integer, double, text): the same struct for every column type."""
    n, d, s = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(kind, _INTEGRAL):
        n = x.cast("bigint")
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        d = x.cast("double")
    else:
        s = x.cast("string")
    return F.struct(n.alias("n"), d.alias("d"), s.alias("s"))


def _unpacked(v: Column, kind: T.DataType) -> Column:
    part = "n" if isinstance(kind, _INTEGRAL) else "d" if isinstance(kind, (T.FloatType, T.DoubleType)) else "s"
    return v[part].cast(kind)


@dataclass
class FittedIndependent:
    label: str
    columns: list
    counts: dict
    cells: DataFrame
    seed: int
    types: dict
    label_type: T.DataType

    def generate(self, spark, n: int, materialize: bool = False) -> DataFrame:
        """``n`` rows: one draw per (row, column), joined to its cell; a row's
        cells are then collected.  Every step moves n * columns cells."""
        base = drawn_classes(spark, n, self.counts, self.label_type, self.seed, "_syn_y")
        draws = base.select(SYNTH_ID, "_syn_y", F.explode(F.array(*[
            F.struct(F.lit(j).alias("_j"), (F.floor(hash_uniform(self.seed, F.lit(c), F.col(SYNTH_ID)) * F.col("_size")) + 1)
                     .cast("long").alias("_syn_rank"))
            for j, c in enumerate(self.columns)])).alias("d")).select(SYNTH_ID, "_syn_y", "d._j", "d._syn_rank")
        rows = draws.join(self.cells, ["_syn_y", "_syn_rank", "_j"]).groupBy(SYNTH_ID, "_syn_y").agg(
            F.array_sort(F.collect_list(F.struct("_j", "_v"))).alias("_row"))
        out = rows.select(SYNTH_ID, *[_unpacked(F.element_at("_row", j + 1)["_v"], self.types[c]).alias(c)
                                      for j, c in enumerate(self.columns)], F.col("_syn_y").alias(self.label))
        return store(out, "independent") if materialize else out


# ------------------------------------------------------------------ augmentation (G2-G4)

def make_synthesizer(mode: str, label: str, key_cols: list, seed: int = 42, **opts):
    if mode == "independent":
        return IndependentSynthesizer(label, key_cols, seed, **opts)
    if mode == "copula":
        return CopulaSynthesizer(label, seed, **opts)
    if mode == "trees":
        return TreeSynthesizer(label, seed, **opts)
    raise ValueError(f"unknown synthesizer {mode!r}")


@dataclass
class GenerationSource:
    """What a generator is fitted on: (over-sampled) real rows and their classes."""
    rows: DataFrame
    group: str
    key_cols: list
    columns: list
    counts: dict
    conditional: bool

    @property
    def n_rows(self) -> int:
        return sum(self.counts.values())

    def fit(self, mode: str, seed: int = 42, **opts):
        syn = make_synthesizer(mode, self.group, self.key_cols, seed, columns=self.columns, **opts)
        rows = self.rows if mode == "independent" else self.rows.select(*[qcol(c) for c in (self.group, *self.columns)])
        return syn.fit(rows, self.counts)

    def generate(self, fitted, spark, n: int) -> DataFrame:
        """``n`` rows, written once for their several readers."""
        out = fitted.generate(spark, n, materialize=True)
        return out if self.conditional else out.drop(self.group)


def generation_source(train: DataFrame, label: str, key: str, strategy: str, target_balance: float = 1.0,
                      seed: int = 42, conditional: bool = True) -> GenerationSource:
    """The source of a strategy: over-sampled for ``balance``, else the training rows.

    With ``conditional`` (classification) each class is synthesized on its own;
    otherwise (regression, a continuous label) all rows are one pseudo-class
    and the label is a column like any other."""
    from tabprep.operators.sampling import DRAW, oversample, oversample_plan
    if strategy not in ("balance", "augment", "replace"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "balance" and not conditional:
        raise ValueError("the balance strategy needs a class label")
    group, source, key_cols = label, train, [key]
    if conditional:
        counts = stats.class_counts(train, label)
    else:
        group = "_all_rows"
        source = source.withColumn(group, F.lit(0))
        counts = {0: train.count()}
    if strategy == "balance":
        source = oversample(train, label, key, target_balance, seed, counts=counts)
        key_cols = [key, DRAW]
        minor, _, k = oversample_plan(counts, target_balance)
        counts = {**counts, minor: counts[minor] + k}
    cols = [c for c in train.columns if c not in (group, key) and (c != label or not conditional)]
    return GenerationSource(source, group, key_cols, cols, counts, conditional)


def augment_training(spark, train: DataFrame, label: str, key: str, strategy: str | None,
                     generate_factor: float = 1.0, target_balance: float = 1.0, seed: int = 42,
                     synthesizer: str = "independent", conditional: bool = True,
                     source: GenerationSource | None = None, fitted=None, **opts) -> DataFrame:
    """Training rows after the generation strategy, tagged by ``origin``.

    ``None``: real rows only.  ``balance``: over-sample the minority class,
    then add synthetic rows.  ``augment``: add synthetic rows.  ``replace``:
    synthetic rows only.  The row budget is ``floor(rows * factor)`` of the
    (possibly over-sampled) source.  Pass ``source`` and ``fitted`` to generate
    from a generator that a search has chosen.
    """
    from tabprep.operators.sampling import DRAW
    if strategy is None:
        return train.withColumn("origin", F.lit("real"))
    source = source or generation_source(train, label, key, strategy, target_balance, seed, conditional)
    fitted = fitted or source.fit(synthesizer, seed, **opts)
    n_gen = math.floor(source.n_rows * float(generate_factor))
    generated = source.generate(fitted, spark, n_gen).withColumn("origin", F.lit("synthetic"))
    if strategy == "replace":
        return generated
    src = source.rows if source.conditional else source.rows.drop(source.group)
    src = src.withColumn("origin", F.lit("real"))
    if DRAW in src.columns:
        src = src.withColumn("origin", F.when(F.col(DRAW).isNull(), "real").otherwise("oversampled")) \
            .drop(DRAW)
    return union_real_synthetic(src, generated)
