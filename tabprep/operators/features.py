"""Feature typing, label encoding and the fitted preprocessor.

Numeric block: median imputation, then standardisation with the population
std of the imputed column (a zero std divides by 1).  Categorical block:
null -> ``"missing"``, then one indicator per sorted level seen while fitting;
an unseen level gets all zeros.  All-null numeric columns leave the features.

Fitting is two scans on small and mid-size inputs (counts and moments; then
median windows and levels in one group-by), plus two per narrowing level of
the median window on very large ones.  The fitted state is a few numbers and
level lists per column.  Transforming is a
single narrow projection, so it pipelines into whatever reads it (including
a streaming DataFrame).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.names import check_unique_names, qcol, require_columns
from tabprep.functions.ranks import sorted_rank
from tabprep.operators import stats
from tabprep.session import drop_stored, store

MISSING = "missing"
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)
STRING_LIKE = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


# ---------------------------------------------------------------- columns

def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop named columns; a missing name is an error (Spark would ignore it)."""
    cols = [cols] if isinstance(cols, str) else list(cols or [])
    require_columns(df, cols)
    return df.drop(*cols)


def feature_columns(df: DataFrame, target: str, drop=()) -> list[str]:
    """All columns except the label and the dropped ones (exact name match)."""
    drop = [drop] if isinstance(drop, str) else list(drop or [])
    return [c for c in df.columns if c != target and c not in drop]


def align_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename columns by position, guarded by an arity check."""
    if len(df.columns) != len(names):
        raise ValueError(f"cannot align {len(df.columns)} columns to {len(names)} names")
    return df.toDF(*names)


def split_types(df: DataFrame, cols: list[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) by the typing rules.

    Numeric types are numeric; strings, dates and timestamps are categorical;
    a boolean column is numeric (0/1) when it has no nulls, otherwise
    categorical.  Nested types are rejected.
    """
    numeric, categorical, bools = [], [], []
    for c in cols:
        dt = df.schema[c].dataType
        if isinstance(dt, NUMERIC_TYPES):
            numeric.append(c)
        elif isinstance(dt, T.BooleanType):
            bools.append(c)
        elif isinstance(dt, STRING_LIKE):
            categorical.append(c)
        else:
            raise TypeError(f"column {c!r} has unsupported type {dt.simpleString()}")
    if bools:
        row = df.agg(*[F.count_if(qcol(c).isNull()).alias(f"b{i}") for i, c in enumerate(bools)]).first()
        for i, c in enumerate(bools):
            (categorical if row[f"b{i}"] > 0 else numeric).append(c)
    order = {c: i for i, c in enumerate(cols)}
    return sorted(numeric, key=order.get), sorted(categorical, key=order.get)


def as_category(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    x = qcol(c)
    if isinstance(dt, T.BooleanType):
        return F.when(x, F.lit("True")).when(~x, F.lit("False"))
    return x.cast("string")


# ---------------------------------------------------------------- label codes

#: Classes that may stand in the plan as a literal map; classes or levels of a table that may be broadcast.
LITERAL_CLASSES, BROADCAST_CLASSES = 64, 500_000


@dataclass
class LabelEncoding:
    """Codes of the sorted classes: a list of a few, or a table (level, code) of any number."""
    label: str
    classes: list
    table: stats.LevelTable | None = None

    def code(self) -> Column:
        """Code = position of the label in the sorted classes; null -> -1."""
        if self.table is not None:
            raise ValueError(f"{len(self.table)} classes are joined, see apply")
        if not self.classes:
            return F.lit(-1)
        m = F.create_map(*[x for i, v in enumerate(self.classes) for x in (F.lit(v), F.lit(i))])
        return F.coalesce(F.element_at(m, qcol(self.label)), F.lit(-1)).cast("int")

    def apply(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """``df`` with the code in ``out`` (default: in place of the label).

        A few classes are a literal map; more are a table that is joined
        (broadcast up to BROADCAST_CLASSES rows), so the plan stays small.
        Rows without a label meet no class; in a shuffled join they are dealt to all tasks.
        """
        out = out or self.label
        if self.table is None:
            return df.withColumn(out, self.code())
        table = self.table.table.select(F.col("level").alias("_class"), F.col("code").cast("int").alias("_code"))
        same = qcol(self.label) == F.col("_class")
        if len(self.table) <= BROADCAST_CLASSES:
            joined = df.join(F.broadcast(table), same, "left")
        else:
            dealt = df.withColumn("_dealt", F.when(qcol(self.label).isNull(), F.monotonically_increasing_id()).otherwise(0))
            # 0 for every class, but no literal: it has to stay a key of the join
            table = table.withColumn("_place", F.when(F.col("_code") < 0, 1).otherwise(0).cast("long"))
            joined = dealt.join(table, same & (F.col("_dealt") == F.col("_place")), "left").drop("_dealt", "_place")
        return joined.withColumn(out, F.coalesce("_code", F.lit(-1))).drop("_class", "_code")


def fit_label_encoding(df: DataFrame, label: str) -> LabelEncoding:
    """Sorted distinct labels (numbers sort as numbers, strings as strings).

    Beyond LITERAL_CLASSES the classes are ranked in Spark and never reach the driver.
    """
    classes = store(df.select(qcol(label).alias("level")).where(F.col("level").isNotNull()).distinct(), "classes")  # one pass over the rows
    few = classes.limit(LITERAL_CLASSES + 1).collect()
    if len(few) <= LITERAL_CLASSES:
        drop_stored(classes)
        return LabelEncoding(label, sorted(r["level"] for r in few))
    ranked = sorted_rank(classes, ["level"]).select("level", (F.col("_rank") - 1).alias("code"))
    n = classes.count()
    drop_stored(classes)
    return LabelEncoding(label, [], stats.LevelTable(ranked, n))


def encode_label(df: DataFrame, label: str, out: str | None = None) -> DataFrame:
    return fit_label_encoding(df, label).apply(df, out)


# ---------------------------------------------------------------- preprocessor

@dataclass
class FittedPreprocessor:
    numeric: list = field(default_factory=list)       # [(name, median, mean, std)]
    categorical: list = field(default_factory=list)   # [(name, [levels])], or LevelTable beyond max_levels
    bool_numeric: list = field(default_factory=list)  # numeric columns that are booleans
    dropped: list = field(default_factory=list)       # all-null numeric columns
    input_columns: list = field(default_factory=list)

    # names follow the block/column[_level] convention; where two features get
    # one name (column "a" with level "b_c", column "a_b" with level "c"), the
    # later ones are numbered
    def feature_names(self) -> list[str]:
        names = [f"num__{c}" for c, *_ in self.numeric]
        for c, levels in self.categorical:
            if isinstance(levels, stats.LevelTable):
                raise ValueError(f"column {c!r} has {len(levels)} levels: their names are the rows of its level table")
            names += [f"cat__{c}_{v}" for v in levels]
        taken: set[str] = set()
        for i, name in enumerate(names):
            n = 2
            while names[i].lower() in taken:  # Spark's names are not case-sensitive
                names[i], n = f"{name}__{n}", n + 1
            taken.add(names[i].lower())
        return names

    @property
    def n_features(self) -> int:
        return len(self.numeric) + sum(len(levels) for _, levels in self.categorical)

    def feature_exprs(self) -> list[Column]:
        exprs = []
        for c, median, mean, std in self.numeric:
            x = qcol(c)
            x = (F.when(x, 1.0).when(~x, 0.0) if c in self.bool_numeric else stats.clean_double(c))
            scale = std if std is not None and std > 10 * 2.220446049250313e-16 else 1.0
            exprs.append((F.coalesce(x, F.lit(median)) - F.lit(mean)) / F.lit(scale))
        for c, levels in self.categorical:
            s = F.coalesce(qcol(c).cast("string") if c not in self.bool_numeric else qcol(c),
                           F.lit(MISSING))
            for v in levels:
                exprs.append((s == F.lit(v)).cast("double"))
        return [e.alias(n) for e, n in zip(exprs, self.feature_names())]

    def transform(self, df: DataFrame, keep=(), assemble: bool = False,
                  output_col: str = "features", sparse_levels: int = 64) -> DataFrame:
        """Encoded features next to the ``keep`` columns (label, key, split).

        Input columns not fitted are ignored; a fitted column that is missing
        is an error.  With ``assemble`` the features become one vector column;
        categorical columns with more than ``sparse_levels`` levels are then
        encoded as sparse one-hot vectors (hash lookup of the level, the
        unknown-level slot dropped) instead of one column per level.  Levels
        beyond the fit's ``max_levels`` are a table that is joined (needs ``assemble``).
        """
        need = [c for c, *_ in self.numeric] + [c for c, _ in self.categorical]
        require_columns(df, need)
        cat_exprs = {c: self._cat_source(df, c) for c, _ in self.categorical}
        staged = df.select(*[qcol(k) for k in keep],
                           *[qcol(c) for c, *_ in self.numeric],
                           *[cat_exprs[c].alias(c) for c in cat_exprs])
        if not assemble:
            return staged.select(*[qcol(k) for k in keep], *self.feature_exprs())
        in_table = lambda lv: isinstance(lv, stats.LevelTable)
        wide = [(c, lv) for c, lv in self.categorical if len(lv) > sparse_levels or in_table(lv)]
        narrow = FittedPreprocessor(self.numeric, [(c, lv) for c, lv in self.categorical
                                                   if len(lv) <= sparse_levels and not in_table(lv)],
                                    self.bool_numeric, self.dropped, self.input_columns)
        # assembler inputs get positional names: feature names may hold dots
        inputs = [f"_f{j}" for j in range(len(narrow.feature_names()))]
        out = staged.select(*[qcol(k) for k in keep],
                            *[e.alias(n) for e, n in zip(narrow.feature_exprs(), inputs)],
                            *[F.coalesce(qcol(c), F.lit(MISSING)).alias(f"_sp_{i}")
                              for i, (c, _) in enumerate(wide)])
        for i, (c, lv) in enumerate(wide):
            if in_table(lv):
                out = _joined_codes(out, lv, f"_sp_{i}", f"_ix_{i}")
                out = OneHotEncoder(inputCols=[f"_ix_{i}"], outputCols=[f"_oh_{i}"], dropLast=True).fit(out).transform(out)
                continue
            out = StringIndexerModel.from_labels(lv, inputCol=f"_sp_{i}", outputCol=f"_ix_{i}",
                                                 handleInvalid="keep").transform(out)
            # the indexer's "keep" slot (index = number of levels) is the last
            # category, and dropLast removes it: unseen levels -> all zeros
            out = OneHotEncoder(inputCols=[f"_ix_{i}"], outputCols=[f"_oh_{i}"],
                                dropLast=True).fit(out).transform(out)
        order = self._vector_order(wide, inputs)
        out = VectorAssembler(inputCols=order, outputCol=output_col,
                              handleInvalid="keep").transform(out)
        return out.select(*[qcol(k) for k in keep], output_col)

    def _vector_order(self, wide: list, inputs: list[str]) -> list:
        """Assembler inputs in feature_names() order (numeric, then each
        categorical column's levels, sparse blocks in their column's place)."""
        wide_idx = {c: i for i, (c, _) in enumerate(wide)}
        rest = iter(inputs)
        order = [next(rest) for _ in self.numeric]
        for c, levels in self.categorical:
            order += [f"_oh_{wide_idx[c]}"] if c in wide_idx else [next(rest) for _ in levels]
        return order

    def _cat_source(self, df, c):
        return as_category(df, c)

    # persistence: a one-row JSON parameter table written by Spark, and the level tables beside it
    def to_json(self) -> str:
        plain = [(c, {"levels_in_table": len(v)} if isinstance(v, stats.LevelTable) else v) for c, v in self.categorical]
        return json.dumps({**self.__dict__, "categorical": plain})

    @classmethod
    def from_json(cls, s: str, tables: dict | None = None) -> "FittedPreprocessor":
        d = json.loads(s)
        levels = lambda c, v: stats.LevelTable(tables[c], v["levels_in_table"]) if isinstance(v, dict) else list(v)
        return cls(numeric=[tuple(x) for x in d["numeric"]],
                   categorical=[(c, levels(c, v)) for c, v in d["categorical"]],
                   bool_numeric=d.get("bool_numeric", []), dropped=d.get("dropped", []),
                   input_columns=d.get("input_columns", []))

    def save(self, spark, path: str) -> None:
        for i, (_, levels) in enumerate(self.categorical):
            if isinstance(levels, stats.LevelTable):
                levels.table.write.mode("overwrite").parquet(f"{path}_levels/{i}")
        spark.createDataFrame([(self.to_json(),)], "params string").coalesce(1) \
            .write.mode("overwrite").json(path)

    @classmethod
    def load(cls, spark, path: str) -> "FittedPreprocessor":
        params = spark.read.json(path).first()["params"]
        tables = {c: spark.read.parquet(f"{path}_levels/{i}")
                  for i, (c, v) in enumerate(json.loads(params)["categorical"]) if isinstance(v, dict)}
        return cls.from_json(params, tables)


def _joined_codes(df: DataFrame, levels: stats.LevelTable, level: str, out: str) -> DataFrame:
    """``df`` with the code of ``level`` as an index column ``out``; an unknown level gets the last, dropped slot."""
    table = levels.table.select(F.col("level").alias("_level"), F.col("code").alias("_code"))
    table = F.broadcast(table) if len(levels) <= BROADCAST_CLASSES else table
    kind = {"ml_attr": {"type": "nominal", "num_vals": len(levels) + 1, "name": out}}
    index = F.coalesce(F.col("_code"), F.lit(len(levels))).cast("double").alias(out, metadata=kind)
    return df.join(table, df[level] == table["_level"], "left").select(*df.columns, index)


class TabularPreprocessor:
    """Fit the numeric and categorical blocks on a DataFrame."""

    def __init__(self, columns: list[str] | None = None, exact_median: bool = True,
                 max_levels: int = 10_000):
        self.columns = columns
        self.exact_median = exact_median
        self.max_levels = max_levels

    def fit(self, df: DataFrame) -> FittedPreprocessor:
        check_unique_names(df)
        cols = self.columns if self.columns is not None else list(df.columns)
        require_columns(df, cols)
        numeric, categorical = split_types(df, cols)
        bool_numeric = [c for c in numeric if isinstance(df.schema[c].dataType, T.BooleanType)]
        num_src = {c: (F.when(qcol(c), 1.0).when(~qcol(c), 0.0) if c in bool_numeric
                       else stats.clean_double(c)) for c in numeric}
        staged = df.select(*[num_src[c].alias(c) for c in numeric],
                           *[as_category(df, c).alias(c) for c in categorical])
        cat_exprs = {c: F.coalesce(qcol(c), F.lit(MISSING)) for c in categorical}
        if self.exact_median:
            fit = stats.fit_columns(staged, numeric, cat_exprs, self.max_levels)
            medians, moments, levels = fit["medians"], fit["moments"], fit["levels"]
        else:
            medians = stats.approx_medians(staged, numeric)
            moments = stats.mean_std_pop(staged, {c: F.coalesce(qcol(c), F.lit(medians[c]))
                                                  for c in numeric if medians[c] is not None})
            levels = stats.distinct_levels(staged, cat_exprs, self.max_levels)
        kept = [c for c in numeric if medians[c] is not None]
        dropped = [c for c in numeric if medians[c] is None]
        return FittedPreprocessor(
            numeric=[(c, medians[c], moments[c][0], moments[c][1]) for c in kept],
            categorical=[(c, levels[c]) for c in categorical],
            bool_numeric=bool_numeric, dropped=dropped, input_columns=cols)
