"""CSV scans with the NA-token rule and column type inference.

Files are read with every column as a string (``records``); the NA tokens are mapped to
null *before* typing (Spark's ``nullValue`` takes one token only, and with
``N/A`` left in, a numeric column would be typed as text).  Typing is one
aggregate pass: a column is numeric when every non-null value casts to a
number, boolean when every non-null value is a boolean literal, else text.
Dates are kept as text (they become categories).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.names import check_unique_names, qcol
from tabprep.sources.records import read_records

# The default missing-value tokens of the common CSV reader
# the job specs were written for.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null"]
# Text read as booleans.
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]
#: Text that is a number: decimal or scientific notation, or an infinity.
NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"


def normalize_na(df: DataFrame, cols=None, tokens=NA_TOKENS) -> DataFrame:
    """Map NA tokens to null in string columns (one projection)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cols = set(cols)
    toks = list(tokens)
    return df.select(*[
        (F.when(qcol(c).isin(toks), F.lit(None).cast("string")).otherwise(qcol(c)).alias(c)
         if c in cols else qcol(c)) for c in df.columns])


def infer_types(df: DataFrame, cols=None) -> DataFrame:
    """Cast string columns to long / double / boolean where every value fits."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df
    # long form (column index, text): one small aggregate however wide the file
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), qcol(c).alias("s")) for i, c in enumerate(cols)])).alias("e")) \
        .select("e.i", "e.s")
    x = F.col("s")
    nn = x.isNotNull()
    # a cast alone would also take Java literals such as "1d" or "2f"
    number = x.rlike(NUMBER)
    rows = {r["i"]: r for r in long.groupBy("i").agg(
        F.count_if(nn & ~(number & F.expr("try_cast(s as double)").isNotNull())).alias("d"),
        F.count_if(nn & ~(number & F.expr("try_cast(s as long)").isNotNull())).alias("l"),
        F.count_if(nn & ~x.isin(TRUE_TOKENS + FALSE_TOKENS)).alias("b"),
        F.count(x).alias("n")).collect()}
    kinds = {}
    for i, c in enumerate(cols):
        row = rows.get(i)
        if row is None or row["n"] == 0:
            kinds[c] = "double"          # all missing: a numeric column of nulls
        elif row["b"] == 0:
            kinds[c] = "boolean"
        elif row["l"] == 0:
            kinds[c] = "long"
        elif row["d"] == 0:
            kinds[c] = "double"
    out = []
    for c in df.columns:
        k = kinds.get(c)
        if k == "boolean":
            out.append(F.when(qcol(c).isin(TRUE_TOKENS), True)
                       .when(qcol(c).isin(FALSE_TOKENS), False).alias(c))
        elif k:
            out.append(qcol(c).cast(k).alias(c))
        else:
            out.append(qcol(c))
    return df.select(*out)


def cast_like(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that ``schema`` names, cast to its types (text to boolean by token).

    A value that does not fit its column is null.  Columns the schema lacks stay as they are.
    """
    want = {f.name: f.dataType for f in schema.fields}
    out = []
    for f in df.schema.fields:
        kind = want.get(f.name)
        if kind is None or kind == f.dataType:
            out.append(qcol(f.name))
        elif isinstance(kind, T.BooleanType) and isinstance(f.dataType, T.StringType):
            out.append(F.when(qcol(f.name).isin(TRUE_TOKENS), True)
                       .when(qcol(f.name).isin(FALSE_TOKENS), False).alias(f.name))
        else:
            out.append(qcol(f.name).try_cast(kind).alias(f.name))
    return df.select(*out)


def read_csv(spark: SparkSession, path: str, na_tokens=NA_TOKENS, infer: bool = True, sep: str = ",",
             malformed: str = "raise") -> DataFrame:
    """Header CSV (plain or ``.gz``) -> NA tokens to null -> typed columns.

    Quoted separators, quotes and line breaks are read by the rules of ``records``.
    Rows with too many fields raise an error, like in the reader the specs were
    written for; ``malformed="drop"`` leaves them out, and ``read_csv_apart`` returns them.
    """
    rows, bad = read_csv_apart(spark, path, na_tokens, infer, sep)
    if malformed == "raise":
        first = bad.limit(3).collect()
        if first:
            raise ValueError(f"{bad.count()} malformed rows in {path}, e.g. {[r['text'][:200] for r in first]}")
    elif malformed != "drop":
        raise ValueError(f"unknown choice for malformed rows: {malformed!r}")
    return rows


def read_csv_apart(spark: SparkSession, path: str, na_tokens=NA_TOKENS, infer: bool = True,
                   sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(typed rows, malformed rows as ``text``).  Compressed files are dealt to all tasks after the scan."""
    rows, bad = read_records(spark, path, sep)
    check_unique_names(rows)
    rows = normalize_na(rows, tokens=na_tokens)
    return (infer_types(rows) if infer else rows), bad
