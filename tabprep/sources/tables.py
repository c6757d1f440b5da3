"""Stage inputs and outputs: parquet between stages, CSV / JSON at the edges."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.names import qcol


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> None:
    """Encoded rows partitioned by split: readers prune to one split."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)


def expand_vector(df: DataFrame, vec: str, names: list[str], keep=()) -> DataFrame:
    """Dense columns from a vector column (label first), for CSV sinks."""
    arr = vector_to_array(F.col(vec))
    return df.select(*[qcol(k) for k in keep], *[arr[i].alias(n) for i, n in enumerate(names)])


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """CSV that every common reader takes: quotes are doubled, blanks at the ends of texts stay."""
    df.write.mode(mode).option("header", header).option("escape", '"').option("emptyValue", '""') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)
