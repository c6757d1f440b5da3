"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.session import drop_stored, release, store, stored_paths

#: ASCII white space: words are the maximal runs of other characters.
SPACE = r"\x20\x09-\x0D"


def small_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python tasks in batches of 1000 rows or 16 MB, unless the session chose others.

    Spark's defaults of 10,000 rows and 64 MB suit narrow rows; with whole texts the
    batches alone would take a good part of a task's memory.
    """
    for what, usual, less in (("Records", "10000", "1000"), ("Bytes", "67108864b", "16m")):
        name = f"spark.sql.execution.arrow.max{what}PerBatch"
        if spark.conf.get(name, usual) == usual:
            spark.conf.set(name, less)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | Column) -> Column:
    """The whole text as UTF-8 bytes; null counts as empty.

    Tasks get bytes because ``bytes.lower`` folds A-Z alone and
    ``bytes.split`` cuts at ASCII white space alone.
    """
    c = F.col(text) if isinstance(text, str) else text
    return F.encode(F.coalesce(c, F.lit("")), "UTF-8")


def word_count(text: str | Column) -> Column:
    """Number of words (null: 0): word starts, that is non-space after space or start."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def row(df: DataFrame) -> Column:
    """All columns of a row as one struct ``_row``, so that helper columns never clash with them."""
    return F.struct(*[qcol(c) for c in df.columns]).alias("_row")


#: Rows of a key table that may be broadcast (about 20 MB); beyond, Spark shuffles.
BROADCAST_ROWS = 500_000


def small_side(keys: DataFrame, label: str) -> DataFrame:
    """``keys``, stored and counted: broadcast if it has at most BROADCAST_ROWS rows."""
    keys = store(keys, label)
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small driver-made table as one literal (no Python rows in the plan)."""
    import json

    names = [part.strip().split()[0] for part in schema.split(",")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(
        F.inline(F.from_json(F.lit(text), f"array<struct<{', '.join(':'.join(p.split()) for p in schema.split(','))}>>"))
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words (bytes), remembered within a task.

    The memory is bounded: at ``limit`` remembered words it starts afresh.
    """

    class _Ids(dict):
        def __init__(self, owner):
            super().__init__()
            self.owner = owner

        def __missing__(self, word: bytes) -> int:
            import xxhash

            i = self[word] = len(self)
            if i >= len(self.owner.table):
                self.owner.table = np.concatenate([self.owner.table, np.zeros_like(self.owner.table)])
            self.owner.table[i] = xxhash.xxh64_intdigest(word)
            return i

    def __init__(self, limit: int = 150_000):
        self.limit, self.table, self.ids = limit, np.zeros(1 << 16, np.uint64), self._Ids(self)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.ids) > self.limit:
            self.ids.clear()
        ids = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        return self.table[ids]


def list_array(parts: list[np.ndarray], kind):
    """Numpy arrays as one Arrow list column."""
    import pyarrow as pa

    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat, kind)) if ends[-1] >= 2 ** 31 \
        else pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


__all__ = ["SPACE", "BROADCAST_ROWS", "WordHashes", "drop_stored", "list_array", "literal_table", "mix64", "release", "row", "small_batches", "small_side", "store", "stored_paths", "table", "utf8", "word_count"]
