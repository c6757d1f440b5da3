"""Deterministic per-row order keys and uniforms.

``md5(seed|key)`` depends only on the row's key, never on partitioning or
task retries, so a lost executor recomputes exactly the same split / sample.
The same expression in DuckDB gives the same digest, which is what makes
the split and sampling operators checkable against SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = float(2 ** 52)


def _to_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def hash_key(seed, *parts) -> Column:
    """Hex md5 of ``seed|part1|part2...`` (parts cast to string)."""
    cols = [F.lit(str(seed))] + [_to_col(p).cast("string") for p in parts]
    return F.md5(F.concat_ws("|", *cols))


def hash_uniform(seed, *parts) -> Column:
    """Uniform in [0, 1): first 13 hex digits of the md5 as an integer / 2^52."""
    return uniform_from_hex(hash_key(seed, *parts))


def uniform_from_hex(h: Column) -> Column:
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(TWO_POW_52)


def range_partitions(spark, n: int, rows_per_partition: int = 1_000_000) -> int:
    """Partitions for ``spark.range(n)``: at least the cluster's parallelism,
    at most ~``rows_per_partition`` generated rows per task."""
    try:
        par = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect sessions have no SparkContext
        par = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return int(max(1, min(max(par, n // rows_per_partition + 1), max(par, 200_000), max(n, 1))))


# ---- counter-based uniforms for Arrow-batched tasks ----

_M64 = (1 << 64) - 1


def _splitmix64(x):
    """SplitMix64 finaliser on a uint64 numpy array (wrapping arithmetic)."""
    import numpy as np
    x = (x + np.uint64(0x9E3779B97F4A7C15)) & np.uint64(_M64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream_key(seed, *salt) -> int:
    """A 64-bit stream id from the seed and a salt (stable across processes)."""
    import hashlib
    h = hashlib.md5("|".join([str(seed), *map(str, salt)]).encode()).hexdigest()
    return int(h[:16], 16)


def np_uniform(stream: int, ids):
    """Uniform in (0, 1) per id for one stream: a pure function of (stream, id)."""
    import numpy as np
    with np.errstate(over="ignore"):
        x = _splitmix64(np.asarray(ids, dtype=np.uint64) ^ np.uint64(stream))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
