"""Column-name helpers.

Names in real job specs carry spaces and punctuation (``Loan Status``,
``Bankrupt?``, ``a.b``), so every reference goes through ``qcol`` which
backtick-quotes the name instead of letting Spark parse it as a path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    return F.col(quote(name))


def check_unique_names(df: DataFrame) -> None:
    """Spark resolves names case-insensitively; reject case-only duplicates."""
    seen: dict[str, str] = {}
    for c in df.columns:
        low = c.lower()
        if low in seen:
            raise ValueError(
                f"columns {seen[low]!r} and {c!r} differ only by case; rename one")
        seen[low] = c


def require_columns(df: DataFrame, cols) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}; available: {df.columns}")
