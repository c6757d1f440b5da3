"""Scoring a stream with a fitted preprocessor and model.

The reference has no streaming operators.  Its two per-row stages - the
fitted encoding and model scoring - are stateless projections, so they run
unchanged on a streaming DataFrame; this module only wires them together.
No state, watermark or window is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabprep.operators import training


def score_stream(stream: DataFrame, fitted, model, task: str, keep=()) -> DataFrame:
    """Encoded features -> model score, for a batch or streaming DataFrame."""
    encoded = fitted.transform(stream, keep=list(keep), assemble=True)
    return training.score(model, encoded, task).select(*keep, "score")
