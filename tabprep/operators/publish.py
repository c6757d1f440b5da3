"""Best trial, metric gate and publishing a passing model.

A published model is a version: a folder of its own below the model path and a
row of the registry that names it.  The folder is written first and never
again; the row, one file that Spark's committer moves into place, makes it
visible.  A publication that fails before leaves the earlier versions as they were.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_trial(trials: DataFrame, metric: str, maximize: bool, trial_col: str = "trial") -> DataFrame:
    """The winning trial row; ties go to the earliest trial (top-1 report)."""
    order = F.col(metric).desc() if maximize else F.col(metric).asc()
    return trials.where(F.col(metric).isNotNull()).orderBy(order, F.col(trial_col).asc()).limit(1)


def gate(report: DataFrame, metric: str, threshold: float, maximize: bool,
         strict: bool = False, keep=()) -> DataFrame:
    """One row: metric, value, threshold, passed (plus ``keep`` columns).

    ``report`` has the nested ``metrics.<name>.value`` layout.  By default
    equality passes (``>=`` / ``<=``); ``strict`` makes it ``>`` / ``<``.
    """
    v = F.col(f"metrics.{metric}.value").cast("double")
    thr = F.lit(float(threshold))
    if maximize:
        passed = v > thr if strict else v >= thr
    else:
        passed = v < thr if strict else v <= thr
    return report.select(F.lit(metric).alias("metric"), v.alias("value"), thr.alias("threshold"),
                         F.coalesce(passed, F.lit(False)).alias("passed"), *keep)


_ENTRY = "run_id string, model_path string, framework string, metric string, value double, threshold double, published_at string"


def registry(spark, registry_path: str) -> DataFrame:
    """The registry's rows, one per published run; empty before the first."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(_ENTRY).parquet(registry_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _ENTRY)


def latest_model_path(spark, registry_path: str) -> str | None:
    """Folder of the version published last, or None."""
    row = registry(spark, registry_path).orderBy(F.desc("published_at"), F.desc("run_id")).limit(1).first()
    return row["model_path"] if row else None


def run_id_of(*parts) -> str:
    """A run's id from what defines it (paths, metric values): a repeat gets the same."""
    return hashlib.sha256("|".join(map(repr, parts)).encode()).hexdigest()[:16]


def publish_if_passed(spark, gate_row: DataFrame, model, model_path: str, registry_path: str,
                      framework: str = "spark-ml-gbt", run_id: str | None = None) -> bool:
    """Save the model as a new version and register it if the gate passed.

    A repeat of a registered run (by ``run_id``; by default every call is a run of
    its own) adds nothing.  What an earlier attempt of the same run left
    unregistered is written anew.
    """
    row = gate_row.first()
    if not row["passed"]:
        return False
    run_id = run_id or uuid.uuid4().hex[:16]
    if registry(spark, registry_path).where(F.col("run_id") == run_id).limit(1).count():
        return True
    version = f"{model_path}/{run_id}"
    model.write().overwrite().save(version)
    entry = spark.createDataFrame(
        [(run_id, version, framework, row["metric"], float(row["value"]), float(row["threshold"]),
          _dt.datetime.now(_dt.timezone.utc).isoformat())], _ENTRY)
    entry.coalesce(1).write.mode("append").parquet(registry_path)
    return True
