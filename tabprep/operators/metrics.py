"""Classification and regression reports as Spark aggregates.

The precision-recall and ROC quantities are running sums over scores in
descending order.  Rows first collapse to one row per distinct score (a hot
score becomes one row), then ``running_totals_desc`` adds the cumulative
positives / negatives without a single-partition window.

Semantics follow the usual library definitions: one curve point per
distinct score; ROC AUC by trapezoids (ties handled exactly); average
precision as the step sum ``sum((R_i - R_{i-1}) * P_i)`` (not the
interpolated area); best-F1 over points with precision or recall above
zero, ties to the lowest threshold.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.functions.ranks import running_totals_desc


def _f(x) -> Column:
    return x.cast("double")


def score_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score: (threshold, pos, neg).

    A missing or NaN score has no place on the curve; such rows form the null
    threshold, and the reports refuse a table that has any.
    """
    y = qcol(label)
    s = qcol(score).cast("double")
    return (df.groupBy(F.when(~F.isnan(s), s).alias("threshold"))
            .agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(y == 1, 0).otherwise(1)).cast("long").alias("neg")))


class UnscoredRows(ValueError):
    """Some rows have no score: a report over the others would be incomplete."""


def _check_scored(n: int) -> None:
    if n:
        raise UnscoredRows(f"{n} rows have a null or NaN score or prediction")


def score_coverage(df: DataFrame, score: str) -> DataFrame:
    """One row: n_rows and n_unscored (null or NaN scores)."""
    s = qcol(score).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(s.isNull() | F.isnan(s)).alias("n_unscored"))


def _check_binary(df: DataFrame, label: str) -> None:
    bad = df.where(~qcol(label).isin(0, 1) | qcol(label).isNull()).limit(1).count()
    if bad:
        raise ValueError(f"metrics are binary: label {label!r} must hold only 0 and 1")


def pr_curve(df: DataFrame, label: str, score: str, check: bool = True,
             rows_per_bucket: int = 1_000_000, per: DataFrame | None = None
             ) -> tuple[DataFrame, int, int]:
    """Curve points (threshold, pos, neg, tp, fp, precision, recall) and (P, N).

    The per-score table is read several times (totals, bucket edges, curve);
    pass a persisted one as ``per`` to control its lifetime, otherwise it is
    persisted here and stays cached while the returned curve is in use.
    """
    if check:
        _check_binary(df, label)
    if per is None:
        per = score_points(df, label, score).persist(StorageLevel.MEMORY_AND_DISK)
    tot = per.agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("P"), F.sum("neg").alias("N"),
                  F.sum(F.when(F.col("threshold").isNull(), F.col("pos") + F.col("neg"))).alias("unscored")).first()
    _check_scored(int(tot["unscored"] or 0))
    n, P, N = int(tot["n"]), int(tot["P"] or 0), int(tot["N"] or 0)
    curve = running_totals_desc(per, "threshold", {"pos": "tp", "neg": "fp"},
                                rows_per_bucket=rows_per_bucket, n=n)
    curve = (curve
             .withColumn("precision", F.when(F.col("tp") + F.col("fp") > 0,
                                             _f(F.col("tp")) / _f(F.col("tp") + F.col("fp")))
                         .otherwise(0.0))
             .withColumn("recall", _f(F.col("tp")) / F.lit(float(P)) if P > 0 else F.lit(1.0)))
    return curve, P, N


def _kept() -> Column:
    """Points that count for F1: precision or recall above zero."""
    return ~((F.col("precision") == 0) & (F.col("recall") == 0))


def _f1_of_point() -> Column:
    return F.when(_kept(), (2 * (F.col("precision") * F.col("recall"))) / (F.col("precision") + F.col("recall")))


def _best_point() -> Column:
    """The point with the largest F1, ties to the lowest threshold."""
    return F.max_by(F.struct("threshold", "f1", "precision", "recall", "tp", "fp"),
                    F.when(_kept(), F.struct(F.col("f1"), -F.col("threshold"))))


def _point_columns(P: int, N: int) -> list[Column]:
    return [F.col("b.threshold").alias("threshold"), F.col("b.f1").alias("f1"),
            F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall"),
            (F.lit(N) - F.col("b.fp")).cast("long").alias("tn"), F.col("b.fp").alias("fp"),
            (F.lit(P) - F.col("b.tp")).cast("long").alias("fn"), F.col("b.tp").alias("tp")]


def _area_terms(P: int, N: int) -> list[Column]:
    """ROC AUC (null with one class) and average precision."""
    roc = F.sum(_f(F.col("neg")) * (2.0 * _f(F.col("tp")) - _f(F.col("pos"))))
    ap = F.sum(_f(F.col("pos")) * F.col("precision"))
    return [(roc / F.lit(2.0 * P * N) if P > 0 and N > 0 else F.lit(None).cast("double")).alias("auc"),
            (ap / F.lit(float(P)) if P > 0 else F.lit(0.0)).alias("aucpr")]


def best_f1(curve: DataFrame, P: int, N: int) -> DataFrame:
    """One row: threshold, f1, precision, recall and the confusion counts."""
    return curve.withColumn("f1", _f1_of_point()).agg(_best_point().alias("b")).select(*_point_columns(P, N))


def auc_terms(curve: DataFrame, P: int, N: int) -> DataFrame:
    """One row: ROC AUC (null with one class) and average precision."""
    return curve.agg(*_area_terms(P, N))


def classification_report(df: DataFrame, label: str, score: str,
                          per: DataFrame | None = None) -> DataFrame:
    """One row: auc, aucpr, precision, recall, f1, threshold, tn/fp/fn/tp and
    ``confusion_matrix`` as ``[[tn, fp], [fn, tp]]``.

    Every row takes part: a null or NaN score raises ``UnscoredRows``."""
    curve, P, N = pr_curve(df, label, score, per=per)
    # best-F1 point, ROC AUC and average precision in one pass over the curve
    row = curve.withColumn("f1", _f1_of_point()).agg(_best_point().alias("b"), *_area_terms(P, N))
    row = row.select(*_point_columns(P, N), "auc", "aucpr")
    return row.withColumn("confusion_matrix", F.array(F.array("tn", "fp"), F.array("fn", "tp")))


def classification_reports(df: DataFrame, label: str, scores: list) -> DataFrame:
    """The report of every score column, a row each (``score_column`` first), in one pass over the rows.

    Distinct scores are counted by (column, score), range-partitioned by column
    and falling score and stored, which fixes each row's range; running totals are a
    window within a range plus the totals of the column's earlier ranges.  Nulls
    and NaNs raise ``UnscoredRows`` as in a single report; no rows give no report.
    """
    from pyspark.sql import Window

    from tabprep.session import store

    _check_binary(df, label)
    y = qcol(label)
    long = df.select(y.alias("y"), F.posexplode(F.array(*[qcol(s).cast("double") for s in scores])).alias("at", "s"))
    per = long.groupBy("at", F.when(~F.isnan("s"), F.col("s")).alias("threshold")) \
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    falling = [F.col("at"), F.col("threshold").desc()]
    per = store(per.repartitionByRange(*falling).sortWithinPartitions(*falling).withColumn(
        "part", F.shiftright(F.monotonically_increasing_id(), 33)), "score-points")  # the partition, fixed by storing
    ranges = per.groupBy("at", "part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum(F.when(
        F.col("threshold").isNull(), F.col("pos") + F.col("neg"))).alias("unscored"))
    _check_scored(ranges.agg(F.sum("unscored").alias("n")).first()["n"] or 0)
    own = Window.partitionBy("at")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("at", "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in "pn"],
                            *[F.sum(c).over(own).alias(f"{c}all") for c in "pn"])  # a row a range
    upto = Window.partitionBy("at", "part").orderBy(F.col("threshold").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    curve = per.join(offsets, ["at", "part"]).withColumn("tp", F.col("p0") + F.sum("pos").over(upto)) \
        .withColumn("fp", F.col("n0") + F.sum("neg").over(upto)) \
        .withColumn("precision", _f(F.col("tp")) / _f(F.col("tp") + F.col("fp"))) \
        .withColumn("recall", F.when(F.col("pall") > 0, _f(F.col("tp")) / F.col("pall")).otherwise(1.0)) \
        .withColumn("f1", _f1_of_point())
    roc = F.sum(_f(F.col("neg")) * (2.0 * _f(F.col("tp")) - _f(F.col("pos"))))
    rows = curve.groupBy("at").agg(
        _best_point().alias("b"), F.max("pall").alias("P"), F.max("nall").alias("N"), roc.alias("roc"),
        F.sum(_f(F.col("pos")) * F.col("precision")).alias("ap"))
    names = F.array(*[F.lit(s) for s in scores])
    area = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("roc") / (2.0 * _f(F.col("P")) * _f(F.col("N"))))
    return rows.select(F.element_at(names, F.col("at") + 1).alias("score_column"), "b.threshold", "b.f1", "b.precision",
                       "b.recall", (F.col("N") - F.col("b.fp")).alias("tn"), F.col("b.fp").alias("fp"),
                       (F.col("P") - F.col("b.tp")).alias("fn"), F.col("b.tp").alias("tp"), area.alias("auc"),
                       F.when(F.col("P") > 0, F.col("ap") / F.col("P")).otherwise(0.0).alias("aucpr")) \
        .withColumn("confusion_matrix", F.array(F.array("tn", "fp"), F.array("fn", "tp")))


# The names under which reports are stored and gated.
def metrics_struct(report: DataFrame, names=("auc", "aucpr", "precision", "recall", "f1",
                                             "confusion_matrix")) -> Column:
    """``metrics.<name>.value`` (and ``.std`` where present) as one struct Column."""
    present = [n for n in names if n in report.columns]
    return F.struct(*[
        F.struct(F.col(n).alias("value"), *([F.col(n + "_std").alias("std")]
                                             if n + "_std" in report.columns else [])).alias(n)
        for n in present])


def report_struct(report: DataFrame, names=("auc", "aucpr", "precision", "recall", "f1",
                                            "confusion_matrix")) -> DataFrame:
    """Nest a flat report into ``metrics.<name>.value`` (the JSON layout)."""
    return report.select(metrics_struct(report, names).alias("metrics"))


def regression_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: mse, mae, rmse, R2 and their population spreads.

    ``rmse_std`` equals ``mae_std`` (std of absolute errors).  The R2 spread
    is over ``1 - e^2 / (y - mean(y))^2`` and skips rows with y equal to the
    mean, where that ratio is undefined.
    """
    y = _f(qcol(label))
    p = _f(qcol(pred))
    base = df.select(y.alias("y"), p.alias("p")).where(F.col("y").isNotNull())
    seen = base.agg(F.avg("y").alias("ybar"), F.count_if(F.col("p").isNull() | F.isnan("p")).alias("unscored")).first()
    ybar = seen["ybar"]
    if ybar is None:
        raise ValueError("no rows to score")
    _check_scored(seen["unscored"])
    e2 = (F.col("y") - F.col("p")) * (F.col("y") - F.col("p"))
    ae = F.abs(F.col("y") - F.col("p"))
    d2 = (F.col("y") - F.lit(ybar)) * (F.col("y") - F.lit(ybar))
    ratio = F.when(d2 != 0, 1.0 - e2 / d2)
    agg = base.agg(F.avg(e2).alias("mse"), F.avg(ae).alias("mae"),
                   F.stddev_pop(e2).alias("mse_std"), F.stddev_pop(ae).alias("mae_std"),
                   F.sum(e2).alias("_sse"), F.sum(d2).alias("_sst"),
                   F.stddev_pop(ratio).alias("R2_std"))
    r2 = (F.when(F.col("_sst") != 0, 1.0 - F.col("_sse") / F.col("_sst"))
          .when(F.col("_sse") == 0, 1.0).otherwise(0.0))
    return agg.select("mse", "mae", F.sqrt("mse").alias("rmse"), r2.alias("R2"), "mse_std",
                      "mae_std", F.col("mae_std").alias("rmse_std"), "R2_std")


def predict_at(score: Column, threshold: float) -> Column:
    """Hard label: 1 where ``score >= threshold``."""
    return (score >= F.lit(float(threshold))).cast("int")


def confusion_at(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row: tn, fp, fn, tp of ``score >= threshold`` (four counts, one pass)."""
    y = qcol(label)
    p = predict_at(qcol(score), threshold)
    return df.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def classification_metrics(df: DataFrame, label: str, score: str):
    """The classification report as a collected Row; its cache is released."""
    return collected_report(df, label, score).first()


def collected_report(df: DataFrame, label: str, score: str) -> DataFrame:
    """The classification report, computed once into a one-row table; its cache is released."""
    _check_binary(df, label)
    per = score_points(df, label, score).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        report = classification_report(df, label, score, per=per)
        return df.sparkSession.createDataFrame(report.collect(), report.schema)
    finally:
        per.unpersist()
