import pytest
from pyspark.sql import functions as F

from tabprep.operators import metrics
from tabprep.operators.publish import best_trial, gate, latest_model_path, publish_if_passed, registry


def test_gate_equality(spark):
    rep = spark.createDataFrame([(0.5,)], "f1 double")
    s = metrics.report_struct(rep, names=("f1",))
    assert gate(s, "f1", 0.5, maximize=True).first()["passed"] is True
    assert gate(s, "f1", 0.5, maximize=True, strict=True).first()["passed"] is False
    assert gate(s, "f1", 0.5, maximize=False).first()["passed"] is True


def test_best_trial_ties_to_first(spark):
    t = spark.createDataFrame([(0, 0.7), (1, 0.9), (2, 0.9)], "trial int, value double")
    assert best_trial(t, "value", True).first()["trial"] == 1
    assert best_trial(t, "value", False).first()["trial"] == 0


def test_publish_appends_registry(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    train = spark.createDataFrame([(Vectors.dense([0.0]), 0.0), (Vectors.dense([1.0]), 1.0)],
                                  ["features", "label"])
    model = LogisticRegression(maxIter=2).fit(train)
    rep = metrics.report_struct(spark.createDataFrame([(0.8,)], "f1 double"), names=("f1",))
    ok = publish_if_passed(spark, gate(rep, "f1", 0.0, True), model, str(tmp_path / "m"),
                           str(tmp_path / "reg"))
    assert ok and spark.read.parquet(str(tmp_path / "reg")).count() == 1
    no = publish_if_passed(spark, gate(rep, "f1", 0.9, True), model, str(tmp_path / "m2"),
                           str(tmp_path / "reg"))
    assert not no and spark.read.parquet(str(tmp_path / "reg")).count() == 1


class _Model:
    """A model of one number; writing may fail half way."""

    def __init__(self, spark, value, fails=False):
        self.spark, self.value, self.fails = spark, value, fails

    def write(self):
        return self

    def overwrite(self):
        return self

    def save(self, path):
        self.spark.createDataFrame([(self.value,)], "value int").write.mode("overwrite").parquet(f"{path}/data")
        if self.fails:
            raise OSError("lost while writing")


def test_failed_publication_leaves_the_first_version(spark, tmp_path):
    rep = metrics.report_struct(spark.createDataFrame([(0.8,)], "f1 double"), names=("f1",))
    passed, where, reg = gate(rep, "f1", 0.5, True), str(tmp_path / "model"), str(tmp_path / "registry")
    held = lambda: spark.read.parquet(f"{latest_model_path(spark, reg)}/data").first()["value"]
    assert registry(spark, reg).count() == 0 and latest_model_path(spark, reg) is None
    assert publish_if_passed(spark, passed, _Model(spark, 1), where, reg, run_id="a") and held() == 1
    with pytest.raises(OSError):
        publish_if_passed(spark, passed, _Model(spark, 2, fails=True), where, reg, run_id="b")
    assert held() == 1 and registry(spark, reg).count() == 1
    assert publish_if_passed(spark, passed, _Model(spark, 2), where, reg, run_id="b") and held() == 2
    # a repeat neither writes the model nor adds a row
    assert publish_if_passed(spark, passed, _Model(spark, 3, fails=True), where, reg, run_id="b")
    assert held() == 2 and [r["run_id"] for r in registry(spark, reg).orderBy("published_at").collect()] == ["a", "b"]
