from pyspark.sql import functions as F

from tabprep.operators import features
from tabprep.operators.training import SearchSpace
from tabprep.plans.workflow import run_workflow
from tabprep.spec import TabularSpec
from tabprep.streaming.scoring import score_stream


def test_regression_workflow_and_stream_scoring(spark, sf, tmp_path):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        (F.col("l_extendedprice") / 1000).alias("price"), "l_quantity", "l_discount", "l_returnflag",
        "l_linestatus")
    spec = TabularSpec(target_column="price", ml_task="regression", objective="reg:linear",
                       objective_type="Minimize", ml_eval_metric="rmse", ml_metric_threshold=60.0,
                       drop_columns="l_linestatus", strategy="augment")
    res = run_workflow(spark, li, spec, space=SearchSpace(max_depth=(2, 3), num_round=(3, 5)),
                       n_trials=2, parallelism=2, out_dir=str(tmp_path / "out"))
    counts = {r["split"]: r["count"] for r in res.splits.groupBy("split").count().collect()}
    assert counts == {"test": 12000, "validation": 12000, "train": 36000}
    g = res.gate.first()
    assert g["metric"] == "rmse" and g["passed"] and res.published
    assert spark.read.parquet(str(tmp_path / "out" / "registry")).count() == 1

    # the same fitted encoding + model score a stream
    src = tmp_path / "stream_src"
    li.limit(500).write.parquet(str(src))
    stream = spark.readStream.schema(li.schema).parquet(str(src))
    q = (score_stream(stream, res.preprocessor, res.model, "regression", keep=["price"])
         .writeStream.format("memory").queryName("scored").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT count(*) AS n FROM scored").first()["n"] == 500


def test_classification_workflow_writes_outputs(spark, sf, tmp_path):
    from tabprep.plans.catalog import docs_labelled
    df = docs_labelled(spark, sf).select("quality", "lang", "source", "n_chars")
    spec = TabularSpec(target_column="quality", ml_eval_metric="f1", strategy="augment")
    out = str(tmp_path / "job")
    res = run_workflow(spark, df, spec, space=SearchSpace(max_depth=(2, 2), num_round=(3, 3)),
                       n_trials=1, parallelism=1, out_dir=out, synthesizer="copula")
    assert res.published
    assert spark.read.parquet(f"{out}/train_source").count() == 239
    assert spark.read.json(f"{out}/synthetic/summary").first()["overall"] > 0
    assert spark.read.parquet(f"{out}/synthetic/sample").count() == 100
    cm = res.report.first()["confusion_matrix"]
    assert sum(map(sum, cm)) == 80


def test_spec_normalisation():
    s = TabularSpec(target_column="y", drop_columns="id", target_balance=None, objective_type="Maximize")
    assert s.drop_columns == ["id"] and s.target_balance == 1.0 and s.maximize


def test_spec_from_three_section_dict():
    d = {"dataset": {"name": "house-rent", "train_path": "s3a://bucket/train.csv", "validation_path": None,
                     "test_path": None, "target_column": "Rent",
                     "drop_columns": ["Area Locality", "Point of Contact"]},
         "ML": {"ml_task": "regression", "objective": "reg:linear", "objective_type": "Minimize",
                "ml_eval_metric": "rmse", "ml_metric_threshold": 6.0},
         "generator": {"strategy": "augment", "generate_factor": 1.0, "target_balance": None,
                       "mode": "cloud", "sink_bucket": None}}
    s = TabularSpec.from_dict(d)
    assert (s.target_column, s.ml_task, s.strategy, s.maximize, s.target_balance) == \
        ("Rent", "regression", "augment", False, 1.0)
    assert s.drop_columns == ["Area Locality", "Point of Contact"]
    churn = {"dataset": {"target_column": "Exited", "drop_columns": "CustomerId"},
             "ML": {"ml_task": "classification", "objective_type": "Maximize", "ml_eval_metric": "aucpr"},
             "gen": {"strategy": "balance", "generate_factor": 1.0, "target_balance": 1.0}}
    s = TabularSpec.from_dict(churn)
    assert s.drop_columns == ["CustomerId"] and s.strategy == "balance" and s.maximize


def test_csv_job_with_supplied_test_file(spark, sf, tmp_path):
    from tabprep.plans.catalog import docs_labelled
    from tabprep.sources.csv import read_csv
    rows = docs_labelled(spark, sf).select(
        "doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("Quality Flag"),
        F.coalesce("lang", F.lit("N/A")).alias("lang"), "source",
        F.coalesce(F.col("n_chars").cast("string"), F.lit("NA")).alias("n_chars"))
    main_dir, test_dir = str(tmp_path / "train_csv"), str(tmp_path / "test_csv")
    rows.where(F.col("doc_id") % 4 != 0).write.option("header", True).csv(main_dir)
    rows.where(F.col("doc_id") % 4 == 0).write.option("header", True).csv(test_dir)
    main, test = read_csv(spark, main_dir), read_csv(spark, test_dir)
    assert dict(main.dtypes)["n_chars"] == "bigint"
    spec = TabularSpec(target_column="Quality Flag", drop_columns="doc_id", ml_eval_metric="aucpr",
                       strategy="balance")
    res = run_workflow(spark, main, spec, test_df=test.drop("doc_id"),
                       space=SearchSpace(max_depth=(2, 2), num_round=(3, 3)), n_trials=1, parallelism=1)
    counts = {r["split"]: r["count"] for r in res.splits.groupBy("split").count().collect()}
    assert counts["test"] == test.count()
    n_main = main.count()
    assert counts["validation"] == -(-n_main // 4) and counts["train"] == n_main - counts["validation"]
    # supplied test labels got the fitted codes (bad=0, good=1)
    codes = {r["Quality Flag"] for r in res.splits.where(F.col("split") == "test").collect()}
    assert codes == {0, 1}
    assert res.gate.first()["metric"] == "aucpr"


def test_row_key_from_parquet_position_or_checkpoint(spark, sf, tmp_path):
    from tabprep.plans.workflow import with_row_key
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus")
    k = with_row_key(o.where("o_orderstatus <> 'P'"))
    plan = k._jdf.queryExecution().analyzed().toString()
    assert "LogicalRDD" not in plan          # no checkpoint: keyed from the scan
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        again = with_row_key(o.where("o_orderstatus <> 'P'"))
        assert again.rdd.getNumPartitions() > 1
        assert k.exceptAll(again).count() == 0 and k.select("_row_key").distinct().count() == k.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    csv_dir = str(tmp_path / "c")
    o.limit(50).write.option("header", True).csv(csv_dir)
    c = with_row_key(spark.read.option("header", True).csv(csv_dir))
    assert c.select("_row_key").distinct().count() == 50


def test_workflow_with_punctuated_names(spark, sf):
    from tabprep.plans.catalog import docs_labelled
    df = docs_labelled(spark, sf).select(
        F.col("doc_id").alias("row id"), F.col("quality").alias("Loan Status"),
        F.col("lang").alias("a.b"), F.col("n_chars").alias("Bankrupt?"), "source")
    spec = TabularSpec(target_column="Loan Status", key_column="row id", strategy="balance",
                       ml_eval_metric="f1")
    for synth in ("independent", "copula"):
        res = run_workflow(spark, df, spec, space=SearchSpace(max_depth=(2, 2), num_round=(2, 2)),
                           n_trials=1, parallelism=1, synthesizer=synth)
        assert res.gate.first()["metric"] == "f1"
        assert "num__Bankrupt?" in res.preprocessor.feature_names()


def test_run_spec_from_paths(spark, sf, tmp_path):
    from tabprep.plans.catalog import docs_labelled
    from tabprep.plans.workflow import run_spec
    rows = docs_labelled(spark, sf).select("doc_id", "quality", "lang", "source", "n_chars")
    rows.where(F.col("doc_id") % 5 != 0).write.option("header", True).csv(str(tmp_path / "train"))
    rows.where(F.col("doc_id") % 5 == 0).write.option("header", True).csv(str(tmp_path / "valid"))
    spec = TabularSpec.from_dict({
        "dataset": {"train_path": str(tmp_path / "train"), "validation_path": str(tmp_path / "valid"),
                    "test_path": None, "target_column": "quality", "drop_columns": "doc_id"},
        "ML": {"ml_task": "classification", "objective_type": "Maximize", "ml_eval_metric": "aucpr"},
        "gen": {"strategy": None}})
    res = run_spec(spark, spec, space=SearchSpace(max_depth=(2, 2), num_round=(2, 2)), n_trials=1,
                   parallelism=1)
    counts = {r["split"]: r["count"] for r in res.splits.groupBy("split").count().collect()}
    n_train_file = spark.read.option("header", True).csv(str(tmp_path / "train")).count()
    assert counts["validation"] == spark.read.option("header", True).csv(str(tmp_path / "valid")).count()
    assert counts["test"] == -(-n_train_file * 2 // 10)


def test_spec_values_are_kept_or_refused():
    import pytest
    zero = {"dataset": {"target_column": "y"}, "gen": {"strategy": "augment", "generate_factor": 0}}
    assert TabularSpec.from_dict(zero).generate_factor == 0.0
    zero["gen"]["generate_factor"] = None
    assert TabularSpec.from_dict(zero).generate_factor == 1.0
    assert TabularSpec("y", ml_task="regression").objective == "reg:squarederror"
    with pytest.raises(ValueError):
        TabularSpec("y", objective="rank:pairwise")
    with pytest.raises(ValueError):
        TabularSpec("y", ml_task="regression", objective="binary:logistic")


def test_stages_run_alone_from_files(spark, sf, tmp_path):
    """Every stage starts from the stored files; a text column whose test file holds only digits keeps its type."""
    from tabprep.plans import workflow as w
    from tabprep.plans.catalog import docs_labelled
    df = docs_labelled(spark, sf).select(F.col("doc_id").alias("id"), "quality", "source", "n_chars")
    main = df.where(F.col("id") % 5 != 0)
    test = df.where(F.col("id") % 5 == 0).withColumn("source", (F.col("id") % 7).cast("string")) \
        .withColumn("n_chars", F.lit("1000000"))
    spec = TabularSpec(target_column="quality", key_column="id", strategy="replace", ml_eval_metric="aucpr")
    out = str(tmp_path / "job")
    fitted = w.prepare(spark, main, spec, out, test_df=test, csv=True)
    plain = spark.read.csv(f"{out}/encoded_csv/test").collect()
    assert len(plain) == test.count() and len(plain[0]) == 1 + len(fitted.feature_names())
    assert {r["_c0"] for r in plain} <= {"0", "1"}
    alone = features.TabularPreprocessor(["source", "n_chars"]).fit(main.select("source", "n_chars"))
    assert fitted.numeric == alone.numeric and fitted.categorical == alone.categorical
    encoded = spark.read.parquet(f"{out}/encoded")
    assert {r["split"] for r in encoded.select("split").distinct().collect()} == {"train", "validation", "test"}
    w.synthesize(spark, spec, out)
    assert {r["origin"] for r in spark.read.parquet(f"{out}/train_augmented").select("origin").distinct().collect()} == {"synthetic"}
    space = SearchSpace(max_depth=(2, 2), num_round=(2, 2))
    w.train_stage(spark, spec, out, space, n_trials=1, parallelism=1)
    first = w.evaluate_stage(spark, spec, out).first()
    assert w.evaluate_stage(spark, spec, out).first() == first
    assert first["tp"] + first["fn"] + first["tn"] + first["fp"] == test.count()
    g, published = w.gate_stage(spark, spec, out)
    assert published and g.first()["passed"] and spark.read.json(f"{out}/evaluation").count() == 1


def test_job_tunes_its_generator(spark, sf, tmp_path):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_orderkey % 20 = 0").select(
        (F.col("l_extendedprice") / 1000).alias("price"), "l_quantity", "l_returnflag")
    spec = TabularSpec(target_column="price", ml_task="regression", objective_type="Minimize", ml_eval_metric="rmse",
                       ml_metric_threshold=1000.0, strategy="augment")
    out = str(tmp_path / "job")
    res = run_workflow(spark, li, spec, synthesizer="tuned", generator_trials=2, generator_parallelism=2, inner_trials=1,
                       space=SearchSpace(max_depth=(2, 2), num_round=(2, 3)), n_trials=1, parallelism=1, out_dir=out)
    trials = spark.read.json(f"{out}/generator_trials").collect()
    assert len(trials) == 2 and all(r["value"] > 0 for r in trials) and res.published
    assert spark.read.parquet(f"{out}/train_augmented").where("origin = 'synthetic'").count() > 0


def test_colliding_feature_names(spark):
    df = spark.createDataFrame([("b_c", "c"), ("x", "y"), ("b_c", "y")], "a string, a_b string")
    fitted = features.TabularPreprocessor().fit(df)
    names = fitted.feature_names()
    assert len({n.lower() for n in names}) == len(names) and "cat__a_b_c" in names and "cat__a_b_c__2" in names
    flat = [tuple(r) for r in fitted.transform(df).collect()]
    dense = [tuple(r["features"].toArray()) for r in fitted.transform(df, assemble=True).collect()]
    assert flat == dense


def test_java_number_literals_are_text(spark):
    from tabprep.sources.csv import infer_types
    df = spark.createDataFrame([("1d", "2f", "1.5", "7", "-1e3", "inf")], "a string, b string, c string, d string, e string, f string")
    assert dict(infer_types(df).dtypes) == {"a": "string", "b": "string", "c": "double", "d": "bigint", "e": "double", "f": "double"}
