"""The end-to-end job: spec -> splits -> augmentation -> encoding ->
tuning -> refit -> test report -> gate -> publish.

Each stage is a function that reads the files of the stages before it and
writes its own, so any of them can run alone or again.  The source is scanned
once to type it; the typed rows and the split rows are written once.  Control
returns to the driver only for fitted parameters (medians, levels, class
counts, trial metrics).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.names import check_unique_names, qcol, require_columns
from tabprep.operators import features, metrics, sampling, training
from tabprep.operators.association import compare_associations, compare_components
from tabprep.operators.publish import gate, publish_if_passed, run_id_of
from tabprep.operators.synthesizer import SYNTH_ID, augment_training, generation_source, quality_by_column, quality_summary
from tabprep.session import drop_stored, ensure_checkpoint_dir, scratch_path, store
from tabprep.sources.csv import cast_like
from tabprep.sources.tables import expand_vector, read_report, read_table, write_csv, write_report, write_splits
from tabprep.spec import TabularSpec

KEY = "_row_key"


@dataclass
class WorkflowResult:
    splits: DataFrame
    preprocessor: features.FittedPreprocessor
    tuning: training.TuningResult
    model: object
    report: DataFrame
    gate: DataFrame
    published: bool


def with_row_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """Attach a unique row id that never changes on recomputation.

    Rows read straight from parquet files get ``file path # row index``
    from the scan's hidden ``_metadata`` column: a file position, so it does
    not depend on how files are split into tasks, and nothing is written.
    Other inputs (CSV, unions, aggregates) get ``monotonically_increasing_id``
    - which depends on partitioning - and are checkpointed (reliably, into
    ``spark.checkpoint.dir``) before any split or sample hashes the id.
    """
    try:
        keyed = df.withColumn(key, F.concat_ws("#", F.col("_metadata.file_path"),
                                               F.col("_metadata.row_index").cast("string")))
        keyed.schema  # resolve now: raises if the source has no row index
        return keyed
    except AnalysisException:
        ensure_checkpoint_dir(df.sparkSession)
        return df.withColumn(key, F.monotonically_increasing_id()).checkpoint(eager=True)


def prepare(spark: SparkSession, df: DataFrame, spec: TabularSpec, out_dir: str,
            test_df: DataFrame | None = None, val_df: DataFrame | None = None,
            fit_on: str = "all", csv: bool = False) -> features.FittedPreprocessor:
    """Stage 1: type, split and encode; writes ``splits``, ``train_source``, ``preprocess`` and ``encoded``.

    ``csv`` also writes each encoded split as CSV without header, label first
    (``encoded_csv/<split>``), for trainers that read text.

    The split rows are written once, partitioned by split; all later work
    reads them pruned.  ``fit_on="all"`` fits the encoders on the whole train
    source before it is split (the reference's behaviour), ``"train"`` on its
    train rows.  Supplied files never take part in a fit; their columns are
    cast to the train source's types.
    """
    check_unique_names(df)
    label = spec.target_column
    require_columns(df, [label])
    df = features.drop_columns(df, spec.drop_columns)
    key = spec.key_column
    if key is None:
        df = with_row_key(df)
        key = KEY
    feats = features.feature_columns(df, label, [key])
    supplied = [None if x is None else cast_like(x, df.schema) for x in (test_df, val_df)]

    # label codes (classification), fitted on the training source
    if spec.ml_task == "classification":
        enc = features.fit_label_encoding(df, label)
        coded = enc.apply(df)
        supplied = [None if x is None else _apply_codes(x, label, enc) for x in supplied]
    else:
        coded = df.withColumn(label, qcol(label).cast("double"))
        supplied = [None if x is None else x.withColumn(label, qcol(label).cast("double")) for x in supplied]
    stratify = label if spec.ml_task == "classification" else None
    coded = store(coded, "typed")
    splits = sampling.split_with_files(coded, key, *supplied, spec.seed, stratify)
    splits.write.mode("overwrite").partitionBy("split").parquet(f"{out_dir}/splits")
    splits = read_splits(spark, out_dir)
    fit_rows = coded if fit_on == "all" else splits.where(F.col("split") == "train")
    fitted = features.TabularPreprocessor(feats).fit(fit_rows.select(*[qcol(c) for c in feats]))
    drop_stored(coded)
    fitted.save(spark, f"{out_dir}/preprocess")
    splits.where(F.col("split") == "train").drop("split").write.mode("overwrite").parquet(f"{out_dir}/train_source")
    write_splits(_encode(fitted, splits, label, ["split"]), f"{out_dir}/encoded")
    if csv:
        encoded = read_table(spark, f"{out_dir}/encoded")
        for split in ("train", "validation", "test"):
            write_csv(expand_vector(encoded.where(F.col("split") == split), "features", fitted.feature_names(), ["label"]),
                      f"{out_dir}/encoded_csv/{split}", header=False)
    return fitted


def read_splits(spark: SparkSession, out_dir: str) -> DataFrame:
    return read_table(spark, f"{out_dir}/splits")


def _encode(fitted: features.FittedPreprocessor, part: DataFrame, label: str, keep=()) -> DataFrame:
    return fitted.transform(part.withColumnRenamed(label, "label"), keep=["label", *keep], assemble=True)


def synthesize(spark: SparkSession, spec: TabularSpec, out_dir: str, synthesizer: str = "independent",
               generator_trials: int = 16, generator_parallelism: int = 4, inner_trials: int = 6,
               inner_space: training.SearchSpace | None = None, report: bool = True) -> None:
    """Stage 2 (only with a strategy): synthetic rows, their report, and the encoded augmented train rows.

    ``synthesizer="tuned"`` searches the generator's settings by downstream
    quality on the validation rows and generates from the best one.
    """
    if spec.strategy is None:
        return
    fitted = features.FittedPreprocessor.load(spark, f"{out_dir}/preprocess")
    label, key = spec.target_column, spec.key_column or KEY
    train = read_table(spark, f"{out_dir}/train_source")
    conditional = spec.ml_task == "classification"
    source = generator = None
    if synthesizer == "tuned":
        valid = read_splits(spark, out_dir).where(F.col("split") == "validation")
        source = generation_source(train, label, key, spec.strategy, spec.target_balance, spec.seed, conditional)
        found = training.tune_generator(spark, source, valid, fitted, label, spec.ml_task, spec.ml_eval_metric,
                                        spec.maximize, generator_trials, generator_parallelism, inner_trials,
                                        spec.seed, inner_space)
        found.trials.coalesce(1).write.mode("overwrite").json(f"{out_dir}/generator_trials")
        generator = found.fitted
    rows = augment_training(spark, train, label, key, spec.strategy, spec.generate_factor, spec.target_balance,
                            spec.seed, synthesizer, conditional, source=source, fitted=generator)
    rows.write.mode("overwrite").partitionBy("origin").parquet(f"{out_dir}/train_augmented")
    rows = read_table(spark, f"{out_dir}/train_augmented")
    if report:
        write_synthetic_report(train, rows.where(F.col("origin") == "synthetic"), [label, *fitted.input_columns],
                               f"{out_dir}/synthetic", spec.seed)
    _encode(fitted, rows, label).write.mode("overwrite").parquet(f"{out_dir}/encoded_augmented")


def train_stage(spark: SparkSession, spec: TabularSpec, out_dir: str, space: training.SearchSpace | None = None,
                n_trials: int = 6, parallelism: int = 2, hard_labels: bool = False) -> training.TuningResult:
    """Stage 3: tune on the stored encodings, refit; writes ``best_params`` and ``candidate_model``."""
    encoded = read_table(spark, f"{out_dir}/encoded")
    if spec.strategy is None:
        train = encoded.where(F.col("split") == "train").drop("split")
    else:
        train = read_table(spark, f"{out_dir}/encoded_augmented")
    valid = encoded.where(F.col("split") == "validation").drop("split")
    # they feed every trial and the refit: cached once (reread from the files if an executor is lost)
    cached = [x.persist(StorageLevel.MEMORY_AND_DISK) for x in (train, valid)]
    try:
        tr, va = map(_right_sized, cached)
        tuning = training.tune(tr, va, spec.ml_task, spec.ml_eval_metric, spec.maximize, space, n_trials,
                               parallelism, spec.seed, hard_labels=hard_labels, cache_inputs=False)
        model = training.fit_model(tr, spec.ml_task, tuning.best_params, seed=spec.seed)
    finally:
        for x in cached:
            x.unpersist()
    training.params_table(spark, tuning.best_params).coalesce(1).write.mode("overwrite").json(f"{out_dir}/best_params")
    model.write().overwrite().save(f"{out_dir}/candidate_model")
    return tuning


def evaluate_stage(spark: SparkSession, spec: TabularSpec, out_dir: str) -> DataFrame:
    """Stage 4: score the stored model on the stored test rows; writes ``evaluation``; returns the flat report."""
    model = training.load_model(f"{out_dir}/candidate_model", spec.ml_task)
    test = read_table(spark, f"{out_dir}/encoded").where(F.col("split") == "test").drop("split")
    scored = training.score(model, test, spec.ml_task)
    if spec.ml_task == "classification":
        flat = metrics.collected_report(scored, "label", "score")
        report = metrics.report_struct(flat)
    else:
        flat = metrics.regression_report(scored, "label", "score")
        flat = spark.createDataFrame(flat.collect(), flat.schema)
        report = metrics.report_struct(flat, names=("mse", "mae", "R2", "rmse"))
    write_report(report, f"{out_dir}/evaluation")
    return flat


def gate_stage(spark: SparkSession, spec: TabularSpec, out_dir: str, strict: bool = False,
               publish: bool = True) -> tuple[DataFrame, bool]:
    """Stage 5: gate the stored report; publishes the stored model if it passes."""
    g = gate(read_report(spark, f"{out_dir}/evaluation"), spec.ml_eval_metric, spec.ml_metric_threshold,
             spec.maximize, strict)
    if not publish:
        return g, False
    model = training.load_model(f"{out_dir}/candidate_model", spec.ml_task)
    # the same job's stored model: publishing it again adds nothing
    params = read_report(spark, f"{out_dir}/best_params").first()
    row = g.first()
    run = run_id_of(out_dir, spec.seed, params.asDict(recursive=True), row["metric"], row["value"], row["threshold"])
    return g, publish_if_passed(spark, g, model, f"{out_dir}/model", f"{out_dir}/registry", run_id=run)


def run_workflow(spark: SparkSession, df: DataFrame, spec: TabularSpec,
                 test_df: DataFrame | None = None, val_df: DataFrame | None = None,
                 fit_on: str = "all", synthesizer: str = "independent",
                 space: training.SearchSpace | None = None, n_trials: int = 6,
                 parallelism: int = 2, out_dir: str | None = None,
                 strict_gate: bool = False, tune_on_hard_labels: bool = False,
                 generator_trials: int = 16, generator_parallelism: int = 4,
                 inner_trials: int = 6) -> WorkflowResult:
    """Run the whole job, stage by stage, each from the files of the one before.

    Without ``out_dir`` the files go to the session's shared folder and nothing
    is published.  Parity options: ``fit_on`` (see ``prepare``);
    ``synthesizer="tuned"`` searches the generator (``generator_trials``, so
    many at once, ``inner_trials`` models each: the reference's sizes);
    ``tune_on_hard_labels`` scores tuning trials on 0/1 predictions instead
    of probabilities; ``strict_gate`` makes equality fail the gate.
    """
    where = out_dir or scratch_path(spark, "job")
    fitted = prepare(spark, df, spec, where, test_df, val_df, fit_on)
    synthesize(spark, spec, where, synthesizer, generator_trials, generator_parallelism, inner_trials, space)
    tuning = train_stage(spark, spec, where, space, n_trials, parallelism, tune_on_hard_labels)
    flat = evaluate_stage(spark, spec, where)
    g, published = gate_stage(spark, spec, where, strict_gate, publish=out_dir is not None)
    model = training.load_model(f"{where}/candidate_model", spec.ml_task)
    return WorkflowResult(read_splits(spark, where), fitted, tuning, model, flat, g, published)


def write_synthetic_report(real: DataFrame, synthetic: DataFrame, columns: list, path: str,
                           seed: int = 42, sample_size: int = 100) -> None:
    """Quality by column, quality summary, associations and principal components, and a seeded sample of synthetic rows."""
    by_column = quality_by_column(real, synthetic, columns)
    by_column = by_column.sparkSession.createDataFrame(by_column.collect(), by_column.schema)  # a row a column
    by_column.coalesce(1).write.mode("overwrite").json(f"{path}/by_column")
    quality_summary(real, synthetic, columns, by_column=by_column).coalesce(1).write.mode("overwrite") \
        .json(f"{path}/summary")
    compare_associations(real, synthetic, columns).coalesce(1).write.mode("overwrite").json(f"{path}/associations")
    compare_components(real, synthetic, columns).coalesce(1).write.mode("overwrite").json(f"{path}/components")
    sampling.sample_rows(synthetic, SYNTH_ID, sample_size, seed).write.mode("overwrite") \
        .parquet(f"{path}/sample")


def _right_sized(cached: DataFrame, rows_per_partition: int = 1_000_000) -> DataFrame:
    """Materialise a cached training set and merge its partitions (no
    shuffle) down to ~``rows_per_partition`` rows each, never below the
    cluster's parallelism: every boosting iteration visits every partition,
    and unions of shuffled inputs can arrive in hundreds of tiny ones."""
    n = cached.count()
    try:
        par = cached.sparkSession.sparkContext.defaultParallelism
    except Exception:  # Spark Connect
        return cached
    target = max(par, -(-n // rows_per_partition))
    if cached.rdd.getNumPartitions() > 2 * target:
        return cached.coalesce(target)
    return cached


def _apply_codes(df: DataFrame, label: str, enc: features.LabelEncoding) -> DataFrame:
    """Encode a supplied file's label with the fitted codes; unseen labels fail."""
    coded = enc.apply(df.withColumn("_label_given", qcol(label).isNotNull()))
    unseen = coded.where((qcol(label) == -1) & F.col("_label_given")).limit(1).count()
    coded = coded.drop("_label_given")
    if unseen:
        raise ValueError(f"label values in a supplied file were not seen in training: {label!r}")
    return coded


def run_spec(spark: SparkSession, spec: TabularSpec, **kw) -> WorkflowResult:
    """Run a job from its spec alone: read the train CSV (and the optional
    validation / test CSVs) named in the spec, then ``run_workflow`` with a
    generator search.  Supplied files are read as text and take the train
    file's types."""
    from tabprep.sources.csv import read_csv
    kw.setdefault("synthesizer", "tuned")
    if not spec.train_path:
        raise ValueError("the spec names no train_path")
    df = read_csv(spark, spec.train_path)
    test_df = read_csv(spark, spec.test_path, infer=False) if spec.test_path else None
    val_df = read_csv(spark, spec.validation_path, infer=False) if spec.validation_path else None
    return run_workflow(spark, df, spec, test_df=test_df, val_df=val_df, **kw)
