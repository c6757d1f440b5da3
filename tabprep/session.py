"""Session helpers for tests, the bench and the entry module.

Library code never creates a session; it uses the one it is given.  The
checkpoint directory is read from ``spark.checkpoint.dir`` (the cluster's
shared folder) and only set here when it is missing, as in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tabprep") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # fused codegen methods above the JIT limit (8000 bytes) run interpreted;
        # let Spark fall back to per-operator code for such subtrees instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # remove checkpoint files once their DataFrame is garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TABPREP_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _runs_in_one_process(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share for intermediate tables.

    Read from ``spark.checkpoint.dir``.  Where that is unset, a scratch folder
    is made only if driver and executors are one process (``local[N]``, as in
    tests); on a cluster a machine-local folder would lose data with its
    machine, so that raises.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return conf_dir
    current = sc.getCheckpointDir()
    if not conf_dir:
        if current:
            conf_dir = os.path.dirname(current.rstrip("/")) or current
        elif _runs_in_one_process(spark):
            conf_dir = tempfile.mkdtemp(prefix="tabprep-ckpt-", dir="/tmp")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if not current:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def share_package(spark: SparkSession) -> None:
    """Let Python tasks import this package where only the driver's ``sys.path`` has it.

    Sets the workers' ``PYTHONPATH``; on a cluster whose machines lack the
    package, install it or submit it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


#: Paths of the tables that ``store`` wrote and nobody dropped yet, by application.
_STORED: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, listed by ``stored_paths`` and deleted by ``release``."""
    path = f"{ensure_checkpoint_dir(spark)}/tabprep-{label}-{uuid.uuid4().hex}"
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def store(df: DataFrame, label: str = "step", **options) -> DataFrame:
    """Write ``df`` once as Parquet (with the writer's ``options``) under the shared folder and read it back.

    Cuts the lineage: a lost executor rereads files instead of recomputing,
    and several readers share one computation.  Rows are compressed and
    columns prunable, unlike ``checkpoint()``.  The files stay until
    ``drop_stored`` or ``release``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
    _STORED[spark.sparkContext.applicationId].remove(path)


def drop_stored(*tables: DataFrame) -> None:
    """Delete the files of tables that ``store`` returned and nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df._stored_at)


def stored_paths(spark: SparkSession) -> list[str]:
    """Paths of this application's stored tables, oldest first."""
    return list(_STORED.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str], *needed: DataFrame) -> None:
    """Delete those of the stored tables at ``paths`` that ``needed`` does not read.

    The caller answers for it that no other pending result reads them.
    """
    left = set(paths) & set(stored_paths(spark))
    if left:
        in_use = {f.rpartition("/")[0].rpartition("/")[2] for df in needed for f in df.inputFiles()}
        for path in left:
            if path.rpartition("/")[2] not in in_use:
                _delete(spark, path)
