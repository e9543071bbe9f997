"""SparkSession set-up and shared-storage helpers.

Everything here is plain Spark configuration.  On a cluster the session is
normally created by the launcher; ``get_session`` then only returns it and
never overrides cluster settings.  ``shared_dir`` reads the checkpoint folder
the cluster names in ``spark.checkpoint.dir`` and sets one only when it is
missing (local tests).
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the pipeline relies on for correctness (not for speed).
_REQUIRED_CONF = {
    # date_format / strftime agree only when both sides use UTC.
    "spark.sql.session.timeZone": "UTC",
    # A dt partition value like 20240101 must stay a string.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Settings for the execution model: runtime re-planning, skew splitting,
# coalescing of small shuffle partitions, and partition reuse: a partitioning
# on the user alone may serve joins keyed by (user, anchor) / (user, route),
# so the feature tail shuffles its pair rows once (see operators.features).
_EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pairscope", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one (tests, local runs)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_REQUIRED_CONF)
    conf.update(_EXECUTION_CONF)
    # Checkpoint files of frames that are no longer referenced are removed.
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the pipeline's settings to an existing session (runtime confs only)."""
    for k, v in {**_REQUIRED_CONF, **_EXECUTION_CONF}.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set a local one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="pairscope-ckpt-")  # one process: tests, bench
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder (one per call)."""
    return f"{shared_dir(spark)}/pairscope/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str = "frame") -> DataFrame:
    """``df`` written once as a Parquet table of the shared folder, and read back.

    What several parts of a plan use is computed once, and a lost executor
    repeats nothing before it.  The files go when the driver process ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    atexit.register(remove_path, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if the session still lives."""
    if spark.sparkContext._jsc is not None:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_at_exit(spark: SparkSession, database: str) -> str:
    """Drop a scratch database with its tables and files when the driver process ends."""
    def drop() -> None:
        if spark.sparkContext._jsc is not None:
            spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")

    atexit.register(drop)
    return database
