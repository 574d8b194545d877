"""SparkSession construction and shared-folder helpers.

Cluster settings win: every helper here reads the session configuration first and
only fills in a value when it is unset (local runs and tests).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings we want on every session, applied only where the launcher (spark-submit,
# spark-defaults.conf) has not set them, so a cluster's configuration keeps precedence.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # keep shuffle files of lost executors reachable when an external shuffle
    # service exists; harmless in local mode
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def get_spark(app: str = "plume", master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with our defaults.

    ``master`` is only used when no master is configured (e.g. plain ``python``);
    under ``spark-submit`` the cluster master is kept.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master is None and not os.environ.get("SPARK_MASTER") and "spark.master" not in os.environ.get(
            "PYSPARK_SUBMIT_ARGS", ""):
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master:
        builder = builder.master(master)
    # settings already given by the launcher (spark-submit, spark-defaults.conf)
    # win over our defaults; explicit arguments win over both
    try:
        from pyspark import SparkConf
        launched = SparkConf()
    except Exception:  # noqa: BLE001 - no launcher configuration available
        launched = None
    conf = {k: v for k, v in _DEFAULTS.items() if launched is None or not launched.contains(k)}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Reads the session setting. Only when it is unset *and* Spark runs in local
    mode (tests) a local folder is installed as the context's checkpoint folder;
    on a cluster an unset value is an error, never a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if fallback is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
        import tempfile
        fallback = tempfile.mkdtemp(prefix="plume-checkpoints-")
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote and no longer needs."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
