"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces small
# shuffle partitions at run time, and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # PySpark 4 records the Python call site of every DataFrame/functions
    # call (several JVM round trips each), which made building a query's
    # plan cost as much as running it at sf0.1; errors still name the
    # failing expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Cluster defaults, applied only where spark-submit leaves them unset:
# shuffles start with many partitions and AQE coalesces them to about
# 128 MB each, so a shuffle partition fits in executor memory whether the
# input is 1 GB or 100 TB (the built-in default of 200 is far too few).
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # coalesce to the advisory size, not to the default parallelism
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def cluster_defaults_for(master: str, is_set) -> dict:
    """The ``CLUSTER_DEFAULTS`` to apply: none on a local master, else those
    the application's conf does not name (``is_set(key)``)."""
    if master.startswith("local"):
        return {}
    return {k: v for k, v in CLUSTER_DEFAULTS.items() if not is_set(k)}


def apply_cluster_defaults(spark: SparkSession) -> dict:
    """Set ``CLUSTER_DEFAULTS`` on a non-local session where the
    application's conf (spark-submit, builder) does not name them.  Both are
    runtime SQL settings.  Returns what was set."""
    sc = spark.sparkContext
    conf = sc.getConf()
    out = cluster_defaults_for(sc.master, conf.contains)
    for k, v in out.items():
        spark.conf.set(k, v)
    return out


def get_session(master: str | None = None, app: str = "streamfold",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Get (or create) a session with the engine's defaults.

    On a cluster the master and resources come from spark-submit; pass
    ``master`` only for local runs and tests.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    apply_cluster_defaults(spark)
    return spark


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is read as
    is.  Only when it is unset on a local master (local runs, tests) is a
    scratch folder made and registered with ``setCheckpointDir`` (the
    setting itself is static and cannot change on a running session); on a
    cluster an unset setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder (e.g. on HDFS or an "
                               "object store) that every executor and the driver can reach")
        d = tempfile.mkdtemp(prefix="streamfold-ckpt-")
        sc.setCheckpointDir(d)
    return d


def checkpoint_subdir(spark: SparkSession, name: str) -> str:
    """A named folder under the shared checkpoint dir (streaming queries,
    snapshot tables)."""
    return os.path.join(shared_checkpoint_dir(spark), name)
