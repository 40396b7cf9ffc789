"""Session helpers: a tuned builder for local runs and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "propensity",
                  shuffle_partitions: int | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """Local/test session.  On a cluster, use the cluster's own session; these
    settings only mirror what a production job would set explicitly."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or max(cpus * 2, 8)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        # AQE: coalesce small shuffle partitions, split skewed join partitions,
        # and turn sort-merge joins into broadcast joins only when the runtime
        # size of a side is under the broadcast threshold (a checked size).
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.files.maxPartitionBytes", "128m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, taking it from ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we never invent one on a cluster.
    Only a local-mode session (tests, bench) without the setting gets a
    private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    single = sc.master == "local" or sc.master.startswith("local[")
    one_host = single or sc.master.startswith("local-cluster")
    if configured:
        if not one_host and not _shared(configured, sc._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")):
            raise RuntimeError(f"spark.checkpoint.dir={configured} lies in a local file system; give the "
                               "URI of a folder that all executors share")
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not single:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="propensity-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def _shared(path: str, default_fs: str) -> bool:
    """Whether a path's file system is not the local one of each machine."""
    scheme = path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else default_fs.split(":", 1)[0]
    return scheme != "file"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for written intermediate tables, inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def spread(df, *cols):
    """Hash-spread an input that the reader makes fewer tasks of than there are cores
    (a small single file is one split), so that its per-row work is not serialised.
    Larger inputs, a single large file included, are returned as they are."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > par:
        return df
    return df.repartition(par, *cols) if cols else df.repartition(par)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete this application's written intermediate tables (the ``tables``
    folder inside its own checkpoint directory, which Spark names per
    application).  Call at the end of a job; returns whether anything was
    removed.  Uses the Hadoop FileSystem of that path, so it works on any
    shared store the cluster names."""
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        return False
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base.rstrip("/") + "/tables")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(path) and fs.delete(path, True))
