"""Session settings the library relies on.

Time semantics (bar edges, day boundaries) are defined in UTC, so the session
time zone is pinned. Everything else is about scale: adaptive execution
re-plans joins from measured shuffle sizes (a broadcast only happens when the
runtime size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
otherwise the sort-merge plan stays), coalesces small partitions and splits
skewed ones.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session-level SQL settings applied to any session handed to the library.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's SQL settings to an existing session (idempotent)."""
    for key, value in SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "barflow", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def materialize(df, name: str = "t"):
    """Cut the lineage of an intermediate used by several jobs: write it once
    as a Parquet table in the shared ``spark.checkpoint.dir`` (never a
    machine-local folder) and read it back. Later jobs read the table instead
    of recomputing it; a lost executor costs a re-read, not a recompute from
    the source; and the optimizer sees its real size (broadcast decisions)."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    _MATERIALIZED.append(path)
    return spark.read.parquet(path)


_MATERIALIZED: list[str] = []


def release_materialized(spark: SparkSession) -> int:
    """Delete the tables :func:`materialize` wrote in this process. Call it
    only once every DataFrame reading them has been written out (a job's
    end); returns how many were removed."""
    jvm = spark._jvm
    removed = 0
    while _MATERIALIZED:
        hpath = jvm.org.apache.hadoop.fs.Path(_MATERIALIZED.pop())
        fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(hpath) and fs.delete(hpath, True):
            removed += 1
    return removed


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it (a shared file system or object store);
    without it nothing may be written that other executors must read, so this
    raises. In local mode there is one machine, and a private folder is made.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="barflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def is_local(master: str) -> bool:
    """Driver and executors in one process (``local-cluster`` is a cluster)."""
    return master == "local" or master.startswith("local[")
