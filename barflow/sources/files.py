"""File layouts: bucketed history, write-once buckets, incremental loads,
compaction, append/snapshot sinks and the run log.

History lives under ``root/source=../instrument=../resolution=..`` with one
folder per fetched range; readers get partition pruning for free.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.sources.tables import read_or_empty

BUCKET_KEYS = ["source", "instrument", "resolution"]


def bucket_path(source: Column, instrument: Column, resolution: Column, start: Column, end: Column) -> Column:
    """S3: ``training/<source>/<instrument>/<resolution>/<start>_to_<end>``."""
    return F.concat_ws("/", F.lit("training"), source, F.lower(instrument), resolution,
                       F.concat_ws("_to_", F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd")))


def write_buckets(df: DataFrame, root: str, manifest: DataFrame | None = None) -> DataFrame:
    """S3 + S4: append new buckets under ``root`` partitioned by source,
    instrument, resolution and range; buckets already in ``manifest``
    (``bucket`` column) are left out, never rewritten. Returns what was written."""
    new = df if manifest is None else df.join(manifest.select("bucket").distinct(), "bucket", "left_anti")
    new.write.mode("append").partitionBy(*BUCKET_KEYS, "bucket_range").parquet(root)
    return new


_LOG = "bucket string, job string"


def _publish(spark: SparkSession, text: str, folder: str, name: str) -> bool:
    """Write ``folder/name`` whole or not at all; False if another writer was first. The text goes to a file of
    this call's own, which then takes the name only if nothing has it: by a rename that doesn't
    overwrite, atomic in HDFS, or a hard link in a local folder."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    own = jvm.org.apache.hadoop.fs.Path(f"{folder}/_{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    fs.mkdirs(target.getParent())
    out = fs.create(own, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(own.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        if fs.exists(target):
            return False
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(own, target, none)
        except Exception as e:  # the Java exception's class tells a lost race from a failure
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        return True
    finally:
        if fs.exists(own):
            fs.delete(own, False)


def _commits(spark: SparkSession, root: str) -> list[str]:
    """The committed log entries, oldest first (a listing, one name per commit)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/log")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(n for n in names if n.endswith(".json") and not n.startswith(("_", ".")))


def committed(spark: SparkSession, root: str) -> DataFrame:
    """``(bucket, job)`` of every committed bucket: which job's rows are its rows."""
    names = _commits(spark, root)
    if not names:
        return spark.createDataFrame([], _LOG)
    return spark.read.schema(_LOG).json([f"{root}/log/{n}" for n in names])


def commit_buckets(df: DataFrame, root: str, bucket_col: str = "bucket") -> DataFrame:
    """S3 + S4 for several writers: the rows of buckets that nobody has committed, staged in a folder of this call's own
    and then committed by one log entry. Entries are numbered and a number is given once, so of two
    writers with the same bucket the second one loses its number, leaves out what the first has
    committed and tries the next. Readers see a bucket whole or not at all, and a writer that is lost before
    its entry leaves nothing behind but unread files.

    Returns the buckets that this call has committed. Rows without a bucket are left out. Only names of buckets, a
    few per instrument and run, reach the driver."""
    spark, job = df.sparkSession, uuid.uuid4().hex
    rows = df.filter(F.col(bucket_col).isNotNull())
    new = rows.join(committed(spark, root).select(F.col("bucket").alias(bucket_col)), bucket_col, "left_anti")
    new.withColumn("_bucket", F.col(bucket_col)).write.mode("errorifexists").partitionBy("_bucket").parquet(f"{root}/data/job={job}")
    staged = spark.read.schema(df.schema).parquet(f"{root}/data/job={job}").select(F.col(bucket_col).alias("bucket")).distinct()
    while True:
        names = _commits(spark, root)
        left = sorted(r["bucket"] for r in staged.join(committed(spark, root), "bucket", "left_anti").collect())
        if not left:
            return spark.createDataFrame([], _LOG)
        number = int(names[-1].split(".")[0]) + 1 if names else 0
        text = "\n".join(json.dumps({"bucket": b, "job": job}) for b in left)
        # the log is listed before what is left is worked out, so an entry that came in between has this number
        if _publish(spark, text + "\n", f"{root}/log", f"{number:020d}.json"):
            return spark.createDataFrame([(b, job) for b in left], _LOG)


def read_buckets(spark: SparkSession, root: str, schema: T.StructType, bucket_col: str = "bucket") -> DataFrame:
    """The rows of all committed buckets, each bucket from the job that has committed it."""
    done = committed(spark, root).select(F.col("bucket").alias(bucket_col), F.col("job").alias("_job"))
    if not _commits(spark, root):
        return spark.createDataFrame([], schema)
    staged = T.StructType([*schema.fields, T.StructField("job", T.StringType())])
    rows = spark.read.schema(staged).option("basePath", f"{root}/data").parquet(f"{root}/data").withColumnRenamed("job", "_job")
    return rows.join(done, [bucket_col, "_job"], "left_semi").select(*[f.name for f in schema.fields])


def compact(spark: SparkSession, root: str, schema: T.StructType, order: list[str]) -> DataFrame:
    """Every bucket as one sorted table (missing root -> empty table)."""
    df = read_or_empty(spark, root, schema)
    return df.orderBy(*order)


def next_ranges(loaded: DataFrame, as_of: Column, time_col: str = "updated_at",
                keys: list[str] | None = None) -> DataFrame:
    """S5 + A3 + F17: per instrument, the range to fetch next -- from the day
    after the newest loaded day up to the day before ``as_of``; instruments
    already up to date produce no row."""
    keys = keys or ["instrument"]
    bounds = loaded.groupBy(*keys).agg(F.to_date(F.min(time_col)).alias("first_date"),
                                       F.to_date(F.max(time_col)).alias("last_date"))
    return (bounds.withColumn("fetch_start", F.date_add("last_date", 1))
            .withColumn("fetch_end", F.date_sub(F.to_date(as_of), 1))
            .filter(F.col("fetch_start") <= F.col("fetch_end")))


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append sink (headers are a CSV concern; Parquet carries the schema)."""
    df.write.mode("append").format(fmt).save(path)


def snapshot(df: DataFrame, path: str, partition_cols: list[str] | None = None, fmt: str = "parquet") -> None:
    """Overwrite sink; with partition columns only the partitions present
    in ``df`` are replaced (dynamic partition overwrite)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_cols:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    w.save(path)


def run_log_long(wide: DataFrame, id_col: str, keys: list[str]) -> DataFrame:
    """Wide per-run values -> EAV rows ``(run_id, key, value)``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value"))
                                for k in keys]))
    return wide.select(F.col(id_col).alias("run_id"), pairs.alias("_p")).select("run_id", "_p.key", "_p.value")


def run_log_wide(log: DataFrame, keys: list[str]) -> DataFrame:
    """EAV rows -> one row per run (pivot over the known keys)."""
    return log.groupBy("run_id").pivot("key", keys).agg(F.first("value"))
