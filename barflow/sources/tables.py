"""Table sources: Parquet/CSV scans with explicit schemas and pruning."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barflow.session import configure


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``; ``columns`` prunes at the scan."""
    configure(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             columns: list[str] | None = None, timestamp_format: str | None = None) -> DataFrame:
    """Delimited scan with a declared schema (no inference) and column pruning."""
    reader = spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE")
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    df = reader.csv(path)
    return df.select(*columns) if columns else df


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  **options) -> DataFrame:
    """Empty-tolerant scan (S2): a missing or empty location is an empty table
    with the declared columns instead of an error."""
    exists = _path_has_data(spark, path)
    if not exists:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def _path_has_data(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm  # Hadoop FileSystem works for local, HDFS and object stores alike
    if jvm is None:
        return os.path.exists(path) and (os.path.isfile(path) and os.path.getsize(path) > 0
                                         or os.path.isdir(path) and bool(os.listdir(path)))
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return False
    # Stop at the first non-empty data file: no walk over a large table's files.
    files = fs.listFiles(hpath, True)
    while files.hasNext():
        st = files.next()
        name = st.getPath().getName()
        if st.getLen() > 0 and not name.startswith(("_", ".")):
            return True
    return False


def sql_table(spark: SparkSession, name: str) -> DataFrame:
    """SQL table read (S11): a catalog table or temp view."""
    return spark.table(name)


def sql_text(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """SQL text (S11) over DataFrames named in braces: ``FROM {positions}``."""
    return spark.sql(text, **views)


def object_store_csv(spark: SparkSession, bucket: str, key: str, schema: T.StructType) -> DataFrame:
    """Object-store file read (S12). Only the path form differs from S1."""
    return spark.read.schema(schema).option("header", "true").csv(f"s3a://{bucket}/{key}")
