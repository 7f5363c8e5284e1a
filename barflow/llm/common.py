"""Scratch tables, session settings and row keys shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.session import checkpoint_root

#: Arrow batches to Python workers are bounded by rows and by bytes.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
#: Shuffle files go when the write that needed them ends; its table is kept.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stands for a null id inside an operator.
NULL_ID = -(1 << 63)


class Scratch:
    """Intermediate tables in the shared ``spark.checkpoint.dir``. A table cuts
    the lineage: later jobs, and retries after a lost executor, read it again."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/llm/{uuid.uuid4().hex}"
        self.made = 0

    def table(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """``df`` written and reread, in folders ``by`` a column if one is named."""
        self.made += 1
        path = f"{self.root}/{self.made:03d}-{name}"
        (df.write.partitionBy(by) if by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def tables(self, like: DataFrame, name: str) -> DataFrame:
        """The rows of all tables written under ``name``, which have the columns of ``like``."""
        return self.spark.read.schema(like.schema).parquet(f"{self.root}/*-{name}")

    def part(self, table: DataFrame, *folders: str) -> DataFrame:
        """The rows in some folders of a table that was written ``by`` a column, without this column."""
        paths = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        found = sorted(p for p in paths if p.rsplit("/", 1)[1] in folders)
        kind = type(table.schema)([f for f in table.schema if f.name != folders[0].split("=")[0]])
        return self.spark.read.schema(kind).parquet(*found) if found else self.spark.createDataFrame([], kind)

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
            if path.find(self.root.split(":")[-1]) >= 0:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A :class:`Scratch`; while it is open each write frees its shuffle files."""
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield Scratch(spark)
    finally:
        spark.conf.set(CLEANUP, before)


def row_id(column: str) -> Column:
    """The id as a long; null ids share one value below all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def keep_bits(df: DataFrame, column: str, log2_bits: int) -> np.ndarray:
    """A bit filter of fixed size over the long ``column``: bit ``x mod 2**log2_bits``
    is set for each value x. It holds 2**log2_bits bits whatever the rows, so it
    may be sent to every task; a test lets all values pass and some others."""
    slot = F.col(column).bitwiseAND(F.lit((1 << log2_bits) - 1))
    parts = (df.select(slot.alias("slot"))
             .groupBy(F.expr("bitmap_bucket_number(slot)").alias("part"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")).collect())
    size = 32768 // 8
    out = np.zeros(max(size, (1 << log2_bits) // 8 + size), np.uint8)
    for r in parts:  # bucket k holds the values from 32768 * (k - 1) + 1 on
        at = (r["part"]) * size
        out[at:at + size] |= np.frombuffer(r["bits"], np.uint8)
    return out


def bit_test(bits: np.ndarray, log2_bits: int, values: np.ndarray) -> np.ndarray:
    """True for each value whose bit is set."""
    slot = values.view(np.uint64) & np.uint64((1 << log2_bits) - 1)
    # the SQL bitmap functions number buckets from 1 and bits from value - 1; value 0 is bucket 0's bit 0
    s = slot.astype(np.int64)
    part = np.where(s > 0, 1 + (s - 1) // 32768, s // 32768)
    bit = np.where(s > 0, (s - 1) % 32768, (-s) % 32768)
    return (bits[part * 4096 + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1 == 1
