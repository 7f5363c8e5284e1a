"""Sources and sinks: empty-tolerant reads, SQL views, write-once buckets."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from barflow import schemas
from barflow.sources import files, tables


def _scratch():
    return tempfile.mkdtemp(prefix="barflow-test-")


def test_empty_tolerant_read(spark):
    missing = _scratch() + "/nothing_here"
    df = tables.read_or_empty(spark, missing, schemas.SOLD)
    assert df.count() == 0 and df.columns == ["dealId", "close_level_responce"]


def test_sql_table_read(spark):
    spark.createDataFrame([("1", 2.0)], schemas.SOLD).createOrReplaceTempView("sold_v")
    assert tables.sql_table(spark, "sold_v").count() == 1


def test_csv_scan_with_schema_and_pruning(spark):
    d = _scratch()
    with open(f"{d}/t.csv", "w") as f:
        f.write("dealId,close_level_responce\n1,2.5\n2,3.5\n")
    df = tables.read_csv(spark, f"{d}/t.csv", schemas.SOLD, columns=["close_level_responce"])
    assert [r[0] for r in df.collect()] == [2.5, 3.5]


def test_buckets_are_written_once(spark):
    root = _scratch() + "/history"
    rows = spark.createDataFrame(
        [("quotes", "GOLD", "1m", "2024-01-01_to_2024-01-01", "b1", dt.datetime(2024, 1, 1, 10), 1.0)],
        "source string, instrument string, resolution string, bucket_range string, bucket string, "
        "updated_at timestamp, open double")
    files.write_buckets(rows, root)
    manifest = spark.read.parquet(root).select("bucket")
    files.write_buckets(rows, root, manifest)  # same bucket again: skipped
    assert spark.read.parquet(root).count() == 1
    # partition pruning: the filter on a partition column reaches the scan
    plan = spark.read.parquet(root).filter(F.col("instrument") == "GOLD")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_next_ranges_noop_when_up_to_date(spark):
    h = spark.createDataFrame([("A", dt.datetime(2024, 1, 9, 12)), ("B", dt.datetime(2024, 1, 3, 1))],
                              "instrument string, updated_at timestamp")
    out = {r.instrument: (r.fetch_start, r.fetch_end) for r in files.next_ranges(h, F.lit("2024-01-10")).collect()}
    assert out == {"B": (dt.date(2024, 1, 4), dt.date(2024, 1, 9))}


def test_run_log_round_trip(spark):
    wide = spark.createDataFrame([("r1", 0.5, 3)], "run_id string, mae double, k int")
    long = files.run_log_long(wide, "run_id", ["mae", "k"])
    back = files.run_log_wide(long, ["mae", "k"]).first()
    assert (back.mae, back.k) == ("0.5", "3")


def test_folder_with_only_markers_reads_as_empty(spark):
    import os
    d = _scratch() + "/only_markers"
    os.makedirs(d)
    open(f"{d}/_SUCCESS", "w").close()
    df = tables.read_or_empty(spark, d, schemas.SOLD)
    assert df.count() == 0 and df.columns == ["dealId", "close_level_responce"]


def test_two_writers_commit_each_bucket_once(spark, tmp_path, monkeypatch):
    """Writers that stage the same buckets at the same time: one commits a shared bucket, rows are read once; a lost writer leaves nothing."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier, local

    root = str(tmp_path / "buckets")
    assert files.read_buckets(spark, root, spark.createDataFrame([], "bucket string, v long").schema).count() == 0
    gate, seen, real = Barrier(3, timeout=100), local(), files._publish

    def together(*args):  # every writer's first entry is tried once all have staged
        if not getattr(seen, "once", False):
            seen.once = True
            gate.wait()
        return real(*args)
    monkeypatch.setattr(files, "_publish", together)

    def write(k):
        df = spark.createDataFrame([(f"a/{b}", 10 * k + b) for b in range(k, k + 3)] + [(None, 0)], "bucket string, v long")
        return k, sorted(r.bucket for r in files.commit_buckets(df, root).collect())

    with ThreadPoolExecutor(3) as pool:
        won = dict(pool.map(write, range(3)))
    assert sorted(b for w in won.values() for b in w) == [f"a/{b}" for b in range(5)]
    owner = {b: k for k, w in won.items() for b in w}
    monkeypatch.setattr(files, "_publish", real)
    lost = spark.createDataFrame([("a/9", 9)], "bucket string, v long")
    lost.withColumn("_bucket", F.col("bucket")).write.partitionBy("_bucket").parquet(f"{root}/data/job=lost")
    got = files.read_buckets(spark, root, lost.schema).collect()
    assert sorted((r.bucket, r.v) for r in got) == [(b, 10 * k + int(b[2:])) for b, k in sorted(owner.items())]
    assert files.commit_buckets(lost.withColumn("bucket", F.lit("a/1")), root).count() == 0
