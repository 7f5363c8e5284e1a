"""Properties of the distributed ordered-series helpers."""

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from barflow.operators import features, series
from barflow.plans import fixtures

from conftest import SF_MID


def _ticks(spark):
    return fixtures.raw_stream(spark, SF_MID)


def test_row_index_equals_row_number(spark):
    t = _ticks(spark)
    idx = series.with_row_index(t, ["epic"], ["updated_at", "seq"], chunk_seconds=3600, with_size=True)
    w = Window.partitionBy("epic").orderBy("updated_at", "seq")
    ref = t.withColumn("rn", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(Window.partitionBy("epic")))
    bad = idx.join(ref, "seq").filter((F.col("_idx") != F.col("rn")) | (F.col("_n") != F.col("n")))
    assert bad.count() == 0


def test_halo_window_equals_plain_window(spark):
    t = _ticks(spark)
    got = features.shift_features(t, future={"bid_open": 2}, past={"ask_open": 3}, block_rows=5, chunk_seconds=7200)
    w = Window.partitionBy("epic").orderBy("updated_at", "seq")
    ref = t.select("seq", *[F.lead("bid_open", i).over(w).alias(f"rf{i}") for i in (1, 2)],
                   *[F.lag("ask_open", i).over(w).alias(f"rp{i}") for i in (1, 2, 3)])
    j = got.join(ref, "seq")
    cond = F.lit(False)
    for a, b in [("bid_open_f1", "rf1"), ("bid_open_f2", "rf2"), ("ask_open_p1", "rp1"),
                 ("ask_open_p2", "rp2"), ("ask_open_p3", "rp3")]:
        cond = cond | ~F.col(a).eqNullSafe(F.col(b))
    assert got.count() == t.count()
    assert j.filter(cond).count() == 0


def test_lag_of_lead_is_identity(spark):
    t = _ticks(spark).select("epic", "updated_at", "seq", "bid_open")
    a = features.shift_features(t, future={"bid_open": 1}, block_rows=7)
    b = features.shift_features(a.withColumnRenamed("bid_open", "x").withColumnRenamed("bid_open_f1", "bid_open"),
                                past={"bid_open": 1}, block_rows=7)
    inner = b.filter(F.col("bid_open_p1").isNotNull())
    assert inner.filter(F.col("bid_open_p1") != F.col("x")).count() == 0


def test_running_sum_blocks_equal_plain(spark):
    t = _ticks(spark)
    got = series.running_sum(t, ["epic"], ["updated_at", "seq"], "bid_open", "c", block_rows=11)
    w = Window.partitionBy("epic").orderBy("updated_at", "seq").rowsBetween(Window.unboundedPreceding, 0)
    ref = t.select("seq", F.sum("bid_open").over(w).alias("rc"))
    bad = got.join(ref, "seq").filter(F.abs(F.col("c") - F.col("rc")) > 1e-6)
    assert bad.count() == 0


def test_tail_and_split(spark):
    from barflow.plans.catalogue_bars import chronological_split
    s = fixtures.stream(spark, SF_MID)
    tail = features.series_tail(s, 3)
    assert tail.groupBy("epic").count().filter("count != 3").count() == 0
    sp = chronological_split(s)
    counts = {(r.epic, r.split): r["count"] for r in sp.groupBy("epic", "split").count().collect()}
    for epic in {e for e, _ in counts}:
        n = counts[(epic, "test")] + counts[(epic, "train")]
        assert counts[(epic, "test")] == int(n * 0.1)


def test_building_a_query_runs_no_job(spark):
    t = _ticks(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "")
    out = features.training_rows(t)
    out = series.running_sum(out, ["epic"], ["updated_at", "seq"], "bid_open", "c")
    features.series_tail(out, 3)
    assert len(tracker.getJobIdsForGroup("build-only")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_histogram_counts_sum_to_rows_in_range(spark):
    from barflow.operators import evaluate
    df = _ticks(spark)
    h = evaluate.histogram(df, ["bid_open", "ask_open"], 0.0, 50.0, 2.5)
    for col in ("bid_open", "ask_open"):
        in_range = df.filter((F.col(col) >= 0) & (F.col(col) <= 50)).count()
        assert h.filter(F.col("series") == col).agg(F.sum("count")).first()[0] == in_range


def test_anti_plus_semi_is_everything(spark):
    from barflow.plans import fixtures as fx
    buys, sold = fx.buys(spark, SF_MID), fx.sold(spark, SF_MID)
    anti = buys.join(sold, "dealId", "left_anti").count()
    semi = buys.join(sold, "dealId", "left_semi").count()
    assert anti + semi == buys.count()


def test_interpolation_keeps_the_knots(spark):
    from barflow.operators.bars import daily_interpolate
    from barflow.plans import fixtures as fx
    br = fx.base_rate(spark, SF_MID).withColumn("k", F.lit(1))
    daily = daily_interpolate(br, ["k"], "date_changed", "rate", "daily")
    j = br.join(daily.withColumnRenamed("date_changed", "d"), (F.col("date_changed") == F.col("d")))
    assert j.filter(F.col("rate") != F.col("daily")).count() == 0


def test_a_burst_at_one_instant_splits_and_keeps_positions(spark):
    rows = spark.range(4000).select(
        F.lit("hot").alias("epic"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("updated_at"), F.col("id").alias("seq"))
    idx = series.with_row_index(rows, ["epic"], ["updated_at", "seq"], block_rows=800, with_size=True)
    assert idx.filter("_idx <> seq OR _n <> 4000").count() == 0
    chunks = series._chunked(rows, ["epic"], ["updated_at", "seq"], "updated_at", 86_400, 100)
    sizes = [r["count"] for r in chunks.groupBy("epic", "_bucket", "_piece").count().collect()]
    assert len(sizes) >= 20 and max(sizes) < 800 and sum(sizes) == 4000


def test_many_splitters_in_one_bucket(spark):
    """Rows of one key and day, ties in time and null times included, cut at
    hundreds of splitters: positions equal the plain row number."""
    t = spark.range(6000).select(
        F.when(F.col("id") % 7 == 0, None).otherwise(F.lit("a")).alias("epic"), F.col("id").alias("seq"),
        F.when(F.col("id") % 50 != 0, F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.hash("id"), F.lit(900)))).alias("updated_at"))
    got = series.with_row_index(t, ["epic"], ["updated_at", "seq"], block_rows=80)
    ref = t.withColumn("rn", F.row_number().over(Window.partitionBy("epic").orderBy("updated_at", "seq")) - 1)
    both = got.join(ref.select("seq", "rn"), "seq")
    assert both.count() == 6000 and both.filter("_idx <> rn").count() == 0
    pieces = series._chunked(t, ["epic"], ["updated_at", "seq"], "updated_at", 86_400, 10)
    sizes = pieces.groupBy("epic", "_bucket", "_branch", "_piece").count()
    assert sizes.count() > 300 and sizes.agg(F.max("count")).first()[0] < 200


def test_daily_values_come_from_the_knots_of_any_bucket(spark):
    """Gaps longer than a bucket, null values at both ends, a series without a value, a null key: as pandas interpolates."""
    import datetime
    import random

    from barflow.operators.bars import daily_interpolate

    rng, day0 = random.Random(5), datetime.date(2020, 1, 1)
    rows = [(k, day0 + datetime.timedelta(days=d), None if rng.random() < 0.3 else rng.random() * 10)
            for k in ("a", "b", None) for d in sorted(rng.sample(range(300), 25))]
    rows += [("none", day0, None), ("none", day0 + datetime.timedelta(days=3), None), ("a", None, 5.0)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    for days in (1, 7, 1024):
        got = {(r.k, r.d): r.v for r in daily_interpolate(df, ["k"], "d", "v", bucket_days=days).collect()}
        count = 0
        for key in ("a", "b", None, "none"):
            own = sorted((d, v) for k, d, v in rows if k == key and d is not None)
            s = pd.Series({pd.Timestamp(d): v for d, v in own}, dtype=float).asfreq("D").interpolate()
            count += len(s)
            for d, v in s.items():
                have = got[(key, d.date())]
                assert (have is None) == bool(pd.isna(v)) and (have is None or abs(have - v) < 1e-9)
        assert len(got) == count
