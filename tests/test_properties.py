"""Random series: the chunked helpers equal plain windows (duplicate
timestamps, bursts, null keys and times, one hot key)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from barflow.operators import features, series

rows_st = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", None]),  # one key holds most rows, one is null
              st.one_of(st.none(), st.just(7), st.integers(0, 40)),  # minutes: nulls, a burst at one instant, equal times
              st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))),
    min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, block=st.integers(2, 20), chunk_minutes=st.sampled_from([1, 5, 60]))
def test_chunked_helpers_equal_plain_windows(spark, rows, block, chunk_minutes):
    base = dt.datetime(2024, 1, 1)
    data = [(k, None if m is None else base + dt.timedelta(minutes=m), i, v) for i, (k, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "epic string, updated_at timestamp, seq long, x double")
    kw = dict(block_rows=block, chunk_seconds=chunk_minutes * 60)
    got = features.shift_features(df.withColumnRenamed("x", "bid_open").withColumn("ask_open", F.col("bid_open")),
                                  future={"bid_open": 2}, past={"ask_open": 1}, **kw)
    got = series.running_sum(got, ["epic"], ["updated_at", "seq"], "bid_open", "c", **kw)
    w = Window.partitionBy("epic").orderBy("updated_at", "seq")
    ref = {r.seq: r for r in df.select(
        "seq", F.lead("x", 1).over(w).alias("f1"), F.lead("x", 2).over(w).alias("f2"), F.lag("x", 1).over(w).alias("p1"),
        F.when(F.col("x").isNotNull(), F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0))).alias("c")
    ).collect()}
    out = got.collect()
    assert len(out) == len(data)
    for r in out:
        e = ref[r.seq]
        assert (r.bid_open_f1, r.bid_open_f2, r.ask_open_p1) == (e.f1, e.f2, e.p1)
        assert (r.c is None and e.c is None) or abs(r.c - e.c) < 1e-9
