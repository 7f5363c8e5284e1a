"""Ticks to fixed-width bars, bucket coverage and daily interpolation.

``last_bars`` (W11/T4) follows the reference's resample exactly: buckets are
left-closed, labelled by their right edge, each column takes its last
non-null value by ``(time, seq)``, bars with a missing column are dropped and
the bar holding each instrument's newest tick (still open) is removed.

It is one hash aggregation on ``(epic, bucket)`` -- partial aggregation runs
map-side, so a hot instrument is combined before the shuffle -- and a join
with a per-instrument "newest bar" table that adaptive execution broadcasts
when its measured size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.operators.series import null_safe_join


def market_open(ticks: DataFrame, state_col: str = "market_state", open_state: str = "TRADEABLE") -> DataFrame:
    """Ticks of a tradeable market only."""
    return ticks.filter(F.col(state_col) == F.lit(open_state))


def market_closed(ticks: DataFrame, state_col: str = "market_state", open_state: str = "TRADEABLE") -> DataFrame:
    """T1 side output: the rows the gate holds back (the reference raises)."""
    return ticks.filter(~F.coalesce(F.col(state_col) == F.lit(open_state), F.lit(False)))


def _last_non_null(col: str, order) -> F.Column:
    # max_by skips rows whose ordering is null, so a null value never wins.
    return F.max_by(F.col(col), F.when(F.col(col).isNotNull(), order)).alias(col)


def last_bars(ticks: DataFrame, width: str = "1 minute", keys: Sequence[str] = ("epic",),
              time_col: str = "updated_at", seq_col: str = "seq",
              value_cols: Sequence[str] = ("bid_open", "ask_open"),
              start_time: str | None = None, drop_incomplete: bool = True,
              last_tick_col: str | None = None) -> DataFrame:
    """Tumbling bars, last value per column, right label; ``seq`` is the
    bar's last tick, so bars keep the ``(time, seq)`` order key.
    ``last_tick_col`` also keeps the time of that last tick."""
    keys = list(keys)
    bucket = (F.window(time_col, width, width, start_time) if start_time
              else F.window(time_col, width)).alias("_w")
    order = F.struct(F.col(time_col), F.col(seq_col))
    bars = (ticks.groupBy(*keys, bucket)
            .agg(F.max_by(F.col(seq_col), order).alias(seq_col),
                 *([F.max(time_col).alias(last_tick_col)] if last_tick_col else []),
                 *[_last_non_null(c, order) for c in value_cols])
            .select(*keys, F.col("_w.end").alias(time_col), seq_col,
                    *([last_tick_col] if last_tick_col else []), *value_cols)
            .na.drop("any", subset=list(value_cols)))
    if not drop_incomplete:
        return bars
    # The newest remaining bar goes after the null filter. Its time is a partial
    # aggregate per key, a row each, joined back: no task holds a key's bars.
    newest = bars.groupBy(*keys).agg(F.max(time_col).alias("_newest"))
    return (null_safe_join(bars, newest, keys).filter(F.col(time_col) < F.col("_newest"))
            .select(bars.columns))


def bucket_counts(ticks: DataFrame, width_seconds: int, keys: Sequence[str] = ("epic",),
                  time_col: str = "updated_at", count_col: str = "count") -> DataFrame:
    """Ticks per left-labelled bucket, empty buckets included (count 0).

    Counts come from one aggregation; the spine of every bucket between each
    key's first and last bucket is generated per key from its (min, max) --
    its size is bounded by the time span, not by the tick volume.
    """
    keys = list(keys)
    width_us = width_seconds * 1_000_000
    b = F.floor(F.unix_micros(F.col(time_col)) / F.lit(width_us)).alias("_b")
    counts = ticks.groupBy(*keys, b).agg(F.count(F.lit(1)).alias(count_col))
    spine = (counts.groupBy(*keys).agg(F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
             .select(*keys, F.explode(F.sequence("_lo", "_hi")).alias("_b")))
    return (spine.join(counts, [*keys, "_b"], "left")
            .select(*keys, F.timestamp_micros(F.col("_b") * F.lit(width_us)).alias("bucket"),
                    F.coalesce(F.col(count_col), F.lit(0)).alias(count_col)))


def daily_interpolate(series: DataFrame, keys: Sequence[str], date_col: str, value_col: str,
                      out_col: str | None = None, bucket_days: int = 1024) -> DataFrame:
    """Upsample to one row per day and fill gaps linearly in time.

    Known points stay; a day between two known points gets
    ``v0 + (v1 - v0) * (d - d0) / (d1 - d0)``; days after the last known point
    keep the last value (pandas ``interpolate`` pads forward, never back), days before the first have none.
    Every gap is filled from its two knots alone. The next knot is sought among those of the same
    ``bucket_days``; the last of a bucket takes the first knot of the next bucket that has one, so the only
    window over a whole key is over its buckets. Points without a date are left out; a null key is a key.
    """
    keys = list(keys)
    out_col = out_col or value_col
    pts = series.select(*keys, F.col(date_col).cast("date").alias("_d"), F.col(value_col).alias("_v")).filter(F.col("_d").isNotNull())
    span = pts.groupBy(*keys).agg(F.min("_d").alias("_lo"), F.max("_d").alias("_hi"),
                                  F.min(F.when(F.col("_v").isNotNull(), F.col("_d"))).alias("_first"))
    known = pts.filter(F.col("_v").isNotNull()).withColumn("_bucket", F.floor(F.unix_date("_d") / F.lit(bucket_days)))
    firsts = known.groupBy(*keys, "_bucket").agg(F.min(F.struct("_d", "_v")).alias("_knot"))
    later = firsts.select(*keys, "_bucket", F.lead("_knot").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_later"))
    inside = F.lead(F.struct("_d", "_v")).over(Window.partitionBy(*keys, "_bucket").orderBy("_d", "_v"))
    knots = null_safe_join(known.withColumn("_next", inside), later, [*keys, "_bucket"])
    knots = null_safe_join(knots, span.drop("_lo", "_first"), keys).withColumn("_next", F.coalesce("_next", "_later"))
    d1, v1 = F.col("_next._d"), F.col("_next._v")
    # up to the day before the next knot; of knots on one day, the last goes on
    until = F.when(d1.isNull(), F.col("_hi")).otherwise(F.greatest(F.col("_d"), F.date_sub(d1, 1)))
    day = F.explode(F.sequence("_d", until)).alias("_day")
    frac = F.try_divide(F.datediff("_day", "_d").cast("double"), F.datediff(d1, "_d").cast("double"))
    value = F.when(d1.isNull() | (F.col("_day") == F.col("_d")), F.col("_v")).otherwise(F.col("_v") + (v1 - F.col("_v")) * frac)
    filled = knots.select(*keys, "_d", "_v", "_next", day).select(*keys, F.col("_day").alias(date_col), value.alias(out_col))
    before = F.coalesce(F.date_sub("_first", 1), F.col("_hi"))
    bare = span.filter(F.col("_lo") <= before).select(*keys, F.explode(F.sequence("_lo", before)).alias(date_col))
    return filled.unionByName(bare.withColumn(out_col, F.lit(None).cast(filled.schema[out_col].dataType)))


def latest_prices(ticks: DataFrame, keys: Sequence[str] = ("epic",), time_col: str = "updated_at",
                  seq_col: str = "seq", value_cols: Sequence[str] = ("bid_open", "ask_open")) -> DataFrame:
    """S9 (MERGE subscription): the conflated price per instrument, in one hash
    aggregation with ``max_by`` on ``(time, seq)``. An update may carry some fields
    only (the others null): each value is the newest one that was given, time and
    sequence are the newest update's. On a stream it runs in ``update`` mode
    and the state is one row per instrument."""
    order = F.struct(F.col(time_col), F.col(seq_col))
    return ticks.groupBy(*keys).agg(
        F.max(order).alias("_last"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in value_cols]).select(
        *keys, *[F.col(f"_last.{c}").alias(c) for c in (time_col, seq_col)], *value_cols)
