"""Catalogue: bars, ordered-series features, targets, tails and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.scalar import floor_minute, format_day, ts_text
from barflow.operators import bars, features, series
from barflow.operators.modeling import FunctionStep
from barflow.operators.features import TEST_FRACTION, chronological_split
from barflow.plans import fixtures
from barflow.plans.registry import query, with_fixtures

HOUR_TS = "'%Y-%m-%d %H:%M:%S'"
MICRO_TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _r(c, d: int = 6):
    return F.round(c if not isinstance(c, str) else F.col(c), d)


# ---------------------------------------------------------------- bars


@query("bars_last_hourly", with_fixtures(f"""
    SELECT b.epic, strftime(b.updated_at, {HOUR_TS}) AS updated_at, b.seq, b.bid_open, b.ask_open,
           strftime(date_trunc('minute', t.updated_at), {HOUR_TS}) AS last_tick_minute
    FROM stream b JOIN ticks t ON t.seq = b.seq""", "stream"))
def bars_last_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of tradeable ticks (T1 gate, W11) with the minute of each
    bar's last tick (F7)."""
    ticks = bars.market_open(fixtures.raw_stream(spark, sf_dir))
    # the last tick's time comes out of the bar aggregation itself: no join back to the ticks
    b = bars.last_bars(ticks, fixtures.BAR_WIDTH, last_tick_col="_tick_at")
    return b.select("epic", ts_text("updated_at").alias("updated_at"), "seq", "bid_open", "ask_open",
                    ts_text(floor_minute("_tick_at")).alias("last_tick_minute"))


TRAINING_SQL = with_fixtures(f"""
    SELECT epic, strftime(updated_at, {HOUR_TS}) AS updated_at, bid_open, ask_open,
           ask_open_p1, ask_open_p2, ask_open_p3, bid_open_f1, round(bid_open_f1 / ask_open, 6) AS r
    FROM (SELECT *, lead(bid_open, 1) OVER w AS bid_open_f1, lag(ask_open, 1) OVER w AS ask_open_p1,
                 lag(ask_open, 2) OVER w AS ask_open_p2, lag(ask_open, 3) OVER w AS ask_open_p3
          FROM stream WINDOW w AS (PARTITION BY epic ORDER BY updated_at, seq))
    WHERE bid_open_f1 IS NOT NULL AND ask_open_p3 IS NOT NULL""", "stream")


@query("bars_training_set", TRAINING_SQL)
def bars_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: ticks -> hourly bars -> future bid, past asks, return target
    -> complete rows (the training table of the reference)."""
    rows = fixtures.stream(spark, sf_dir).transform(features.training_rows, horizon=1, past_periods=3)
    return rows.select("epic", ts_text("updated_at").alias("updated_at"), "bid_open", "ask_open",
                       "ask_open_p1", "ask_open_p2", "ask_open_p3", "bid_open_f1", _r("r").alias("r"))


@query("bars_nested_history", f"""
    SELECT event_type AS epic, strftime(ts, {MICRO_TS}) AS updated_at, event_id AS seq,
           value + 0.5 AS ask_open, value AS bid_open FROM events""")
def bars_nested_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker history with two-level (struct) columns -> flat ask/bid."""
    flat = features.adapt_nested_history(fixtures.history_nested(spark, sf_dir), time_col="DateTime")
    return flat.select("epic", ts_text("updated_at", micros=True).alias("updated_at"), "seq",
                       "ask_open", "bid_open")


@query("tick_coverage_2h", with_fixtures("""
    SELECT s.epic, strftime(make_timestamp(s.b * 7200000000), '%Y-%m-%d %H:%M:%S') AS bucket,
           coalesce(c.n, 0) AS n_ticks, t.total AS ticks_total
    FROM s LEFT JOIN c USING (epic, b)
    JOIN (SELECT epic, count(*) AS total FROM raw_stream GROUP BY epic) t USING (epic)""", "raw_stream", extra="""
    c AS (SELECT epic, CAST(floor(epoch_us(updated_at) / 7200000000.0) AS BIGINT) AS b, count(*) AS n
          FROM raw_stream GROUP BY 1, 2),
    s AS (SELECT epic, unnest(range(min(b), max(b) + 1)) AS b FROM c GROUP BY epic)"""))
def tick_coverage_2h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks per two-hour bucket including empty buckets (W12), with the
    per-instrument total (A4); ``count`` starts as a constant 1 (P16)."""
    ticks = fixtures.raw_stream(spark, sf_dir).withColumn("one", F.lit(1))
    cov = bars.bucket_counts(ticks, 7200, count_col="n_ticks")
    totals = ticks.groupBy("epic").agg(F.sum("one").alias("ticks_total"))
    return cov.join(totals, "epic").select("epic", ts_text("bucket").alias("bucket"), "n_ticks", "ticks_total")


# ---------------------------------------------------------------- features


def _lag_sql(periods: int, fill: str) -> str:
    lags = ", ".join(f"lag(ask_open, {i}) OVER w AS p{i}" for i in range(1, periods + 1))
    cols = ["ask_open"] + [f"p{i}" for i in range(1, periods + 1)]
    outs = ["round(ask_open / ask_open, 6) AS ask_open"]
    for i in range(1, periods + 1):
        if fill == "impute":
            v = f"coalesce(p{i}, -999.0)"
        else:
            v = "coalesce(" + ", ".join(reversed(cols[: i + 1])) + ")"
        outs.append(f"round({v} / ask_open, 6) AS ask_open_p{i}")
    return with_fixtures(f"""
        SELECT epic, strftime(updated_at, {HOUR_TS}) AS updated_at, {", ".join(outs)}
        FROM (SELECT *, {lags} FROM stream WINDOW w AS (PARTITION BY epic ORDER BY updated_at, seq))""",
                         "stream")


def _feature_out(df: DataFrame, periods: int) -> DataFrame:
    return df.select("epic", ts_text("updated_at").alias("updated_at"),
                     *[_r(c).alias(c) for c in features.lag_columns("ask_open", periods)])


@query("features_imputed_normalised", _lag_sql(3, "impute"))
def features_imputed_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past asks -> -999 for missing -> divide by the current ask (W2, P13,
    P15), as a parameter-bound ML transformer step (M2)."""
    step = FunctionStep(fn=features.model_features, kwargs={"past_periods": 3, "fill": "impute"})
    return _feature_out(step.transform(fixtures.stream(spark, sf_dir)), 3)


@query("features_ffilled_normalised", _lag_sql(10, "ffill"))
def features_ffilled_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past asks -> forward fill across the row -> normalise."""
    out = features.model_features(fixtures.stream(spark, sf_dir), 10, fill="ffill")
    return _feature_out(out, 10)


GOES_UP_BY = 20.0


@query("target_three_way", with_fixtures(f"""
    SELECT epic, strftime(updated_at, {HOUR_TS}) AS updated_at,
           CASE WHEN abs(f1 - ask_open) > {GOES_UP_BY} THEN sign(f1 - ask_open)
                WHEN abs(f2 - ask_open) > {GOES_UP_BY} THEN sign(f2 - ask_open)
                WHEN abs(f3 - ask_open) > {GOES_UP_BY} THEN sign(f3 - ask_open)
                ELSE 0.0 END AS move,
           round_even(abs(f1 - ask_open), 2) AS move_size_1
    FROM (SELECT *, lead(bid_open, 1) OVER w AS f1, lead(bid_open, 2) OVER w AS f2,
                 lead(bid_open, 3) OVER w AS f3
          FROM stream WINDOW w AS (PARTITION BY epic ORDER BY updated_at, seq))""", "stream"))
def target_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-class move target over the next three bars."""
    s = features.future_bids(fixtures.stream(spark, sf_dir), 3)
    out = features.three_way_target(s, GOES_UP_BY, 3)
    return out.select("epic", ts_text("updated_at").alias("updated_at"), F.col("move").cast("double").alias("move"),
                      F.bround(F.abs(F.col("bid_open_f1") - F.col("ask_open")), 2).alias("move_size_1"))


# ---------------------------------------------------------------- tails, splits

TAIL_N = 4
MIN_BARS = 3


@query("series_tail", with_fixtures(f"""
    SELECT epic, strftime(updated_at, {HOUR_TS}) AS updated_at, ask_open, rows_from_end FROM (
      SELECT *, row_number() OVER (PARTITION BY epic ORDER BY updated_at DESC, seq DESC) - 1 AS rows_from_end,
             count(*) OVER (PARTITION BY epic) AS n
      FROM stream)
    WHERE rows_from_end < {TAIL_N} AND n >= {MIN_BARS}""", "stream"))
def series_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest bars per instrument for live scoring, only once the minimum
    history exists (W17, T6, O3)."""
    t = features.series_tail(fixtures.stream(spark, sf_dir), TAIL_N, min_rows=MIN_BARS)
    return t.select("epic", ts_text("updated_at").alias("updated_at"), "ask_open", "rows_from_end")




@query("chronological_split_bounds", with_fixtures(f"""
    SELECT epic, split, count(*) AS n_rows, strftime(min(updated_at), {HOUR_TS}) AS first_at,
           strftime(max(updated_at), {HOUR_TS}) AS last_at, min(row_index) AS first_index,
           max(days_since) AS max_days_since
    FROM (SELECT *, CASE WHEN row_index < floor(n * {TEST_FRACTION}) THEN 'test' ELSE 'train' END AS split
          FROM (SELECT *, row_number() OVER (PARTITION BY epic ORDER BY updated_at, seq) - 1 AS row_index,
                       count(*) OVER (PARTITION BY epic) AS n,
                       CAST(floor((epoch_us(updated_at) - epoch_us(min(updated_at) OVER (PARTITION BY epic)))
                             / 86400000000.0) AS BIGINT) AS days_since
                FROM stream))
    GROUP BY epic, split""", "stream"))
def chronological_split_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train/test split in time order; rows, date bounds and elapsed days per
    split (W14, W10, A3, A5)."""
    s = features.elapsed_since_start(fixtures.stream(spark, sf_dir), "updated_at")
    sp = chronological_split(s)
    return (sp.groupBy("epic", "split")
            .agg(F.count(F.lit(1)).alias("n_rows"), ts_text(F.min("updated_at")).alias("first_at"),
                 ts_text(F.max("updated_at")).alias("last_at"), F.min("row_index").alias("first_index"),
                 F.max("days_since").alias("max_days_since")))


@query("series_rebased", with_fixtures("""
    SELECT Name, strftime(Date, '%Y-%m-%d') AS day, round(Open / first_open, 6) AS open_rebased,
           CAST(floor((epoch_us(Date::TIMESTAMP) - epoch_us(first_day::TIMESTAMP)) / 86400000000.0) AS BIGINT)
               AS days_since
    FROM (SELECT *, first_value(Open) OVER (PARTITION BY Name ORDER BY Date) AS first_open,
                 min(Date) OVER (PARTITION BY Name) AS first_day FROM daily_prices)""", "daily_prices"))
def series_rebased(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series divided by its first value, with days since the start
    (W9, W10, F9)."""
    d = fixtures.daily_prices(spark, sf_dir).withColumn("_t", F.col("Date").cast("timestamp"))
    r = features.rebase(d, "Open", keys=["Name"], order=["Date"], alias="open_rebased")
    e = features.elapsed_since_start(r, "_t", keys=["Name"])
    return e.select("Name", format_day("Date").alias("day"), _r("open_rebased").alias("open_rebased"),
                    F.col("days_since").cast("long").alias("days_since"))


LIVE_PERIODS = 3


def _live_sql(order: str, fn: str) -> str:
    shifts = ", ".join(f"{fn}(ask_open, {i}) OVER w AS p{i}" for i in range(1, LIVE_PERIODS + 1))
    return f"""
    SELECT '{order}' AS feature_order, epic, strftime(updated_at, {HOUR_TS}) AS updated_at,
           round(ask_open / ask_open, 6) AS ask_open,
           {", ".join(f"round(coalesce(p{i}, -999.0) / ask_open, 6) AS ask_open_p{i}" for i in range(1, LIVE_PERIODS + 1))}
    FROM (SELECT *, {shifts}, max(rfe) OVER (PARTITION BY epic) AS oldest
          FROM tail WINDOW w AS (PARTITION BY epic ORDER BY updated_at, seq))
    WHERE rfe = {"0" if order == "time_correct" else "oldest"}"""


@query("live_feature_rows", with_fixtures(
    _live_sql("time_correct", "lag") + "\n    UNION ALL" + _live_sql("reference_live", "lead"), "stream", extra=f"""
    t AS (SELECT *, row_number() OVER (PARTITION BY epic ORDER BY updated_at DESC, seq DESC) - 1 AS rfe,
                 count(*) OVER (PARTITION BY epic) AS n FROM stream),
    tail AS (SELECT * FROM t WHERE rfe < {LIVE_PERIODS + 1} AND n >= {LIVE_PERIODS})"""))
def live_feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row per instrument that live scoring would use, time-correct and
    as the reference's live path does it (T6, T7; SURVEY 1.4-2)."""
    bars_ = fixtures.stream(spark, sf_dir)
    out = None
    for order in ("time_correct", "reference_live"):
        rows = features.live_feature_rows(bars_, LIVE_PERIODS, order).select(
            F.lit(order).alias("feature_order"), "epic", ts_text("updated_at").alias("updated_at"),
            *[_r(c).alias(c) for c in features.lag_columns("ask_open", LIVE_PERIODS)])
        out = rows if out is None else out.unionByName(rows)
    return out


@query("target_volatility", with_fixtures(f"""
    SELECT epic, strftime(updated_at, {HOUR_TS}) AS updated_at,
           round(((r1 + r2 + r3) / 3.0)
                 * sqrt(((r1 - (r1 + r2 + r3) / 3.0) * (r1 - (r1 + r2 + r3) / 3.0)
                         + (r2 - (r1 + r2 + r3) / 3.0) * (r2 - (r1 + r2 + r3) / 3.0)
                         + (r3 - (r1 + r2 + r3) / 3.0) * (r3 - (r1 + r2 + r3) / 3.0)) / 2.0), 6) AS r_vol
    FROM (SELECT *, lead(bid_open, 1) OVER w / ask_open AS r1, lead(bid_open, 2) OVER w / ask_open AS r2,
                 lead(bid_open, 3) OVER w / ask_open AS r3
          FROM stream WINDOW w AS (PARTITION BY epic ORDER BY updated_at, seq))""", "stream"))
def target_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volatility-aware target over the next three bars (a documented
    intention of the reference)."""
    v = features.volatility_target(fixtures.stream(spark, sf_dir), 3)
    return v.select("epic", ts_text("updated_at").alias("updated_at"), _r("r_vol").alias("r_vol"))


@query("latest_price", with_fixtures(f"""
    SELECT epic, strftime(arg_max(updated_at, (updated_at, seq)), {MICRO_TS}) AS updated_at,
           arg_max(seq, (updated_at, seq)) AS seq,
           arg_max(bid_open, (updated_at, seq)) FILTER (WHERE bid_open IS NOT NULL) AS bid_open,
           arg_max(ask_open, (updated_at, seq)) FILTER (WHERE ask_open IS NOT NULL) AS ask_open
    FROM ticks GROUP BY epic""", "ticks"))
def latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conflated latest tradeable price per instrument, field by field (S9, MERGE)."""
    p = bars.latest_prices(bars.market_open(fixtures.raw_stream(spark, sf_dir)))
    return p.select("epic", ts_text("updated_at", micros=True).alias("updated_at"), "seq", "bid_open", "ask_open")


@query("gated_ticks", with_fixtures("""
    SELECT epic, market_state, count(*) AS n_ticks, strftime(min(updated_at), '%Y-%m-%d %H:%M:%S.%f') AS first_at
    FROM raw_stream WHERE market_state IS DISTINCT FROM 'TRADEABLE' GROUP BY epic, market_state""", "raw_stream"))
def gated_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks the market-open gate holds back, as a side table per
    instrument and state (T1: the reference raises; the query goes on)."""
    held = bars.market_closed(fixtures.raw_stream(spark, sf_dir))
    return held.groupBy("epic", "market_state").agg(
        F.count(F.lit(1)).alias("n_ticks"), ts_text(F.min("updated_at"), micros=True).alias("first_at"))
