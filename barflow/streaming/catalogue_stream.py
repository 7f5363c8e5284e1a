"""Catalogue: the streaming queries. The watermark is the newest tick, so a run
over all files closes exactly the bars that end at or before it; that is plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.scalar import ts_text
from barflow.jobs import ROW_KEY
from barflow.operators import features, forecast, knn, positions, scoring
from barflow.plans import fixtures
from barflow.plans.catalogue_bars import HOUR_TS
from barflow.plans.catalogue_models import BAR_MODEL_SQL, K, LOOKBACKS, R_THRESHOLD, bar_model_rows, stacked_sql
from barflow.plans.registry import query, with_fixtures
from barflow.streaming import keyed, live

STREAMED_SQL = """
    sbars AS (SELECT b.* FROM bars_all b WHERE b.updated_at <= (SELECT max(updated_at) FROM ticks))"""


@query("stream_bars", with_fixtures(f"""
    SELECT epic, strftime(updated_at, {HOUR_TS}) AS updated_at, seq, bid_open, ask_open FROM sbars""",
                                    "bars_all", extra=STREAMED_SQL))
def stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars from the tick files as a stream in append mode."""
    path = live.run_bars(spark, fixtures.tick_stream(spark, sf_dir), fixtures.BAR_WIDTH)
    b = spark.read.parquet(path)
    return b.select("epic", ts_text("updated_at").alias("updated_at"), "seq", "bid_open", "ask_open")


SIGNALS_SQL = f"""
    sq AS (SELECT epic, updated_at, seq, ask_open AS level,
                  [ask_open / ask_open, coalesce(lag(ask_open, 1) OVER w, -999.0) / ask_open,
                   coalesce(lag(ask_open, 2) OVER w, -999.0) / ask_open, coalesce(lag(ask_open, 3) OVER w, -999.0) / ask_open] AS v,
                  count(*) OVER (PARTITION BY epic) AS n
           FROM sbars WINDOW w AS (PARTITION BY epic ORDER BY updated_at, seq)),
    snn AS (SELECT * FROM (
              SELECT q.epic, q.updated_at, q.seq, q.level, t.y_true AS t_y,
                     row_number() OVER (PARTITION BY q.epic, q.updated_at, q.seq
                                        ORDER BY list_distance(q.v, t.v), t.epic, t.updated_at, t.seq) AS rank
              FROM sq q, fs t WHERE t.split = 'train' AND q.n >= 3)
            WHERE rank <= {K}),
    sig AS (SELECT epic, updated_at, seq, any_value(level) AS level, avg(t_y) AS y_pred FROM snn GROUP BY ALL
            HAVING avg(t_y) > {R_THRESHOLD})"""


@query("stream_signals", with_fixtures(f"""
    SELECT substr(sha256(concat_ws('|', epic, CAST(updated_at AS VARCHAR), 'knn-reg-model-v1')), 1, 32) AS dealId,
           'knn-reg-model-v1' AS model_used, strftime(updated_at, {HOUR_TS}) AS buy_date,
           strftime(updated_at + INTERVAL 1 MINUTE, {HOUR_TS}) AS sell_date, level AS buy_level_responce,
           round(y_pred, 6) AS y_pred
    FROM sig""", "stream", extra=BAR_MODEL_SQL + "," + STREAMED_SQL + "," + SIGNALS_SQL))
def stream_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live loop: streamed bars scored by the kNN model fitted once on the
    batch bars' training split, positions written per micro-batch (S8, T6-T12, T14)."""
    train = bar_model_rows(spark, sf_dir).filter(F.col("split") == "train")
    model = dict(model_name="knn-reg-model", model_version=1, k=K, r_threshold=R_THRESHOLD,
                 fitted=knn.fit(train, ROW_KEY, y="y_true"))
    out = live.run_signals(spark, fixtures.tick_stream(spark, sf_dir), [model], width=fixtures.BAR_WIDTH)
    p = spark.read.parquet(f"{out}/positions")
    return p.select("dealId", "model_used", ts_text("buy_date").alias("buy_date"),
                    ts_text("sell_date").alias("sell_date"), "buy_level_responce", F.round("y_pred", 6).alias("y_pred"))


STACKED_SIGNALS_SQL = f"""
    scored AS (SELECT epic, updated_at, seq, label - left_over AS y_pred FROM h{len(LOOKBACKS)} WHERE fold = -2),
    enough AS (SELECT epic FROM sbars GROUP BY epic HAVING count(*) >= {max(LOOKBACKS)})"""


@query("stream_stacked_signals", with_fixtures(f"""
    SELECT substr(sha256(concat_ws('|', epic, CAST(updated_at AS VARCHAR), 'stacked-linear-reg-model-v1')), 1, 32) AS dealId,
           'stacked-linear-reg-model-v1' AS model_used, strftime(updated_at, {HOUR_TS}) AS buy_date,
           strftime(updated_at + INTERVAL 1 MINUTE, {HOUR_TS}) AS sell_date, ask_open AS buy_level_responce,
           round(y_pred, 4) AS y_pred
    FROM scored JOIN sbars USING (epic, updated_at, seq) JOIN enough USING (epic) WHERE y_pred > {R_THRESHOLD}""", "stream",
                                              extra=STREAMED_SQL + "," + stacked_sql("sbars") + "," + STACKED_SIGNALS_SQL))
def stream_stacked_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stacked model deployed: fitted on the batch bars with a label, stored, loaded
    by its kind, and scoring the streamed bars of every instrument with enough of them (M8, M9, T14)."""
    order = list(features.ORDER)
    rows = forecast.stacked_features(fixtures.stream(spark, sf_dir), max(LOOKBACKS), ["epic"], order, future={"bid_open": 1})
    rows = features.return_target(rows, alias="y_true").filter(F.col("y_true").isNotNull()).withColumnRenamed("x", "vec")
    path = live.stream_dir(spark, "model")
    scoring.save(spark, "stacked", scoring.KINDS["stacked"].fit(rows, lookbacks=LOOKBACKS), path)
    kind, fitted = scoring.load(spark, path)
    model = dict(model_name=scoring.KINDS[kind].label, model_version=1, kind=kind, past_periods=max(LOOKBACKS),
                 r_threshold=R_THRESHOLD, fitted=fitted)
    out = live.run_signals(spark, fixtures.tick_stream(spark, sf_dir), [model], width=fixtures.BAR_WIDTH)
    p = spark.read.parquet(f"{out}/positions")
    return p.select("dealId", "model_used", ts_text("buy_date").alias("buy_date"),
                    ts_text("sell_date").alias("sell_date"), "buy_level_responce", F.round("y_pred", 4).alias("y_pred"))


def _as_files(df: DataFrame, name: str, files: int = 1) -> DataFrame:
    """A table as a file stream; with several files, rows arrive dealt by a hash, one file a micro-batch."""
    spark, path = df.sparkSession, live.stream_dir(df.sparkSession, name)
    (df.repartition(files, F.xxhash64(F.lit(name), "seq")) if files > 1 else df).write.parquet(path)
    reader = spark.readStream.schema(df.schema)
    return (reader.option("maxFilesPerTrigger", 1) if files > 1 else reader).parquet(path)


@query("stream_instrument_bars", with_fixtures(f"""
    SELECT epic, strftime(updated_at, {HOUR_TS}) AS updated_at, seq, bid_open, ask_open FROM stream""", "stream"))
def stream_instrument_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars that close on their own instrument's progress, corrected by late ticks: the ticks arrive
    out of order in four files, the last revisions are the batch bars (T4, W11)."""
    ticks = fixtures.raw_stream(spark, sf_dir).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    stream = keyed.instrument_bars(_as_files(ticks, "ticks", 4), fixtures.BAR_WIDTH, keep="36500 days")
    b = keyed.current_bars(keyed.run_table(spark, stream, live.stream_dir(spark, "instrument-bars")))
    return b.select("epic", ts_text("updated_at").alias("updated_at"), "seq", "bid_open", "ask_open")


HOLD_MINUTES = 90
EXIT_SQL = f"""
    pos AS (SELECT substr(sha256(concat_ws('|', epic, CAST(updated_at AS VARCHAR), 'exits-v1')), 1, 32) AS dealId, epic,
                   make_timestamp(CAST(round_even(epoch_us(updated_at) / 60000000.0, 0) AS BIGINT) * 60000000
                                  + {HOLD_MINUTES * 60_000_000}) AS sell_date
            FROM stream WHERE bid_open / ask_open > 0.99),
    fill AS (SELECT p.dealId, p.epic, s.updated_at AS close_date, s.bid_open AS close_level_responce
             FROM pos p ASOF JOIN stream s ON p.epic = s.epic AND p.sell_date <= s.updated_at)"""


@query("stream_exit_fills", with_fixtures(f"""
    SELECT dealId, epic, strftime(close_date, {HOUR_TS}) AS close_date, close_level_responce FROM fill""", "stream", extra=EXIT_SQL))
def stream_exit_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exits by event-time timers on keyed state: each position closes at its instrument's first bar
    at or after its exit time (T9, T10, T11)."""
    b = fixtures.stream(spark, sf_dir).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    scored = b.withColumn("y_pred", F.try_divide("bid_open", "ask_open")).withColumn("level", F.col("ask_open"))
    opened = positions.signals_to_positions(scored, 0.99, "exits", "1", HOLD_MINUTES, keep_cols=["seq"])
    fills = keyed.exit_fills(_as_files(opened, "positions"), _as_files(b, "bars"), parts=4)
    out = keyed.run_table(spark, fills, live.stream_dir(spark, "exits"))
    return out.select("dealId", "epic", ts_text("close_date").alias("close_date"), "close_level_responce")


@query("stream_monitor_ticks", with_fixtures("""
    SELECT r.epic, strftime(r.at, '%Y-%m-%d %H:%M:%S.%f') AS updated_at, r.seq,
           r.bid_open AS bid_open_raw_stream, r.ask_open AS ask_open_raw_stream,
           s.bid_open AS bid_open_stream, s.ask_open AS ask_open_stream
    FROM (SELECT *, CASE WHEN seq % 7 = 0 THEN date_trunc('hour', updated_at) ELSE updated_at END AS at FROM raw_stream) r
    LEFT JOIN stream s ON r.epic = s.epic AND r.at = s.updated_at
    WHERE s.epic IS NOT NULL
       OR epoch_ms(r.at) <= least((SELECT max(epoch_ms(updated_at)) FROM stream),
                       (SELECT max(epoch_ms(CASE WHEN seq % 7 = 0 THEN date_trunc('hour', updated_at) ELSE updated_at END)) FROM raw_stream))""",
                                             "raw_stream", "stream"))
def stream_monitor_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live monitoring: every tick beside the bar of exactly its time, as two streams joined. The ticks
    that neither have a bar nor are passed by both streams' watermark are still waiting (T13, J6)."""
    full = F.date_trunc("hour", "updated_at").cast("timestamp")
    ticks = fixtures.raw_stream(spark, sf_dir).withColumn(
        "updated_at", F.when(F.col("seq") % 7 == 0, full).otherwise(F.col("updated_at").cast("timestamp")))
    bars = fixtures.stream(spark, sf_dir).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    j = keyed.run_table(spark, keyed.ticks_beside_bars(_as_files(ticks, "raw"), _as_files(bars, "bars")), live.stream_dir(spark, "monitor"))
    return j.select("epic", ts_text("updated_at", micros=True).alias("updated_at"), "seq", "bid_open_raw_stream", "ask_open_raw_stream",
                    "bid_open_stream", "ask_open_stream")
