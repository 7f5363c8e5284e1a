"""The live loop as Structured Streaming.

Feed items -> typed ticks (T2, :func:`ticks_from_items`) -> every tick kept, open
and closed market apart (T3, T1, :func:`run_ticks`) -> market-open gate ->
watermark -> tumbling bars in **append** mode (T4/T5: a bar is emitted once,
when the watermark passes its end) -> ``foreachBatch``: the new bars are scored
by every deployed model (T6, T7), forecasts above the threshold become positions
(T8/T9), positions past their exit time are closed at the first bar after it
(T10, T11), and outcomes are appended (T12). :func:`monitoring_tables` puts the
written tables side by side (T13).

The source is any streaming table of ticks; nothing here knows where it lands.

State is only the open bars (the watermark drops closed ones); the
checkpoint lives under the session's shared ``spark.checkpoint.dir``, so a
restarted query resumes where it stopped and an executor loss replays from
the checkpointed offsets.

Note: a watermark is global. A quiet instrument's bar is closed when any
instrument moves past it, while the reference (one instrument per process)
holds back each instrument's newest bar. Batch bars follow the reference.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow import schemas
from barflow.functions import scalar
from barflow.operators import bars as bar_ops
from barflow.operators import features, positions, scoring
from barflow.session import checkpoint_root

ROW_KEY = ["epic", "updated_at", "seq"]


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Shuffle/state partitions a new streaming query is started with. They
    are fixed in its checkpoint at first start, so they are sized on purpose
    (default: the cluster's parallelism) instead of inheriting the batch
    setting; the session value is restored afterwards."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def stream_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming query under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/streams/{name}-{uuid.uuid4().hex[:12]}"


def ticks_from_items(items: DataFrame, item_col: str = "item") -> DataFrame:
    """Feed items as JSON text (a Kafka value, a landed line) -> typed
    ticks, in a batch or a stream; a bare time of day stands on the item's
    trade date. Text that isn't an item gives a tick without values, which the
    market-open gate holds back."""
    p = items.select(F.from_json(F.col(item_col), schemas.PRICE_ITEM).alias("i")).select("i.*")
    return p.select("epic", "seq", scalar.time_on_date(F.col("values.UPDATE_TIME"), F.col("trade_date")).alias("updated_at"),
                    F.col("values.BID").alias("bid_open"), F.col("values.OFFER").alias("ask_open"),
                    F.col("values.MARKET_STATE").alias("market_state"))


def streaming_bars(ticks: DataFrame, width: str = "1 minute", delay: str = "0 seconds") -> DataFrame:
    """T4: watermarked tumbling bars, last value per column, right label."""
    gated = bar_ops.market_open(ticks).withWatermark("updated_at", delay)
    order = F.struct("updated_at", "seq")
    return (gated.groupBy("epic", F.window("updated_at", width).alias("_w"))
            .agg(F.max_by("seq", order).alias("seq"),
                 *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in ("bid_open", "ask_open")])
            .select("epic", F.col("_w.end").alias("updated_at"), "seq", "bid_open", "ask_open")
            .na.drop("any", subset=["bid_open", "ask_open"]))


def run_latest_prices(spark: SparkSession, ticks: DataFrame, query_name: str):
    """The conflated latest price per instrument as a stream (``update``
    output: each trigger emits the instruments that moved) into a memory
    table for inspection; returns the finished query."""
    with state_partitions(spark):
        q = (bar_ops.latest_prices(bar_ops.market_open(ticks))
             .writeStream.outputMode("update").format("memory").queryName(query_name)
             .option("checkpointLocation", stream_dir(spark, query_name) + "/_checkpoint")
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def distinct_updates(updates: DataFrame, keys: Sequence[str] = ("dealId", "timestamp"), time_col: str = "timestamp",
                     delay: str = "1 hour") -> DataFrame:
    """S10/T16 (DISTINCT subscription): every update once, also when the feed
    repeats it after a reconnect. A stream's state holds the keys seen in the
    last ``delay`` of event time; a batch drops every repeat. An update without
    a time can't be watermarked and is left out of either."""
    timed = updates.filter(F.col(time_col).isNotNull())
    if not updates.isStreaming:
        return timed.dropDuplicates(list(keys))
    return timed.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def run_bars(spark: SparkSession, ticks: DataFrame, width: str, out_dir: str | None = None,
             delay: str = "0 seconds") -> str:
    """Run the bar stream to completion (``availableNow``) into an
    append-only Parquet table; returns its path. Re-running with the same
    ``out_dir`` resumes from the checkpoint and adds nothing twice."""
    out_dir = out_dir or stream_dir(spark, "bars")
    with state_partitions(spark):
        q = (streaming_bars(ticks, width, delay)
             .writeStream.outputMode("append").format("parquet")
             .option("path", f"{out_dir}/data").option("checkpointLocation", f"{out_dir}/_checkpoint")
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{out_dir}/data"


def run_ticks(spark: SparkSession, ticks: DataFrame, out_dir: str) -> str:
    """T3 + T1: keep every raw tick, once, in an append-only table parted into
    ``market_open=true`` and the side table ``market_open=false``; returns its path."""
    open_ = F.coalesce(F.col("market_state") == F.lit("TRADEABLE"), F.lit(False))
    q = (ticks.withColumn("market_open", open_).writeStream.outputMode("append").format("parquet")
         .partitionBy("market_open").option("path", f"{out_dir}/ticks")
         .option("checkpointLocation", f"{out_dir}/_checkpoint_ticks").trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{out_dir}/ticks"


def _latest_epoch_before(spark: SparkSession, path: str, epoch: int) -> int | None:
    """Newest ``epoch=N`` folder under ``path`` with N < ``epoch`` (a metadata
    listing on the driver, no data read)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    found = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("epoch="):
            e = int(name.split("=", 1)[1])
            if e < epoch:
                found.append(e)
    return max(found) if found else None


def live_features(new_bars: DataFrame, history: DataFrame | None, past_periods: int, kind: str = "knn") -> DataFrame:
    """Feature vectors of the new bars as a model of ``kind`` takes them, with
    ``history`` (the last bars per instrument, at least ``past_periods``, or
    None) before them; an instrument is scored once it has at least ``past_periods`` bars."""
    cur = new_bars.withColumn("_new", F.lit(True))
    allb = cur if history is None else history.withColumn("_new", F.lit(False)).unionByName(cur)
    enough = allb.groupBy("epic").agg(F.count(F.lit(1)).alias("_nb")).filter(F.col("_nb") >= past_periods)
    allb = allb.join(enough.select("epic"), "epic", "left_semi")
    return scoring.KINDS[kind].vectors(allb, past_periods).filter(F.col("_new")).select(*ROW_KEY, "level", "vec")


def score(feats: DataFrame, model: dict, hold_minutes: int) -> DataFrame:
    """T7 + T8: one deployed model on its instrument's feature rows (on all,
    where it names none), threshold -> position rows."""
    own = feats if model.get("instrument") is None else feats.filter(F.col("epic") == F.lit(model["instrument"]))
    pred = scoring.KINDS[_kind(model)].predict(own, model["fitted"], k=model.get("k"))
    return positions.signals_to_positions(own.select(*ROW_KEY, "level").join(pred, ROW_KEY), model["r_threshold"],
                                          model["model_name"], str(model["model_version"]), hold_minutes)


def _kind(model: dict) -> str:
    return model.get("kind", "knn")


def _table(spark: SparkSession, path: str, epoch: int | None) -> DataFrame | None:
    return None if epoch is None else spark.read.parquet(f"{path}/epoch={epoch}")


def process_signal_batch(spark: SparkSession, batch: DataFrame, epoch_id: int, out_dir: str, models: list[dict],
                         past_periods: int, hold_minutes: int) -> None:
    """One micro-batch of new bars: close what is due, score the bars with every
    model, append positions, fills, outcomes and bars, and roll the state tables
    forward (the last bars per instrument, and the open positions).

    A model's features reach back its own ``past_periods`` bars (``past_periods``
    where it has none); models that take the same features share them.
    State is the newest committed epoch's: per instrument as many bars as the deepest model
    reaches back, and the positions still open, however long the stream runs. Every
    write replaces only this epoch's folder, so a replayed batch (after a
    failure before the commit) rewrites instead of duplicating."""
    def put(df: DataFrame, name: str) -> DataFrame:
        path = f"{out_dir}/{name}/epoch={epoch_id}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    prev = _latest_epoch_before(spark, f"{out_dir}/tails", epoch_id)
    history, held = _table(spark, f"{out_dir}/tails", prev), _table(spark, f"{out_dir}/open", prev)
    depth = {id(m): m.get("past_periods") or past_periods for m in models}
    deepest = max(depth.values())
    feats: dict[tuple, DataFrame] = {}
    opened = None
    for m in models:  # a handful of deployed configurations, not data
        form = (scoring.KINDS[_kind(m)].vectors, depth[id(m)])
        if form not in feats:
            feats[form] = put(live_features(batch, history, depth[id(m)], _kind(m)), f"features_{form[0].__name__}_{form[1]}")
        p = score(feats[form], m, hold_minutes)
        opened = p if opened is None else opened.unionByName(p)
    opened = put(opened, "positions")
    bars = put(batch, "bars")
    # A position is due from its exit time on; it closes at the first bar at or after it
    candidates = opened if held is None else held.unionByName(opened)
    fills = put(positions.paper_fills(candidates, bars), "sold")
    put(positions.outcomes(candidates.join(fills.select("dealId"), "dealId", "left_semi"), fills), "outcomes")
    put(positions.still_open(candidates, fills), "open")
    both = batch if history is None else history.unionByName(batch)
    put(features.series_tail(both, deepest).drop("rows_from_end"), "tails")
    # Retention: states older than the one this batch read are never read again
    # (a replay of this epoch reads ``prev``), so the listing stays short.
    if prev is not None:
        for name in ("tails", "open"):
            _drop_epochs_before(spark, f"{out_dir}/{name}", prev)


def monitoring_tables(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """T13 + J4 + J6: positions with their fills and outcomes, and ticks next to
    the bar with exactly their time, from the tables that the loop has written."""
    opened, closed = spark.read.parquet(f"{out_dir}/positions"), spark.read.parquet(f"{out_dir}/outcomes")
    done = closed.select("dealId", "close_date", "close_level_responce", "y_true", "profit_responce")
    out = {"positions": opened.drop("epoch").join(done, "dealId", "left")}
    if _latest_epoch_before(spark, f"{out_dir}/bars", 1 << 62) is not None and _exists(spark, f"{out_dir}/ticks"):
        ticks, bars = spark.read.parquet(f"{out_dir}/ticks"), spark.read.parquet(f"{out_dir}/bars")
        r = ticks.select("epic", "updated_at", "seq", *[F.col(c).alias(f"{c}_raw_stream") for c in ("bid_open", "ask_open")])
        b = bars.select("epic", "updated_at", *[F.col(c).alias(f"{c}_stream") for c in ("bid_open", "ask_open")])
        out["ticks"] = r.join(b, ["epic", "updated_at"], "left")
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)


def _drop_epochs_before(spark: SparkSession, path: str, epoch: int) -> None:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("epoch=") and int(name.split("=", 1)[1]) < epoch:
            fs.delete(st.getPath(), True)


def run_signals(spark: SparkSession, ticks: DataFrame, models: list[dict], width: str = "1 hour",
                delay: str = "0 seconds", past_periods: int = 3, hold_minutes: int = 1,
                out_dir: str | None = None) -> str:
    """T1-T12 + T14 end to end: bars stream, and per micro-batch the new bars
    are kept, scored and turned into positions, and due positions are closed.

    ``models`` lists the deployed configurations: ``model_name``,
    ``model_version``, ``kind`` (of :data:`barflow.operators.scoring.KINDS`; default
    ``knn``), ``fitted`` (a model of that kind, fitted or loaded once, before the
    stream starts), ``k`` for ``knn``, ``past_periods`` (default: the argument),
    ``r_threshold`` and the ``instrument`` it trades (None: all). ``delay`` is how late a tick may
    come, over all instruments (the watermark is global): ticks later than that
    are in the raw table, not in a bar. Returns the folder of the tables."""
    out_dir = out_dir or stream_dir(spark, "signals")
    pinned = [scoring.KINDS[_kind(m)].pin(m["fitted"]) for m in models]
    models = [{**m, "fitted": held} for m, (held, _) in zip(models, pinned)]

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # The micro-batch feeds several writes: keep it for the duration of this call only.
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                process_signal_batch(spark, batch, epoch_id, out_dir, models, past_periods, hold_minutes)
        finally:
            batch.unpersist()

    try:
        with state_partitions(spark):
            q = (streaming_bars(ticks, width, delay)
                 .writeStream.outputMode("append").foreachBatch(on_batch)
                 .option("checkpointLocation", f"{out_dir}/_checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for _, release in pinned:
            release()
    return out_dir
