"""Streams with state per instrument: bars that close on their own instrument's
progress, exits by event-time timers, and ticks beside their bars.

The bars of :func:`barflow.streaming.live.streaming_bars` close by the watermark, which is
global. Here an instrument's bar closes when the same instrument has a newer whole bar, as the reference
closes it, and a late tick corrects a bar that was emitted: the bar is
emitted again with a higher revision. Exits wait in keyed state for their time instead of being
rewritten with every micro-batch.

State is held as one Arrow table per key, in Spark's state store under the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barflow.operators import bars as bar_ops
from barflow.streaming.live import state_partitions

FIELDS = ("bid_open", "ask_open")
_PART = ["ends", "field", "at", "seq", "value"]
_BAR = ["ends", "seq", *FIELDS]


def _packed(df: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(df, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def _newest(parts: pd.DataFrame, by: Sequence[str]) -> pd.DataFrame:
    """The newest entry of each bar and field."""
    return parts.sort_values(["at", "seq"], kind="stable").drop_duplicates(list(by), keep="last")


def _whole_bars(parts: pd.DataFrame) -> pd.DataFrame:
    """The bars that have every field; ``seq`` is that of the bar's newest tick."""
    out = parts[parts.field == -1].set_index("ends")[["seq"]]
    for i, name in enumerate(FIELDS):
        out = out.join(parts[parts.field == i].set_index("ends")["value"].rename(name), how="inner")
    return out.reset_index()[_BAR]


def instrument_bars(ticks: DataFrame, width: str = "1 minute", keep: str = "7 days") -> DataFrame:
    """T4 per instrument: ``(epic, updated_at, seq, bid_open, ask_open, revision)`` of a tick stream, append mode.

    A bar is emitted once its instrument has a newer whole bar, and again, with a higher ``revision``, when a late
    tick changes it. The state of an instrument is the newest entry of each field of its bars of the last ``keep`` before
    its newest whole bar; ticks of older bars change nothing. Ticks are reduced to these entries in each partition before they are dealt to
    instruments, so an instrument with a third of all ticks sends a few rows per bar and partition. Ticks without a time or
    of a closed market are left out; a bar without one of its fields is never emitted."""
    micros = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00 UTC' + INTERVAL {width})")
    keep_micros = int(pd.Timedelta(keep).total_seconds() * 1_000_000)
    at = F.unix_micros("updated_at")
    gated = bar_ops.market_open(ticks).filter(F.col("updated_at").isNotNull()).select(
        "epic", ((F.floor(at / micros) + 1) * micros).cast("long").alias("ends"), at.alias("at"), F.col("seq").cast("long").alias("seq"),
        *[F.col(c).cast("double").alias(c) for c in FIELDS])

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            long = [b.assign(field=-1, value=0.0)]
            long += [b[b[c].notna()].assign(field=i, value=b[c]) for i, c in enumerate(FIELDS)]
            yield _newest(pd.concat(long)[["epic", *_PART]], ["epic", "ends", "field"])

    def merge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, revision = (state.get if state.exists else (None, 0))
        before = _unpacked(held) if held is not None else pd.DataFrame({c: pd.Series(dtype="float64" if c == "value" else "int64") for c in _PART})
        parts = before
        for b in batches:
            parts = _newest(pd.concat([parts, b[_PART]]) if len(parts) else b[_PART], ["ends", "field"])
        was, now = _whole_bars(before), _whole_bars(parts)
        if len(now):
            newest = now.ends.max()
            closed = now[(now.ends < newest) & (now.ends >= newest - keep_micros)]
            old = was[was.ends < was.ends.max()] if len(was) else was
            # a bar below the state's reach was dropped from it: a late tick must not make half a bar of it
            if len(was):
                closed = closed[closed.ends >= was.ends.max() - keep_micros]
            known = set(old.itertuples(index=False, name=None))
            fresh = closed[[r not in known for r in closed.itertuples(index=False, name=None)]]
            if len(fresh):
                yield fresh.assign(epic=key[0], revision=revision)[["epic", *_BAR, "revision"]]
        if len(parts):
            parts = parts[parts.ends >= (now if len(now) else parts).ends.max() - keep_micros]
        state.update((_packed(parts[_PART].reset_index(drop=True)), revision + 1))

    kind = ticks.schema["epic"].dataType.simpleString()
    parts = gated.mapInPandas(reduced, f"epic {kind}, ends long, field int, at long, seq long, value double")
    out = parts.groupBy("epic").applyInPandasWithState(
        merge, f"epic {kind}, ends long, seq long, bid_open double, ask_open double, revision long", "held binary, revision long",
        "append", GroupStateTimeout.NoTimeout)
    return out.select("epic", F.timestamp_micros("ends").alias("updated_at"), "seq", *FIELDS, "revision")


def current_bars(table: DataFrame) -> DataFrame:
    """The last revision of each bar that :func:`instrument_bars` has written."""
    values = F.struct("revision", "seq", *FIELDS)
    return (table.groupBy("epic", "updated_at").agg(F.max(values).alias("_b"))
            .select("epic", "updated_at", *[F.col(f"_b.{c}").alias(c) for c in ("seq", *FIELDS)]))


def exit_fills(positions: DataFrame, bars: DataFrame, delay: str = "0 seconds", parts: int = 1) -> DataFrame:
    """``(dealId, epic, close_date, close_level_responce)`` of streams of positions (``dealId, epic, buy_date,
    sell_date``) and bars: each position closes at the bid of its instrument's first bar at or after ``sell_date``.

    An instrument's open positions and the bars that may still be preceded by others stand in keyed state. A fill
    is final when the watermark, ``delay`` behind the newest event, has reached its bar; an event-time
    timer wakes the instrument then, with or without new events. Later events are dropped by the watermark.
    ``parts`` deals one instrument's positions to that many keys, each with the instrument's bars. Rows without a
    time, and positions without an id, are left out; positions without a later bar wait."""
    none = F.lit(None)
    place = F.pmod(F.xxhash64("dealId"), F.lit(parts)).cast("int")
    asked = positions.filter(F.col("sell_date").isNotNull() & F.col("dealId").isNotNull()).select(
        "epic", place.alias("part"), F.col("buy_date").cast("timestamp").alias("at"), "dealId",
        F.unix_micros(F.col("sell_date").cast("timestamp")).alias("due"), none.cast("double").alias("level"))
    given = bars.select("epic", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.col("updated_at").cast("timestamp").alias("at"),
                        none.cast("string").alias("dealId"), none.cast("long").alias("due"), F.col("bid_open").cast("double").alias("level"))
    events = asked.unionByName(given).filter(F.col("at").isNotNull()).withWatermark("at", delay).withColumn("t", F.unix_micros("at"))
    kept = ["t", "dealId", "due", "level"]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frames = [_unpacked(state.get[0])] if state.exists else []
        if not state.hasTimedOut:
            frames += [b[kept] for b in batches]
        rows = pd.concat(frames).astype({"t": "int64", "due": "Int64", "level": "float64"})
        reached = state.getCurrentWatermarkMs() * 1000
        ask = rows.dealId.notna()
        levels = rows[~ask].sort_values("t", kind="stable")
        final = levels[levels.t <= reached]
        waits = rows[ask].sort_values("due", kind="stable")
        at = final.t.searchsorted(waits.due.astype("int64")) if len(waits) else []
        hit = pd.Series([i < len(final) for i in at], index=waits.index, dtype=bool)
        if hit.any():
            bar = final.iloc[[i for i in at if i < len(final)]]
            yield pd.DataFrame({"dealId": waits.dealId[hit.to_numpy()].to_numpy(), "epic": key[0], "closes": bar.t.to_numpy(),
                                "level": bar.level.to_numpy()})
        waits, levels = waits[~hit.to_numpy()], levels[levels.t > reached]
        if len(waits) or len(levels):
            state.update((_packed(pd.concat([waits, levels]).reset_index(drop=True)),))
            if len(levels):  # the next bar that becomes final
                state.setTimeoutTimestamp(max(int(levels.t.min()) // 1000 - 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()

    kind = positions.schema["epic"].dataType.simpleString()
    out = events.groupBy("epic", "part").applyInPandasWithState(
        step, f"dealId string, epic {kind}, closes long, level double", "held binary", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select("dealId", "epic", F.timestamp_micros("closes").alias("close_date"), F.col("level").alias("close_level_responce"))


def ticks_beside_bars(ticks: DataFrame, bars: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """T13 + J6 as a stream-stream left outer join: every tick with the bar of exactly its time. A tick
    without a bar is emitted when the watermark of both streams has passed it; state holds the ticks and bars since then."""
    r = ticks.select("epic", "updated_at", "seq", *[F.col(c).alias(f"{c}_raw_stream") for c in FIELDS]).withWatermark("updated_at", delay)
    b = bars.select(F.col("epic").alias("_epic"), F.col("updated_at").alias("_at"),
                    *[F.col(c).alias(f"{c}_stream") for c in FIELDS]).withWatermark("_at", delay)
    return r.join(b, (F.col("epic") == F.col("_epic")) & (F.col("updated_at") == F.col("_at")), "leftOuter").drop("_epic", "_at")


def run_table(spark: SparkSession, stream: DataFrame, out_dir: str) -> DataFrame:
    """Run a stream over all that is there into an append-only table under ``out_dir`` and read it; run again,
    it goes on from its checkpoint."""
    with state_partitions(spark):
        q = (stream.writeStream.outputMode("append").format("parquet").option("path", f"{out_dir}/data")
             .option("checkpointLocation", f"{out_dir}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out_dir}/data")
