"""Keyed state in streams: revisions, quiet instruments, timers, restarts."""

import datetime as dt
import uuid

import pytest

from barflow.streaming import keyed, live

TICK = "epic string, updated_at timestamp, seq long, bid_open double, ask_open double, market_state string"


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 10, 0, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=minute, seconds=second)


@pytest.fixture
def folder(spark):
    return live.stream_dir(spark, "test-" + uuid.uuid4().hex[:6])


def add(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_bars_close_by_their_own_instrument_and_late_ticks_correct_them(spark, folder):
    def run():
        s = spark.readStream.schema(TICK).parquet(f"{folder}/ticks")
        t = keyed.run_table(spark, keyed.instrument_bars(s, "1 minute"), f"{folder}/out")
        key = lambda r: (r.epic, int((r.updated_at - at(0).replace(tzinfo=None)).total_seconds() // 60))
        return ({key(r): (r.seq, r.bid_open) for r in keyed.current_bars(t).collect()}, t.count())

    o = "TRADEABLE"
    add(spark, folder, "ticks", [("a", at(0, 10), 1, 1.0, 1.5, o), ("a", at(1, 10), 2, 2.0, 2.5, o), ("b", at(0, 30), 3, 9.0, 9.5, o),
                                 ("a", at(9), 4, 5.0, 5.5, "SUSPENDED"), ("a", None, 5, 5.0, 5.5, o), ("a", at(5), 6, None, 7.0, o)], TICK)
    # b's only bar is its newest; a's bar of minute 6 lacks a field and closes nothing
    assert run() == ({("a", 1): (1, 1.0)}, 1)
    add(spark, folder, "ticks", [("a", at(0, 50), 7, 1.25, None, o), ("a", at(0, 5), 8, 0.5, 0.5, o), ("b", at(3), 9, 8.0, 8.5, o)], TICK)
    assert run() == ({("a", 1): (7, 1.25), ("b", 1): (3, 9.0)}, 3)
    # nothing new, nothing written; a tick that changes no bar writes none either
    assert run()[1] == 3
    add(spark, folder, "ticks", [("a", at(0, 1), 10, 0.1, 0.1, o)], TICK)
    assert run() == ({("a", 1): (7, 1.25), ("b", 1): (3, 9.0)}, 3)


def test_exits_wait_for_their_bar_and_survive_restarts(spark, folder):
    pos, bar = "dealId string, epic string, buy_date timestamp, sell_date timestamp", "epic string, updated_at timestamp, bid_open double"

    def run(delay="10 minutes"):
        p = spark.readStream.schema(pos).parquet(f"{folder}/pos")
        b = spark.readStream.schema(bar).parquet(f"{folder}/bars")
        t = keyed.run_table(spark, keyed.exit_fills(p, b, delay, parts=3), f"{folder}/out")
        return sorted((r.dealId, r.close_level_responce) for r in t.collect())

    add(spark, folder, "pos", [("p1", "a", at(1), at(5)), ("p2", "a", at(2), at(6)), ("p3", "b", at(1), at(2)), ("p4", "a", at(1), None)], pos)
    add(spark, folder, "bars", [("a", at(4), 4.0), ("a", at(7), 7.0), ("b", at(1), 1.0)], bar)
    assert run() == []  # the watermark stands ten minutes behind: an earlier bar may still come
    add(spark, folder, "bars", [("a", at(5), 5.0), ("c", at(16), 0.0)], bar)
    add(spark, folder, "pos", [("p5", "a", at(6), at(7))], pos)
    assert run() == [("p1", 5.0)]
    add(spark, folder, "bars", [("c", at(30), 0.0), ("b", at(25), 25.0)], bar)
    assert run() == [("p1", 5.0), ("p2", 7.0), ("p5", 7.0)]
    add(spark, folder, "bars", [("c", at(60), 0.0)], bar)
    assert run() == [("p1", 5.0), ("p2", 7.0), ("p3", 25.0), ("p5", 7.0)]
    assert len(run()) == 4
