"""Streaming bars equal the batch bars minus open ones; restarts add nothing;
the live loop's tables equal the batch operators on all bars."""

import tempfile

from pyspark.sql import functions as F

from barflow.jobs import ROW_KEY, training_matrix
from barflow.operators import bars, knn, positions
from barflow.plans import fixtures
from barflow.streaming import live

from conftest import SF_SMALL


def test_stream_bars_match_batch_and_restart_is_idempotent(spark):
    out = tempfile.mkdtemp(prefix="barflow-stream-")
    ticks = lambda: fixtures.tick_stream(spark, SF_SMALL)
    path = live.run_bars(spark, ticks(), "1 hour", out_dir=out)
    streamed = spark.read.parquet(path)
    n1 = streamed.count()
    batch_all = bars.last_bars(bars.market_open(fixtures.raw_stream(spark, SF_SMALL)), "1 hour",
                               drop_incomplete=False)
    # Every streamed bar is a batch bar with the same values.
    assert streamed.select("epic", "updated_at", "bid_open", "ask_open") \
        .exceptAll(batch_all.select("epic", "updated_at", "bid_open", "ask_open")).count() == 0
    # Only bars still open at the global watermark are missing.
    newest = batch_all.agg(F.max("updated_at")).first()[0]
    missing = batch_all.join(streamed.select("epic", "updated_at"), ["epic", "updated_at"], "left_anti")
    assert missing.filter(F.col("updated_at") < newest).count() == 0
    live.run_bars(spark, ticks(), "1 hour", out_dir=out)  # restart from the checkpoint
    assert spark.read.parquet(path).count() == n1


def test_update_stream_parse_equals_batch(spark):
    """S10/T16 as a real stream: the same parse over readStream."""
    from barflow.plans.catalogue_misc import opu_documents, parse_updates, updates_parsed
    parsed = parse_updates(opu_documents(fixtures.event_stream(spark, SF_SMALL)))
    q = parsed.writeStream.format("memory").queryName("opu_stream").outputMode("append") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    streamed = spark.table("opu_stream")
    batch = updates_parsed(spark, SF_SMALL)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def _models(spark, **more):
    rows = training_matrix(fixtures.stream(spark, SF_SMALL), 3)
    fitted = knn.save(knn.fit(rows.filter(F.col("split") == "train"), ROW_KEY, y="y_true"), tempfile.mkdtemp(prefix="bf-model-"))
    return [dict(model_name="m", model_version=v, k=k, r_threshold=0.9, fitted=fitted, **more) for v, k in ((1, 3), (2, 5))]


def _bars(spark):
    return fixtures.stream(spark, SF_SMALL).select("epic", "updated_at", "seq", "bid_open", "ask_open")


def test_epochs_equal_one_and_the_batch_operators(spark):
    """Whatever the cut into micro-batches, also with a batch run twice, the
    written tables are the same, and equal the batch operators on all bars."""
    models, b = _models(spark), _bars(spark)
    cuts = b.selectExpr("percentile(unix_seconds(updated_at), array(0.3, 0.6)) AS c").first()[0]
    t = F.unix_seconds("updated_at")
    parts = [b.filter(t <= cuts[0]), b.filter((t > cuts[0]) & (t <= cuts[1])), b.filter(t > cuts[1])]
    one, many = tempfile.mkdtemp(prefix="bf-one-"), tempfile.mkdtemp(prefix="bf-many-")
    live.process_signal_batch(spark, b, 0, one, models, 3, 90)
    for epoch, part in ((0, parts[0]), (1, parts[1]), (1, parts[1]), (2, parts[2])):
        live.process_signal_batch(spark, part, epoch, many, models, 3, 90)
    for name in ("positions", "sold", "outcomes", "bars"):
        x, y = (spark.read.parquet(f"{d}/{name}").drop("epoch") for d in (one, many))
        assert x.count() > 0 and x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
    still = [spark.read.parquet(f"{d}/open/epoch={e}") for d, e in ((one, 0), (many, 2))]
    assert still[0].exceptAll(still[1]).count() == 0 and still[1].exceptAll(still[0]).count() == 0
    opened = spark.read.parquet(f"{one}/positions").drop("epoch")
    want = positions.outcomes(opened, positions.paper_fills(opened, b))
    table = live.monitoring_tables(spark, many)["positions"].select(want.columns)
    assert want.exceptAll(table).count() == 0 and table.exceptAll(want).count() == 0
    assert still[0].count() == want.filter("close_date IS NULL").count() > 0


def test_signals_end_to_end_one_instrument_per_model(spark):
    models, out = _models(spark), tempfile.mkdtemp(prefix="bf-live-")
    epic = fixtures.raw_stream(spark, SF_SMALL).select(F.min("epic")).first()[0]
    models[1]["instrument"] = epic
    path = live.run_ticks(spark, fixtures.tick_stream(spark, SF_SMALL), out)
    kept = spark.read.parquet(path)
    assert kept.drop("market_open").exceptAll(fixtures.raw_stream(spark, SF_SMALL).select(kept.drop("market_open").columns)).count() == 0
    assert kept.count() == fixtures.raw_stream(spark, SF_SMALL).count()
    assert kept.filter("NOT market_open").count() == bars.market_closed(fixtures.raw_stream(spark, SF_SMALL)).count() > 0
    assert live.run_signals(spark, fixtures.tick_stream(spark, SF_SMALL), models, out_dir=out, delay="10 minutes") == out
    got = {(r.model_used, r.epic) for r in spark.read.parquet(f"{out}/positions").collect()}
    assert {m for m, _ in got} == {"m-v1", "m-v2"} and {e for m, e in got if m == "m-v2"} == {epic}
    assert len({e for m, e in got if m == "m-v1"}) > 1
    assert live.monitoring_tables(spark, out)["ticks"].count() == kept.count()


def test_items_parse_the_same_in_batch_and_stream(spark):
    from barflow.plans.catalogue_misc import price_items
    folder = tempfile.mkdtemp(prefix="bf-items-")
    price_items(spark, SF_SMALL).write.mode("overwrite").text(f"{folder}/in")
    stream = live.ticks_from_items(spark.readStream.text(f"{folder}/in"), "value")
    q = stream.writeStream.format("memory").queryName("items").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = live.ticks_from_items(price_items(spark, SF_SMALL))
    got = spark.table("items")
    assert batch.count() > 0 and got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_late_ticks_are_kept_within_the_delay(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1, 10)
    rows = [("a", base + dt.timedelta(minutes=m), i, 1.0 + i, 2.0 + i, "TRADEABLE")
            for i, m in enumerate((1, 61, 125, 59, 190, 250))]  # the fourth comes late
    names = "epic string, updated_at timestamp, seq long, bid_open double, ask_open double, market_state string"
    folder = tempfile.mkdtemp(prefix="bf-late-")
    for r in rows:  # one file per tick, in order of arrival
        spark.createDataFrame([r], names).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    for delay, want in (("0 seconds", 0), ("2 hours", 3)):
        ticks = spark.readStream.schema(names).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        out = spark.read.parquet(live.run_bars(spark, ticks, "1 hour", delay=delay))
        first = out.filter(F.col("updated_at") == F.lit(base + dt.timedelta(hours=1))).first()
        assert first.seq == want


def test_latest_price_stream_equals_batch(spark):
    q = live.run_latest_prices(spark, fixtures.tick_stream(spark, SF_SMALL), "latest_px")
    streamed = spark.table("latest_px")
    batch = bars.latest_prices(bars.market_open(fixtures.raw_stream(spark, SF_SMALL)))
    assert streamed.count() == batch.count() == 5
    assert streamed.exceptAll(batch).count() == 0
    assert q.lastProgress is not None


def test_a_partial_update_keeps_the_other_field(spark):
    rows = [("a", 1, 1, 1.0, 2.0), ("a", 2, 2, None, 2.5), ("a", 3, 3, 1.5, None), ("b", 1, 4, None, None)]
    t = spark.createDataFrame(rows, "epic string, t long, seq long, bid_open double, ask_open double") \
        .withColumn("updated_at", F.timestamp_seconds("t")).drop("t")
    got = {r.epic: (r.seq, r.bid_open, r.ask_open) for r in bars.latest_prices(t).collect()}
    assert got == {"a": (3, 1.5, 2.5), "b": (4, None, None)}


def test_a_replayed_feed_adds_no_update(spark):
    folder = tempfile.mkdtemp(prefix="bf-feed-")
    names = "dealId string, timestamp timestamp, status string"
    day = spark.range(40).selectExpr("concat('d', id % 8) AS dealId", "timestamp_seconds(1700000000 + id * 60) AS timestamp",
                                     "'OPEN' AS status")
    for _ in range(2):  # the second file repeats the first after a reconnect
        day.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    feed = spark.readStream.schema(names).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    q = live.distinct_updates(feed).writeStream.format("memory").queryName("feed").outputMode("append") \
        .option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    got, batch = spark.table("feed"), live.distinct_updates(spark.read.schema(names).parquet(f"{folder}/in"))
    assert len(sorted(got.collect())) == 40 and sorted(got.collect()) == sorted(batch.collect())
