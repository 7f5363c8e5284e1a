"""Market-data views derived from the driver's tables.

The reference's inputs (price ticks, positions, fills, macro series...) are
not shipped, so each is derived from the TPC-H-like tables by a projection or
a small aggregation. The same definitions exist as SQL in
:mod:`barflow.plans.registry` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions import scalar
from barflow.operators import bars
from barflow.sources.tables import read_table

# The fixture parameters.
BAR_WIDTH = "1 hour"
HISTORY_OFFSET = "-05:00"
HOLD_MINUTES = 1
SHEET_HEADER_ROWS = 3


def raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks: epic = event_type, one tick per event; ask = bid + 0.5;
    every tenth ``k`` marks the market as suspended."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value", "props"])
    k = F.expr("try_cast(get_json_object(props, '$.k') AS INT)")
    return ev.select(
        F.col("event_type").alias("epic"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("bid_open"),
        (F.col("value") + F.lit(0.5)).alias("ask_open"),
        F.when(k % 10 == 0, F.lit("SUSPENDED")).otherwise(F.lit("TRADEABLE")).alias("market_state"),
    )


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the tradeable ticks (``BAR_WIDTH``), newest incomplete bar removed."""
    ticks = bars.market_open(raw_stream(spark, sf_dir))
    return bars.last_bars(ticks, BAR_WIDTH)


def history_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote-service history: text timestamps with a zone suffix, one ``open``."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    return ev.select(
        F.col("event_type").alias("instrument"),
        F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                 F.lit(HISTORY_OFFSET)).alias("datetime"),
        F.col("value").alias("open"),
        F.col("event_id").alias("seq"),
    )


def history_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker history: two-level columns as structs ``ask.Open``, ``bid.Open``."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    return ev.select(
        F.col("event_type").alias("epic"),
        F.col("ts").cast("timestamp").alias("DateTime"),
        F.col("event_id").alias("seq"),
        F.struct((F.col("value") + 0.5).alias("Open"), (F.col("value") + 0.75).alias("Close")).alias("ask"),
        F.struct(F.col("value").alias("Open"), (F.col("value") + 0.25).alias("Close")).alias("bid"),
    )


def buys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``position_metrics``: one opened position per order."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    buy_date = F.col("o_orderdate").cast("timestamp")
    y_pred = F.lit(1.0) + ((F.col("o_custkey") % 100) - 50).cast("double") / F.lit(1000.0)
    return o.select(
        F.col("o_orderkey").cast("string").alias("dealId"),
        F.col("o_orderpriority").alias("model_used"),
        buy_date.alias("buy_date"),
        scalar.round_to_minute_plus(buy_date, HOLD_MINUTES).alias("sell_date"),
        F.col("o_totalprice").alias("buy_level_responce"),
        y_pred.alias("y_pred"),
        (y_pred * F.col("o_totalprice")).alias("y_pred_actual"),
    )


def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Close fills: one per order with lines, the level of its latest line."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate"])
    latest = F.max_by("l_extendedprice",
                      F.struct("l_shipdate", "l_partkey", "l_linenumber", "l_extendedprice"))
    return (li.groupBy("l_orderkey")
            .agg(latest.alias("close_level_responce"),
                 F.max(F.col("l_shipdate").cast("timestamp")).alias("close_date"))
            .select(F.col("l_orderkey").cast("string").alias("dealId"), "close_level_responce", "close_date"))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account activity: BUY rows for opened positions, SELL rows for closes."""
    b = buys(spark, sf_dir)
    s = sold(spark, sf_dir)
    buy_rows = b.select(
        F.col("buy_date").alias("date"), "dealId", F.col("dealId").alias("affectedDealId"),
        F.lit("BUY").alias("direction"), F.col("model_used").alias("epic"),
        F.col("buy_level_responce").alias("level"))
    sell_rows = s.join(b.select("dealId", "model_used"), "dealId", "left").select(
        F.col("close_date").alias("date"), F.concat(F.lit("S"), F.col("dealId")).alias("dealId"),
        F.col("dealId").alias("affectedDealId"), F.lit("SELL").alias("direction"),
        F.col("model_used").alias("epic"), F.col("close_level_responce").alias("level"))
    return buy_rows.unionByName(sell_rows)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-deal history as the broker reports it: levels as text, P&L as '£' text."""
    b = buys(spark, sf_dir)
    s = sold(spark, sf_dir)
    j = s.join(b, "dealId")
    pnl = F.round(F.col("close_level_responce") - F.col("buy_level_responce"), 2)
    return j.select(
        F.concat(F.lit("S"), F.col("dealId")).alias("reference"),
        F.col("model_used").alias("instrumentName"),
        F.col("buy_level_responce").cast("string").alias("openLevel"),
        F.col("close_level_responce").cast("string").alias("closeLevel"),
        F.lit(1.0).alias("size"),
        F.concat(F.lit("£"), pnl.cast("string")).alias("profitAndLoss"),
        F.lit("GBP").alias("currency"),
        F.col("close_date").alias("date"),
        F.lit("-").alias("period"),
        F.lit("DEAL").alias("transactionType"),
        F.lit(False).alias("cashTransaction"),
    )


def open_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag"])
    return li.select(
        F.concat(F.lit("EPIC"), (F.col("l_partkey") % 5).cast("string")).alias("epic"),
        F.when(F.col("l_returnflag") == "R", F.lit("SELL")).otherwise(F.lit("BUY")).alias("direction"),
        F.col("l_quantity").alias("size"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string")).alias("dealId"),
    )


def base_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderdate", "o_totalprice"])
    return (o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("date_changed"))
            .agg((F.avg("o_totalprice") / F.lit(100000.0)).alias("rate")))


def inflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_shipdate", "l_extendedprice"])
    return (li.groupBy(F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("period"))
            .agg((F.avg("l_extendedprice") / F.lit(10000.0)).alias("value")))


def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderdate", "o_totalprice", "o_orderpriority"])
    return (o.groupBy(F.col("o_orderpriority").alias("Name"),
                      F.col("o_orderdate").cast("date").alias("Date"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("Open"),
                 F.max("o_totalprice").alias("Close")))


def company_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_name", "p_brand"])
    return p.select(F.col("p_brand").alias("Symbol"), F.col("p_name").alias("Name"))


def inflation_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed spreadsheet: three title rows and one units row, then
    (period, source, inflation text with '[No data]' gaps)."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_size", "p_retailprice"])
    text = F.when(F.col("p_size") % 7 == 0, F.lit("[No data]")).otherwise(F.col("p_retailprice").cast("string"))
    body = p.select(
        (F.col("p_partkey") + SHEET_HEADER_ROWS + 1).alias("source_row"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("c0"),
        F.col("p_size").cast("string").alias("c1"),
        text.alias("c2"),
    )
    header = spark.createDataFrame(
        [(0, "Inflation", None, None), (1, "Source: landed sheet", None, None), (2, None, None, None),
         (3, "Period", "Source", "Inflation")],
        "source_row long, c0 string, c1 string, c2 string")
    return header.unionByName(body)


EVENTS_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table as a file stream."""
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(sf_dir)


def tick_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Ticks of the event stream, as :func:`raw_stream` has them; the time is an instant, for the watermark."""
    k = F.expr("try_cast(get_json_object(props, '$.k') AS INT)")
    return event_stream(spark, sf_dir, max_files_per_trigger).select(
        F.col("event_type").alias("epic"), F.col("ts").cast("timestamp").alias("updated_at"),
        F.col("event_id").alias("seq"), F.col("value").alias("bid_open"), (F.col("value") + 0.5).alias("ask_open"),
        F.when(k % 10 == 0, F.lit("SUSPENDED")).otherwise(F.lit("TRADEABLE")).alias("market_state"))
