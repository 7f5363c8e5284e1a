"""Explicit schemas and enum domains of the market-data tables."""

from pyspark.sql import types as T

# Enum domains of the documented schema (as documented).
DEAL_STATUS = ["ACCEPTED", "DECLINED"]
ACTION_STATUS = ["ACCEPTED", "REJECTED", "UNKNOWN"]
STATUS = ["AMENDED", "DELETED", "FULLY_CLOSED", "UPDATED", "OPENED", "PARTIALLY_CLOSED"]
DIRECTION = ["BUY", "SELL"]
CHANNEL = ["DEALER", "MOBILE", "pub_FIX_API", "pub_WEB_API", "SYSTEM", "WEB"]
MARKET_STATE = ["CLOSED", "OFFLINE", "TRADEABLE", "EDIT", "AUCTION", "AUCTION_NO_EDIT", "SUSPENDED"]
ACTIVITY_TYPE = ["EDIT_STOP_AND_LIMIT", "POSITION", "SYSTEM", "WORKING_ORDER"]

RAW_STREAM = T.StructType([
    T.StructField("epic", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("bid_open", T.DoubleType()),
    T.StructField("ask_open", T.DoubleType()),
    T.StructField("market_state", T.StringType()),
])

PRICE_ITEM = T.StructType([
    T.StructField("epic", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("trade_date", T.StringType()),
    T.StructField("values", T.StructType([
        T.StructField("UPDATE_TIME", T.StringType()),
        T.StructField("BID", T.DoubleType()),
        T.StructField("OFFER", T.DoubleType()),
        T.StructField("MARKET_STATE", T.StringType()),
    ])),
])

POSITION_METRICS = T.StructType([
    T.StructField("dealId", T.StringType()),
    T.StructField("model_used", T.StringType()),
    T.StructField("buy_date", T.TimestampType()),
    T.StructField("sell_date", T.TimestampType()),
    T.StructField("buy_level_responce", T.DoubleType()),
    T.StructField("y_pred", T.DoubleType()),
    T.StructField("y_pred_actual", T.DoubleType()),
])

SOLD = T.StructType([
    T.StructField("dealId", T.StringType()),
    T.StructField("close_level_responce", T.DoubleType()),
])

POSITION_OUTCOMES = T.StructType([
    T.StructField("dealId", T.StringType()),
    T.StructField("y_true", T.DoubleType()),
    T.StructField("profit_responce", T.DoubleType()),
])

OPU = T.StructType([
    T.StructField("dealId", T.StringType()),
    T.StructField("dealIdOrigin", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("epic", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("dealStatus", T.StringType()),
    T.StructField("level", T.DoubleType()),
    T.StructField("size", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])
