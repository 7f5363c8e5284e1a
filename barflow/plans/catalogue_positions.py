"""Catalogue: signals, positions, fills, reconciliation and P&L."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.scalar import strip_currency, thousands, ts_text
from barflow.operators import positions, series
from barflow.plans import fixtures
from barflow.plans.catalogue_bars import HOUR_TS
from barflow.plans.catalogue_models import BAR_MODEL_SQL, R_THRESHOLD, bar_model_predictions
from barflow.plans.registry import query, with_fixtures
from barflow.session import materialize

DAY_TS = "'%Y-%m-%d %H:%M:%S'"
MODEL_NAME, MODEL_VERSION = "knn-reg-model", "1"
SESSION_START, SESSION_END = "2024-01-02 00:00:00", "2024-01-29 00:00:00"
AS_OF = "1999-01-01 00:00:00"


def _r(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


@query("signals_to_positions", with_fixtures(f"""
    SELECT substr(sha256(concat_ws('|', epic, CAST(updated_at AS VARCHAR), '{MODEL_NAME}-v{MODEL_VERSION}')), 1, 32)
               AS dealId,
           '{MODEL_NAME}-v{MODEL_VERSION}' AS model_used, strftime(updated_at, {HOUR_TS}) AS buy_date,
           strftime(make_timestamp(CAST(round_even(epoch_us(updated_at) / 60000000.0, 0) AS BIGINT) * 60000000
                                   + 60000000), {HOUR_TS}) AS sell_date,
           level AS buy_level_responce, round(y_pred, 6) AS y_pred, round(y_pred * level, 4) AS y_pred_actual
    FROM preds
    WHERE y_pred > {R_THRESHOLD} AND updated_at > TIMESTAMP '{SESSION_START}' AND updated_at < TIMESTAMP '{SESSION_END}'
    """, "stream", extra=BAR_MODEL_SQL))
def signals_to_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored bars above the return threshold inside the session become
    position rows with an exit one bar-minute later (T7, T8, T9, F8, F12, P5, P7)."""
    scored = bar_model_predictions(spark, sf_dir)
    in_session = scored.filter((F.col("updated_at") > F.lit(SESSION_START).cast("timestamp"))
                               & (F.col("updated_at") < F.lit(SESSION_END).cast("timestamp")))
    pos = positions.signals_to_positions(in_session, R_THRESHOLD, MODEL_NAME, MODEL_VERSION, hold_minutes=1)
    return pos.select("dealId", "model_used", ts_text("buy_date").alias("buy_date"),
                      ts_text("sell_date").alias("sell_date"), "buy_level_responce", _r("y_pred").alias("y_pred"),
                      _r("y_pred_actual", 4).alias("y_pred_actual"))


@query("positions_due", with_fixtures(f"""
    SELECT dealId, model_used, strftime(sell_date, {DAY_TS}) AS sell_date FROM buys
    WHERE sell_date < TIMESTAMP '{AS_OF}' AND dealId NOT IN (SELECT dealId FROM sold)""", "buys", "sold"))
def positions_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions past their exit time without a close fill, as of a fixed
    instant (J5, T10, P7)."""
    due = positions.due_unsold(fixtures.buys(spark, sf_dir), fixtures.sold(spark, sf_dir),
                               F.lit(AS_OF).cast("timestamp"))
    return due.select("dealId", "model_used", ts_text("sell_date").alias("sell_date"))


@query("positions_open", with_fixtures("""
    SELECT b.dealId, b.model_used, b.buy_level_responce FROM buys b ANTI JOIN sold s USING (dealId)""",
                                       "buys", "sold"))
def positions_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opened minus closed: what the end-of-session close must sell."""
    o = positions.still_open(fixtures.buys(spark, sf_dir), fixtures.sold(spark, sf_dir))
    return o.select("dealId", "model_used", "buy_level_responce")


OUTCOMES_SQL = """
    outc AS (
      SELECT b.*, s.close_level_responce, s.close_date, s.close_level_responce / b.buy_level_responce AS y_true,
             CASE WHEN s.close_level_responce IS NULL THEN NULL
                  ELSE 1.0 * (s.close_level_responce - b.buy_level_responce) END AS profit_responce
      FROM buys b LEFT JOIN sold s USING (dealId))"""


@query("position_outcomes", with_fixtures("""
    SELECT dealId, round(y_true, 6) AS y_true, round(profit_responce, 2) AS profit_responce,
           CASE WHEN profit_responce IS NULL THEN NULL ELSE round(CAST(sum(CAST(profit_responce AS DECIMAL(28, 10)))
                OVER (ORDER BY buy_date, dealId ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE), 4)
           END AS profit_responce_cumsum
    FROM outc""", "buys", "sold", extra=OUTCOMES_SQL))
def position_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Realised return and profit per position with the running profit
    (J3, P5, P11, W5, T11, T12)."""
    o = positions.running_profit(positions.outcomes(fixtures.buys(spark, sf_dir), fixtures.sold(spark, sf_dir)))
    return o.select("dealId", _r("y_true").alias("y_true"), _r("profit_responce", 2).alias("profit_responce"),
                    _r("profit_responce_cumsum", 4).alias("profit_responce_cumsum"))


@query("monitor_positions", with_fixtures("""
    SELECT o.dealId, o.model_used, strftime(o.buy_date, '%Y-%m-%d %H:%M:%S') AS buy_date,
           round(o.y_true, 6) AS y_true, round(o.profit_responce, 2) AS profit_responce,
           coalesce(CAST(s.close_level_responce AS VARCHAR), 'None') AS close_level_text
    FROM outc o LEFT JOIN sold s USING (dealId)""", "buys", "sold", extra=OUTCOMES_SQL))
def monitor_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with their outcomes and fills for the dashboard; missing
    text shows as 'None' (J4, P13, T13)."""
    b, s = fixtures.buys(spark, sf_dir), fixtures.sold(spark, sf_dir)
    out = positions.outcomes(b, s).select("dealId", "y_true", "profit_responce")
    j = (b.join(out, "dealId", "left").join(s, "dealId", "left")
         .withColumn("close_level_text", F.col("close_level_responce").cast("string"))
         .na.fill("None", subset=["close_level_text"]))
    return j.select("dealId", "model_used", ts_text("buy_date").alias("buy_date"), _r("y_true").alias("y_true"),
                    _r("profit_responce", 2).alias("profit_responce"), "close_level_text")


SNAPSHOT_EVERY = 7  # every so many ticks, the feed sends one on the full hour


@query("monitor_ticks", with_fixtures(f"""
    SELECT r.epic, strftime(r.at, '%Y-%m-%d %H:%M:%S.%f') AS updated_at, r.seq,
           r.bid_open AS bid_open_raw_stream, r.ask_open AS ask_open_raw_stream,
           s.bid_open AS bid_open_stream, s.ask_open AS ask_open_stream
    FROM (SELECT *, CASE WHEN seq % {SNAPSHOT_EVERY} = 0 THEN date_trunc('hour', updated_at) ELSE updated_at END AS at
          FROM raw_stream) r
    LEFT JOIN stream s ON r.epic = s.epic AND r.at = s.updated_at""", "raw_stream", "stream"))
def monitor_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick next to the bar with exactly its timestamp."""
    full = F.date_trunc("hour", "updated_at").cast("timestamp")
    raw = fixtures.raw_stream(spark, sf_dir).withColumn(
        "updated_at", F.when(F.col("seq") % SNAPSHOT_EVERY == 0, full).otherwise(F.col("updated_at").cast("timestamp")))
    bars = fixtures.stream(spark, sf_dir)
    r = raw.select("epic", "updated_at", "seq", *[F.col(c).alias(f"{c}_raw_stream") for c in ("bid_open", "ask_open")])
    b = bars.select("epic", F.col("updated_at").cast("timestamp").alias("updated_at"),
                    *[F.col(c).alias(f"{c}_stream") for c in ("bid_open", "ask_open")])
    j = r.join(b, ["epic", "updated_at"], "left")
    return j.select("epic", ts_text("updated_at", micros=True).alias("updated_at"), "seq", "bid_open_raw_stream",
                    "ask_open_raw_stream", "bid_open_stream", "ask_open_stream")


TJ_SQL = """
    tj AS (
      SELECT t.reference AS closing_dealId, t.instrumentName, CAST(t.openLevel AS DOUBLE) AS openLevel,
             CAST(t.closeLevel AS DOUBLE) AS closeLevel,
             CAST(t.closeLevel AS DOUBLE) / CAST(t.openLevel AS DOUBLE) AS y_true, t.size,
             CAST(ltrim(t.profitAndLoss, '£') AS DOUBLE) AS profitAndLoss_numeric, t.currency,
             sa.date AS sell_date, ba.date AS buy_date, sa.affectedDealId AS opening_dealId, p.model_used, p.y_pred
      FROM (SELECT * FROM activity WHERE direction = 'SELL') sa
      JOIN (SELECT * FROM activity WHERE direction = 'BUY') ba ON sa.affectedDealId = ba.dealId
      JOIN transactions t ON t.reference = sa.dealId
      JOIN buys p ON p.dealId = sa.affectedDealId)"""


def transactions_joined_df(spark: SparkSession, sf_dir: str, sort: bool = True) -> DataFrame:
    """The reconciliation view: closed deals with their sell and buy activity
    and the position metrics of the opening deal (J1, J2, P1-P4, P6, F1, O1)."""
    t = (fixtures.transactions(spark, sf_dir)
         .drop("date", "period", "transactionType", "cashTransaction")
         .withColumnsRenamed({"reference": "closing_dealId"})
         .withColumns({"openLevel": F.col("openLevel").try_cast("double"),
                       "closeLevel": F.col("closeLevel").try_cast("double")}))
    t = t.withColumn("y_true", F.try_divide(F.col("closeLevel"), F.col("openLevel"))) \
         .withColumn("profitAndLoss_numeric", strip_currency("profitAndLoss"))
    act = fixtures.activity(spark, sf_dir)
    sell = act.filter(F.col("direction") == "SELL").select(
        F.col("date").alias("sell_date"), F.col("dealId").alias("closing_dealId"),
        F.col("affectedDealId").alias("opening_dealId"))
    buy = act.filter(F.col("direction") == "BUY").select(F.col("date").alias("buy_date"),
                                                         F.col("dealId").alias("opening_dealId"))
    pm = fixtures.buys(spark, sf_dir).select(F.col("dealId").alias("opening_dealId"), "model_used", "y_pred")
    j = sell.join(buy, "opening_dealId").join(t, "closing_dealId").join(pm, "opening_dealId")
    j = j.select("closing_dealId", "instrumentName", "openLevel", "closeLevel", "y_true", "size",
                    "profitAndLoss_numeric", "currency", "sell_date", "buy_date", "opening_dealId", "model_used",
                    "y_pred")
    return j.orderBy("sell_date", "closing_dealId") if sort else j


@query("transactions_joined", with_fixtures("""
    SELECT closing_dealId, instrumentName, openLevel, closeLevel, round(y_true, 6) AS y_true,
           profitAndLoss_numeric, strftime(sell_date, '%Y-%m-%d %H:%M:%S') AS sell_date,
           strftime(buy_date, '%Y-%m-%d %H:%M:%S') AS buy_date, opening_dealId, model_used, round(y_pred, 6) AS y_pred
    FROM tj""", "activity", "transactions", "buys", extra=TJ_SQL))
def transactions_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = transactions_joined_df(spark, sf_dir)
    return j.select("closing_dealId", "instrumentName", "openLevel", "closeLevel", _r("y_true").alias("y_true"),
                    "profitAndLoss_numeric", ts_text("sell_date").alias("sell_date"),
                    ts_text("buy_date").alias("buy_date"), "opening_dealId", "model_used", _r("y_pred").alias("y_pred"))


@query("profit_by_model", with_fixtures("""
    SELECT model_used, closing_dealId, strftime(sell_date, '%Y-%m-%d %H:%M:%S') AS sell_date,
           CAST(sum(CAST(profitAndLoss_numeric AS DECIMAL(20, 2))) OVER (PARTITION BY model_used
               ORDER BY sell_date, closing_dealId ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
               AS running_pnl,
           CAST(sum(CAST(profitAndLoss_numeric AS DECIMAL(20, 2))) OVER (PARTITION BY model_used) AS DOUBLE) AS total_pnl,
           format('{:,}', count(*) OVER (PARTITION BY model_used)) AS n_deals
    FROM tj""", "activity", "transactions", "buys", extra=TJ_SQL))
def profit_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running and total P&L per model with the deal count in thousands
    format (A2, W5, F13)."""
    # the reconciled rows feed the index, the sums and the totals: joined once
    j = materialize(transactions_joined_df(spark, sf_dir, sort=False).select(
        "model_used", "closing_dealId", "sell_date", F.col("profitAndLoss_numeric").cast("decimal(20,2)").alias("_pnl")))
    run = series.running_sum(j, ["model_used"], ["sell_date", "closing_dealId"], "_pnl", "running_pnl")
    tot = j.groupBy("model_used").agg(F.sum("_pnl").cast("double").alias("total_pnl"),
                                      thousands(F.count(F.lit(1))).alias("n_deals"))
    return series.null_safe_join(run, tot, ["model_used"]).select(
        "model_used", "closing_dealId", ts_text("sell_date").alias("sell_date"),
        F.col("running_pnl").cast("double").alias("running_pnl"), "total_pnl", "n_deals")


@query("net_size_by_epic", with_fixtures("""
    SELECT epic, sum(CASE WHEN direction = 'SELL' THEN -size ELSE size END) AS net_size
    FROM open_positions GROUP BY epic""", "open_positions"))
def net_size_by_epic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net signed size held per instrument."""
    return positions.net_size(fixtures.open_positions(spark, sf_dir))


@query("position_change_needed", with_fixtures("""
    SELECT epic, net_size, round(forecast, 4) AS forecast, last,
           round((forecast - last) / 50.0 - net_size, 2) AS change,
           CASE WHEN round((forecast - last) / 50.0 - net_size, 2) > 0 THEN 'BUY'
                WHEN round((forecast - last) / 50.0 - net_size, 2) < 0 THEN 'SELL' ELSE 'NONE' END AS action
    FROM (SELECT epic, sum(CASE WHEN direction = 'SELL' THEN -size ELSE size END) AS net_size,
                 avg(l_extendedprice / size) AS forecast,
                 arg_max(l_extendedprice / size, (l_shipdate, l_orderkey, l_linenumber)) AS last
          FROM open_positions GROUP BY epic)""", "open_positions"))
def position_change_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size wanted from a forecast against the last price, minus the size
    held, and the order side (F18, A1, P11)."""
    from barflow.sources.tables import read_table
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                                "l_extendedprice", "l_shipdate"])
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    fc = (li.withColumn("epic", F.concat(F.lit("EPIC"), (F.col("l_partkey") % 5).cast("string")))
          .groupBy("epic").agg(F.avg(unit).alias("forecast"),
                               F.max_by(unit, F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("last")))
    ch = positions.change_needed(positions.net_size(fixtures.open_positions(spark, sf_dir)), fc)
    return ch.select("epic", "net_size", _r("forecast", 4).alias("forecast"), "last",
                     "change", "action")


@query("latest_activity", with_fixtures("""
    SELECT strftime(date, '%Y-%m-%d %H:%M:%S') AS date, dealId, affectedDealId, epic, level
    FROM activity WHERE direction = 'SELL' ORDER BY date DESC, dealId DESC LIMIT 5""", "activity"))
def latest_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most recent closing activities (O2, P6); a top-k report."""
    a = fixtures.activity(spark, sf_dir).filter(F.col("direction") == "SELL")
    top = a.orderBy(F.col("date").desc(), F.col("dealId").desc()).limit(5)
    return top.select(ts_text("date").alias("date"), "dealId", "affectedDealId", "epic", "level")



PAPER_SQL = f"""
    pos AS (
      SELECT substr(sha256(concat_ws('|', epic, CAST(updated_at AS VARCHAR), '{MODEL_NAME}-v{MODEL_VERSION}')), 1, 32)
                 AS dealId, epic, updated_at AS buy_date,
             make_timestamp(CAST(round_even(epoch_us(updated_at) / 60000000.0, 0) AS BIGINT) * 60000000 + 60000000)
                 AS sell_date,
             level AS buy_level_responce
      FROM preds
      WHERE y_pred > {R_THRESHOLD}),
    fill AS (SELECT p.dealId, s.updated_at AS close_date, s.bid_open AS close_level_responce
             FROM pos p ASOF JOIN stream s ON p.epic = s.epic AND p.sell_date <= s.updated_at)"""


@query("paper_fill_outcomes", with_fixtures(f"""
    SELECT p.dealId, p.epic, strftime(f.close_date, {HOUR_TS}) AS close_date, f.close_level_responce,
           round(f.close_level_responce / p.buy_level_responce, 6) AS y_true,
           round(f.close_level_responce - p.buy_level_responce, 2) AS profit_responce
    FROM pos p LEFT JOIN fill f USING (dealId)""", "stream", extra=BAR_MODEL_SQL + "," + PAPER_SQL))
def paper_fill_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions from the scored bars closed on paper at the first bar at or
    after their exit time (a forward as-of join), with return and profit
    (T8, T9, T11, T12)."""
    scored = bar_model_predictions(spark, sf_dir)
    pos = positions.signals_to_positions(scored, R_THRESHOLD, MODEL_NAME, MODEL_VERSION, hold_minutes=1)
    fills = positions.paper_fills(pos, fixtures.stream(spark, sf_dir))
    out = positions.outcomes(pos, fills)  # the left join keeps the fill's close_date
    return out.select("dealId", "epic", ts_text("close_date").alias("close_date"), "close_level_responce",
                      _r("y_true").alias("y_true"), _r("profit_responce", 2).alias("profit_responce"))


MAX_CLOSENESS = 0.5


@query("signals_near_enough", with_fixtures(f"""
    SELECT substr(sha256(concat_ws('|', epic, CAST(updated_at AS VARCHAR), '{MODEL_NAME}-v{MODEL_VERSION}')), 1, 32)
               AS dealId, epic, strftime(updated_at, {HOUR_TS}) AS buy_date, round(y_pred, 6) AS y_pred,
           round(closeness, 6) AS closeness
    FROM preds
    WHERE y_pred > {R_THRESHOLD} AND closeness <= {MAX_CLOSENESS}""",
                                            "stream", extra=BAR_MODEL_SQL))
def signals_near_enough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions only where the forecast's neighbours are near enough -- the
    reference's planned distance filter before buying (M5 + T8)."""
    scored = bar_model_predictions(spark, sf_dir)
    pos = positions.signals_to_positions(scored, R_THRESHOLD, MODEL_NAME, MODEL_VERSION, hold_minutes=1,
                                         max_closeness=MAX_CLOSENESS, keep_cols=["closeness"])
    return pos.select(
        "dealId", "epic", ts_text("buy_date").alias("buy_date"), _r("y_pred").alias("y_pred"),
        _r("closeness").alias("closeness"))
