"""Signals, positions, fills and profit.

Joins are keyed on deal ids (a primary key), so plain equality joins are
exact; adaptive execution picks broadcast or sort-merge from measured sizes
and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions import scalar
from barflow.operators import series


def signals_to_positions(scored: DataFrame, r_threshold: float, model_name: str | Column,
                         model_version: str | Column, hold_minutes: int, time_col: str = "updated_at",
                         level_col: str = "level", pred_col: str = "y_pred", key_cols=("epic",),
                         max_closeness: float | None = None, closeness_col: str = "closeness",
                         keep_cols: Sequence[str] = ()) -> DataFrame:
    """T8 + T9 + F8 + F12 + P5: forecasts above the threshold become
    position rows; ``dealId`` is a deterministic hash of (instrument, bar, model).
    ``max_closeness`` trades only when the neighbours are near enough (sum of
    their distances at most this). ``keep_cols`` pass through unchanged."""
    label = scalar.model_label(F.lit(model_name) if isinstance(model_name, str) else model_name,
                               F.lit(model_version) if isinstance(model_version, str) else model_version)
    chosen = scored.filter(F.col(pred_col) > F.lit(r_threshold))
    if max_closeness is not None:
        chosen = chosen.filter(F.col(closeness_col) <= F.lit(max_closeness))
    deal = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols],
                              F.col(time_col).cast("string"), label), 256).substr(1, 32)
    return chosen.select(
        deal.alias("dealId"), *key_cols, label.alias("model_used"), F.col(time_col).alias("buy_date"),
        scalar.round_to_minute_plus(F.col(time_col), hold_minutes).alias("sell_date"),
        F.col(level_col).alias("buy_level_responce"), F.col(pred_col).alias("y_pred"),
        (F.col(pred_col) * F.col(level_col)).alias("y_pred_actual"), *keep_cols)


def due_unsold(positions: DataFrame, sold: DataFrame, as_of: Column) -> DataFrame:
    """T10 + J5: positions whose exit time has passed and that have no fill."""
    due = positions.filter(F.col("sell_date") < as_of)
    return due.join(sold.select("dealId"), "dealId", "left_anti")


def still_open(positions: DataFrame, sold: DataFrame) -> DataFrame:
    """J10 + T15: opened minus closed."""
    return positions.join(sold.select("dealId"), "dealId", "left_anti")


def outcomes(positions: DataFrame, sold: DataFrame, size: Column | float = 1.0) -> DataFrame:
    """T12 + J3 + P5 + P11: realised return and profit per unit (``size``
    default 1, as live); null without a fill."""
    j = positions.join(sold, "dealId", "left")
    size_c = size if isinstance(size, Column) else F.lit(size)
    return (j.withColumn("y_true", F.try_divide(F.col("close_level_responce"), F.col("buy_level_responce")))
            .withColumn("profit_responce",
                        F.when(F.col("close_level_responce").isNull(), F.lit(None).cast("double"))
                        .otherwise(size_c * (F.col("close_level_responce") - F.col("buy_level_responce")))))


def running_profit(outcome_rows: DataFrame, order=("buy_date", "dealId"), scale: int = 10) -> DataFrame:
    """The running profit of :func:`outcomes`, nulls skipped in place.

    Profits are summed as decimals of ``scale`` places: exact and independent of
    the order of partial sums. One global running total: the row index and
    block prefix sums keep it distributed although there is no grouping key."""
    j = (outcome_rows.withColumn("_all", F.lit(0)).withColumn("_t", F.col(order[0]).cast("timestamp"))
         .withColumn("_money", F.col("profit_responce").cast(f"decimal(28,{scale})")))
    out = series.running_sum(j, ["_all"], ["_t", *order[1:]], "_money", "profit_responce_cumsum")
    return (out.withColumn("profit_responce_cumsum", F.col("profit_responce_cumsum").cast("double"))
            .drop("_all", "_t", "_money"))


def net_size(open_positions: DataFrame) -> DataFrame:
    """A1: signed size per instrument (SELL counts negative)."""
    signed = F.when(F.col("direction") == "SELL", -F.col("size")).otherwise(F.col("size"))
    return open_positions.groupBy("epic").agg(F.sum(signed).alias("net_size"))


def change_needed(net: DataFrame, forecasts: DataFrame, per_unit: float = 50.0) -> DataFrame:
    """F18 + P11: wanted size ``(forecast - last) / per_unit`` minus the size
    held, rounded to hundredths, and the order side that closes that gap."""
    j = net.join(forecasts, "epic")
    change = F.round((F.col("forecast") - F.col("last")) / F.lit(per_unit) - F.col("net_size"), 2)
    return j.withColumn("change", change).withColumn(
        "action", F.when(F.col("change") > 0, F.lit("BUY")).when(F.col("change") < 0, F.lit("SELL"))
        .otherwise(F.lit("NONE")))


def paper_fills(positions: DataFrame, bars: DataFrame, level_col: str = "bid_open", key_cols=("epic",),
                bucket_seconds: int = 86_400) -> DataFrame:
    """T11 (paper form): close each position at the first bar at or after its
    ``sell_date`` (selling at that bar's bid) -> ``(dealId, close_date,
    close_level_responce)``; positions with no later bar get no fill."""
    from barflow.operators.asof import asof_forward
    hit = asof_forward(positions.select("dealId", *key_cols, "sell_date"), bars, list(key_cols), "sell_date",
                       "updated_at", [level_col], left_id="dealId", bucket_seconds=bucket_seconds, prefix="_f_")
    return hit.filter(F.col("_f_updated_at").isNotNull()).select(
        "dealId", F.col("_f_updated_at").alias("close_date"), F.col(f"_f_{level_col}").alias("close_level_responce"))
