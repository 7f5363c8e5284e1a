"""Named catalogue queries: Spark builder + equivalent DuckDB SQL.

``@query(name, sql)`` registers a function ``(spark, sf_dir) -> DataFrame``.
``sql`` is the oracle (DuckDB dialect, over the raw tables); ``None`` marks a
query that SQL cannot express (checked by tests against a brute-force
fixture instead).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

# Fixture views in DuckDB SQL: name -> (dependencies, body). Mirrors
# barflow.plans.fixtures.
FIXTURE_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_stream": ((), """
        SELECT event_type AS epic, ts AS updated_at, event_id AS seq, value AS bid_open,
               value + 0.5 AS ask_open,
               CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0
                    THEN 'SUSPENDED' ELSE 'TRADEABLE' END AS market_state
        FROM events"""),
    "ticks": (("raw_stream",), "SELECT * FROM raw_stream WHERE market_state = 'TRADEABLE'"),
    "bars_all": (("ticks",), """
        SELECT * FROM (
          SELECT epic, date_trunc('hour', updated_at) + INTERVAL 1 HOUR AS updated_at,
                 arg_max(seq, (updated_at, seq)) AS seq,
                 arg_max(bid_open, (updated_at, seq)) FILTER (WHERE bid_open IS NOT NULL) AS bid_open,
                 arg_max(ask_open, (updated_at, seq)) FILTER (WHERE ask_open IS NOT NULL) AS ask_open
          FROM ticks GROUP BY epic, date_trunc('hour', updated_at))
        WHERE bid_open IS NOT NULL AND ask_open IS NOT NULL"""),
    "stream": (("bars_all",), """
        SELECT b.* FROM bars_all b
        JOIN (SELECT epic, max(updated_at) AS newest FROM bars_all GROUP BY epic) m USING (epic)
        WHERE b.updated_at < m.newest"""),
    "history_simple": ((), """
        SELECT event_type AS instrument, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '-05:00' AS datetime,
               value AS open, event_id AS seq, ts AS wall_ts
        FROM events"""),
    "buys": ((), """
        SELECT CAST(o_orderkey AS VARCHAR) AS dealId, o_orderpriority AS model_used,
               o_orderdate AS buy_date,
               make_timestamp(CAST(round_even(epoch_us(o_orderdate) / 60000000.0, 0) AS BIGINT) * 60000000
                              + 60000000) AS sell_date,
               o_totalprice AS buy_level_responce,
               1.0 + CAST((o_custkey % 100) - 50 AS DOUBLE) / 1000.0 AS y_pred,
               (1.0 + CAST((o_custkey % 100) - 50 AS DOUBLE) / 1000.0) * o_totalprice AS y_pred_actual
        FROM orders"""),
    "sold": ((), """
        SELECT CAST(l_orderkey AS VARCHAR) AS dealId,
               arg_max(l_extendedprice, (l_shipdate, l_partkey, l_linenumber, l_extendedprice))
                   AS close_level_responce,
               max(l_shipdate) AS close_date
        FROM lineitem GROUP BY l_orderkey"""),
    "activity": (("buys", "sold"), """
        SELECT buy_date AS date, dealId, dealId AS affectedDealId, 'BUY' AS direction,
               model_used AS epic, buy_level_responce AS level FROM buys
        UNION ALL
        SELECT s.close_date, 'S' || s.dealId, s.dealId, 'SELL', b.model_used, s.close_level_responce
        FROM sold s LEFT JOIN buys b USING (dealId)"""),
    "transactions": (("buys", "sold"), """
        SELECT 'S' || dealId AS reference, model_used AS instrumentName,
               CAST(buy_level_responce AS VARCHAR) AS openLevel,
               CAST(close_level_responce AS VARCHAR) AS closeLevel, 1.0 AS size,
               '£' || CAST(round(close_level_responce - buy_level_responce, 2) AS VARCHAR) AS profitAndLoss,
               'GBP' AS currency, close_date AS date
        FROM sold JOIN buys USING (dealId)"""),
    "open_positions": ((), """
        SELECT 'EPIC' || CAST(l_partkey % 5 AS VARCHAR) AS epic,
               CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS direction,
               l_quantity AS size,
               CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
                   || CAST(l_partkey AS VARCHAR) AS dealId,
               l_extendedprice, l_shipdate, l_orderkey, l_linenumber
        FROM lineitem"""),
    "base_rate": ((), """
        SELECT date_trunc('month', o_orderdate)::DATE AS date_changed, avg(o_totalprice) / 100000.0 AS rate
        FROM orders GROUP BY 1"""),
    "inflation": ((), """
        SELECT date_trunc('quarter', l_shipdate)::DATE AS period, avg(l_extendedprice) / 10000.0 AS value
        FROM lineitem GROUP BY 1"""),
    "daily_prices": ((), """
        SELECT o_orderpriority AS Name, o_orderdate::DATE AS Date,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS Open,
               max(o_totalprice) AS Close
        FROM orders GROUP BY 1, 2"""),
    "company_list": ((), "SELECT p_brand AS Symbol, p_name AS Name FROM part"),
}


def with_fixtures(body: str, *names: str, extra: str | None = None) -> str:
    """Prefix ``body`` with the CTEs of ``names`` and their dependencies, then
    the ``extra`` CTE definitions (``a AS (...), b AS (...)``)."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in FIXTURE_SQL[n][0]:
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({FIXTURE_SQL[n][1]})" for n in ordered]
    if extra:
        parts.append(extra.strip())
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # Importing the catalogue modules registers their queries.
    from barflow.plans import (catalogue_bars, catalogue_models, catalogue_positions,  # noqa: F401
                               catalogue_macro, catalogue_misc)
    from barflow.streaming import catalogue_stream  # noqa: F401
    return REGISTRY
