"""Catalogue: macro series alignment and similarity to a reference date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.scalar import format_day
from barflow.operators import macro
from barflow.plans import fixtures
from barflow.plans.registry import query, with_fixtures
from barflow.session import materialize

SIMILARITY_TO = "1998-08-31"  # the comparison date


def _interp_sql(name: str, src: str, date_col: str, val_col: str) -> str:
    return f"""
    {name}_pts AS (SELECT {date_col}::DATE AS d, {val_col} AS v FROM {src}),
    {name}_days AS (SELECT unnest(generate_series(min(d)::TIMESTAMP, max(d)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d
                    FROM {name}_pts),
    {name}_f AS (
      SELECT d, v,
             last_value(CASE WHEN v IS NOT NULL THEN d END IGNORE NULLS) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS d0,
             last_value(v IGNORE NULLS) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
             first_value(CASE WHEN v IS NOT NULL THEN d END IGNORE NULLS) OVER (ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS d1,
             first_value(v IGNORE NULLS) OVER (ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
      FROM {name}_days LEFT JOIN {name}_pts USING (d)),
    {name}_daily AS (
      SELECT d, CASE WHEN v IS NOT NULL THEN v WHEN d1 IS NULL THEN v0
                     ELSE v0 + (v1 - v0) * (CAST(date_diff('day', d0, d) AS DOUBLE) / CAST(date_diff('day', d0, d1) AS DOUBLE))
                END AS {name}
      FROM {name}_f)"""


MACRO_SQL = f"""
    macro AS (SELECT 'BOE' AS provider, 'IUDBEDR' AS dataset, 'base_rate' AS series, date_changed AS period,
                     rate AS value FROM base_rate
              UNION ALL
              SELECT 'ONS', 'MM23', 'inflation', period, value FROM inflation),
    {_interp_sql("rate", "(SELECT period, value FROM macro WHERE provider = 'BOE' AND dataset = 'IUDBEDR' AND series = 'base_rate')", "period", "value").strip()},
    {_interp_sql("inflation", "(SELECT period, value FROM macro WHERE provider = 'ONS' AND dataset = 'MM23' AND series = 'inflation')", "period", "value").strip()},
    aligned AS (
      SELECT r.d, r.rate, i.inflation FROM rate_daily r LEFT JOIN inflation_daily i USING (d)
      WHERE r.d > greatest((SELECT min(d) FROM rate_daily), (SELECT min(d) FROM inflation_daily))
        AND r.d < least((SELECT max(d) FROM rate_daily), (SELECT max(d) FROM inflation_daily)))"""


def _macro_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    br = fixtures.base_rate(spark, sf_dir).select(
        F.lit("BOE").alias("provider"), F.lit("IUDBEDR").alias("dataset"), F.lit("base_rate").alias("series"),
        F.col("date_changed").alias("period"), F.col("rate").alias("value"))
    inf = fixtures.inflation(spark, sf_dir).select(
        F.lit("ONS").alias("provider"), F.lit("MM23").alias("dataset"), F.lit("inflation").alias("series"),
        "period", "value")
    return br.unionByName(inf)


def aligned_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _macro_long(spark, sf_dir)
    rate = macro.daily(macro.macro_series(long, "BOE", "IUDBEDR", "base_rate"), "period", "value", "rate")
    infl = macro.daily(macro.macro_series(long, "ONS", "MM23", "inflation"), "period", "value", "inflation")
    lo, hi = macro.overlap_bounds(rate, infl, "period")
    j = rate.join(infl, "period", "left")
    # One row per day: small and bounded by the calendar; written once so the
    # scalar statistics downstream read it instead of re-interpolating.
    return materialize(j.filter((F.col("period") > lo) & (F.col("period") < hi)))


@query("macro_daily", with_fixtures("""
    SELECT strftime(d, '%Y-%m-%d') AS day, round(rate, 6) AS rate, round(inflation, 6) AS inflation FROM aligned""",
                                    "base_rate", "inflation", extra=MACRO_SQL))
def macro_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two macro series from a long table, each interpolated to days,
    joined on the date inside their common range (S13, W13, W16, J7)."""
    a = aligned_daily(spark, sf_dir)
    return a.select(format_day("period").alias("day"), F.round("rate", 6).alias("rate"),
                    F.round("inflation", 6).alias("inflation"))


@query("macro_similarity", with_fixtures(f"""
    SELECT strftime(d, '%Y-%m-%d') AS day, round(rate_scaled, 6) AS rate_scaled,
           round(inflation_scaled, 6) AS inflation_scaled,
           round(abs(cr - rate_scaled) + abs(ci - inflation_scaled), 6) AS overall_similarity
    FROM (SELECT *, (SELECT max(rate_scaled) FROM z WHERE d = DATE '{SIMILARITY_TO}') AS cr,
                    (SELECT max(inflation_scaled) FROM z WHERE d = DATE '{SIMILARITY_TO}') AS ci FROM z)
    ORDER BY overall_similarity DESC""", "base_rate", "inflation", extra=MACRO_SQL + """,
    z AS (SELECT d, (rate - (SELECT avg(rate) FROM aligned)) / (SELECT stddev_pop(rate) FROM aligned) AS rate_scaled,
                 (inflation - (SELECT avg(inflation) FROM aligned)) / (SELECT stddev_pop(inflation) FROM aligned)
                     AS inflation_scaled FROM aligned)"""))
def macro_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days ranked by how far the scaled rate and inflation are from their
    values on the comparison date (W15, J8, M12, O1)."""
    a = macro.zscore(aligned_daily(spark, sf_dir), ["rate", "inflation"])
    a = macro.attach_values_on(a, "period", SIMILARITY_TO, ["rate_scaled", "inflation_scaled"])
    s = macro.similarity(a, ["rate_scaled", "inflation_scaled"])
    return s.select(format_day("period").alias("day"), F.round("rate_scaled", 6).alias("rate_scaled"),
                    F.round("inflation_scaled", 6).alias("inflation_scaled"),
                    F.round("overall_similarity", 6).alias("overall_similarity")).orderBy(F.desc("overall_similarity"))
