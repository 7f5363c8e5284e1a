"""Macro series: long-format scans, daily alignment, z-scores, similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.operators.bars import daily_interpolate


def macro_series(df: DataFrame, provider: str, dataset: str, series_code: str) -> DataFrame:
    """One series of a long ``(provider, dataset, series, period, value)``
    table; the filter reaches the scan (and partition pruning when the table
    is partitioned by provider/dataset)."""
    return df.filter((F.col("provider") == provider) & (F.col("dataset") == dataset)
                     & (F.col("series") == series_code)).select("period", "value")


def daily(df: DataFrame, date_col: str, value_col: str, out_col: str) -> DataFrame:
    """W13 for one unkeyed series (a constant key keeps the helper general)."""
    keyed = df.withColumn("_k", F.lit(0))
    return daily_interpolate(keyed, ["_k"], date_col, value_col, out_col).drop("_k")


def overlap_bounds(a: DataFrame, b: DataFrame, col: str) -> tuple[Column, Column]:
    """(max of the minima, min of the maxima) -- one scalar subquery per side."""
    ra = a.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    rb = b.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    return F.greatest(ra.getField("lo"), rb.getField("lo")), F.least(ra.getField("hi"), rb.getField("hi"))


def zscore(df: DataFrame, cols: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Population z-score; all means and sds come from one aggregate,
    attached as one scalar subquery (no join)."""
    stats = df.select(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols],
                               *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])).scalar()
    return df.withColumns({
        f"{c}{suffix}": F.try_divide(F.col(c) - stats.getField(f"m_{c}"), stats.getField(f"s_{c}")) for c in cols})


def attach_values_on(df: DataFrame, date_col: str, on: str, cols: Sequence[str], prefix: str = "current_") -> DataFrame:
    """The values of ``cols`` on the comparison date, on every row
    (one scalar subquery: one row, no cross join)."""
    ref = df.filter(F.col(date_col) == F.lit(on).cast(df.schema[date_col].dataType))
    row = ref.select(F.struct(*[F.max(c).alias(c) for c in cols])).scalar()
    return df.withColumns({f"{prefix}{c}": row.getField(c) for c in cols})


def similarity(df: DataFrame, cols: Sequence[str], prefix: str = "current_") -> DataFrame:
    """Per-series absolute distance to the comparison date, summed."""
    out = df.withColumns({f"{c}_similarity": F.abs(F.col(f"{prefix}{c}") - F.col(c)) for c in cols})
    total = None
    for c in cols:
        total = F.col(f"{c}_similarity") if total is None else total + F.col(f"{c}_similarity")
    return out.withColumn("overall_similarity", total)
