"""Forecast evaluation: quantiles, summaries, hit rates, errors, histograms.

Every metric is an aggregate (partial aggregation, no per-group collection);
the report is long-format ``(group..., metric, value)`` so several splits or
models come out of one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.operators.series import null_safe_join


def exact_quantiles(df: DataFrame, col: str, levels: Sequence[float], group_cols: Sequence[str] = (),
                    chunks: int = 256) -> DataFrame:
    """Exact interpolated quantiles without holding a group in one task.

    Equal values are counted first (partial aggregation, so a hot group or
    value shrinks map-side). Each group is cut into about ``chunks`` pieces at
    its sketch quantiles (``percentile_approx``: bounded memory), so pieces
    are balanced by row count whatever the distribution (outliers included).
    An exclusive prefix sum over the small piece table plus a running sum
    inside each piece gives every distinct value its exact rank range. Each
    value is emitted for the levels whose interpolation ranks fall in its
    range, and the pair is blended as Spark's ``percentile`` does:
    ``(hi - h) * v_lo + (h - lo) * v_hi`` with ``h = (n - 1) q``. The sketch
    only places the cuts, so the result is exact.
    Returns ``(group..., level, value)``.
    """
    g = list(group_cols)
    levels = [float(x) for x in levels]
    vals = df.select(*g, F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    dist = vals.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    cuts = [i / chunks for i in range(1, chunks)]
    per_group = vals.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_n"),
        (F.percentile_approx("_v", cuts, 10 * chunks) if cuts else F.array().cast("array<double>")).alias("_cuts"))
    if g:
        d = null_safe_join(dist, per_group, g)
    else:
        d = dist.withColumns({c: per_group.select(c).scalar() for c in ("_n", "_cuts")})
    # piece = number of cuts below the value: monotone in the value, equal values share a piece
    piece = F.aggregate("_cuts", F.lit(0), lambda acc, b: acc + F.when(b < F.col("_v"), 1).otherwise(0))
    d = d.withColumn("_chunk", piece).drop("_cuts")
    before = Window.partitionBy(*g).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (d.groupBy(*g, "_chunk").agg(F.sum("_c").alias("_cc"))
               .select(*g, "_chunk", F.coalesce(F.sum("_cc").over(before), F.lit(0)).alias("_off")))
    inner = Window.partitionBy(*g, "_chunk").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = null_safe_join(d, offsets, [*g, "_chunk"]).withColumn("_end", F.col("_off") + F.sum("_c").over(inner))
    # rank range of this value: [_end - _c, _end - 1]; only the levels whose ranks touch it are spread
    touched = F.filter(F.array(*[F.lit(x) for x in levels]), lambda q: (F.ceil((F.col("_n") - 1) * q) >= F.col("_end") - F.col("_c"))
                       & (F.floor((F.col("_n") - 1) * q) <= F.col("_end") - 1))
    ranked = ranked.withColumn("_lv", F.explode(touched))
    h = (F.col("_n") - 1) * F.col("_lv")
    r_lo, r_hi = F.floor(h), F.ceil(h)
    start, end = F.col("_end") - F.col("_c"), F.col("_end") - 1
    hit = ranked.select(*g, "_lv", "_v", h.alias("_h"),
                        ((r_lo >= start) & (r_lo <= end)).alias("_is_lo"),
                        ((r_hi >= start) & (r_hi <= end)).alias("_is_hi")) \
        .filter(F.col("_is_lo") | F.col("_is_hi"))
    agg = hit.groupBy(*g, "_lv").agg(F.max(F.when(F.col("_is_lo"), F.col("_v"))).alias("_vlo"),
                                     F.max(F.when(F.col("_is_hi"), F.col("_v"))).alias("_vhi"),
                                     F.first("_h").alias("_h"))
    lo_i, hi_i = F.floor("_h"), F.ceil("_h")
    value = F.when(lo_i == hi_i, F.col("_vlo")).otherwise(
        (hi_i - F.col("_h")) * F.col("_vlo") + (F.col("_h") - lo_i) * F.col("_vhi"))
    return agg.select(*g, F.col("_lv").alias("level"), value.alias("value"))


def quantile_pairs(df: DataFrame, col: str, qs: Sequence[float], group_cols: Sequence[str] = (),
                   accuracy: int | None = None) -> DataFrame:
    """Interpolated quantiles at (1-q, q) for each q -> (group..., level,
    value). Exact by default (:func:`exact_quantiles`); ``accuracy`` selects
    the sketch-based ``percentile_approx``."""
    levels = sorted({round(1 - q, 10) for q in qs} | {round(q, 10) for q in qs})
    if accuracy is None:
        return exact_quantiles(df, col, levels, group_cols)
    agg = F.percentile_approx(F.col(col), [float(x) for x in levels], accuracy)
    g = df.groupBy(*group_cols).agg(agg.alias("_q"))
    return g.select(*group_cols, F.posexplode("_q").alias("_i", "value")).select(
        *group_cols, F.element_at(F.array(*[F.lit(x) for x in levels]), F.col("_i") + 1).alias("level"), "value")


def describe(df: DataFrame, col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample sd, min, quartiles, max (exact; quartiles via
    :func:`exact_quantiles`, moments via one aggregation)."""
    g = list(group_cols)
    c = F.col(col)
    moments = df.groupBy(*g).agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                                 F.min(c).alias("min"), F.max(c).alias("max"))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], g)
    wide = q.groupBy(*g).pivot("level", [0.25, 0.5, 0.75]).agg(F.first("value"))
    wide = wide.withColumnsRenamed({"0.25": "p25", "0.5": "p50", "0.75": "p75"})
    out = null_safe_join(moments, wide, g, "left") if g else moments.withColumns(
        {c2: wide.select(c2).scalar() for c2 in ("p25", "p50", "p75")})
    return out.select(*g, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def hit_rates(df: DataFrame, pred_threshold: float, actual_threshold: float = 1.0, pred: str = "y_pred",
              actual: str = "y_true", group_cols: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction exceeds the buy threshold, and of rows
    whose actual return exceeds its own (1: any gain)."""
    return df.groupBy(*group_cols).agg(
        F.avg((F.col(pred) > pred_threshold).cast("double")).alias("pred_rate"),
        F.avg((F.col(actual) > actual_threshold).cast("double")).alias("actual_rate"),
        F.count(F.lit(1)).alias("n"))


def residuals(df: DataFrame, pred: str = "y_pred", actual: str = "y_true", alias: str = "residual") -> DataFrame:
    """Y - y_hat."""
    return df.withColumn(alias, F.col(actual) - F.col(pred))


def error_metrics(df: DataFrame, pred: str = "y_pred", actual: str = "y_true",
                  group_cols: Sequence[str] = ()) -> DataFrame:
    """A10 + A11: MAE, MSE, RMSE, R^2 -- one pass of sums, then arithmetic."""
    e = F.col(actual) - F.col(pred)
    g = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.sum(e * e).alias("_sse"), F.var_pop(F.col(actual)).alias("_var"))
    return g.select(*group_cols, "n", "mae", "mse", F.sqrt("mse").alias("rmse"),
                    (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("n"))).alias("r2"))


def to_long(df: DataFrame, group_cols: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metrics -> (group..., metric, value)."""
    pairs = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    return df.select(*group_cols, F.expr(f"stack({len(metrics)}, {pairs}) AS (metric, value)"))


def report(preds: DataFrame, pred_threshold: float, actual_threshold: float = 1.0, time_col: str = "updated_at",
           pred: str = "y_pred", actual: str = "y_true", group_cols: Sequence[str] = ("split",),
           levels: Sequence[float] = (0.1, 0.05, 0.01, 0.9, 0.95, 0.99)) -> DataFrame:
    """The whole evaluation of a run, long and as text:
    ``(group..., metric, value)`` with the errors, the share of predictions and
    of actual returns above their thresholds, the date bounds and the quantile
    limits of the actual returns (exact, interpolated, see :func:`exact_quantiles`)."""
    e, g = F.col(actual) - F.col(pred), list(group_cols)
    wide = preds.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(F.col(actual)) * F.count(F.lit(1)))).alias("r2"),
        F.avg((F.col(pred) > pred_threshold).cast("double")).alias("predicted_frequency"),
        F.avg((F.col(actual) > actual_threshold).cast("double")).alias("actual_frequency"),
        F.min(time_col).alias("first_time"), F.max(time_col).alias("last_time"))
    metrics = ["n", "mae", "mse", "rmse", "r2", "predicted_frequency", "actual_frequency", "first_time", "last_time"]
    cols = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics]
    name = F.coalesce(*[F.when(F.col("level") == float(x), F.lit(f"quantile_{x:g}")) for x in levels])
    limits = exact_quantiles(preds, actual, levels, g).select(*g, name.alias("metric"), F.col("value").cast("string").alias("value"))
    return (wide.select(*g, F.explode(F.array(*cols)).alias("_m")).select(*g, "_m.metric", "_m.value").unionByName(limits))


def _bucket(c: Column, lo: float, hi: float, width: float) -> Column:
    n_bins = int(round((hi - lo) / width))
    b = F.floor((c - F.lit(lo)) / F.lit(width))
    # The last bin is closed on the right, as numpy's histogram.
    return F.when((c >= lo) & (c <= hi), F.least(b, F.lit(n_bins - 1)))


def histogram(df: DataFrame, cols: Sequence[str], lo: float, hi: float, width: float,
              group_cols: Sequence[str] = ()) -> DataFrame:
    """Fixed-width counts for several series at once -> (series, bin, lo, count)."""
    stacked = df.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_s"))
    b = stacked.select(*group_cols, "_s.series", _bucket(F.col("_s.v"), lo, hi, width).alias("bin"))
    return (b.filter(F.col("bin").isNotNull())
            .groupBy(*group_cols, "series", "bin").agg(F.count(F.lit(1)).alias("count"))
            .withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(width)))


def density(df: DataFrame, cols: Sequence[str], bins: int, q_lo: float = 0.01, q_hi: float = 0.99,
            group_cols: Sequence[str] = (), range_rows: Column | None = None) -> DataFrame:
    """Density histograms of several series over one quantile-clipped range
    per group, every bin present: ``(group..., series, bin, bin_lo, count, density)``.

    The range is that of the first series, over the rows that meet
    ``range_rows`` (the training rows, say). A bin's density is
    ``count / (rows of the series in range * width)``; empty bins have 0."""
    g, cols = list(group_cols), list(cols)
    base = df if range_rows is None else df.filter(range_rows)
    q = exact_quantiles(base, cols[0], [q_lo, q_hi], g)
    bounds = q.groupBy(*g).agg(F.max(F.when(F.col("level") == q_lo, F.col("value"))).alias("_lo"),
                               F.max(F.when(F.col("level") == q_hi, F.col("value"))).alias("_hi"))
    values = df.select(*g, F.explode(F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("v"))
                                               for c in cols])).alias("_s")).select(*g, "_s.series", "_s.v")

    def with_bounds(rows: DataFrame) -> DataFrame:
        if g:
            return null_safe_join(rows, bounds, g)
        return rows.withColumns({c: bounds.select(c).scalar() for c in ("_lo", "_hi")})  # one range: no join

    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    inr = with_bounds(values).filter((F.col("v") >= F.col("_lo")) & (F.col("v") <= F.col("_hi")))
    bin_ = F.least(F.floor(F.try_divide(F.col("v") - F.col("_lo"), width)), F.lit(bins - 1)).alias("bin")
    counts = inr.select(*g, "series", bin_).groupBy(*g, "series", "bin").agg(F.count(F.lit(1)).alias("count"))
    # every bin of every group and series: as many rows as the result has
    groups = bounds if g else bounds.select("_lo", "_hi")
    spine = (groups.withColumn("series", F.explode(F.array(*map(F.lit, cols))))
             .withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")))))
    full = null_safe_join(spine, counts, [*g, "series", "bin"], "left").fillna(0, ["count"])
    n = F.sum("count").over(Window.partitionBy(*g, "series"))  # ``bins`` rows
    return full.select(*g, "series", "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_lo"), "count",
                       F.coalesce(F.try_divide(F.col("count").cast("double"), n * width), F.lit(0.0)).alias("density"))


def observe_shape(df: DataFrame, name: str = "shape"):
    """A4 without an extra job: rows are counted while the next action runs
    (``DataFrame.observe``); columns come from the schema. Returns
    ``(df, get)`` where ``get()`` gives ``(rows, columns)`` after an action."""
    from pyspark.sql import Observation
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    return observed, lambda: (obs.get["rows"], len(df.columns))
