"""Rolling and trend forecasts, and the stacked linear model.

Rolling least squares on the previous ``n`` rows against their row positions
(the reference refits a regression per row) has a closed form: positions are
consecutive integers, so the one-step forecast is a fixed linear filter of
the last ``n`` values, ``sum_j c_j * y[i-n+j]`` with

    c_j = 1/n + (n - m) (j - m) / S,   m = (n-1)/2,   S = n (n^2 - 1) / 12.

That is ``n`` ``lag`` columns in one bounded row frame -- exact, no per-row
fit, and evaluated through the halo-block windows of
:mod:`barflow.operators.series`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions.scalar import poly_terms
from barflow.operators import modeling, series


def ols_filter_weights(n: int) -> list[float]:
    """Weights of y[i-n], ..., y[i-1] in the next-step least-squares forecast."""
    if n < 2:
        raise ValueError("a line needs at least two points")
    m = (n - 1) / 2.0
    s = n * (n * n - 1) / 12.0
    return [1.0 / n + (n - m) * (j - m) / s for j in range(n)]


def rolling_ols_forecasts(df: DataFrame, value: str, lengths: Sequence[int], keys: Sequence[str],
                          order: Sequence[str], prefix: str = "preds_", **kw) -> DataFrame:
    """W6 + W7: for each n in ``lengths``, the forecast of row i from rows
    i-n..i-1 (null for the first n rows), all from one sort."""
    lengths = list(lengths)

    def build(w) -> list[Column]:
        cols = []
        for n in lengths:
            weights = ols_filter_weights(n)
            expr = None
            for j, c in enumerate(weights):
                term = F.lit(c) * F.lag(value, n - j).over(w)
                expr = term if expr is None else expr + term
            cols.append(expr.alias(f"{prefix}{n}"))
        return cols

    return series.ordered_window(df, keys, order, build, lookback=max(lengths), **kw)


def forecast_errors(df: DataFrame, value: str, prefix: str = "preds_", out_prefix: str = "diff_") -> DataFrame:
    """Absolute error of each forecast column."""
    preds = [c for c in df.columns if c.startswith(prefix)]
    return df.withColumns({out_prefix + c[len(prefix):]: F.abs(F.col(c) - F.col(value)) for c in preds})


def polynomial_trend(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str],
                     degree: int = 3, hours: bool = False) -> DataFrame:
    """M7 + F14: fit value ~ poly(t) per key and forecast one step ahead. The
    axis is the position in the series, or with ``hours`` the whole hours since
    its first row; t is the axis over one more than its last value (scaled
    before the powers), so the next step is t = 1. Returns one row per key:
    ``(keys..., n, coef, intercept, next_forecast)``."""
    keys = list(keys)
    if hours:
        secs = F.unix_micros(F.col(order[0]).cast("timestamp")) / F.lit(1_000_000)
        span = df.groupBy(*keys).agg(F.min(secs).alias("_s0"), F.max(secs).alias("_s1"))
        at = series.null_safe_join(df, span, keys)
        axis = F.floor((secs - F.col("_s0")) / 3600)
        t = axis / (F.floor((F.col("_s1") - F.col("_s0")) / 3600) + 1)
    else:
        at = series.with_row_index(df, keys, order, with_size=True)
        t = F.col(series.IDX) / F.col("_n")
    base = at.select(*keys, F.col(value).alias("_y"), t.alias("_t"))
    base = base.select("*", *poly_terms("_t", degree, prefix="_x"))
    feats = [f"_x{d}" for d in range(1, degree + 1)]
    fit = modeling.ols_fit(base, feats, "_y", keys)
    pred = F.aggregate("coef", F.col("intercept"), lambda acc, c: acc + c)  # every power of 1 is 1
    return fit.select(*keys, "n", "coef", "intercept", pred.alias("next_forecast"))


def stacked_features(bars: DataFrame, deepest: int, keys: Sequence[str], order: Sequence[str],
                     base_col: str = "ask_open", future: dict[str, int] | None = None) -> DataFrame:
    """The stacked model's inputs: lags -> row ffill -> divide by the base, as one
    array ``x``; ``future`` columns come from the same pass over the series."""
    from barflow.operators import features as feat

    cols = feat.lag_columns(base_col, deepest)
    lagged = feat.shift_features(bars, future=future, past={base_col: deepest}, keys=list(keys), order=list(order))
    filled = feat.row_ffill(lagged, cols)
    # x is divided by the raw base, which stays as it is for the target
    return filled.withColumn("x", F.array(*[F.try_divide(F.col(c), F.col(base_col)) for c in cols[1:]])).drop(*cols[1:])


def contiguous_folds(rows: DataFrame, folds: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``fold``: contiguous parts of each series; the first ``n % folds`` have one row more."""
    idx = series.with_row_index(rows, list(keys), list(order), with_size=True)
    q, r = F.floor(F.col("_n") / folds), F.col("_n") % folds
    big = r * (q + 1)
    fold = F.when(F.col(series.IDX) < big, F.floor(F.col(series.IDX) / (q + 1))) \
        .otherwise(r + F.floor((F.col(series.IDX) - big) / F.greatest(q, F.lit(1))))
    return idx.withColumn("fold", fold.cast("int")).drop("_n", series.IDX)


def stacked_fit(rows: DataFrame, lookbacks: Sequence[int], label: str, keys: Sequence[str]) -> DataFrame:
    """M8, one model per series: a least-squares model per lookback and a final
    one over their out-of-fold predictions. The base models in the result are
    fitted on all rows, as a stacking regressor keeps them.

    ``rows`` have ``x`` (the lags of the deepest lookback), ``label`` and
    ``fold``. The rows are read once: per fold, the triangular factor of the rows
    ``(1, x, label)`` is built (``modeling.qr_factors``), which keeps their condition
    number though neighbouring lags are near equal. A lookback's inputs are the
    first entries of ``x``, so its columns are some of the factor's; a fold's
    out-of-fold model comes from the other folds' factors, and the out-of-fold
    predictions are linear in x, so the final model's rows follow from the same
    factors. Inputs and label are shifted by one (ratios are near it).

    Returns per series: ``n``, ``bases`` (coefficients and intercept per
    lookback), ``final`` (weights and intercept), ``coef`` and ``intercept`` of
    the whole model as one linear form in x."""
    keys, deepest = list(keys), max(lookbacks)
    size = deepest + 2
    ok = rows.filter(F.col(label).isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    shifted = F.transform(F.col("x").cast("array<double>"), lambda v: v - 1)
    row = F.concat(F.array(F.lit(1.0)), shifted, F.array(F.col(label).cast("double") - 1))
    factors = modeling.qr_factors(ok.select(*keys, "fold", row.alias("z")), "z", [*keys, "fold"])
    named = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("fold")
        own = [np.asarray(r).reshape(size, size) for r in part["r"]]
        all_rows = np.vstack(own)
        inputs = [range(1, lb + 1) for lb in lookbacks]
        second = []
        for f, r in enumerate(own):
            # columns of the final model's rows: the constant, each lookback's out-of-fold prediction, the label, as forms in (1, x, y)
            forms = np.zeros((len(lookbacks) + 2, size))
            forms[0, 0] = forms[-1, -1] = 1.0
            others = [x for g, x in enumerate(own) if g != f]
            rest = np.linalg.qr(np.vstack(others), mode="r") if others else np.zeros((size, size))
            for i, cols in enumerate(inputs):
                w = modeling.solve_factor(rest, cols)
                forms[1 + i, list(cols)], forms[1 + i, 0] = w[:-1], w[-1]
            second.append(r @ forms.T)
        weights = modeling.solve_factor(np.linalg.qr(np.vstack(second), mode="r"), range(1, len(lookbacks) + 1))
        whole = np.linalg.qr(all_rows, mode="r")
        bases = [modeling.solve_factor(whole, cols) for cols in inputs]
        coef, intercept = np.zeros(deepest), weights[-1]
        for w, b in zip(weights, bases):
            coef[:len(b) - 1] += w * b[:-1]
            intercept += w * b[-1]
        level = intercept + 1.0 - coef.sum()
        plain = [[*b[:-1], b[-1] + 1.0 - b[:-1].sum()] for b in bases]
        last = [*weights[:-1], weights[-1] + 1.0 - weights[:-1].sum()]
        row = {k: [part[k].iloc[0]] for k in keys}
        return pd.DataFrame({**row, "n": [int(round(whole[0, 0] ** 2))], "bases": [plain], "final": [last], "coef": [coef.tolist()],
                             "intercept": [level]})

    return factors.groupBy(*keys).applyInPandas(
        fit, f"{named}, n long, bases array<array<double>>, final array<double>, coef array<double>, intercept double")


def stacked_predict(rows: DataFrame, model: DataFrame, keys: Sequence[str], alias: str = "stacked_pred") -> DataFrame:
    """Score rows with ``x``, new ones too, by their series' model (null without one)."""
    fit = model.select(*keys, F.col("coef").alias("_coef"), F.col("intercept").alias("_intercept"))
    joined = series.null_safe_join(rows, fit, list(keys), "left")
    terms = F.zip_with("x", "_coef", lambda v, c: v * c)
    return joined.withColumn(alias, F.aggregate(terms, F.col("_intercept"), lambda a, v: a + v)).drop("_coef", "_intercept")


def stacked_regression(bars: DataFrame, lookbacks: Sequence[int], keys: Sequence[str], order: Sequence[str],
                       base_col: str = "ask_open", horizon: int = 1, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Fit the stacked model of the return ``horizon`` bars ahead on the bars that
    have one, and score them: ``(predictions, models)``; the label is ``y``."""
    from barflow.operators import features as feat

    rows = stacked_features(bars, max(lookbacks), keys, order, base_col, future={"bid_open": horizon})
    rows = feat.return_target(rows, horizon=horizon, alias="y").filter(F.col("y").isNotNull())
    rows = contiguous_folds(rows, folds, keys, order)
    model = stacked_fit(rows, lookbacks, "y", keys)
    return stacked_predict(rows, model, keys), model
