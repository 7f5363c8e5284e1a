"""Model steps: table-function transformers and least squares at scale.

Least squares is solved from sufficient statistics: one aggregation (partial
aggregation, so any number of rows and any skew) produces, per group, the
count, feature sums, label sum, cross-products and squares. Each group's
small p x p system is then solved next to its row by a vectorised pandas UDF
on the executors -- the data never reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class FunctionStep(Transformer):
    """M2: a DataFrame function with bound parameters as a pipeline stage
    (``FunctionTransformer(partial(f, ...))``)."""

    kwargs = Param(Params._dummy(), "kwargs", "keyword arguments bound to the function",
                   typeConverter=TypeConverters.identity)

    def __init__(self, fn: Callable[..., DataFrame], kwargs: dict | None = None):
        super().__init__()
        self._fn = fn
        self._set(kwargs=dict(kwargs or {}))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._fn(dataset, **self.getOrDefault(self.kwargs))


def gram_stats(df: DataFrame, features: Sequence[str], label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Sufficient statistics of least squares per group (rows with a null
    feature or label are left out, as a fit on ``dropna`` data would)."""
    feats = list(features)
    ok = F.lit(True)
    for c in [*feats, label]:
        ok = ok & F.col(c).isNotNull()
    d = df.filter(ok)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(label).alias("sy"), F.sum(F.col(label) * F.col(label)).alias("syy")]
    aggs += [F.sum(c).alias(f"sx_{i}") for i, c in enumerate(feats)]
    aggs += [F.sum(F.col(c) * F.col(label)).alias(f"sxy_{i}") for i, c in enumerate(feats)]
    aggs += [F.sum(F.col(a) * F.col(b)).alias(f"sxx_{i}_{j}")
             for i, a in enumerate(feats) for j, b in enumerate(feats) if j >= i]
    g = d.groupBy(*group_cols).agg(*aggs)
    return pack_stats(g, len(feats), group_cols)


def pack_stats(g: DataFrame, p: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """Flat statistic columns (``n, sy, syy, sx_i, sxy_i, sxx_i_j``) -> arrays."""
    return g.select(
        *group_cols, "n", "sy", "syy",
        F.array(*[F.col(f"sx_{i}") for i in range(p)]).alias("sx"),
        F.array(*[F.col(f"sxy_{i}") for i in range(p)]).alias("sxy"),
        F.array(*[F.col(f"sxx_{min(i, j)}_{max(i, j)}") for i in range(p) for j in range(p)]).alias("sxx"),
    )


def _solve(n, sy, sx, sxy, sxx) -> tuple[list[float], float]:
    p = len(sx)
    sx, sxy = np.asarray(sx, float), np.asarray(sxy, float)
    sxx = np.asarray(sxx, float).reshape(p, p)
    xm, ym = sx / n, sy / n
    a = sxx - n * np.outer(xm, xm)
    b = sxy - n * xm * ym
    beta = np.linalg.lstsq(a, b, rcond=None)[0]
    return beta.tolist(), float(ym - xm @ beta)


@F.pandas_udf(T.StructType([T.StructField("coef", T.ArrayType(T.DoubleType())),
                            T.StructField("intercept", T.DoubleType())]))
def _solve_udf(n: pd.Series, sy: pd.Series, sx: pd.Series, sxy: pd.Series, sxx: pd.Series) -> pd.DataFrame:
    out = [_solve(*row) if row[0] and row[0] > 0 else ([], None)
           for row in zip(n, sy, sx, sxy, sxx)]
    return pd.DataFrame({"coef": [o[0] for o in out], "intercept": [o[1] for o in out]})


def _reduced(parts: list[np.ndarray], width: int) -> np.ndarray:
    """The triangular factor of the rows below one another, filled up to a square."""
    r = np.linalg.qr(np.vstack(parts), mode="r")
    return np.vstack([r, np.zeros((width - len(r), width))]) if len(r) < width else r


def qr_factors(rows: DataFrame, vec: str, group_cols: Sequence[str], slots: int = 64, held: int = 4096) -> DataFrame:
    """``(group..., r)``: the triangular factor R (row by row) of the QR decomposition
    of each group's rows ``vec`` (equally long arrays without nulls).

    Each partition reduces its rows to one R per group, batch by batch (at most ``held`` groups at a
    time); these are merged in ``slots`` parts and then as one. Only R's are shuffled, one per
    partition and group, and unlike a matrix of products R keeps the condition number of the rows."""
    keys = list(group_cols)
    data = rows.select(*keys, F.col(vec).cast("array<double>").alias("_z"))
    named = ", ".join(f"`{k}` {data.schema[k].dataType.simpleString()}" for k in keys)

    def local(batches):
        found: dict[tuple, np.ndarray] = {}

        def given():
            out = pd.DataFrame([(*k, r.ravel()) for k, r in found.items()], columns=[*keys, "r"])
            found.clear()
            return out
        for b in batches:
            for name, part in b.groupby(keys, dropna=False, sort=False):
                name = tuple(None if pd.isna(v) else v for v in name)
                z = np.stack(part["_z"].to_numpy())
                found[name] = _reduced([found[name], z] if name in found else [z], z.shape[1])
            if len(found) > held:
                yield given()
        if found:
            yield given()

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        width = int(np.sqrt(len(part["r"].iloc[0])))
        r = _reduced([np.asarray(x).reshape(width, width) for x in part["r"]], width)
        return pd.DataFrame({**{k: [part[k].iloc[0]] for k in keys}, "r": [r.ravel()]})

    form = f"{named}, r array<double>"
    parts = data.mapInPandas(local, form).withColumn("_slot", F.pmod(F.spark_partition_id(), F.lit(slots)))
    return parts.groupBy(*keys, "_slot").applyInPandas(merged, form).groupBy(*keys).applyInPandas(merged, form)


def solve_factor(r: np.ndarray, inputs: Sequence[int]) -> np.ndarray:
    """Least squares of the last column on the columns ``inputs`` and the constant,
    which is column 0: coefficients and intercept. Below its first row R is the factor of the centred columns."""
    if not r[0, 0]:
        return np.zeros(len(inputs) + 1)
    mean = r[0] / r[0, 0]
    beta = np.linalg.lstsq(r[1:, list(inputs)], r[1:, -1], rcond=1e-10)[0]
    return np.append(beta, mean[-1] - mean[list(inputs)] @ beta)


def ols_fit(df: DataFrame, features: Sequence[str], label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """M6: ordinary least squares per group -> (group..., n, coef, intercept, r2).

    One aggregation, then a p x p solve per group on the executors."""
    g = gram_stats(df, features, label, group_cols)
    solved = g.withColumn("_fit", _solve_udf("n", "sy", "sx", "sxy", "sxx")).withColumn("coef", F.col("_fit.coef"))
    # R^2 from the same statistics: explained / total, with the centred cross
    # products b = sxy - sx * sy / n, explained = coef . b, total = syy - sy^2 / n.
    centred = F.zip_with("sxy", "sx", lambda xy, x: xy - x * F.col("sy") / F.col("n"))
    explained = F.aggregate(F.zip_with("coef", centred, lambda c, v: c * v), F.lit(0.0), lambda acc, v: acc + v)
    total = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return solved.select(*group_cols, "n", "coef", F.col("_fit.intercept").alias("intercept"),
                         F.try_divide(explained, total).alias("r2"), "sy", "syy", "sx", "sxy", "sxx")


def ols_predict(df: DataFrame, fit: DataFrame, features: Sequence[str], alias: str = "y_hat",
                group_cols: Sequence[str] = ()) -> DataFrame:
    """M9 for a linear model: attach the group's coefficients and score."""
    fit = fit.select(*group_cols, "coef", "intercept")
    if group_cols:
        joined = df.join(fit, list(group_cols))
    else:
        joined = df.withColumn("_fit", F.struct(fit.select("coef").scalar().alias("coef"),
                                                fit.select("intercept").scalar().alias("intercept"))) \
            .withColumn("coef", F.col("_fit.coef")).withColumn("intercept", F.col("_fit.intercept")).drop("_fit")
    pred: Column = F.col("intercept")
    for i, c in enumerate(features):
        pred = pred + F.col("coef")[i] * F.col(c)
    return joined.withColumn(alias, pred).drop("coef", "intercept")


def simple_ols(df: DataFrame, x: str, y: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """M6 with one feature: built-in ``regr_slope`` / ``regr_intercept`` / ``regr_r2``."""
    return df.groupBy(*group_cols).agg(
        F.regr_count(F.col(y), F.col(x)).alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"))
