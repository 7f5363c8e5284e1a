"""Ordered-series features: future bids, past asks, targets, row fills.

Series are ordered ascending by ``(updated_at, seq)``: the future is
``lead``, the past is ``lag`` (the reference sorts descending and shifts the
other way). Shifts are positional -- a night gap is one step. All window
work goes through :mod:`barflow.operators.series`, so a hot instrument is
split into bounded blocks instead of one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions.scalar import clean_identifier
from barflow.operators import series

KEYS = ("epic",)
ORDER = ("updated_at", "seq")
IMPUTE_VALUE = -999.0
TEST_FRACTION = 0.1


def shift_features(df: DataFrame, future: dict[str, int] | None = None, past: dict[str, int] | None = None,
                   keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
                   block_rows: int = series.DEFAULT_BLOCK_ROWS, **kw) -> DataFrame:
    """W1 + W2 in one pass: ``future={"bid_open": 1}`` adds ``bid_open_f1``;
    ``past={"ask_open": 3}`` adds ``ask_open_p1..p3``."""
    future, past = future or {}, past or {}
    lookahead = max(future.values(), default=0)
    lookback = max(past.values(), default=0)

    def build(w) -> list[Column]:
        cols = [F.lead(c, i).over(w).alias(f"{c}_f{i}") for c, n in future.items() for i in range(1, n + 1)]
        cols += [F.lag(c, i).over(w).alias(f"{c}_p{i}") for c, n in past.items() for i in range(1, n + 1)]
        return cols

    return series.ordered_window(df, keys, order, build, lookback=lookback, lookahead=lookahead,
                                 block_rows=block_rows, **kw)


def future_bids(df: DataFrame, periods: int = 1, **kw) -> DataFrame:
    """``bid_open_f1..fN`` -- the selling price N bars ahead."""
    return shift_features(df, future={"bid_open": periods}, **kw)


def past_asks(df: DataFrame, periods: int = 3, **kw) -> DataFrame:
    """``ask_open_p1..pN`` -- the buying price N bars back."""
    return shift_features(df, past={"ask_open": periods}, **kw)


def return_target(df: DataFrame, horizon: int = 1, alias: str = "r") -> DataFrame:
    """r = bid N bars ahead / ask now (null when the ratio is undefined)."""
    return df.withColumn(alias, F.try_divide(F.col(f"bid_open_f{horizon}"), F.col("ask_open")))


def three_way_target(df: DataFrame, goes_up_by: float, horizons: int = 3, alias: str = "move") -> DataFrame:
    """W4 + P12: sign of the first of ``horizons`` future moves whose size
    exceeds ``goes_up_by``, else 0 (expects ``bid_open_f1..fN``)."""
    expr = None
    for i in range(1, horizons + 1):
        diff = F.col(f"bid_open_f{i}") - F.col("ask_open")
        cond = F.abs(diff) > F.lit(goes_up_by)
        expr = F.when(cond, F.signum(diff)) if expr is None else expr.when(cond, F.signum(diff))
    return df.withColumn(alias, expr.otherwise(F.lit(0.0)))


def lag_columns(base: str, periods: int) -> list[str]:
    return [base] + [f"{base}_p{i}" for i in range(1, periods + 1)]


def impute(df: DataFrame, cols: Sequence[str], value: float = IMPUTE_VALUE) -> DataFrame:
    """Null -> constant."""
    return df.na.fill(value, subset=list(cols))


def row_ffill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill each null from the nearest non-null column to its left."""
    cols = list(cols)
    return df.withColumns({c: F.coalesce(*[F.col(x) for x in reversed(cols[: i + 1])])
                           for i, c in enumerate(cols)})


def normalise(df: DataFrame, cols: Sequence[str], base: str = "ask_open") -> DataFrame:
    """Divide every feature by the row's base column (base becomes 1).
    All ratios are one projection over the input, so they use the raw base."""
    return df.withColumns({c: F.try_divide(F.col(c), F.col(base)) for c in cols})


def adapt_simple_history(df: DataFrame, time_col: str = "datetime", open_col: str = "open") -> DataFrame:
    """History with one price -> (updated_at, bid_open, ask_open), no spread."""
    return df.select(F.col(time_col).alias("updated_at"),
                     F.col(open_col).alias("bid_open"), F.col(open_col).alias("ask_open"),
                     *[c for c in df.columns if c not in (time_col, open_col)])


def adapt_nested_history(df: DataFrame, time_col: str = "DateTime") -> DataFrame:
    """P19 + P9 + P3: flatten ``ask``/``bid`` structs to ``ask_open``/``bid_open``
    and the time column to ``updated_at``; other plain columns pass through."""
    flat = flatten_structs(df)
    t = clean_identifier(time_col)
    keep = [c for c in flat.columns if c != t and not c.startswith(("ask_", "bid_"))]
    return flat.select(*keep, F.col(t).alias("updated_at"), "ask_open", "bid_open")


def flatten_structs(df: DataFrame) -> DataFrame:
    """One level of struct columns -> ``parent_child`` columns with
    lower-case, underscore names (driven by the schema, not the data)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct":
            cols += [F.col(f"`{f.name}`.`{s.name}`").alias(clean_identifier(f"{f.name}_{s.name}"))
                     for s in f.dataType.fields]
        else:
            cols.append(F.col(f"`{f.name}`").alias(clean_identifier(f.name)))
    return df.select(*cols)


def training_rows(bars: DataFrame, horizon: int = 1, past_periods: int = 3, **kw) -> DataFrame:
    """P20/M1 composite: future bid -> target -> past asks -> complete rows."""
    return (bars.transform(shift_features, future={"bid_open": horizon}, past={"ask_open": past_periods}, **kw)
            .transform(return_target, horizon=horizon)
            .na.drop("any"))


def model_features(bars: DataFrame, past_periods: int, fill: str = "impute", **kw) -> DataFrame:
    """M3 front half: past asks -> impute -999 (or row-ffill) -> normalise by ask."""
    lagged = past_asks(bars, past_periods, **kw)
    cols = lag_columns("ask_open", past_periods)
    filled = impute(lagged, cols) if fill == "impute" else row_ffill(lagged, cols)
    return normalise(filled, cols)


def rebase(df: DataFrame, value: str, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
           alias: str | None = None) -> DataFrame:
    """Value / first value of its series. The first value is a per-key
    ``min_by`` aggregate joined back -- no window over the whole series."""
    keys = list(keys)
    first = df.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias("_first"))
    return (df.join(first, keys)
            .withColumn(alias or f"{value}_rebased", F.try_divide(F.col(value), F.col("_first")))
            .drop("_first"))


def elapsed_since_start(df: DataFrame, time_col: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Whole days and whole hours since the series' first row."""
    keys = list(keys)
    start = df.groupBy(*keys).agg(F.min(time_col).alias("_start"))
    secs = (F.unix_micros(F.col(time_col).cast("timestamp")) -
            F.unix_micros(F.col("_start").cast("timestamp"))) / F.lit(1_000_000)
    return (df.join(start, keys)
            .withColumn("days_since", F.floor(secs / 86400))
            .withColumn("hours_since", F.floor(secs / 3600))
            .drop("_start"))


def chronological_split(df: DataFrame, fraction: float = TEST_FRACTION, **kw) -> DataFrame:
    """The reference holds out the last ``int(n * fraction)`` rows of a
    series sorted newest first -- i.e. its oldest rows. Adds ``split`` and
    ``row_index``. Lags are taken before the split, so the first training rows
    see the last held-out bars; the reference lags each part on its own, which
    only leaves those rows without their lags."""
    idx = series.with_row_index(df, KEYS, ORDER, with_size=True, **kw)
    n_test = F.floor(F.col("_n") * F.lit(fraction))
    return (idx.withColumn("split", F.when(F.col(series.IDX) < n_test, F.lit("test")).otherwise(F.lit("train")))
            .withColumn("row_index", F.col(series.IDX))
            .drop(series.IDX, "_n"))


def series_tail(df: DataFrame, n: int, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
                min_rows: int | None = None, **kw) -> DataFrame:
    """W17 + T6: the newest ``n`` rows per series (``iloc[-n:]``), only for
    series with at least ``min_rows`` rows. Uses the distributed row index and
    the per-key size, so no task holds a whole series."""
    idx = series.with_row_index(df, keys, order, with_size=True, **kw)
    out = idx.filter(F.col(series.IDX) >= F.col("_n") - F.lit(n))
    if min_rows is not None:
        out = out.filter(F.col("_n") >= F.lit(min_rows))
    return out.withColumn("rows_from_end", F.col("_n") - F.col(series.IDX) - 1).drop(series.IDX, "_n")


def live_feature_rows(bars: DataFrame, past_periods: int, feature_order: str = "time_correct",
                      keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """T6 + T7: the one row per series that live scoring uses.

    * ``time_correct`` (default): the newest bar with its past asks (``lag``).
    * ``reference_live``: the reference's live path -- the tail of
      ``past_periods + 1`` bars, features from the *following* rows (its
      shift on ascending bars) and the *oldest* row of the tail scored. With
      exactly ``past_periods`` bars the last feature is missing and imputed.

    Series with fewer than ``past_periods`` bars are not scored (T6). Windows
    run over the tail only: ``past_periods + 1`` rows per series.
    """
    keys = list(keys)
    tail = series_tail(bars, past_periods + 1, keys=keys, order=order, min_rows=past_periods)
    w = Window.partitionBy(*keys).orderBy(*order)  # bounded: the tail has at most past_periods + 1 rows
    shift = F.lag if feature_order == "time_correct" else F.lead
    if feature_order not in ("time_correct", "reference_live"):
        raise ValueError(feature_order)
    lagged = tail.select("*", *[shift("ask_open", i).over(w).alias(f"ask_open_p{i}")
                                for i in range(1, past_periods + 1)])
    if feature_order == "time_correct":
        pick = lagged.filter(F.col("rows_from_end") == 0)
    else:
        oldest = F.max("rows_from_end").over(Window.partitionBy(*keys))
        pick = lagged.withColumn("_oldest", oldest).filter(F.col("rows_from_end") == F.col("_oldest")).drop("_oldest")
    cols = lag_columns("ask_open", past_periods)
    return normalise(impute(pick, cols), cols).drop("rows_from_end")


def volatility_target(df: DataFrame, horizons: int = 3, alias: str = "r_vol", keys: Sequence[str] = KEYS,
                      order: Sequence[str] = ORDER, **kw) -> DataFrame:
    """The reference's planned volatility-aware target: over the next
    ``horizons`` bars, mean x sample sd of the return ``bid / ask now``
    (null unless all ``horizons`` bars exist)."""
    out = shift_features(df, future={"bid_open": horizons}, keys=keys, order=order, **kw)
    rets = [F.try_divide(F.col(f"bid_open_f{i}"), F.col("ask_open")) for i in range(1, horizons + 1)]
    mean = sum(rets[1:], rets[0]) / F.lit(float(horizons))
    var = sum([(r - mean) * (r - mean) for r in rets[1:]], (rets[0] - mean) * (rets[0] - mean)) / F.lit(horizons - 1.0)
    return out.withColumn(alias, mean * F.sqrt(var)).drop(*[f"bid_open_f{i}" for i in range(1, horizons + 1)])
