"""Catalogue: nearest neighbours, evaluation, linear trends, rolling forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.scalar import format_day, ts_text
from barflow.jobs import training_matrix
from barflow.operators import evaluate, features, forecast, knn, modeling, promotion, series
from barflow.plans import fixtures
from barflow.plans.catalogue_bars import HOUR_TS, TEST_FRACTION, chronological_split
from barflow.plans.registry import query, with_fixtures
from barflow.session import materialize
from barflow.sources.tables import read_table

ROW_KEY = ["epic", "updated_at", "seq"]  # sequence numbers may repeat between instruments
K = 3  # fixed value: the reference's neighbour count
PAST_PERIODS = 3
R_THRESHOLD = 1.0
#: The reference counts predictions above the buy threshold and actual returns above one.
HIT_THRESHOLD, GAIN_THRESHOLD = 0.9, 1.0


def _r(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# ---------------------------------------------------------------- kNN on embeddings

EMB_PAIRS = f"""
    e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
    nn AS (SELECT * FROM (
             SELECT a.vec_id AS q_id, b.vec_id AS t_id, list_distance(a.v, b.v) AS distance,
                    CAST(b.label AS DOUBLE) AS t_y,
                    row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank
             FROM e a, e b WHERE a.vec_id % 5 = 0 AND b.vec_id % 5 <> 0)
           WHERE rank <= {K})"""


def _embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    # one row in five is a query, the others are the training set
    return knn.knn(emb.filter("vec_id % 5 = 0"), emb.filter("vec_id % 5 <> 0"), K, q_id="vec_id", t_id="vec_id", q_vec="embedding", t_vec="embedding", t_y="label")


@query("knn_neighbours", f"WITH {EMB_PAIRS} SELECT q_id, rank, t_id, round(distance, 6) AS distance FROM nn")
def knn_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k nearest training embeddings of every query embedding."""
    nb = _embedding_neighbours(spark, sf_dir)
    return nb.select("q_id", F.col("rank").cast("long").alias("rank"), "t_id", _r("distance").alias("distance"))


@query("knn_predict", f"""WITH {EMB_PAIRS}
    SELECT q_id AS vec_id, round(avg(t_y), 6) AS y_pred FROM nn GROUP BY q_id""")
def knn_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kNN regression: mean label of the k nearest (M4)."""
    p = knn.knn_predict(_embedding_neighbours(spark, sf_dir))
    return p.select(F.col("q_id").alias("vec_id"), _r("y_pred").alias("y_pred"))


@query("knn_closeness", f"""WITH {EMB_PAIRS}
    SELECT q_id AS vec_id, round(sum(distance), 6) AS closeness FROM nn GROUP BY q_id""")
def knn_closeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of the k neighbour distances per row."""
    c = knn.knn_closeness(_embedding_neighbours(spark, sf_dir))
    return c.select(F.col("q_id").alias("vec_id"), _r("closeness").alias("closeness"))


@query("closeness_vs_error", f"""WITH {EMB_PAIRS}
    SELECT n.q_id AS vec_id, round(sum(distance), 6) AS closeness,
           round(abs(avg(t_y) - any_value(CAST(e.label AS DOUBLE))), 6) AS abs_error,
           round(any_value(CAST(e.label AS DOUBLE)) - avg(t_y), 6) AS residual
    FROM nn n JOIN e ON e.vec_id = n.q_id GROUP BY n.q_id""")
def closeness_vs_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closeness against absolute error per row."""
    nb = _embedding_neighbours(spark, sf_dir)
    per = nb.groupBy("q_id").agg(F.sum("distance").alias("closeness"), F.avg("t_y").alias("y_pred"))
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "label"])
    j = per.join(emb.select(F.col("vec_id").alias("q_id"), F.col("label").cast("double").alias("y_true")), "q_id")
    j = evaluate.residuals(j)
    return j.select(F.col("q_id").alias("vec_id"), _r("closeness").alias("closeness"),
                    _r(F.abs(F.col("y_pred") - F.col("y_true"))).alias("abs_error"), _r("residual").alias("residual"))


# ---------------------------------------------------------------- kNN on bars (the reference model)

BAR_MODEL_SQL = f"""
    feat AS (
      SELECT epic, updated_at, seq, bid_open_f1 / ask_open AS y_true, ask_open AS level,
             ask_open / ask_open AS x0, coalesce(p1, -999.0) / ask_open AS x1,
             coalesce(p2, -999.0) / ask_open AS x2, coalesce(p3, -999.0) / ask_open AS x3
      FROM (SELECT *, lead(bid_open, 1) OVER w AS bid_open_f1, lag(ask_open, 1) OVER w AS p1,
                   lag(ask_open, 2) OVER w AS p2, lag(ask_open, 3) OVER w AS p3
            FROM stream WINDOW w AS (PARTITION BY epic ORDER BY updated_at, seq))
      WHERE bid_open_f1 IS NOT NULL),
    fs AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY epic ORDER BY updated_at, seq) - 1
                               < floor(count(*) OVER (PARTITION BY epic) * {TEST_FRACTION})
                          THEN 'test' ELSE 'train' END AS split,
                  [x0, x1, x2, x3] AS v FROM feat),
    bnn AS (SELECT * FROM (
              SELECT q.epic, q.updated_at, q.seq, t.y_true AS t_y, list_distance(q.v, t.v) AS distance,
                     row_number() OVER (PARTITION BY q.epic, q.updated_at, q.seq
                                        ORDER BY list_distance(q.v, t.v), t.epic, t.updated_at, t.seq) AS rank
              FROM fs q, fs t WHERE t.split = 'train')
            WHERE rank <= {K}),
    preds AS (SELECT f.epic, f.updated_at, f.seq, f.split, f.y_true, p.y_pred, p.closeness, f.level
              FROM fs f JOIN (SELECT epic, updated_at, seq, avg(t_y) AS y_pred, sum(distance) AS closeness
                              FROM bnn GROUP BY epic, updated_at, seq) p USING (epic, updated_at, seq))"""


def bar_model_rows(spark: SparkSession, sf_dir: str, past_periods: int = PAST_PERIODS) -> DataFrame:
    """M3 front half + W14: bars -> target -> past asks -> impute -999 ->
    normalise -> chronological split, with the feature vector."""
    # Used by the pivots, the cells and the scoring join.
    return materialize(training_matrix(fixtures.stream(spark, sf_dir), past_periods))


def bar_model_neighbours(rows: DataFrame, k: int) -> DataFrame:
    """kNN(k) fitted on the training split, every row scored (training rows
    see themselves, as in the reference)."""
    train = rows.filter(F.col("split") == "train")
    return knn.knn(rows, train, k, q_id=ROW_KEY, t_id=ROW_KEY, t_y="y_true")


def predictions_for(rows: DataFrame, neighbours: DataFrame, k: int) -> DataFrame:
    """M4 + M9: mean target of the first ``k`` neighbours. Ranks are exact and
    deterministic, so one search with the largest k serves every smaller k."""
    first_k = neighbours.filter(F.col("rank") <= k)
    pred = first_k.groupBy(*ROW_KEY).agg(F.avg("t_y").alias("y_pred"), F.sum("distance").alias("closeness"))
    return rows.select(*ROW_KEY, "split", "y_true", "level").join(pred, ROW_KEY)


def bar_model_predictions(spark: SparkSession, sf_dir: str, past_periods: int = PAST_PERIODS,
                          k: int = K) -> DataFrame:
    """M3 + M9 + W14: the reference's kNN model trained and scored on bars."""
    rows = bar_model_rows(spark, sf_dir, past_periods)
    return predictions_for(rows, bar_model_neighbours(rows, k), k)


@query("knn_bar_model", with_fixtures(f"""
    SELECT epic, strftime(updated_at, {HOUR_TS}) AS updated_at, split, round(y_true, 6) AS y_true,
           round(y_pred, 6) AS y_pred FROM preds""", "stream", extra=BAR_MODEL_SQL))
def knn_bar_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and score the reference's kNN model on hourly bars."""
    p = bar_model_predictions(spark, sf_dir)
    return p.select("epic", ts_text("updated_at").alias("updated_at"), "split",
                    _r("y_true").alias("y_true"), _r("y_pred").alias("y_pred"))


# ---------------------------------------------------------------- evaluation of the bar model

METRICS = ("n", "mae", "mse", "rmse", "r2")


@query("eval_errors", with_fixtures("""
    SELECT split, metric, round(value, 6) AS value FROM (
      SELECT split, CAST(count(*) AS DOUBLE) AS n, avg(abs(y_true - y_pred)) AS mae,
             avg((y_true - y_pred) * (y_true - y_pred)) AS mse,
             sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
             1.0 - sum((y_true - y_pred) * (y_true - y_pred)) / (var_pop(y_true) * count(*)) AS r2
      FROM preds GROUP BY split)
    UNPIVOT (value FOR metric IN (n, mae, mse, rmse, r2))""", "stream", extra=BAR_MODEL_SQL))
def eval_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAE, MSE, RMSE, R^2 per split as a long report."""
    p = bar_model_predictions(spark, sf_dir)
    wide = evaluate.error_metrics(p, group_cols=["split"])
    long = evaluate.to_long(wide, ["split"], METRICS)
    return long.select("split", "metric", _r("value").alias("value"))


@query("eval_hit_rate", with_fixtures(f"""
    SELECT split, round(avg(CASE WHEN y_pred > {HIT_THRESHOLD} THEN 1.0 ELSE 0.0 END), 6) AS pred_rate,
           round(avg(CASE WHEN y_true > {GAIN_THRESHOLD} THEN 1.0 ELSE 0.0 END), 6) AS actual_rate,
           count(*) AS n
    FROM preds GROUP BY split""", "stream", extra=BAR_MODEL_SQL))
def eval_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of predicted and actual returns above the buy threshold."""
    h = evaluate.hit_rates(bar_model_predictions(spark, sf_dir), HIT_THRESHOLD, GAIN_THRESHOLD, group_cols=["split"])
    return h.select("split", _r("pred_rate").alias("pred_rate"), _r("actual_rate").alias("actual_rate"), "n")


QS = (0.9, 0.95, 0.99)
TARGETS_SQL = """
    tgt AS (SELECT epic, bid_open_f1 / ask_open AS r
            FROM (SELECT *, lead(bid_open, 1) OVER (PARTITION BY epic ORDER BY updated_at, seq) AS bid_open_f1
                  FROM stream)
            WHERE bid_open_f1 IS NOT NULL)"""


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = features.future_bids(fixtures.stream(spark, sf_dir), 1)
    return features.return_target(s).filter(F.col("r").isNotNull()).select("epic", "r")


_LEVELS = sorted({round(1 - q, 10) for q in QS} | set(QS))


@query("eval_quantiles", with_fixtures(f"""
    SELECT epic, unnest({list(_LEVELS)}) AS level, round(unnest(quantile_cont(r, {list(_LEVELS)})), 6) AS value
    FROM tgt GROUP BY epic""", "stream", extra=TARGETS_SQL))
def eval_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interpolated quantile pairs (1-q, q) of the return target per instrument."""
    q = evaluate.quantile_pairs(_targets(spark, sf_dir), "r", QS, ["epic"])
    return q.select("epic", F.col("level").cast("double").alias("level"), _r("value").alias("value"))


@query("eval_describe", with_fixtures("""
    SELECT epic, count(r) AS count, round(avg(r), 6) AS mean, round(stddev_samp(r), 6) AS std,
           round(min(r), 6) AS min, round(quantile_cont(r, 0.25), 6) AS p25, round(quantile_cont(r, 0.5), 6) AS p50,
           round(quantile_cont(r, 0.75), 6) AS p75, round(max(r), 6) AS max
    FROM tgt GROUP BY epic""", "stream", extra=TARGETS_SQL))
def eval_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """count / mean / sample sd / min / quartiles / max of the target."""
    d = evaluate.describe(_targets(spark, sf_dir), "r", ["epic"])
    return d.select("epic", "count", *[_r(c).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


HIST_LO, HIST_HI, HIST_W = 0.0, 4.0, 0.05


@query("eval_histogram", with_fixtures(f"""
    SELECT series, bin, count(*) AS count, round({HIST_LO} + bin * {HIST_W}, 6) AS bin_lo FROM (
      SELECT series, CAST(least(floor((v - {HIST_LO}) / {HIST_W}), {int(round((HIST_HI - HIST_LO) / HIST_W)) - 1})
                          AS BIGINT) AS bin
      FROM (SELECT 'y_true' AS series, y_true AS v FROM preds UNION ALL SELECT 'y_pred', y_pred FROM preds)
      WHERE v >= {HIST_LO} AND v <= {HIST_HI})
    GROUP BY series, bin""", "stream", extra=BAR_MODEL_SQL))
def eval_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-width histogram of actual and predicted returns together."""
    h = evaluate.histogram(bar_model_predictions(spark, sf_dir), ["y_true", "y_pred"], HIST_LO, HIST_HI, HIST_W)
    return h.select("series", F.col("bin").cast("long").alias("bin"), "count", _r("bin_lo").alias("bin_lo"))


DENSITY_BINS = 20


@query("eval_density", with_fixtures(f"""
    SELECT s.epic, s.series, s.bin, round(s.lo + s.bin * ((s.hi - s.lo) / {DENSITY_BINS}), 6) AS bin_lo,
           count(v.epic) AS count,
           round(coalesce(count(v.epic) / nullif(sum(count(v.epic)) OVER (PARTITION BY s.epic, s.series)
                          * ((s.hi - s.lo) / {DENSITY_BINS}), 0), 0), 6) AS density
    FROM (SELECT epic, lo, hi, series, bin FROM b, (SELECT unnest(['r', 'r2']) AS series),
          (SELECT unnest(range({DENSITY_BINS})) AS bin)) s
    LEFT JOIN binned v ON v.epic = s.epic AND v.series = s.series AND v.bin = s.bin
    GROUP BY s.epic, s.series, s.bin, s.lo, s.hi""", "stream", extra=f"""
    tgt AS (SELECT * FROM (
              SELECT epic, bid_open_f1 / ask_open AS r, bid_open_f2 / ask_open AS r2,
                     row_number() OVER (PARTITION BY epic ORDER BY updated_at, seq) - 1 AS i, count(*) OVER (PARTITION BY epic) AS n
              FROM (SELECT *, lead(bid_open, 1) OVER w AS bid_open_f1, lead(bid_open, 2) OVER w AS bid_open_f2
                    FROM stream WINDOW w AS (PARTITION BY epic ORDER BY updated_at, seq))
              WHERE bid_open_f2 IS NOT NULL)),
    b AS (SELECT epic, quantile_cont(r, 0.01) AS lo, quantile_cont(r, 0.99) AS hi FROM tgt
          WHERE i >= floor(n * {TEST_FRACTION}) GROUP BY epic),
    binned AS (SELECT t.epic, series, CAST(least(floor((t.v - b.lo) / ((b.hi - b.lo) / {DENSITY_BINS})), {DENSITY_BINS - 1}) AS BIGINT)
                          AS bin
               FROM (SELECT epic, 'r' AS series, r AS v FROM tgt UNION ALL SELECT epic, 'r2', r2 FROM tgt) t
               JOIN b USING (epic) WHERE t.v >= b.lo AND t.v <= b.hi)"""))
def eval_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Densities of the one- and two-bar returns over one range, the 1%-99%
    range of the training rows' one-bar return; every bin present (A13)."""
    s = features.future_bids(fixtures.stream(spark, sf_dir), 2)
    s = features.return_target(features.return_target(s), horizon=2, alias="r2").filter(F.col("r2").isNotNull())
    # the range, the counts and the bins all read the split rows
    rows = materialize(chronological_split(s).select("epic", "split", "r", "r2"))
    d = evaluate.density(rows, ["r", "r2"], DENSITY_BINS, 0.01, 0.99, ["epic"], range_rows=F.col("split") == "train")
    return d.select("epic", "series", "bin", _r("bin_lo").alias("bin_lo"), "count", _r("density").alias("density"))


# ---------------------------------------------------------------- trends and rolling forecasts


@query("trend_linear", with_fixtures("""
    SELECT Name, count(*) AS n, round(regr_slope(Open, idx), 4) AS slope, round(regr_intercept(Open, idx), 2) AS intercept,
           round(regr_intercept(Open, idx) + regr_slope(Open, idx) * count(*), 2) AS next_forecast
    FROM (SELECT *, row_number() OVER (PARTITION BY Name ORDER BY Date) - 1 AS idx FROM daily_prices)
    GROUP BY Name""", "daily_prices"))
def trend_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least-squares line through each daily series and its next value (M6)."""
    d = fixtures.daily_prices(spark, sf_dir)
    idx = series.with_row_index(d.withColumn("_t", F.col("Date").cast("timestamp")), ["Name"], ["Date"], time_col="_t")
    fit = modeling.simple_ols(idx.withColumn("x", F.col(series.IDX).cast("double")), "x", "Open", ["Name"])
    return fit.select("Name", F.col("n").cast("long").alias("n"), F.round("slope", 4).alias("slope"),
                      F.round("intercept", 2).alias("intercept"),
                      F.round(F.col("intercept") + F.col("slope") * F.col("n"), 2).alias("next_forecast"))


def _cubic_sql(points: str) -> str:
    """Cubic least squares of ``points(g, t, y)`` by the closed solution of its
    three normal equations (sums about the means)."""
    det = "({0} * ({4} * {8} - {5} * {7}) - {1} * ({3} * {8} - {5} * {6}) + {2} * ({3} * {7} - {4} * {6}))".format
    a = ["a11", "a12", "a13", "a12", "a22", "a23", "a13", "a23", "a33"]
    swap = lambda k: [f"b{i // 3 + 1}" if i % 3 == k else x for i, x in enumerate(a)]
    sums = ", ".join(f"sum((pow(t, {i}) - m{i}) * (pow(t, {j}) - m{j})) AS a{i}{j}" for i in (1, 2, 3) for j in range(i, 4))
    sums += ", " + ", ".join(f"sum((pow(t, {i}) - m{i}) * (y - my)) AS b{i}" for i in (1, 2, 3))
    return f"""
    points AS ({points}),
    moments AS (SELECT g, count(*) AS n, avg(t) AS m1, avg(pow(t, 2)) AS m2, avg(pow(t, 3)) AS m3, avg(y) AS my FROM points GROUP BY g),
    normal AS (SELECT g, n, m1, m2, m3, my, {sums} FROM points JOIN moments USING (g) GROUP BY ALL),
    cubic AS (SELECT g, n, m1, m2, m3, my, {", ".join(f"{det(*swap(k))} / {det(*a)} AS c{k + 1}" for k in range(3))} FROM normal)"""


CUBIC_NEXT = "my + c1 * (1 - m1) + c2 * (1 - m2) + c3 * (1 - m3)"


@query("trend_cubic", with_fixtures(f"""
    SELECT g AS Name, n, round({CUBIC_NEXT}, 2) AS next_forecast, round(c1, 1) AS c1, round(c2, 1) AS c2, round(c3, 1) AS c3
    FROM cubic""", "daily_prices", extra=_cubic_sql("""
    SELECT Name AS g, Open AS y, (row_number() OVER (PARTITION BY Name ORDER BY Date) - 1) / count(*) OVER (PARTITION BY Name) AS t
    FROM daily_prices""")))
def trend_cubic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cubic trend per daily series and its next value."""
    d = fixtures.daily_prices(spark, sf_dir).withColumn("_t", F.col("Date").cast("timestamp"))
    out = forecast.polynomial_trend(d, "Open", ["Name"], ["_t"], degree=3)
    return out.select("Name", "n", F.round("next_forecast", 2).alias("next_forecast"),
                      *[F.round(F.col("coef")[i], 1).alias(f"c{i + 1}") for i in range(3)])


@query("trend_hours", with_fixtures(f"""
    SELECT g AS epic, n, round({CUBIC_NEXT}, 4) AS next_forecast FROM cubic""", "stream", extra=_cubic_sql("""
    SELECT epic AS g, bid_open AS y,
           floor((epoch(updated_at) - min(epoch(updated_at)) OVER w) / 3600)
             / (floor((max(epoch(updated_at)) OVER w - min(epoch(updated_at)) OVER w) / 3600) + 1) AS t
    FROM stream WINDOW w AS (PARTITION BY epic)""")))
def trend_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cubic trend over elapsed hours per instrument and its value one hour on."""
    out = forecast.polynomial_trend(fixtures.stream(spark, sf_dir), "bid_open", ["epic"], ["updated_at"], degree=3, hours=True)
    return out.select("epic", "n", F.round("next_forecast", 4).alias("next_forecast"))


LOOKBACKS = (3, 10, 15)  # fixed values: the stacked model's lookbacks


FOLDS = 5


def _eliminate(source: str, name: str, inputs: list[str], keep: list[str], group: str, taps: dict[int, str]) -> str:
    """CTEs that take ``inputs`` out of each other and out of ``y`` one by one
    (over the rows with ``fit``, per ``group``); what is left of ``y`` after
    the n-th is kept under the name in ``taps``. Centring comes first."""
    mean = ", ".join(f"{c} - avg({c}) FILTER (WHERE fit) OVER (PARTITION BY {group}) AS {c}" for c in [*inputs, "y"])
    ctes = [f"{name}0 AS (SELECT {', '.join(keep)}, {mean} FROM {source})"]
    carried: list[str] = []
    for j, x in enumerate(inputs):
        rest = [*inputs[j + 1:], "y"]
        # a direction that the earlier ones already span has (nearly) nothing left
        out = ", ".join(
            f"{c} - {x} * coalesce((sum({x} * {c}) FILTER (WHERE fit) OVER (PARTITION BY {group})) / "
            f"nullif(sum({x} * {x}) FILTER (WHERE fit) OVER (PARTITION BY {group}), 0), 0) AS {c}" for c in rest)
        before = ", ".join([*keep, *carried])
        ctes.append(f"{name}{j + 1}_ AS (SELECT {before}, {out} FROM {name}{j})")
        tap = f", y AS {taps[j + 1]}" if j + 1 in taps else ""
        ctes.append(f"{name}{j + 1} AS (SELECT *{tap} FROM {name}{j + 1}_)")
        if tap:
            carried.append(taps[j + 1])
    return ",\n".join(ctes)


def stacked_sql(scored: str | None = None) -> str:
    """The stacked model by elimination on the rows: every row is copied for
    each left-out fold and once for the fit on all rows (part -1). The bars of the
    table ``scored`` are scored by it too, as fold -2; they are in no fit, and
    their label is 0."""
    deepest = max(LOOKBACKS)
    lags = "".join(f", lag(ask_open, {i}) OVER w AS l{i}" for i in range(1, deepest + 1))
    fill = ", ".join(f"coalesce({', '.join(f'l{j}' for j in range(i, 0, -1))}, ask_open) / ask_open AS x{i}"
                     for i in range(1, deepest + 1))
    xs = [f"x{i}" for i in range(1, deepest + 1)]
    outs = [f"e{lb}" for lb in LOOKBACKS]
    ps = [f"p{lb}" for lb in LOOKBACKS]
    more = "" if scored is None else f"""
               UNION ALL
               SELECT epic, updated_at, seq, 0.0, {fill}, -2
               FROM (SELECT *{lags} FROM {scored} WINDOW w AS (PARTITION BY epic ORDER BY updated_at, seq))"""
    return f"""
    lagged AS (SELECT epic, updated_at, seq, ask_open, lead(bid_open, 1) OVER w / ask_open AS y{lags}
               FROM stream WINDOW w AS (PARTITION BY epic ORDER BY updated_at, seq)),
    filled AS (SELECT epic, updated_at, seq, y, {fill},
                      ntile({FOLDS}) OVER (PARTITION BY epic ORDER BY updated_at, seq) - 1 AS fold
               FROM lagged WHERE y IS NOT NULL{more}),
    copied AS (SELECT *, y AS label, fold <> part AND fold <> -2 AS fit
               FROM filled, (SELECT unnest(range(-1, {FOLDS})) AS part) WHERE fold <> -2 OR part = -1),
    {_eliminate("copied", "g", xs, ["epic", "updated_at", "seq", "fold", "part", "fit", "label"], "epic, part",
                dict(zip(LOOKBACKS, outs)))},
    means AS (SELECT epic, part, avg(label) AS m FROM copied WHERE fit GROUP BY epic, part),
    -- a prediction is the label less what is left of it
    based AS (SELECT c.epic, c.updated_at, c.seq, c.fold, c.part, c.label,
                     {", ".join(f"c.label - {e} AS {p}" for e, p in zip(outs, ps))}
              FROM g{deepest} c),
    second AS (SELECT epic, updated_at, seq, fold, label, label AS y, {", ".join(ps)}, part >= 0 AS fit
               FROM based WHERE part = fold OR part = -1),
    {_eliminate("second", "h", ps, ["epic", "updated_at", "seq", "fold", "fit", "label"], "epic", {len(ps): "left_over"})}"""


@query("stacked_forecast", with_fixtures(f"""
    SELECT epic, strftime(updated_at, {HOUR_TS}) AS updated_at, fold, round(label, 6) AS y,
           round(label - left_over, 6) AS stacked_pred
    FROM h{len(LOOKBACKS)} WHERE NOT fit""", "stream", extra=stacked_sql()))
def stacked_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stacked linear model over three lookbacks, one per instrument: base
    models on all rows, the final one over 5-fold out-of-fold predictions (M8, P14)."""
    pred, _ = forecast.stacked_regression(fixtures.stream(spark, sf_dir), LOOKBACKS, ["epic"], ["updated_at", "seq"], folds=FOLDS)
    return pred.select("epic", ts_text("updated_at").alias("updated_at"), F.col("fold").cast("long").alias("fold"),
                       _r("y", 6).alias("y"), _r("stacked_pred", 6).alias("stacked_pred"))


ROLL_LENGTHS = list(range(2, 10))


# regressions of the window functions themselves: nothing of the code under test
ROLL_SQL = f"""
    placed AS (SELECT *, row_number() OVER (PARTITION BY Name ORDER BY Date) - 1 AS i FROM daily_prices),
    roll AS (SELECT Name, Date, Open, {", ".join(
        f"CASE WHEN i >= {n} THEN regr_intercept(Open, i) OVER w{n} + i * regr_slope(Open, i) OVER w{n} END AS preds_{n}"
        for n in ROLL_LENGTHS)}
             FROM placed WINDOW {", ".join(
        f"w{n} AS (PARTITION BY Name ORDER BY Date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in ROLL_LENGTHS)})"""


def _rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fixtures.daily_prices(spark, sf_dir).withColumn("_t", F.col("Date").cast("timestamp"))
    return forecast.rolling_ols_forecasts(d, "Open", ROLL_LENGTHS, ["Name"], ["_t"])


@query("rolling_ols_forecast", with_fixtures(f"""
    SELECT Name, strftime(Date, '%Y-%m-%d') AS day, Open, {", ".join(f"round(preds_{n}, 5) AS preds_{n}" for n in ROLL_LENGTHS)}
    FROM roll""", "daily_prices", extra=ROLL_SQL))
def rolling_ols_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next-day least-squares forecast from the previous n days, n = 2..9."""
    r = _rolling(spark, sf_dir)
    return r.select("Name", format_day("Date").alias("day"), "Open",
                    *[F.round(f"preds_{n}", 5).alias(f"preds_{n}") for n in ROLL_LENGTHS])


@query("rolling_ols_errors", with_fixtures(f"""
    SELECT Name, CAST(substr(metric, 6) AS INTEGER) AS window_n, round(value, 2) AS mean_abs_error FROM (
      SELECT Name, {", ".join(f"avg(abs(preds_{n} - Open)) AS diff_{n}" for n in ROLL_LENGTHS)} FROM roll GROUP BY Name)
    UNPIVOT (value FOR metric IN ({", ".join(f"diff_{n}" for n in ROLL_LENGTHS)}))""", "daily_prices", extra=ROLL_SQL))
def rolling_ols_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute one-step error per window length: the smoothness score
    of each series (W8, P10, A6)."""
    e = forecast.forecast_errors(_rolling(spark, sf_dir), "Open")
    diffs = e.select("Name", e.colRegex("`diff_[0-9]+`"))
    means = diffs.groupBy("Name").agg(*[F.avg(c).alias(c) for c in diffs.columns if c != "Name"])
    long = evaluate.to_long(means, ["Name"], [c for c in means.columns if c != "Name"])
    return long.select("Name", F.substring("metric", 6, 3).cast("int").alias("window_n"),
                       F.round("value", 2).alias("mean_abs_error"))


@query("smoothness_ranking", with_fixtures(f"""
    SELECT window_n, Name, round(mean_abs_error, 2) AS mean_abs_error,
           dense_rank() OVER (PARTITION BY window_n ORDER BY round(mean_abs_error, 2)) AS smoothness_rank
    FROM (SELECT Name, CAST(substr(metric, 6) AS INTEGER) AS window_n, value AS mean_abs_error FROM (
            SELECT Name, {", ".join(f"avg(abs(preds_{n} - Open)) AS diff_{n}" for n in ROLL_LENGTHS)} FROM roll GROUP BY Name)
          UNPIVOT (value FOR metric IN ({", ".join(f"diff_{n}" for n in ROLL_LENGTHS)})))""",
                                           "daily_prices", extra=ROLL_SQL))
def smoothness_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruments ranked by how well a short line predicts them, per window
    length -- the reference's planned search for the smoothest series (W8)."""
    from pyspark.sql import Window
    err = rolling_ols_errors(spark, sf_dir)
    # one row per (series, window length): a small table
    w = Window.partitionBy("window_n").orderBy("mean_abs_error")
    return err.withColumn("smoothness_rank", F.dense_rank().over(w).cast("long"))


# ---------------------------------------------------------------- promotion of shadow models

DEPLOYED_LENGTH, SHADOW_LENGTH = 3, 8
BLOCK, REPLICATES, SEED, LEVEL = 20, 200, 1, 0.95


def _trade_sql(n: int) -> str:
    return f"CASE WHEN preds_{n} > before THEN 1 ELSE -1 END * CAST(CAST(Open AS DECIMAL(28, 2)) - CAST(before AS DECIMAL(28, 2)) AS DECIMAL(28, 2))"


@query("shadow_promotion", with_fixtures(f"""
    SELECT Name, any_value(n) AS n, round(any_value(total) / any_value(n), 4) AS mean_gain,
           round(quantile_cont(mean, {1 - LEVEL}), 4) AS lower, round(avg(CASE WHEN mean <= 0 THEN 1.0 ELSE 0.0 END), 6) AS p_value,
           quantile_cont(mean, {1 - LEVEL}) > 0 AS promote
    FROM (SELECT Name, rep, any_value(n) AS n, any_value(total) AS total, CAST(sum(gain) AS DOUBLE) / any_value(n) AS mean
          FROM picked GROUP BY Name, rep) GROUP BY Name""", "daily_prices", extra=ROLL_SQL + f""",
    told AS (SELECT *, lag(Open) OVER (PARTITION BY Name ORDER BY Date) AS before FROM roll),
    gains AS (SELECT Name, Date, {_trade_sql(SHADOW_LENGTH)} - {_trade_sql(DEPLOYED_LENGTH)} AS gain
              FROM told WHERE preds_{SHADOW_LENGTH} IS NOT NULL AND preds_{DEPLOYED_LENGTH} IS NOT NULL),
    placed_gains AS (SELECT Name, gain, row_number() OVER (PARTITION BY Name ORDER BY Date) - 1 AS at FROM gains),
    spans AS (SELECT Name, count(*) AS n, CAST(sum(gain) AS DOUBLE) AS total, least({BLOCK}, count(*)) AS size FROM gains GROUP BY Name),
    drawn AS (SELECT Name, n, total, rep, no,
                     CAST('0x' || md5('{SEED}:' || rep || ':' || no)[1:15] AS BIGINT) % (n - size + 1) AS first,
                     least(size, n - no * size) AS len
              FROM (SELECT *, unnest(range(0, (n - 1) // size + 1)) AS no
                    FROM (SELECT *, unnest(range(0, {REPLICATES})) AS rep FROM spans))),
    picked AS (SELECT d.Name, d.rep, d.n, d.total, g.gain FROM drawn d
               JOIN placed_gains g ON g.Name = d.Name AND g.at >= d.first AND g.at < d.first + d.len)"""))
def shadow_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deployed and a shadow trend model trade the same days; the shadow one is promoted
    when its gain holds in a paired moving-block bootstrap."""
    preds = materialize(_rolling(spark, sf_dir))
    lagged = features.shift_features(preds, past={"Open": 1}, keys=["Name"], order=["_t"])
    before = F.col(features.lag_columns("Open", 1)[-1])
    step = F.col("Open").cast("decimal(28,2)") - before.cast("decimal(28,2)")

    def profit(n: int):
        return (F.when(F.col(f"preds_{n}") > before, step).when(F.col(f"preds_{n}").isNotNull(), -step))
    trades = lagged.select("Name", "_t", profit(DEPLOYED_LENGTH).alias("deployed"), profit(SHADOW_LENGTH).alias("shadow"))
    out = promotion.paired_block_bootstrap(trades, ["Name"], ["_t"], "deployed", "shadow", BLOCK, REPLICATES, SEED, LEVEL)
    return out.select("Name", "n", _r("mean_gain", 4).alias("mean_gain"), _r("lower", 4).alias("lower"), _r("p_value").alias("p_value"), "promote")
