"""kNN forms agree; least squares matches the closed forms."""

import numpy as np
from pyspark.sql import functions as F

from barflow.operators import knn, modeling, forecast
from barflow.sources.tables import read_table

from conftest import SF_SMALL


def _emb(spark):
    return read_table(spark, SF_SMALL, "embeddings", ["vec_id", "embedding", "label"])


def test_knn_is_the_same_for_any_cut(spark):
    """Pivots and block sizes change the work, not the rows; duplicates tie."""
    e = _emb(spark).limit(400)
    e = e.unionByName(e.limit(60).withColumn("vec_id", F.col("vec_id") + 10_000))
    kw = dict(q_id="vec_id", t_id="vec_id", q_vec="embedding", t_vec="embedding", t_y="label")
    got = [{(r.q_id, r["rank"]): (r.t_id, round(r.distance, 9)) for r in
            knn.knn(e, e, 3, pivots=p, block_rows=b, **kw).collect()} for p, b in ((1, 10**6), (7, 60), (64, 25))]
    assert got[0] == got[1] == got[2] and len(got[0]) == 3 * e.count()


def test_knn_keys_of_two_instruments_stay_apart(spark):
    rows = [(k, i, [float(i), 1.0 if k == "a" else 50.0], float(i)) for k in "ab" for i in range(20)]
    df = spark.createDataFrame(rows, "epic string, seq long, vec array<double>, y double")
    nb = knn.knn(df, df, 2, q_id=["epic", "seq"], t_id=["epic", "seq"], t_y="y", pivots=4)
    assert nb.count() == 80 and nb.filter("epic <> t_epic").count() == 0
    own = knn.knn_predict(nb, ["epic", "seq"])
    assert own.count() == 40


def test_knn_without_training_rows_finds_nothing(spark):
    e = _emb(spark)
    assert knn.knn(e, e.limit(0), 3, q_id="vec_id", t_id="vec_id", q_vec="embedding", t_vec="embedding").count() == 0


def test_knn_matches_numpy_brute_force(spark):
    pdf = _emb(spark).toPandas()
    m = np.stack(pdf.embedding.map(lambda v: np.asarray(v, float)))
    d = np.sqrt(((m[:, None, :] - m[None, :, :]) ** 2).sum(-1))
    ids = pdf.vec_id.to_numpy()
    expect = {}
    for i, q in enumerate(ids):
        order = np.lexsort((ids, d[i]))[:3]
        expect[int(q)] = [int(ids[j]) for j in order]
    got = {}
    nb = knn.knn(_emb(spark), _emb(spark), 3, q_id="vec_id", t_id="vec_id", q_vec="embedding", t_vec="embedding")
    for r in nb.orderBy("q_id", "rank").collect():
        got.setdefault(r.q_id, []).append(r.t_id)
    assert got == expect


def test_ols_fit_matches_regr_slope_and_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    y = 1.5 + x @ np.array([2.0, -3.0]) + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    fit = modeling.ols_fit(df, ["a", "b"], "y").first()
    ref = np.linalg.lstsq(np.c_[np.ones(200), x], y, rcond=None)[0]
    assert np.allclose([fit.intercept, *fit.coef], ref, atol=1e-9)
    one = modeling.ols_fit(df, ["a"], "y").first()
    s = modeling.simple_ols(df, "a", "y").first()
    assert abs(one.coef[0] - s.slope) < 1e-9 and abs(one.intercept - s.intercept) < 1e-9
    assert abs(one.r2 - s.r2) < 1e-9
    resid = y - np.c_[np.ones(200), x] @ ref
    assert abs(fit.r2 - (1 - (resid ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-9


def test_polynomial_trend_recovers_exact_cubic(spark):
    import datetime as dt
    n = 40
    rows = []
    for i in range(n):
        t = i / n
        rows.append(("s", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), 2 + 3 * t - t ** 2 + 0.5 * t ** 3))
    df = spark.createDataFrame(rows, "k string, d timestamp, y double")
    out = forecast.polynomial_trend(df, "y", ["k"], ["d"]).first()
    assert abs(out.next_forecast - (2 + 3 - 1 + 0.5)) < 1e-6


def test_stacked_model_equals_row_by_row_fits(spark):
    """Against least squares on the rows: out-of-fold fits, the final fit on
    their predictions, base fits on all rows; and it scores rows without a label."""
    rng = np.random.default_rng(11)
    n, folds, lookbacks = 83, 5, (1, 3)
    x = 1 + rng.normal(scale=0.05, size=(n, 3))
    y = 0.3 + x @ [0.5, -0.2, 0.4] + rng.normal(scale=0.01, size=n)
    fold = np.sort(np.arange(n) % folds)
    rows = [("a", x[i].tolist(), float(y[i]), int(fold[i])) for i in range(n)] + [(None, x[i].tolist(), float(x[i, 0]), int(fold[i]))
                                                                                 for i in range(n)]
    df = spark.createDataFrame(rows, "k string, x array<double>, y double, fold int")
    model = forecast.stacked_fit(df, lookbacks, "y", ["k"])
    line = lambda a, b: np.linalg.lstsq(np.column_stack([a, np.ones(len(a))]), b, rcond=None)[0]
    use = lambda w, a: np.column_stack([a, np.ones(len(a))]) @ w
    oof = np.zeros((n, 2))
    for f in range(folds):
        for j, lb in enumerate(lookbacks):
            oof[fold == f, j] = use(line(x[fold != f, :lb], y[fold != f]), x[fold == f, :lb])
    final = line(oof, y)
    want = use(final, np.column_stack([use(line(x[:, :lb], y), x[:, :lb]) for lb in lookbacks]))
    new = spark.createDataFrame([(r[0], r[1], i) for i, r in enumerate(rows)], "k string, x array<double>, i int")
    got = {r.i: r.stacked_pred for r in forecast.stacked_predict(new, model, ["k"]).collect()}
    assert np.allclose([got[i] for i in range(n)], want, atol=1e-8)
    assert np.allclose([got[n + i] for i in range(n)], x[:, 0], atol=1e-8)


def test_stacked_fold_sizes_match_ntile(spark):
    from pyspark.sql import Window
    from barflow.operators import features
    from barflow.plans import fixtures
    from conftest import SF_MID
    s = features.return_target(features.future_bids(fixtures.stream(spark, SF_MID), 1), alias="y")
    pred, final = forecast.stacked_regression(fixtures.stream(spark, SF_MID), (3, 10), ["epic"], ["updated_at", "seq"])
    got = pred.groupBy("epic", "fold").count()
    base = s.filter(F.col("y").isNotNull())
    ref = (base.withColumn("fold", F.ntile(5).over(Window.partitionBy("epic").orderBy("updated_at", "seq")) - 1)
           .groupBy("epic", "fold").count())
    assert got.exceptAll(ref).count() == 0
    models = final.collect()
    assert len(models) == s.select("epic").distinct().count()
    assert all(len(m.bases) == 2 and len(m.final) == 3 and len(m.coef) == 10 for m in models)


def test_exact_quantiles_equal_builtin_percentile(spark):
    from barflow.operators import evaluate
    rng = np.random.default_rng(7)
    rows = [("hot", float(v)) for v in rng.integers(0, 50, size=3000)]  # many ties, one big group
    rows += [("cold", float(v)) for v in rng.normal(size=37)]
    rows += [("one", 4.0)]
    rows += [("outlier", float(v)) for v in rng.normal(size=400)] + [("outlier", 1e9), ("outlier", -1e9)]
    df = spark.createDataFrame(rows, "g string, v double")
    levels = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    for chunks in (1, 3, 256):
        got = {(r.g, r.level): r.value for r in evaluate.exact_quantiles(df, "v", levels, ["g"], chunks).collect()}
        ref = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(x) for x in levels])).alias("q")).collect()
        for r in ref:
            for lv, val in zip(levels, r.q):
                assert abs(got[(r.g, lv)] - val) < 1e-9, (chunks, r.g, lv)


def test_function_step_in_ml_pipeline(spark):
    from pyspark.ml import Pipeline
    from barflow.operators import features
    from barflow.operators.modeling import FunctionStep
    df = spark.createDataFrame([("E", i, 10.0 + i) for i in range(6)], "epic string, seq long, ask_open double") \
        .withColumn("updated_at", F.timestamp_seconds(F.col("seq") * 60))
    pipe = Pipeline(stages=[FunctionStep(features.model_features, {"past_periods": 2}),
                            FunctionStep(lambda d: d.filter(F.col("ask_open_p2") > 0))])
    out = pipe.fit(df).transform(df).orderBy("seq").collect()
    assert [r.seq for r in out] == [2, 3, 4, 5] and abs(out[0].ask_open_p1 - 11.0 / 12.0) < 1e-12


def test_observe_shape_counts_during_the_action(spark):
    from barflow.operators.evaluate import observe_shape
    df, get = observe_shape(_emb(spark), "emb_shape")
    df.write.format("noop").mode("overwrite").save()
    assert get() == (500, 3)


def test_top_k_kernel_tie_rule():
    from barflow.operators.knn import _top_k
    rng = np.random.default_rng(0)
    q, t = rng.integers(0, 3, size=(30, 2)).astype(float), rng.integers(0, 3, size=(60, 2)).astype(float)
    rows, cols, dist = (np.concatenate(x) for x in zip(*_top_k(q, t, 4, budget=500)))
    d = np.sqrt(((q[:, None] - t[None]) ** 2).sum(-1))
    for i in range(30):  # equal distances: the smaller place wins
        expect = np.lexsort((np.arange(60), d[i]))[:4]
        assert list(cols[rows == i]) == list(expect) and np.allclose(dist[rows == i], d[i][expect])


def test_report_limits_are_exact(spark):
    """Quantile limits interpolate between the two middle values, as the run log's do."""
    from barflow.operators import evaluate
    rows = [("a", float(i * i), 0.5, i) for i in range(11)] + [("b", 3.0, 0.5, 0), (None, 1.0, 0.5, 0), (None, 2.0, 0.5, 1)]
    preds = spark.createDataFrame(rows, "split string, y_true double, y_pred double, updated_at long")
    got = {(r.split, r.metric): float(r.value) for r in evaluate.report(preds, 0.4, levels=(0.25, 0.9)).filter("value is not null").collect()}
    assert got["a", "quantile_0.25"] == 6.5 and got["a", "quantile_0.9"] == 81.0
    assert got["b", "quantile_0.9"] == 3.0 and got[None, "quantile_0.25"] == 1.25 and got["a", "n"] == 11


def test_knn_tree_compares_few_pairs_and_loses_none():
    """200,000 rows in three dimensions: fewer than a tenth of all pairs are compared, no neighbour lies in a leaf left out."""
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.normal(size=(140_000, 3)), np.tile([0.5, 0.5, 0.5], (60_000, 1))])
    tree = knn.PivotTree.of(rng.permutation(np.unique(rows, axis=0))[:len(rows) // knn.LEAF_ROWS])
    leaf, own, upper = tree.leaf_of(rows)
    n = len(tree.pivots)
    ring = []
    for d in (own, upper):
        least, most = np.full(n, np.inf), np.zeros(n)
        np.minimum.at(least, leaf, d)
        np.maximum.at(most, leaf, d)
        ring += [least, most]
    tree = knn.PivotTree(tree.pivots, tree.parent, np.bincount(leaf, minlength=n), *ring)
    asked = rows[rng.choice(len(rows), 300, replace=False)]
    home, _, _ = tree.leaf_of(asked)
    k, pairs = 3, int(tree.rows[home].sum())
    every = np.stack([np.sqrt(((rows - q) ** 2).sum(1)) for q in asked])
    kth = np.sort(every, 1)[:, k - 1]
    bound = np.array([np.sort(every[i, leaf == home[i]])[k - 1] if tree.rows[home[i]] >= k else np.inf for i in range(len(asked))])
    assert (tree.promised(asked, k) >= kth - 1e-9).all()
    bound = np.minimum(bound, tree.promised(asked, k))
    seen = {(i, int(home[i])) for i in range(len(asked))}
    for i, cell in tree.visits(asked, bound):
        seen.update(zip(i.tolist(), cell.tolist()))
        pairs += int(tree.rows[cell].sum())
    for i in range(len(asked)):
        for j in np.unique(leaf[every[i] <= kth[i]]):
            assert (i, int(j)) in seen
    hot = (asked == 0.5).all(1)
    cold = sum(int(tree.rows[j]) for i, j in seen if not hot[i])
    print("share", pairs / every.size, "of the others", cold / (every.shape[1] * (~hot).sum()))
    assert cold < 0.1 * every.shape[1] * (~hot).sum()


def test_knn_blocks_equal_brute_force_far_from_zero():
    """The matrix product only leaves out: distances, ties and copies as by differences, also where the products cancel."""
    rng = np.random.default_rng(5)
    for offset, width in ((0.0, 64), (1e6, 3), (-999.0, 1)):
        t = offset + np.concatenate([rng.normal(size=(400, width)), rng.integers(0, 2, (300, width)), np.full((500, width), 0.25)])
        q = np.concatenate([t[::7], offset + rng.normal(size=(50, width))])
        cell = rng.integers(0, 6, len(t))
        leaves = [rng.choice(8, rng.integers(1, 6), replace=False) for _ in q]
        limit = np.where(rng.random(len(q)) < 0.5, np.inf, 0.4 * np.sqrt(width))
        i, j, d = knn._nearest(q, leaves, limit, t, cell, 3)
        for n in range(len(q)):
            e = np.sqrt(((t - q[n]) ** 2).sum(1))
            want = [x for x in np.lexsort((np.arange(len(t)), e)) if cell[x] in leaves[n]][:3]
            want = [x for x in want if e[x] <= limit[n]]
            have = j[i == n].tolist()
            assert have[:len(want)] == want and np.allclose(d[i == n][:len(want)], e[want])


def test_knn_sends_a_query_once_to_a_group_of_leaves():
    """Vectors without neighbours need nearly all leaves, but a block of 20,000 rows is one row for them."""
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(20_000, 64))
    tree = knn.PivotTree.of(rows[:200])
    leaf, own, upper = tree.leaf_of(rows)
    ring = [f(x[leaf == n]) for x in (own, upper) for f in (np.min, np.max) for n in range(200)]
    tree = knn.PivotTree(tree.pivots, tree.parent, np.bincount(leaf, minlength=200), *np.array(ring).reshape(4, 200))
    group, blocks = knn._groups(tree, 5_000)
    assert max(np.bincount(group, tree.rows)) <= 5_000 and 4 <= len(blocks) <= 8 and set(blocks) == {1}
    asked, bound = rng.normal(size=(500, 64)), np.full(500, 9.0)
    pairs = [(i, n) for i, leaf in tree.visits(asked, bound) for i, n in zip(i.tolist(), leaf.tolist())]
    sent = [(i, g, n) for i, g, n in ((i, g, x) for a, b, c in knn._asked(group, bound, asked, tree, 30_000)
                                      for i, g, x in zip(a.tolist(), b.tolist(), c))]
    assert len(pairs) > 50_000 and len(sent) == len({x[:2] for x in sent}) <= 500 * len(blocks)
    assert sorted(pairs) == sorted((i, int(x)) for i, g, n in sent for x in n) and all((group[n] == g).all() for _, g, n in sent)


def test_knn_tasks_hold_small_arrays():
    """Numbers held at a time don't grow with the children of a node, the leaves asked for or the rows of a group."""
    import tracemalloc
    from barflow.operators import knn
    r = np.random.default_rng(8)
    points, queries = r.normal(size=(1_000, 64)), r.normal(size=(200, 64))

    def peak(run):
        tracemalloc.start()
        out = run()
        mb = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        return mb, out
    d = knn._distances(queries[:4], points)
    mb, least = peak(lambda: knn._beyond(d, points))
    own = d.argmin(1)
    apart = np.linalg.norm(points[own][:, None] - points[None], axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        want = np.nan_to_num((d ** 2 - d.min(1)[:, None] ** 2) / (2 * apart), nan=0.0)
    assert np.allclose(least, want) and mb < 20
    rows = r.normal(size=(20_000, 64))
    cell = (np.arange(len(rows)) % 20).astype(np.int32)
    leaves = [np.arange(20, dtype=np.int32)] * len(queries)
    mb, (i, j, dist) = peak(lambda: knn._nearest(queries, leaves, np.full(len(queries), np.inf), rows, cell, 3))
    for q in range(0, len(queries), 40):
        exact = np.linalg.norm(rows - queries[q], axis=1)
        assert j[i == q].tolist() == exact.argsort()[:3].tolist() and np.allclose(dist[i == q], np.sort(exact)[:3])
    assert mb < 20
    mb, _ = peak(lambda: list(knn.PivotTree.of(points).visits(queries, np.full(len(queries), 1.0))))
    assert mb < 20
