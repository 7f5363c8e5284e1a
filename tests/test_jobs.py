"""The run-mode jobs write their tables."""

import tempfile

from pyspark.sql import functions as F

from barflow import jobs
from barflow.operators import knn
from barflow.plans import fixtures

from conftest import SF_SMALL


def test_history_job_adds_only_new_buckets(spark):
    out = tempfile.mkdtemp(prefix="barflow-jobs-")
    ticks = fixtures.raw_stream(spark, SF_SMALL)
    cut = ticks.selectExpr("date_trunc('day', percentile_approx(updated_at, 0.5))").first()[0]
    jobs.history_job(spark, ticks.filter(F.col("updated_at") < F.lit(cut)), out, "2024-02-10")
    n = spark.read.parquet(f"{out}/history").count()
    got = jobs.history_job(spark, ticks, out, "2024-02-20")  # the stored buckets stay, the others come
    assert n < got["history"].count() == ticks.count()
    assert [str(r.fetch_end) for r in got["next_buckets"].select("fetch_end").distinct().collect()] == ["2024-02-19"]
    assert got["coverage_2h"].agg(F.sum("n_ticks")).first()[0] == ticks.count()


def test_train_stores_a_model_that_the_live_job_loads(spark):
    out = tempfile.mkdtemp(prefix="barflow-jobs-")
    bars = fixtures.stream(spark, SF_SMALL)
    epic = bars.select(F.min("epic")).first()[0]
    all_, one = jobs.train_job(spark, bars, out, 3, 3), jobs.train_job(spark, bars, out, 5, 3, instrument=epic)
    metrics = spark.read.parquet(f"{out}/run_metrics")
    assert metrics.select("run_id").distinct().count() == 2
    keys = {r.key for r in metrics.collect()}
    assert {"test_mae", "train_predicted_frequency", "test_actual_frequency", "train_first_time", "test_quantile_0.99"} <= keys
    assert spark.read.parquet(f"{out}/predictions").select("run_id").distinct().count() == 2
    models = jobs.load_models(spark, out, [(all_["run_id"], None), (one["run_id"], 0.8)])
    assert [(m["k"], m["r_threshold"], m["instrument"]) for m in models] == [(3, 1.0, None), (5, 0.8, epic)]
    near = knn.search(spark.read.parquet(f"{out}/matrix/{all_['run_id']}"), models[0]["fitted"], 3, jobs.ROW_KEY)
    again = knn.knn_predict(near, jobs.ROW_KEY)
    stored = all_["predictions"].select(*jobs.ROW_KEY, "y_pred")
    assert stored.count() == again.count() and stored.exceptAll(again).count() == 0
    ticks = fixtures.tick_stream(spark, SF_SMALL)
    tables = jobs.live_job(spark, ticks, out, [(all_["run_id"], 0.9), (one["run_id"], 0.8)], f"{out}/live")
    used = {(r.model_used, r.epic) for r in tables["positions"].collect()}
    assert {m for m, _ in used} == {"knn-reg-model-v1", "knn-reg-model-v2"} and {e for m, e in used if m.endswith("v2")} == {epic}


def test_models_of_all_kinds_run_in_one_loop(spark):
    """Stored kNN, linear and stacked models of different depths score the same
    stream; each position's forecast is the stored model's on the batch features."""
    from barflow.operators import scoring
    out = tempfile.mkdtemp(prefix="barflow-kinds-")
    bars = fixtures.stream(spark, SF_SMALL)
    runs = [jobs.train_job(spark, bars, out, 3, 4, model=m, lookbacks=(2, 5)) for m in ("knn", "linear", "stacked")]
    models = jobs.load_models(spark, out, [(r["run_id"], 0.5) for r in runs])
    assert [(m["kind"], m["past_periods"]) for m in models] == [("knn", 4), ("linear", 4), ("stacked", 5)]
    for r, m in zip(runs, models):
        rows = spark.read.parquet(f"{out}/matrix/{r['run_id']}")
        again = {(x.epic, x.updated_at, x.seq): x.y_pred for x in scoring.KINDS[m["kind"]].predict(rows, m["fitted"], k=3).collect()}
        stored = r["predictions"].collect()
        assert len(stored) == len(again) == rows.count()
        assert all(abs(again[x.epic, x.updated_at, x.seq] - x.y_pred) < 1e-9 for x in stored)
    folder = f"{out}/live"
    tables = jobs.live_job(spark, fixtures.tick_stream(spark, SF_SMALL), out, [(r["run_id"], 0.5) for r in runs], folder)
    got = tables["positions"].groupBy("model_used").count().collect()
    assert {x.model_used for x in got} == {"knn-reg-model-v1", "linear-reg-model-v2", "stacked-linear-reg-model-v3"}
    streamed = spark.read.parquet(f"{folder}/bars").drop("epoch")
    feats = scoring.ratio_vectors(streamed, 5)
    want = scoring.KINDS["stacked"].predict(feats, models[2]["fitted"]).withColumnRenamed("updated_at", "buy_date")
    both = tables["positions"].filter("model_used LIKE 'stacked%'").withColumnRenamed("y_pred", "p").join(want, ["epic", "buy_date"])
    assert both.count() > 0 and both.filter("abs(p - y_pred) > 1e-9").count() == 0


def test_the_checkpoint_folder_is_asked_for_off_local_mode(monkeypatch):
    import pytest
    from barflow import session

    class Fake:
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return {}
        conf = {}
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Fake)
    assert session.is_local("local[4]") and session.is_local("local") and not session.is_local("local-cluster[2,1,1024]")


def test_release_materialized_removes_only_written_intermediates(spark):
    import os
    from pyspark.sql import functions as F
    from barflow.session import materialize, release_materialized, _MATERIALIZED
    release_materialized(spark)
    t = materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    path = _MATERIALIZED[-1]
    assert t.count() == 10 and os.path.exists(path.replace("file:", ""))
    assert release_materialized(spark) == 1
    assert not os.path.exists(path.replace("file:", ""))
