"""Batch and streaming jobs: the three run modes of the reference as Spark jobs.

    python -m barflow.jobs history --ticks DIR --out DIR --source NAME [--resolution 1m] [--as-of 2024-02-10]
    python -m barflow.jobs train   --bars DIR --out DIR [--model knn|linear|stacked] [--instrument EPIC] [--k 3] [--past-periods 3]
                           [--lookbacks 3,10,15] [--threshold 1.0]
    python -m barflow.jobs live    --ticks DIR --models DIR --out DIR --run ID[:THRESHOLD] [--run ...] [--delay "10 minutes"]

``--ticks`` holds Parquet files with ``epic, updated_at, seq, bid_open,
ask_open, market_state``, ``--bars`` with ``epic, updated_at, seq, bid_open,
ask_open``; the job functions take any DataFrames of these columns. ``train``
stores the fitted model with its kind under its run id in ``--out``, and ``live``
loads it from there; a loop may run models of different kinds. On a cluster all folders are shared paths, and checkpoints go to the
session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators import bars as bar_ops
from barflow.operators import evaluate, scoring
from barflow.operators.scoring import ROW_KEY, training_matrix  # noqa: F401
from barflow.sources import files
from barflow.sources.tables import read_or_empty

HISTORY = T.StructType([T.StructField(c, t) for c, t in (
    ("instrument", T.StringType()), ("updated_at", T.TimestampType()), ("seq", T.LongType()), ("bid_open", T.DoubleType()),
    ("ask_open", T.DoubleType()), ("source", T.StringType()), ("resolution", T.StringType()), ("bucket_range", T.StringType()),
    ("bucket", T.StringType()))])


def history_job(spark: SparkSession, ticks: DataFrame, out: str, as_of: str, source: str = "broker",
                resolution: str = "1m") -> dict[str, DataFrame]:
    """Refresh: append the day buckets that aren't stored yet (S3, S4), and
    write the compacted history (S6), the next ranges to fetch after it (S5) and
    its two-hour coverage (W12)."""
    day = F.to_date("updated_at")
    rows = ticks.select(F.col("epic").alias("instrument"), F.col("updated_at").cast("timestamp").alias("updated_at"), "seq",
                        "bid_open", "ask_open", F.lit(source).alias("source"), F.lit(resolution).alias("resolution"),
                        F.concat_ws("_to_", F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy-MM-dd")).alias("bucket_range"),
                        files.bucket_path(F.lit(source), F.col("epic"), F.lit(resolution), day, day).alias("bucket"))
    root = f"{out}/buckets"
    stored = read_or_empty(spark, root, HISTORY).select("bucket").distinct()
    files.snapshot(stored, f"{out}/manifest_before")  # apart from the folder that is appended to
    files.write_buckets(rows, root, spark.read.parquet(f"{out}/manifest_before"))
    history = files.compact(spark, root, HISTORY, ["instrument", "updated_at", "seq"])
    results = {"history": history.drop("bucket", "bucket_range"),
               "next_buckets": files.next_ranges(history, F.lit(as_of)),
               "coverage_2h": bar_ops.bucket_counts(history, 7200, keys=("instrument",), count_col="n_ticks")}
    for name, df in results.items():
        files.snapshot(df, f"{out}/{name}")
    return {name: spark.read.parquet(f"{out}/{name}") for name in results}


def train_job(spark: SparkSession, bars: DataFrame, out: str, k: int, past_periods: int, threshold: float = 1.0,
              instrument: str | None = None, model: str = "knn", lookbacks: Sequence[int] = (3, 10, 15)) -> dict[str, DataFrame]:
    """Training run on one instrument's bars (all, where none is named): a
    model of the kind ``model``, stored under the run id (M9), predictions, and the run
    log (S15) with the evaluation report per split (M13). ``knn`` takes ``k`` and
    ``past_periods``, ``linear`` ``past_periods``, ``stacked`` ``lookbacks``."""
    kind = scoring.KINDS[model]
    lookbacks = list(lookbacks) if model == "stacked" else [past_periods]
    depth = max(lookbacks)
    name = f"knn-k{k}-p{depth}" if model == "knn" else f"{model}-p{'-'.join(map(str, lookbacks))}"
    run_id = f"{name}-{uuid.uuid4().hex[:8]}"
    own = bars if instrument is None else bars.filter(F.col("epic") == F.lit(instrument))
    files.snapshot(kind.matrix(own, depth), f"{out}/matrix/{run_id}")
    rows = spark.read.parquet(f"{out}/matrix/{run_id}")
    fitted = kind.fit(rows.filter(F.col("split") == "train"), lookbacks=lookbacks)
    stored = scoring.save(spark, model, fitted, f"{out}/models/{run_id}")
    preds = rows.join(kind.predict(rows, stored, k=k), ROW_KEY).drop("vec")
    files.snapshot(preds.withColumn("run_id", F.lit(run_id)), f"{out}/predictions", partition_cols=["run_id"])
    preds = spark.read.parquet(f"{out}/predictions").filter(F.col("run_id") == run_id)
    report = evaluate.report(preds, threshold, group_cols=["split"])
    metrics_log = report.select(F.lit(run_id).alias("run_id"), F.concat_ws("_", "split", "metric").alias("key"), "value")
    params = {"model": model, "k": k, "past_periods": depth, "lookbacks": ",".join(map(str, lookbacks)),
              "r_threshold": threshold, "instrument": instrument or ""}
    params_log = spark.createDataFrame([(run_id, key, str(v)) for key, v in params.items()],
                                       "run_id string, key string, value string")
    files.append(metrics_log, f"{out}/run_metrics")
    files.append(params_log, f"{out}/run_params")
    return {"run_id": run_id, "predictions": preds, "run_metrics": metrics_log, "run_params": params_log}


def load_models(spark: SparkSession, models: str, runs: list[tuple[str, float | None]]) -> list[dict]:
    """J9 + T14: the deployed configurations of the given runs, each with its
    stored model and kind, its parameters from the run log and (optionally) its own threshold."""
    wanted = [r for r, _ in runs]
    log = spark.read.parquet(f"{models}/run_params").filter(F.col("run_id").isin(wanted)).collect()  # a few keys per run
    params: dict[str, dict[str, str]] = {r: {} for r in wanted}
    for row in log:
        params[row["run_id"]][row["key"]] = row["value"]
    out = []
    for version, (run_id, threshold) in enumerate(runs, 1):
        p = params[run_id]
        if not p:
            raise ValueError(f"no run {run_id} in {models}/run_params")
        kind, fitted = scoring.load(spark, f"{models}/models/{run_id}")
        out.append({"model_name": scoring.KINDS[kind].label, "model_version": version, "run_id": run_id, "kind": kind,
                    "k": int(p["k"]), "past_periods": int(p["past_periods"]), "instrument": p["instrument"] or None,
                    "r_threshold": float(p["r_threshold"]) if threshold is None else threshold, "fitted": fitted})
    return out


def live_job(spark: SparkSession, ticks: DataFrame, models: str, runs: list[tuple[str, float | None]], out: str,
             width: str = "1 hour", delay: str = "0 seconds") -> dict[str, DataFrame]:
    """Live loop on a stream of ticks with stored models: raw ticks kept,
    bars, positions, fills and outcomes per micro-batch, then the monitoring tables."""
    from barflow.streaming import live
    configs = load_models(spark, models, runs)
    live.run_ticks(spark, ticks, out)
    live.run_signals(spark, ticks, configs, width=width, delay=delay, out_dir=out)
    tables = live.monitoring_tables(spark, out)
    for name, df in tables.items():
        files.snapshot(df, f"{out}/monitor_{name}")
    return tables


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="barflow.jobs")
    ap.add_argument("job", choices=["history", "train", "live"])
    ap.add_argument("--ticks")
    ap.add_argument("--bars")
    ap.add_argument("--models")
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default="2024-02-10")
    ap.add_argument("--source", default="broker")
    ap.add_argument("--resolution", default="1m")
    ap.add_argument("--instrument")
    ap.add_argument("--model", choices=sorted(scoring.KINDS), default="knn")
    ap.add_argument("--lookbacks", type=lambda x: [int(n) for n in x.split(",")], default=[3, 10, 15])
    ap.add_argument("--k", type=int, default=3)
    ap.add_argument("--past-periods", type=int, default=3)
    ap.add_argument("--threshold", type=float, default=1.0)
    ap.add_argument("--width", default="1 hour")
    ap.add_argument("--delay", default="0 seconds")
    ap.add_argument("--run", action="append", default=[], help="run id, with its own threshold after a colon")
    a = ap.parse_args(argv)
    from barflow.session import get_session, release_materialized
    spark = get_session(app_name=f"barflow-{a.job}")
    try:
        if a.job == "history":
            history_job(spark, spark.read.parquet(a.ticks), a.out, a.as_of, a.source, a.resolution)
        elif a.job == "train":
            train_job(spark, spark.read.parquet(a.bars), a.out, a.k, a.past_periods, a.threshold, a.instrument,
                      a.model, a.lookbacks)
        else:
            schema = spark.read.parquet(a.ticks).schema
            runs = [(r.partition(":")[0], float(r.partition(":")[2]) if ":" in r else None) for r in a.run]
            live_job(spark, spark.readStream.schema(schema).parquet(a.ticks), a.models, runs, a.out, a.width, a.delay)
    finally:
        # every output is written; the intermediates in the checkpoint folder go
        release_materialized(spark)


if __name__ == "__main__":
    main()
