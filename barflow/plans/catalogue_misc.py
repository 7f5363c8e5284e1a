"""Catalogue: history layouts, stream items, JSON updates, lookups, sheets, runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow import schemas
from barflow.functions import scalar
from barflow.functions.scalar import ts_text
from barflow.operators import evaluate, features
from barflow.plans import fixtures
from barflow.plans.catalogue_models import (BAR_MODEL_SQL, bar_model_neighbours, bar_model_rows,
                                           predictions_for)
from barflow.plans.registry import query, with_fixtures
from barflow.sources import files
from barflow.sources.tables import read_or_empty, read_table, sql_text
from barflow.streaming import live

MICRO = "'%Y-%m-%d %H:%M:%S.%f'"


def _r(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# ---------------------------------------------------------------- history


def _simple_history_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = fixtures.history_simple(spark, sf_dir)
    h = h.withColumn("datetime", scalar.parse_offset_timestamp("datetime"))
    return features.adapt_simple_history(h, "datetime", "open")


@query("history_compact", f"""
    SELECT * FROM (
      SELECT 'quotes' AS source, event_type AS instrument, strftime(ts + INTERVAL 5 HOUR, {MICRO}) AS updated_at,
             value AS bid_open, value AS ask_open FROM events
      UNION ALL
      SELECT 'broker', event_type, strftime(ts, {MICRO}), value, value + 0.5 FROM events)""")
def history_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories from two sources (zone-suffixed text times; nested ask/bid)
    compacted into one sorted table (S6, U1, F2, F5, P18, O1)."""
    quotes = _simple_history_parsed(spark, sf_dir).select(
        F.lit("quotes").alias("source"), "instrument", "updated_at", "bid_open", "ask_open")
    broker = features.adapt_nested_history(fixtures.history_nested(spark, sf_dir)).select(
        F.lit("broker").alias("source"), F.col("epic").alias("instrument"), "updated_at", "bid_open", "ask_open")
    allh = quotes.unionByName(broker, allowMissingColumns=True).orderBy("instrument", "updated_at", "source")
    return allh.select("source", "instrument", ts_text("updated_at", micros=True).alias("updated_at"),
                       "bid_open", "ask_open")


AS_OF_FETCH = "2024-02-10"
ALREADY_FETCHED = ("click", "signup")  # instruments whose planned range an earlier run has stored


@query("history_bucket_commits", """
    WITH h AS (SELECT event_id AS seq, event_type AS instrument, value AS open,
                      'training/quotes/' || lower(event_type) || '/1m/' || strftime(ts::DATE, '%Y-%m-%d') || '_to_'
                          || strftime(ts::DATE, '%Y-%m-%d') AS bucket FROM events)
    SELECT bucket, count(*) AS n, CAST(sum(CAST(round(open, 2) AS DECIMAL(18, 2))) AS DOUBLE) AS total, count(DISTINCT instrument) AS instruments
    FROM h GROUP BY bucket""")
def history_bucket_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily buckets written by two runs that overlap: each is committed once, by the run that
    came first, and read back whole (S3, S4)."""
    from barflow.sources.tables import read_table
    from barflow.streaming.live import stream_dir

    e = read_table(spark, sf_dir, "events", ["event_id", "event_type", "ts", "value"])
    day = F.to_date("ts")
    h = e.select(F.col("event_id").alias("seq"), F.col("event_type").alias("instrument"), F.col("value").alias("open"),
                 files.bucket_path(F.lit("quotes"), F.col("event_type"), F.lit("1m"), day, day).alias("bucket"))
    root = stream_dir(spark, "buckets")
    files.commit_buckets(h.filter(F.col("instrument").isin(*ALREADY_FETCHED)), root)
    files.commit_buckets(h, root)
    money = F.sum(F.round("open", 2).cast("decimal(18,2)")).cast("double")
    return files.read_buckets(spark, root, h.schema).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), money.alias("total"), F.count_distinct("instrument").alias("instruments"))


@query("history_new_buckets", f"""
    WITH h AS (SELECT event_type AS instrument, ts + INTERVAL 5 HOUR AS t FROM events),
    b AS (SELECT instrument, min(t)::DATE AS first_date, max(t)::DATE AS last_date FROM h GROUP BY instrument),
    r AS (SELECT *, last_date + 1 AS fetch_start, DATE '{AS_OF_FETCH}' - 1 AS fetch_end FROM b),
    m AS (SELECT DISTINCT 'training/quotes/' || lower(instrument) || '/1m/' || strftime(t::DATE, '%Y-%m-%d') || '_to_'
                 || strftime(t::DATE, '%Y-%m-%d') AS bucket FROM h
          UNION
          SELECT 'training/quotes/' || lower(instrument) || '/1m/' || strftime(fetch_start, '%Y-%m-%d') || '_to_'
                 || strftime(fetch_end, '%Y-%m-%d') FROM r WHERE instrument IN {ALREADY_FETCHED})
    SELECT instrument, strftime(first_date, '%Y-%m-%d') AS first_date, strftime(last_date, '%Y-%m-%d') AS last_date,
           strftime(fetch_start, '%Y-%m-%d') AS fetch_start, strftime(fetch_end, '%Y-%m-%d') AS fetch_end,
           CAST(epoch_ms(fetch_end::TIMESTAMP) - epoch_ms(fetch_start::TIMESTAMP) AS BIGINT) AS span_ms,
           'training/quotes/' || lower(instrument) || '/1m/' || strftime(fetch_start, '%Y-%m-%d') || '_to_'
               || strftime(fetch_end, '%Y-%m-%d') AS bucket
    FROM r WHERE fetch_start <= fetch_end
      AND 'training/quotes/' || lower(instrument) || '/1m/' || strftime(fetch_start, '%Y-%m-%d') || '_to_'
          || strftime(fetch_end, '%Y-%m-%d') NOT IN (SELECT bucket FROM m)""")
def history_new_buckets(spark: SparkSession, sf_dir: str, as_of: str = AS_OF_FETCH) -> DataFrame:
    """The next range to fetch per instrument from its high-water mark, minus
    buckets already loaded (S3, S4, S5, A3, F10, F17)."""
    h = _simple_history_parsed(spark, sf_dir)
    plan = files.next_ranges(h, F.lit(as_of))
    src, res = F.lit("quotes"), F.lit("1m")
    plan = plan.withColumn("bucket", files.bucket_path(src, F.col("instrument"), res, F.col("fetch_start"),
                                                       F.col("fetch_end")))
    day = F.to_date("updated_at")
    manifest = (h.select(files.bucket_path(src, F.col("instrument"), res, day, day).alias("bucket"))
                .unionByName(plan.filter(F.col("instrument").isin(*ALREADY_FETCHED)).select("bucket")).distinct())
    new = plan.join(manifest, "bucket", "left_anti")
    span = scalar.elapsed_millis(F.col("fetch_start").cast("timestamp"), F.col("fetch_end").cast("timestamp"))
    return new.select("instrument", *[scalar.format_day(c).alias(c) for c in
                                      ("first_date", "last_date", "fetch_start", "fetch_end")],
                      span.alias("span_ms"), "bucket")


# ---------------------------------------------------------------- stream items and JSON


def price_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw push-feed items as JSON text (what a Kafka value would carry)."""
    r = fixtures.raw_stream(spark, sf_dir)
    values = F.struct(F.date_format("updated_at", "HH:mm:ss").alias("UPDATE_TIME"), F.col("bid_open").alias("BID"),
                      F.col("ask_open").alias("OFFER"), F.col("market_state").alias("MARKET_STATE"))
    return r.select(F.to_json(F.struct("epic", "seq", F.date_format("updated_at", "yyyy-MM-dd").alias("trade_date"),
                                       values.alias("values"))).alias("item"))


@query("time_of_day_parsed", f"""
    SELECT event_type AS epic, event_id AS seq, strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated_at,
           value AS bid_open, value + 0.5 AS ask_open FROM events""")
def time_of_day_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items with a bare time of day become timestamps on their trade
    date (F6, T2)."""
    t = live.ticks_from_items(price_items(spark, sf_dir))
    return t.select("epic", "seq", ts_text("updated_at").alias("updated_at"), "bid_open", "ask_open")


def _k(col: str = "props"):
    return F.expr(f"try_cast(get_json_object({col}, '$.k') AS INT)")


def position_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position-update (OPU) documents as JSON text, with a nested list of
    affected deals, one per event."""
    return opu_documents(read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value", "props"]))


def opu_documents(ev: DataFrame) -> DataFrame:
    """The OPU text of each event row (batch or streaming input)."""
    k = _k()
    status = F.element_at(F.array(F.lit("OPENED"), F.lit("FULLY_CLOSED"), F.lit("PARTLY")), (k % 3) + 1)
    deals = F.transform(F.sequence(F.lit(1), k % 3),
                        lambda i: F.struct(F.concat(F.lit("A"), F.col("event_id").cast("string"), F.lit("-"),
                                                    i.cast("string")).alias("dealId"),
                                           F.lit("FULLY_CLOSED").alias("status")))
    doc = F.struct(
        F.concat(F.lit("D"), F.col("event_id").cast("string")).alias("dealId"),
        F.concat(F.lit("D"), F.col("event_id").cast("string")).alias("dealIdOrigin"),
        F.when(k % 2 == 0, F.lit("BUY")).otherwise(F.lit("SELL")).alias("direction"),
        F.col("event_type").alias("epic"), status.alias("status"), F.lit("ACCEPTED").alias("dealStatus"),
        F.col("value").alias("level"), k.cast("double").alias("size"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.when(k % 3 > 0, deals).alias("affectedDeals"))
    return ev.select(F.col("event_id").alias("seq"), F.to_json(doc).alias("opu"))


OPU_SCHEMA = T.StructType(schemas.OPU.fields + [T.StructField("affectedDeals", T.ArrayType(T.StructType([
    T.StructField("dealId", T.StringType()), T.StructField("status", T.StringType())])))])


@query("updates_parsed", """
    SELECT 'D' || event_id AS dealId, CASE WHEN k % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS direction,
           event_type AS epic, st AS status, value AS level, CAST(k AS DOUBLE) AS size,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS update_time,
           st IN ('AMENDED', 'DELETED', 'FULLY_CLOSED', 'UPDATED', 'OPENED', 'PARTIALLY_CLOSED') AS status_valid,
           CASE WHEN i IS NULL THEN NULL ELSE 'A' || event_id || '-' || i END AS affected_deal
    FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                 ['OPENED', 'FULLY_CLOSED', 'PARTLY'][TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 + 1] AS st
          FROM events) e
    LEFT JOIN LATERAL (SELECT unnest(range(1, e.k % 3 + 1)) AS i) ON TRUE""")
def updates_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position-update documents parsed, status checked against its enum and
    the affected-deals list exploded (empty list -> one row) (F15, F16, S10, T16)."""
    return parse_updates(position_updates(spark, sf_dir))


def parse_updates(updates: DataFrame, text_col: str = "opu") -> DataFrame:
    """F15 + F16: OPU JSON -> typed columns, status domain flag, one row per
    affected deal (an empty list keeps the update as one row). Stateless, so
    the same function serves a batch table and a ``readStream`` (S10/T16)."""
    p = updates.select(F.from_json(text_col, OPU_SCHEMA).alias("d")).select("d.*")
    p = p.withColumn("status_valid", scalar.in_domain("status", schemas.STATUS))
    e = p.select("*", F.explode_outer("affectedDeals").alias("_a"))
    return e.select("dealId", "direction", "epic", "status", "level", "size",
                    F.col("timestamp").alias("update_time"), "status_valid", F.col("_a.dealId").alias("affected_deal"))


MARKET_SCHEMA = T.StructType([
    T.StructField("instrument", T.StructType([T.StructField("epic", T.StringType()), T.StructField("name", T.StringType())])),
    T.StructField("dealingRules", T.StructType([T.StructField("minDealSize", T.StructType([
        T.StructField("unit", T.StringType()), T.StructField("value", T.DoubleType())]))])),
    T.StructField("snapshot", T.StructType([T.StructField("bid", T.DoubleType()), T.StructField("offer", T.DoubleType()),
                                            T.StructField("marketStatus", T.StringType())])),
])


def _markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq, size, m)``: a requested size and the market's nested document."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value", "props"])
    k = _k()
    doc = F.struct(
        F.struct(F.col("event_type").alias("epic"), F.upper("event_type").alias("name")).alias("instrument"),
        F.struct(F.struct(F.lit("POINTS").alias("unit"), ((k % 5) * 0.5).alias("value")).alias("minDealSize"))
        .alias("dealingRules"),
        F.struct(F.col("value").alias("bid"), (F.col("value") + 0.5).alias("offer"),
                 F.lit("TRADEABLE").alias("marketStatus")).alias("snapshot"))
    return ev.select(F.col("event_id").alias("seq"), k.cast("double").alias("size"),
                  F.from_json(F.to_json(doc), MARKET_SCHEMA).alias("m"))


@query("minimum_size_check", """
    SELECT event_id AS seq, event_type AS epic, (k % 5) * 0.5 AS min_deal_size, CAST(k AS DOUBLE) AS size,
           CAST(k AS DOUBLE) >= (k % 5) * 0.5 AS meets_minimum, value AS bid
    FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
def minimum_size_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requested size checked against the minimum nested in the market's document."""
    m = _markets(spark, sf_dir)
    # The rule needs one field of each record; they come from the same parsed
    # row, so no join is needed to put them side by side.
    mins = F.col("m.dealingRules.minDealSize.value")
    return m.select("seq", F.col("m.instrument.epic").alias("epic"), mins.alias("min_deal_size"), "size",
                    (F.col("size") >= mins).alias("meets_minimum"), F.col("m.snapshot.bid").alias("bid"))


def market_records(m: DataFrame, doc: str = "m", key: str = "seq") -> tuple[DataFrame, DataFrame, DataFrame]:
    """One market document -> its instrument, dealing-rules and snapshot
    records as three typed tables sharing ``key``."""
    return (m.select(key, f"{doc}.instrument.*"), m.select(key, f"{doc}.dealingRules.*"),
            m.select(key, f"{doc}.snapshot.*"))


@query("market_records", """
    WITH e AS (SELECT event_id AS seq, event_type, value, (TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 5) * 0.5 AS least FROM events)
    SELECT seq, 'instrument' AS record, event_type AS epic, upper(event_type) AS name, CAST(NULL AS VARCHAR) AS unit,
           CAST(NULL AS DOUBLE) AS min_deal_size, CAST(NULL AS DOUBLE) AS bid, CAST(NULL AS DOUBLE) AS offer, CAST(NULL AS VARCHAR) AS status FROM e
    UNION ALL SELECT seq, 'rules', NULL, NULL, 'POINTS', least, NULL, NULL, NULL FROM e
    UNION ALL SELECT seq, 'snapshot', NULL, NULL, NULL, NULL, value, value + 0.5, 'TRADEABLE' FROM e""")
def market_records_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instrument, dealing-rule and snapshot records of every market document, one row each."""
    instrument, rules, snapshot = market_records(_markets(spark, sf_dir))
    rules = rules.select("seq", F.col("minDealSize.unit").alias("unit"), F.col("minDealSize.value").alias("min_deal_size"))
    snapshot = snapshot.select("seq", "bid", "offer", F.col("marketStatus").alias("status"))
    parts = [df.withColumn("record", F.lit(name)) for name, df in (("instrument", instrument), ("rules", rules), ("snapshot", snapshot))]
    rows = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return rows.select("seq", "record", "epic", "name", "unit", "min_deal_size", "bid", "offer", "status")


# ---------------------------------------------------------------- lookups and sheets

NAMES = ["blue", "red w", "gi.mo"]  # alternation; '.' keeps its regex meaning


@query("company_lookup", with_fixtures(f"""
    SELECT Symbol, Name, translate(lower(Name), '. ', '__') AS name_clean,
           lower(Symbol) || '_' || translate(lower(Name), '. ', '__') AS key
    FROM company_list WHERE regexp_matches(Name, '{"|".join(NAMES)}')""", "company_list"))
def company_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies whose name matches any of several patterns, with cleaned
    names (F3, F4)."""
    c = fixtures.company_list(spark, sf_dir).filter(scalar.matches_any("Name", NAMES))
    return c.select("Symbol", "Name", scalar.clean_name("Name").alias("name_clean"),
                    F.concat_ws("_", F.lower("Symbol"), scalar.clean_name("Name")).alias("key"))


@query("sheet_import_clean", """
    SELECT 'P' || p_partkey AS period, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice END AS inflation
    FROM part""")
def sheet_import_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed sheet: skip the title rows, drop the first record, pick
    columns by position, rename, '[No data]' -> null -> number (S14, P17)."""
    sheet = fixtures.inflation_old(spark, sf_dir)
    rows = sheet.filter(F.col("source_row") >= fixtures.SHEET_HEADER_ROWS)
    first = rows.select(F.min("source_row")).scalar()
    body = rows.filter(F.col("source_row") > first)
    picked = body.select(body.columns[1], body.columns[3]).toDF("period", "inflation")
    return picked.withColumn("inflation", F.nullif(F.col("inflation"), F.lit("[No data]")).try_cast("double"))


# ---------------------------------------------------------------- run log and deployment

RUN_KS = (3, 5)
METRIC_KEYS = ["test_mean_absolute_error", "test_r2_score", "training_mean_absolute_error", "training_r2_score"]
PARAM_KEYS = ["k", "past_periods", "model_name"]


def run_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Params and metrics of one training run per configuration, as EAV rows."""
    params, metrics = None, None
    rows = bar_model_rows(spark, sf_dir)
    neighbours = bar_model_neighbours(rows, max(RUN_KS))  # one search serves every k
    for k in RUN_KS:
        run_id = f"knn-k{k}"
        p = predictions_for(rows, neighbours, k)
        m = evaluate.error_metrics(p, group_cols=["split"])
        wide = m.groupBy().pivot("split", ["test", "train"]).agg(F.first("mae").alias("mae"), F.first("r2").alias("r2"))
        wide = wide.select(F.lit(run_id).alias("run_id"),
                           F.col("test_mae").alias("test_mean_absolute_error"), F.col("test_r2").alias("test_r2_score"),
                           F.col("train_mae").alias("training_mean_absolute_error"),
                           F.col("train_r2").alias("training_r2_score"))
        ml = files.run_log_long(wide, "run_id", METRIC_KEYS)
        pl = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(str(k)).alias("k"),
                                   F.lit("3").alias("past_periods"), F.lit("knn-reg-model").alias("model_name"))
        pl = files.run_log_long(pl, "run_id", PARAM_KEYS)
        params = pl if params is None else params.unionByName(pl)
        metrics = ml if metrics is None else metrics.unionByName(ml)
    return params, metrics


def _runs_sql(k: int) -> str:
    return BAR_MODEL_SQL.replace("WHERE rank <= 3)", f"WHERE rank <= {k})").replace(
        "feat AS", f"feat_{k} AS").replace("FROM feat)", f"FROM feat_{k})").replace(
        "fs AS", f"fs_{k} AS").replace("FROM fs q, fs t", f"FROM fs_{k} q, fs_{k} t").replace(
        "FROM fs f", f"FROM fs_{k} f").replace("bnn AS", f"bnn_{k} AS").replace(
        "FROM bnn GROUP", f"FROM bnn_{k} GROUP").replace("preds AS", f"preds_{k} AS")


RUNS_SQL = ",\n".join(_runs_sql(k) for k in RUN_KS) + ",\n    metrics AS (" + " UNION ALL ".join(f"""
      SELECT 'knn-k{k}' AS run_id,
             avg(abs(y_true - y_pred)) FILTER (WHERE split = 'test') AS test_mean_absolute_error,
             1.0 - sum((y_true - y_pred) ^ 2) FILTER (WHERE split = 'test')
                   / (var_pop(y_true) FILTER (WHERE split = 'test') * count(*) FILTER (WHERE split = 'test')) AS test_r2_score,
             avg(abs(y_true - y_pred)) FILTER (WHERE split = 'train') AS training_mean_absolute_error,
             1.0 - sum((y_true - y_pred) ^ 2) FILTER (WHERE split = 'train')
                   / (var_pop(y_true) FILTER (WHERE split = 'train') * count(*) FILTER (WHERE split = 'train'))
                   AS training_r2_score,
             '{k}' AS k
      FROM preds_{k}""" for k in RUN_KS) + ")"

# Deployment configuration and registry (fixed rows: what an operator types in).
MODELS_TO_DEPLOY = [("knn-reg-model", 1, 1.0), ("knn-reg-model", 2, 1.001)]
MODEL_VERSIONS = [("knn-reg-model", 1, "knn-k3", "Production"), ("knn-reg-model", 2, "knn-k5", "Staging")]


@query("deployment_plan", with_fixtures("""
    SELECT d.model_name || '-v' || CAST(d.model_version AS VARCHAR) AS model_used, d.r_threshold, v.run_id, v.stage,
           m.k, round(CAST(m.test_mean_absolute_error AS DOUBLE), 6) AS test_mean_absolute_error
    FROM (VALUES ('knn-reg-model', 1, 1.0), ('knn-reg-model', 2, 1.001)) d(model_name, model_version, r_threshold)
    JOIN (VALUES ('knn-reg-model', 1, 'knn-k3', 'Production'), ('knn-reg-model', 2, 'knn-k5', 'Staging'))
         v(name, version, run_id, stage) ON v.name = d.model_name AND v.version = d.model_version
    JOIN metrics m USING (run_id)""", "stream", extra=RUNS_SQL))
def deployment_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured models resolved through the registry to their runs'
    parameters and metrics -- one scoring config per model (J9, T14, S15, S16)."""
    params, metrics = run_log(spark, sf_dir)
    wide = files.run_log_wide(params.unionByName(metrics), PARAM_KEYS + METRIC_KEYS)
    cfg = spark.createDataFrame(MODELS_TO_DEPLOY, "model_name string, model_version int, r_threshold double")
    reg = spark.createDataFrame(MODEL_VERSIONS, "name string, version int, run_id string, stage string")
    j = (cfg.join(reg, (cfg.model_name == reg.name) & (cfg.model_version == reg.version))
         .join(wide.drop("model_name"), "run_id"))
    return j.select(scalar.model_label("model_name", "model_version").alias("model_used"), "r_threshold", "run_id",
                    "stage", "k", _r(F.col("test_mean_absolute_error").cast("double")).alias("test_mean_absolute_error"))


@query("run_comparison", with_fixtures("""
    SELECT run_id, k, round(test_mean_absolute_error, 6) AS test_mean_absolute_error,
           round(test_r2_score, 6) AS test_r2_score, round(training_mean_absolute_error, 6) AS training_mean_absolute_error,
           round(training_r2_score, 6) AS training_r2_score,
           row_number() OVER (ORDER BY test_mean_absolute_error, run_id) AS rank_by_test_mae
    FROM metrics""", "stream", extra=RUNS_SQL))
def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs side by side, ranked by test error."""
    params, metrics = run_log(spark, sf_dir)
    wide = files.run_log_wide(params.unionByName(metrics), PARAM_KEYS + METRIC_KEYS)
    typed = wide.select("run_id", "k", *[F.col(c).cast("double").alias(c) for c in METRIC_KEYS])
    from pyspark.sql import Window
    ranked = typed.withColumn("rank_by_test_mae", F.row_number().over(
        Window.orderBy("test_mean_absolute_error", "run_id")))  # a handful of runs: one small partition
    return ranked.select("run_id", "k", *[_r(c).alias(c) for c in METRIC_KEYS],
                         F.col("rank_by_test_mae").cast("long").alias("rank_by_test_mae"))


# ---------------------------------------------------------------- scans


@query("scan_or_empty", """
    SELECT CASE WHEN part = 'events' THEN event_type END AS instrument, part, count(event_id) AS n
    FROM (SELECT 'events' AS part, event_type, event_id FROM events) GROUP BY ALL""")
def scan_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is there and one that isn't, both with declared columns."""
    schema = read_table(spark, sf_dir, "events", ["event_id", "event_type"]).schema
    there = read_or_empty(spark, f"{sf_dir}/events.parquet", schema).withColumn("part", F.lit("events"))
    missing = read_or_empty(spark, f"{sf_dir}/events_of_next_year.parquet", schema).withColumn("part", F.lit("missing"))
    return (there.unionByName(missing).groupBy(F.col("event_type").alias("instrument"), "part")
            .agg(F.count("event_id").alias("n")))


@query("sql_text_view", with_fixtures("""
    SELECT model_used, count(*) AS n, round(sum(buy_level_responce), 2) AS total FROM buys
    WHERE sell_date >= TIMESTAMP '1995-01-01' GROUP BY model_used""", "buys"))
def sql_text_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a view."""
    return sql_text(spark, "SELECT model_used, count(*) AS n, round(sum(buy_level_responce), 2) AS total FROM {positions} "
                           "WHERE sell_date >= TIMESTAMP '1995-01-01' GROUP BY model_used",
                    positions=fixtures.buys(spark, sf_dir))
