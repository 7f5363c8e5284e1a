"""Hand-computed frames for the semantic traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barflow.functions import scalar
from barflow.operators import bars, features, series, positions


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_bars_last_non_null_right_label_drop_incomplete(spark):
    ticks = spark.createDataFrame([
        ("E", ts("2024-01-01 10:00:00"), 1, 1.0, 1.0),
        ("E", ts("2024-01-01 10:00:59"), 2, 2.0, 2.0),
        ("E", ts("2024-01-01 10:01:00"), 3, 3.0, 3.0),
        ("E", ts("2024-01-01 10:01:30"), 4, None, None),
        ("E", ts("2024-01-01 10:04:10"), 5, 5.0, 5.0),
    ], "epic string, updated_at timestamp, seq long, bid_open double, ask_open double")
    out = bars.last_bars(ticks, "1 minute").orderBy("updated_at").collect()
    assert [(r.updated_at, r.bid_open) for r in out] == [
        (ts("2024-01-01 10:01:00"), 2.0), (ts("2024-01-01 10:02:00"), 3.0)]


def test_bars_tie_on_time_broken_by_seq(spark):
    ticks = spark.createDataFrame([
        ("E", ts("2024-01-01 10:00:10"), 7, 1.0, 1.0),
        ("E", ts("2024-01-01 10:00:10"), 8, 2.0, 2.0),
        ("E", ts("2024-01-01 10:05:00"), 9, 3.0, 3.0),
    ], "epic string, updated_at timestamp, seq long, bid_open double, ask_open double")
    out = bars.last_bars(ticks, "1 minute").collect()
    assert [(r.bid_open, r.seq) for r in out] == [(2.0, 8)]


def test_normalise_spreads_base_including_imputed(spark):
    df = spark.createDataFrame([(20.0, None)], "ask_open double, ask_open_p1 double")
    cols = ["ask_open", "ask_open_p1"]
    r = features.normalise(features.impute(df, cols), cols).first()
    assert (r.ask_open, r.ask_open_p1) == (1.0, -49.95)


def test_row_ffill_left_to_right(spark):
    df = spark.createDataFrame([(1.0, None, 3.0, None)], "a double, b double, c double, d double")
    r = features.row_ffill(df, ["a", "b", "c", "d"]).first()
    assert (r.a, r.b, r.c, r.d) == (1.0, 1.0, 3.0, 3.0)


def test_cumsum_skips_null_in_place(spark):
    df = spark.createDataFrame([("k", ts("2024-01-01 00:00:00"), 1, 1.0), ("k", ts("2024-01-01 00:01:00"), 2, None),
                                ("k", ts("2024-01-01 00:02:00"), 3, 2.0)],
                               "k string, t timestamp, s long, v double")
    out = series.running_sum(df, ["k"], ["t", "s"], "v", "c").orderBy("t").collect()
    assert [r.c for r in out] == [1.0, None, 3.0]


def test_round_to_minute_half_even(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00:30"),), (ts("2024-01-01 00:01:30"),)], "t timestamp")
    out = df.select(scalar.round_to_minute_plus("t", 0).alias("r")).collect()
    assert [r.r for r in out] == [ts("2024-01-01 00:00:00"), ts("2024-01-01 00:02:00")]


def test_interpolate_daily_linear(spark):
    df = spark.createDataFrame([("s", dt.date(2024, 1, 1), 1.0), ("s", dt.date(2024, 1, 5), 3.0)],
                               "k string, d date, v double")
    out = bars.daily_interpolate(df, ["k"], "d", "v").orderBy("d").collect()
    assert [r.v for r in out] == [1.0, 1.5, 2.0, 2.5, 3.0]


def test_exact_timestamp_left_join_fans_out(spark):
    t = ts("2024-01-01 10:00:00")
    ticks = spark.createDataFrame([("E", t, 1), ("E", t, 2)], "epic string, updated_at timestamp, seq long")
    bar = spark.createDataFrame([("E", t, 9.0)], "epic string, updated_at timestamp, bid double")
    assert ticks.join(bar, ["epic", "updated_at"], "left").count() == 2


def test_anti_join_null_key_is_not_matched(spark):
    left = spark.createDataFrame([("a",), (None,)], "dealId string")
    right = spark.createDataFrame([(None,)], "dealId string")
    assert left.join(right, "dealId", "left_anti").count() == 2  # SQL: null never equals null
    assert left.join(right, left.dealId.eqNullSafe(right.dealId), "left_anti").count() == 1


def test_ratio_by_zero_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert df.select(F.try_divide("a", "b").alias("r")).first().r is None


def test_three_way_target_first_horizon_wins(spark):
    df = spark.createDataFrame([(10.0, 10.5, 13.0, 1.0)],
                               "ask_open double, bid_open_f1 double, bid_open_f2 double, bid_open_f3 double")
    r = features.three_way_target(df, 2.0).first()
    assert r.move == 1.0  # f1 moves 0.5 (< 2), f2 moves +3 -> +1, f3's -9 is never looked at


def test_strip_currency_and_offset_parse(spark):
    df = spark.createDataFrame([("£-12.50", "2024-01-01 00:00:07.000001-05:00")], "p string, t string")
    r = df.select(scalar.strip_currency("p").alias("p"), scalar.parse_offset_timestamp("t").alias("t")).first()
    assert r.p == -12.5 and r.t == ts("2024-01-01 05:00:07.000001")


def test_time_on_explicit_date_midnight(spark):
    df = spark.createDataFrame([("00:00:05", "2024-03-01")], "t string, d string")
    assert df.select(scalar.time_on_date("t", "d").alias("x")).first().x == ts("2024-03-01 00:00:05")


def test_positions_due_unsold(spark):
    pos = spark.createDataFrame([("1", ts("2024-01-01 00:01:00")), ("2", ts("2024-01-01 00:05:00")),
                                 ("3", ts("2024-01-01 00:01:00"))], "dealId string, sell_date timestamp")
    sold = spark.createDataFrame([("3", 1.0)], "dealId string, close_level_responce double")
    due = positions.due_unsold(pos, sold, F.lit("2024-01-01 00:02:00").cast("timestamp"))
    assert [r.dealId for r in due.collect()] == ["1"]


def test_domain_check(spark):
    df = spark.createDataFrame([("BUY",), ("HOLD",), (None,)], "d string")
    out = [r.ok for r in df.select(scalar.in_domain("d", ["BUY", "SELL"]).alias("ok")).collect()]
    assert out == [True, False, False]


@pytest.mark.parametrize("n", [2, 3, 5, 9])
def test_ols_filter_weights_equal_a_fitted_line(n):
    import numpy as np
    from barflow.operators.forecast import ols_filter_weights
    y = np.random.default_rng(n).normal(size=n)
    slope, icpt = np.polyfit(np.arange(n), y, 1)
    assert abs(float(np.dot(ols_filter_weights(n), y)) - (icpt + slope * n)) < 1e-9


def test_asof_forward_matches_brute_force(spark):
    import random
    from barflow.operators.asof import asof_forward
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    right = [("A" if rnd.random() < 0.7 else "B", base + dt.timedelta(minutes=rnd.randrange(0, 3000)), float(i))
             for i in range(300)]
    left = [(f"L{i}", "A" if rnd.random() < 0.7 else "B", base + dt.timedelta(minutes=rnd.randrange(-50, 3100)))
            for i in range(200)]
    left.append(("Lsame", right[0][0], right[0][1]))  # equal time counts as "at or after"
    rdf = spark.createDataFrame(right, "epic string, updated_at timestamp, px double")
    ldf = spark.createDataFrame(left, "id string, epic string, t timestamp")
    got = {r.id: (r.f_updated_at, r.f_px) for r in
           asof_forward(ldf, rdf, ["epic"], "t", "updated_at", ["px"], left_id="id", bucket_seconds=3600,
                        prefix="f_").collect()}
    for lid, epic, t in left:
        cands = sorted((rt, px) for e, rt, px in right if e == epic and rt >= t)
        assert got[lid] == (cands[0] if cands else (None, None)), lid


def test_live_rows_time_correct_and_reference_order(spark):
    rows = [("E", ts(f"2024-01-01 10:0{i}:00"), i, 0.0, float(10 * (i + 1))) for i in range(3)]  # exactly 3 bars
    bars_ = spark.createDataFrame(rows, "epic string, updated_at timestamp, seq long, bid_open double, ask_open double")
    tc = features.live_feature_rows(bars_, 3, "time_correct").first()
    assert tc.updated_at == ts("2024-01-01 10:02:00")              # newest bar, past asks 20, 10, missing
    assert (tc.ask_open_p1, tc.ask_open_p2, tc.ask_open_p3) == (20 / 30, 10 / 30, -999 / 30)
    ref = features.live_feature_rows(bars_, 3, "reference_live").first()
    assert ref.updated_at == ts("2024-01-01 10:00:00")             # oldest of the tail, following asks
    assert (ref.ask_open_p1, ref.ask_open_p2, ref.ask_open_p3) == (2.0, 3.0, -99.9)
    short = bars_.filter("seq < 2")                                # fewer bars than periods: not scored
    assert features.live_feature_rows(short, 3).count() == 0


def test_nested_history_flattens_to_one_time_column(spark):
    df = spark.createDataFrame([("E", ts("2024-01-01 10:00:00"), 1, (2.0, 2.5), (1.0, 1.5))],
                               "epic string, DateTime timestamp, seq long, ask struct<Open:double,Close:double>, "
                               "bid struct<Open:double,Close:double>")
    out = features.adapt_nested_history(df)
    assert out.columns == ["epic", "seq", "updated_at", "ask_open", "bid_open"]
    assert tuple(out.first()) == ("E", 1, ts("2024-01-01 10:00:00"), 2.0, 1.0)


def test_currency_with_thousands(spark):
    from barflow.functions.scalar import strip_currency
    rows = [("£1,234.50", 1234.5), ("£12.50", 12.5), ("-£3", None), ("£1,234,567", 1234567.0), ("£1,23", None), (None, None), ("x", None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "i int, a string")
    got = [r.v for r in df.select("i", strip_currency("a").alias("v")).orderBy("i").collect()]
    assert got == [b for _, b in rows]


def test_null_groups_are_kept_and_profit_is_not_rounded(spark):
    from barflow.operators import evaluate, positions
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0)], "g string, v double")
    assert evaluate.describe(df, "v", ["g"]).count() == 2
    assert evaluate.quantile_pairs(df, "v", (0.9,), ["g"]).count() == 4
    d = evaluate.density(df, ["v"], 4, 0.0, 1.0, ["g"]).collect()
    assert len(d) == 8 and sum(r["count"] for r in d if r.g is None) == 2
    p = spark.createDataFrame([("x", 1, 1.0), ("y", 2, 1.0)], "dealId string, d int, buy_level_responce double").selectExpr(
        "dealId", "timestamp_seconds(d) AS buy_date", "buy_level_responce")
    s = spark.createDataFrame([("x", 1.003), ("y", 1.004)], "dealId string, close_level_responce double")
    run = positions.running_profit(positions.outcomes(p, s)).orderBy("buy_date").collect()
    assert [round(r.profit_responce_cumsum, 6) for r in run] == [0.003, 0.007]
    net = spark.createDataFrame([("e", 0.0)], "epic string, net_size double")
    fc = spark.createDataFrame([("e", 1.2, 1.0)], "epic string, forecast double, last double")
    assert positions.change_needed(net, fc).first().action == "NONE"  # 0.004 rounds to nothing


def test_asof_over_a_hot_day_equals_the_plain_answer(spark):
    import random
    import time
    from barflow.operators.asof import asof_forward
    r = random.Random(3)
    left = [(i, "hot" if r.random() < .9 else r.choice(["a", None]), r.choice([None, 50]) if r.random() < .02 else r.randint(0, 100_000))
            for i in range(300)]
    right = [("hot" if r.random() < .9 else "a", r.choice([50, r.randint(0, 100_000)]), r.randint(0, 9)) for _ in range(300)]
    as_frame = lambda rows, names: spark.createDataFrame(rows, names)
    lf = as_frame(left, "i int, k string, s long").selectExpr("i", "k", "timestamp_seconds(s) AS t")
    rf = as_frame(right, "k string, s long, v int").selectExpr("k", "timestamp_seconds(s) AS u", "v")
    for rows in (8, 80, 10**6):
        got = {x.i: (x.s, x.v) for x in asof_forward(lf, rf, ["k"], "t", "u", ["v"], "i", block_rows=rows)
               .selectExpr("i", "unix_seconds(u) AS s", "v").collect()}
        for i, k, s in left:
            hits = [(b, v) for kk, b, v in right if kk == k and s is not None and b >= s]
            assert got[i] == (min(hits) if hits else (None, None))
    many = spark.range(20_000).selectExpr("id AS i", "'x' AS k", "timestamp_seconds(id) AS t")
    began = time.perf_counter()
    n = asof_forward(many, many.selectExpr("k", "t AS u", "i AS v"), ["k"], "t", "u", ["v"], "i").filter("v = i").count()
    assert n == 20_000 and time.perf_counter() - began < 30


def test_each_key_drops_its_own_newest_bar(spark):
    """A key without a name keeps its bars, and a key of one bar has none left."""
    rows = [(k, ts(f"2024-01-01 10:0{m}:05"), m, 1.0 + m, 2.0 + m) for k, n in (("A", 4), (None, 3), ("B", 1)) for m in range(n)]
    ticks = spark.createDataFrame(rows, "epic string, updated_at timestamp, seq long, bid_open double, ask_open double")
    out = [(r.epic, r.seq) for r in bars.last_bars(ticks, "1 minute").collect()]
    assert sorted(out, key=str) == sorted([("A", 0), ("A", 1), ("A", 2), (None, 0), (None, 1)], key=str)
