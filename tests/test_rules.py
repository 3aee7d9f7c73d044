"""Worked cases of the rules: trades, statistics, cycles, quality, ranking."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barwright.functions.numeric import half_up, pct_from, ratio, round_doubles
from barwright.operators import quality, signals
from barwright.operators import windows as win
from barwright.operators.cycles import with_drawdown
from barwright.operators.indicators import compute_indicators
from barwright.operators.portfolio import percent_rank_within, select_top_by_upside
from barwright.operators.screens import position_summary
from barwright.plans.stages import append_signal_stage, full_weekly
from barwright.sources import candles
from barwright.sources.candles import symbol_name
from checks.registry import Inputs

MONDAY = dt.date(2020, 1, 6)
BAR = "symbol string, week_start date, high double, low double, close double, fvb_upper_thresh double, fvb_lower_thresh double, fvb_band_green int, bx_monthly_dark_red int, tpx1 double"


def week(i):
    return MONDAY + dt.timedelta(days=7 * i)


def bars_of(spark, bars, symbol="A"):
    """bars: (close, high, green, dark_red); band 0..1000, so every close is in the zone."""
    rows = [(symbol, week(i), float(h), float(c), float(c), 1000.0, 0.0, g, d, 200.0) for i, (c, h, g, d) in enumerate(bars)]
    return win.lay_out(spark.createDataFrame(rows, BAR), "week_start", days_per_bar=7)


def signal_rows(spark, bars):
    df, w = bars_of(spark, bars)
    return signals.append_signals(df, w).orderBy("week_start").collect()


def test_target_wins_over_stop_and_next_entry_is_a_reentry(spark):
    rows = signal_rows(spark, [(100, 110, 1, 0), (150, 210, 0, 1), (150, 160, 0, 1), (120, 130, 1, 0), (110, 120, 0, 1), (100, 110, 1, 0)])
    assert [r["sig_entry"] for r in rows] == [1, 0, 0, 0, 0, 1]
    assert [r["sig_tp"] for r in rows] == [0, 1, 0, 0, 0, 0]
    assert [r["sig_reentry"] for r in rows] == [0, 0, 0, 1, 0, 0]
    assert [r["sig_sl"] for r in rows] == [0, 0, 0, 0, 1, 0]
    assert [r["sig_in_position"] for r in rows] == [1, 0, 0, 1, 0, 1]
    assert [r["sig_entry_price"] for r in rows] == [100.0, None, None, 120.0, None, 100.0]


def test_entry_condition_and_target_on_one_bar(spark):
    rows = signal_rows(spark, [(100, 250, 1, 0), (100, 250, 1, 0), (100, 250, 1, 0), (100, 120, 1, 0)])
    assert [r["sig_entry"] for r in rows] == [1, 0, 0, 0]
    assert [r["sig_tp"] for r in rows] == [0, 1, 0, 0]
    assert [r["sig_reentry"] for r in rows] == [0, 0, 1, 0]
    assert [r["sig_add"] for r in rows] == [0, 0, 0, 1]


def test_recovering_month_is_not_dark_red(spark):
    gate = spark.sql("SELECT int(coalesce(c < 0 and c <= p, false)) AS d FROM VALUES (-1.78D, -5.25D), (-5.25D, -1.78D), (null, 1D) AS t(c, p)")
    assert [r["d"] for r in gate.collect()] == [0, 1, 0]


TRADE = "symbol string, trade_id bigint, entry_type string, exit_type string, pct_gain double"


def stats_of(spark, trades):
    rows = [("A", i + 1, kind, how, float(p)) for i, (kind, how, p) in enumerate(trades)]
    return signals.backtest_stats(spark.createDataFrame(rows, TRADE)).collect()[0]


def test_three_trades_compound_to_24_2_percent(spark):
    s = stats_of(spark, [("Entry", "TP", 20), ("Entry", "SL", -10), ("Re-Entry", "SL", 15)])
    assert s["bt_geo_return"] == pytest.approx(24.2)
    assert s["bt_win_rate"] == pytest.approx(200 / 3)  # a stop above the entry price counts as a win
    assert (s["bt_trades"], s["bt_tp_count"], s["bt_sl_count"], s["bt_reentry_count"]) == (3, 1, 2, 1)
    assert s["bt_profit_factor"] == pytest.approx(3.5)
    assert s["bt_reentry_win_rate"] == 100.0


def test_no_losing_trade_gives_no_profit_factor(spark):
    assert stats_of(spark, [("Entry", "TP", 20)])["bt_profit_factor"] is None


def test_equity_curve_survives_a_total_loss(spark):
    rows = [("A", 1, 20.0), ("A", 2, -10.0), ("A", 3, 15.0), ("B", 1, -100.0), ("B", 2, 50.0)]
    got = signals.equity_curve(spark.createDataFrame(rows, "symbol string, trade_id bigint, pct_gain double"))
    values = [(r["symbol"], r["trade_no"], round(r["equity"], 6)) for r in got.orderBy("symbol", "trade_no").collect()]
    assert values == [("A", 0, 100.0), ("A", 1, 120.0), ("A", 2, 108.0), ("A", 3, 124.2), ("B", 0, 100.0), ("B", 1, 0.0), ("B", 2, 0.0)]


def test_open_trade_counts_only_for_weeks_in_trade(spark):
    bars = [(100, 110, 1, 0), (90, 95, 0, 1), (100, 110, 1, 0), (105, 110, 0, 0)]
    df, w = bars_of(spark, bars)
    df = signals.append_signals(df, w).withColumn("cycle_avg_pullback", F.lit(-1.0))
    row = append_signal_stage(bars_of(spark, bars)[0], w).collect()[0]
    assert (row["bt_trades"], row["bt_weeks_in_trade"]) == (1, 3)
    dive = signals.deep_dive_metrics(df, w).collect()[0]
    assert (dive["trades"], dive["weeks_in_trade"], dive["avg_hold"]) == (1, 3, 1.0)
    assert dive["geo_return"] == pytest.approx(-10.0)


def test_risk_reward(spark):
    df, w = bars_of(spark, [(100, 110, 1, 0), (92, 95, 0, 1), (100, 110, 1, 0), (110, 205, 0, 0)])
    df = df.withColumn("tpx1", F.lit(120.0)).withColumn("high", F.when(F.col("high") == 205, 205.0).otherwise(F.lit(101.0)))
    dive = signals.deep_dive_metrics(signals.append_signals(df, w).withColumn("cycle_avg_pullback", F.lit(None).cast("double")), w).collect()[0]
    assert dive["risk_reward"] == pytest.approx(2.5)


def test_cycles(spark):
    df, w = bars_of(spark, [(100, 1, 0, 0), (110, 1, 1, 0), (121, 1, 1, 0), (99, 1, 0, 1), (80, 1, 1, 0), (88, 1, 0, 0)])
    df = df.withColumn("low", F.col("close") - 10.0)
    rows = append_signal_stage(df, w).orderBy("week_start").collect()
    assert [r["cycle_bull"] for r in rows] == [0, 1, 1, 0, 1, 1]
    assert [round(r["cycle_pct"], 6) for r in rows] == [0.0, 10.0, 21.0, round((99 - 121) / 121 * 100, 6), round((80 - 99) / 99 * 100, 6), round((88 - 99) / 99 * 100, 6)]
    assert {(r["cycle_count"], round(r["cycle_signal_return"], 6), r["cycle_win_rate"]) for r in rows} == {(1, 21.0, 100.0)}
    assert rows[0]["cycle_avg_pullback"] == pytest.approx((100 / 110 - 1) * 100)
    assert rows[0]["cycle_avg_loss"] is None and rows[0]["cycle_rvr"] is None


def test_zero_divisors_give_null(spark):
    row = spark.range(1).select(
        ratio(F.lit(1.0), F.lit(0.0)).alias("r"), pct_from(F.lit(0.0), F.lit(5.0)).alias("p"),
        half_up(F.lit(2.675), 2).alias("h"), half_up(F.lit(-2.5), 0).alias("n"), half_up(F.lit(12345678901.0), 2).alias("big"),
    ).collect()[0]
    assert (row["r"], row["p"], row["h"], row["n"], row["big"]) == (None, None, 2.68, -3.0, 12345678901.0)


@pytest.mark.parametrize("x, want", [
    (1234567890.12, 1234567890.12), (98765432109.0, 98765432109.0), (1e12 + 0.25, 1e12 + 0.25), (12345678901.236, 12345678901.24),
    (-12345678901.235, -12345678901.24), (3e29, 3e29), (1e300, 1e300), (float("inf"), float("inf")), (0.125, 0.13), (1e-12, 0.0),
])
def test_rounding_keeps_large_numbers(spark, x, want):
    df = spark.range(1).select(F.lit(x).alias("x"), F.lit("t").alias("t"))
    assert df.select(half_up(F.col("x"), 2)).first()[0] == want
    assert round_doubles(df, 2).first() == (want, "t")


def test_wide_rounding_compiles(spark, sf_dir, capfd):
    """Rounding all columns of the indicator chain leaves its generated code compilable."""
    from __spark_entry__ import queries

    for name in ("compute_indicators_weekly", "compute_indicators_daily"):
        spark.sparkContext.setLogLevel("WARN")
        queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.sparkContext.setLogLevel("ERROR")
    said = capfd.readouterr()
    assert "64 KB" not in said.err + said.out and "failed to compile" not in said.err + said.out


def test_quality_rules(spark):
    schema = "symbol string, week_start date, open double, high double, low double, close double"
    bars = spark.createDataFrame([("A", week(0), 1.0, 10.0, 0.1, 0.4), ("B", week(0), 1.0, 1.08, 1.0, 1.0), ("C", week(0), 1.0, 2.0, 0.0, 0.0)], schema)
    assert [r["symbol"] for r in quality.detect_corrupt_bars(bars, "week_start").collect()] == ["A"]
    assert sorted(r["symbol"] for r in quality.detect_extreme_low(bars).collect()) == ["A"]


def test_best_position_ties_go_to_the_first_symbol(spark):
    view = spark.createDataFrame([("B", 1, 5.0), ("A", 1, 5.0), ("C", 0, 9.0), ("D", 1, -1.0)], "symbol string, sig_in_position int, _unrealised_pct double")
    row = position_summary(view).collect()[0]
    assert (row["positions"], row["profitable"], row["best_symbol"], row["best_unrealised"]) == (3, 2, "A", 5.0)


def test_percent_rank_matches_the_window_function(spark):
    rng = random.Random(3)
    rows = [(k, "s%d" % i, v) for k in range(3) for i in range(500) for v in [rng.choice([0.0, 0.0, rng.gauss(0, 1), 1e9, None])]]
    rows += [(9, "only", 4.0)]
    df = spark.createDataFrame(rows, "week int, symbol string, v double")
    got = percent_rank_within(df, ["week"], "v", "p", slices=7)
    df.createOrReplaceTempView("to_rank")
    want = spark.sql("SELECT week, symbol, percent_rank() OVER (PARTITION BY week ORDER BY v) AS p FROM to_rank WHERE v IS NOT NULL")
    assert sorted(map(tuple, got.select("week", "symbol", "p").collect())) == sorted(map(tuple, want.collect()))


def test_crowded_week_is_cut_before_the_exchange(spark):
    df = spark.range(1000).selectExpr("concat('s', id) AS symbol", "date_add(date'2020-01-06', int(id % 2) * 0) AS week_start", "double(id) AS upside_pct")
    picked = select_top_by_upside(df, 5)
    assert [r["symbol"] for r in picked.orderBy("pick").collect()] == ["s999", "s998", "s997", "s996", "s995"]
    assert "WindowGroupLimit" in picked._jdf.queryExecution().executedPlan().toString()


def test_symbols_are_never_cut_off(spark):
    names = spark.sql("SELECT stack(3, 7L, 12345L, 1234567L) AS k").select(symbol_name(F.col("k")).alias("n"))
    assert [r["n"] for r in names.collect()] == ["SYM00007", "SYM12345", "SYM1234567"]


def test_columns_by_period(spark):
    schema = "symbol string, {} date, open double, high double, low double, close double, volume double"
    daily = compute_indicators(spark.createDataFrame([], schema.format("date")), "daily").columns
    weekly = full_weekly(spark.createDataFrame([], schema.format("week_start"))).columns
    only_weekly = {c for c in weekly if c.startswith(("cycle_", "tpx", "sig_", "bt_")) or c == "in_entry_zone"}
    assert len(only_weekly) == 3 + 9 + 2 + 8 + 11
    assert not only_weekly & set(daily)
    assert set(weekly) - only_weekly - {"week_start"} == set(daily) - {"date"}
    assert not [c for c in daily + weekly if c.startswith("_")]


def test_band_order(spark, sf_dir):
    from checks.registry import Inputs

    df = compute_indicators(Inputs(spark, sf_dir).weekly(), "weekly").where("fvb_dev is not null")
    wrong = df.where(
        "not (fvb_lower_x2 <= fvb_lower_x1 and fvb_lower_x1 <= fvb_lower_thresh and fvb_lower_thresh <= fvb_upper_thresh"
        " and fvb_upper_thresh <= fvb_upper_x1 and fvb_upper_x1 <= fvb_upper_x2)"
    )
    assert wrong.count() == 0


def test_all_weekly_columns_come_from_one_sort_of_the_bars(spark, sf_dir):
    """Neither the second half of the chain nor the drawdown of cycles sorts the wide rows again."""
    weekly = Inputs(spark, sf_dir).weekly()
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (full_weekly(weekly), weekly)]
    assert plans[0].count("Sort [") == plans[1].count("Sort [") + 1


def test_drawdown_of_each_run_starts_anew(spark):
    closes = [(10.0, 9.0, 1), (20.0, 8.0, 1), (5.0, None, 2), (4.0, 1.0, 2), (None, 3.0, 2), (8.0, 2.0, 3)]
    days = [(dt.date(2020, 1, 6) + dt.timedelta(days=7 * i), *c) for i, c in enumerate(closes)]
    df = spark.createDataFrame([("A", 0, *d) for d in days], "symbol string, __era int, week_start date, close double, low double, __run bigint")
    got = [r["__drawdown"] for r in with_drawdown(df).orderBy("week_start").collect()]
    want = [-10.0, -60.0, None, -80.0, -80.0, -75.0]
    assert got == [w if w is None else pytest.approx(w) for w in want]


def test_parts_of_stored_bars_follow_their_number(spark, monkeypatch):
    monkeypatch.setattr(candles, "BARS_PER_TASK", 100)
    for n in (300, 1200):
        bars = spark.range(n).selectExpr("concat('S', id % 40) as symbol", "id")
        parts = candles.by_symbol(bars)
        assert parts.rdd.getNumPartitions() == 1 + n // 100 and parts.count() == n
        plan = parts.groupBy("symbol", "id").count()._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1  # the groups need none of their own
