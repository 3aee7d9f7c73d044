"""Recursive averages, oscillators and the position machine against plain loops."""

import datetime as dt
import itertools
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from barwright.operators import indicators as ind
from barwright.operators import windows as win
from barwright.operators.signals import position_levels

START = dt.date(1980, 1, 7)


def loop_ema(xs, alpha, n):
    out, e = [], None
    for i, x in enumerate(xs):
        e = x if e is None else (1 - alpha) * e + alpha * x
        out.append(e if i + 1 >= n else None)
    return out


def loop_bx(xs):
    fast, slow = loop_ema(xs, 2 / 6, 1), loop_ema(xs, 2 / 21, 1)
    out, g, l, prev, k = [], None, None, None, 0
    for i, (f, s) in enumerate(zip(fast, slow)):
        if i + 1 < 20:
            out.append(None)
            continue
        d = f - s
        if prev is not None:
            up, down = max(d - prev, 0), max(prev - d, 0)
            g = up if g is None else 0.8 * g + 0.2 * up
            l = down if l is None else 0.8 * l + 0.2 * down
            k += 1
        prev = d
        if k < 5:
            out.append(None)
        elif l > 0:
            out.append(100 - 100 / (1 + g / l) - 50)
        else:
            out.append(50.0 if g > 0 else None)
    return out


def frame(spark, histories, step=7):
    rows = []
    for symbol, closes in histories.items():
        for i, c in enumerate(closes):
            rows.append((symbol, START + dt.timedelta(days=step * i), c, c + 1.0, c - 1.0, c, 10.0))
    schema = "symbol string, week_start date, open double, high double, low double, close double, volume double"
    return spark.createDataFrame(rows, schema)


def walk(seed, n):
    rng, x, out = random.Random(seed), 100.0, []
    for _ in range(n):
        x = max(1.0, x * (1 + rng.uniform(-0.05, 0.05)))
        out.append(round(x, 2))
    return out


def by_symbol(df, column):
    out = {}
    for r in df.orderBy("symbol", "week_start").collect():
        out.setdefault(r["symbol"], []).append(r[column])
    return out


def close_to(a, b, tol=1e-9):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert (x is None) == (y is None)
        assert x is None or abs(x - y) <= tol * max(1.0, abs(y))


@pytest.mark.parametrize("era_days", [7 * 3, 7 * 50, 7 * 1000])
def test_ema_across_eras(spark, era_days, monkeypatch):
    monkeypatch.setattr(win, "era_days", lambda *_: era_days)
    histories = {"A": walk(1, 400), "B": walk(2, 37), "C": walk(3, 1)}
    df, bars = win.lay_out(frame(spark, histories), "week_start", days_per_bar=7)
    df = win.ema(df, bars, {"e5": ("close", 5), "e66": ("close", 66)})
    for column, n in (("e5", 5), ("e66", 66)):
        got = by_symbol(df, column)
        for symbol, xs in histories.items():
            close_to(got[symbol], loop_ema(xs, 2 / (n + 1), n))


@pytest.mark.parametrize("era_days", [7 * 9, 7 * 1000])
def test_bx_and_monthly_bx(spark, era_days, monkeypatch):
    monkeypatch.setattr(win, "era_days", lambda *_: era_days)
    histories = {"A": walk(4, 260), "B": walk(5, 140)}
    candles = frame(spark, histories)
    df, bars = win.lay_out(candles, "week_start", days_per_bar=7)
    df = ind.oscillators(df, bars, chart=True, months=True)
    rows = df.orderBy("symbol", "week_start").collect()
    for symbol, xs in histories.items():
        mine = [r for r in rows if r["symbol"] == symbol]
        close_to([r["bx"] for r in mine], loop_bx(xs))
        days = [r["week_start"] for r in mine]
        months = [(d.year, d.month) for d in days]
        for i, r in enumerate(mine):
            closed = [xs[max(k for k in range(len(xs)) if months[k] == m)]
                      for m in sorted(set(months)) if m < months[i]]
            series = loop_bx(closed + [xs[i]])
            wanted = [series[-2] if len(series) > 1 else None, series[-3] if len(series) > 2 else None, series[-1]]
            close_to([r["bx_monthly_completed"], r["bx_monthly_prev"], r["bx_monthly_realtime"]], wanted)


def test_completed_month_is_frozen_and_last_row_is_no_month_end(spark):
    df, bars = win.lay_out(frame(spark, {"A": walk(6, 200)}), "week_start", days_per_bar=7)
    rows = ind.bx_monthly(df, bars).orderBy("week_start").collect()
    for a, b in zip(rows, rows[1:]):
        if (a["week_start"].month == b["week_start"].month):
            assert a["bx_monthly_completed"] == b["bx_monthly_completed"]
    changes = [b for a, b in zip(rows, rows[1:]) if a["bx_monthly_completed"] != b["bx_monthly_completed"]]
    assert changes and all(r["week_start"].day <= 7 for r in changes)


def loop_positions(bars):
    state, out = 0, []
    for e, t, l in bars:
        if state == 1:
            state = 2 if t else 0 if l else 1
        elif e:
            state = 1
        out.append(int(state == 1))
    return out


def test_position_state_for_all_short_sequences(spark):
    kinds = [(e, t, l) for e, t, l in itertools.product((False, True), repeat=3) if not (e and l)]
    rows, wanted = [], {}
    for n, seq in enumerate(itertools.product(kinds, repeat=5)):
        wanted[n] = loop_positions(seq)
        rows += [(str(n), i, e, t, l) for i, (e, t, l) in enumerate(seq)]
    df = spark.createDataFrame(rows, "symbol string, week_start int, e boolean, t boolean, l boolean")
    got = win.run_levels(df, position_levels(win.PLAIN_WEEKLY, "e", "t", "l"))
    lists = got.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("week_start", "__long"))).alias("p"))
    for r in lists.collect():
        assert [x["__long"] for x in r["p"]] == wanted[int(r["symbol"])]


def test_weights_stay_in_range():
    assert win.era_days(1 / 3) > 1461
    with pytest.raises(ValueError):
        win.era_days(1.0)


def test_one_exchange_and_one_sort(spark):
    df = ind.compute_indicators(frame(spark, {"A": walk(7, 80)}), "weekly")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_means_skip_bars_without_a_value(spark):
    import pandas as pd

    xs = [None if i % 5 == 3 or i in (0, 1, 40, 41, 42) else 100.0 + (i * 37) % 11 for i in range(900)]
    rows = [("A", dt.date(2000, 1, 1) + dt.timedelta(days=i), x) for i, x in enumerate(xs)]
    df, bars = win.lay_out(spark.createDataFrame(rows, "symbol string, date date, close double"), "date", alpha=win.alpha_of_span(2))
    got = win.ema(df, bars, {f"e{n}": ("close", n) for n in (1, 2, 3, 5, 20)}).orderBy("date").toPandas()
    known = pd.Series(xs, dtype="float64")
    for n in (1, 2, 3, 5, 20):
        want = known.ewm(span=n, adjust=False, ignore_na=True).mean().where(known.notna().cumsum() >= n)
        pd.testing.assert_series_equal(got[f"e{n}"], want, check_names=False, rtol=1e-9)


def test_a_constant_close_with_a_gap_stays_constant(spark):
    rows = [("A", dt.date(2000, 1, 1) + dt.timedelta(days=i), None if i == 6 else 100.0) for i in range(30)]
    df, bars = win.lay_out(spark.createDataFrame(rows, "symbol string, date date, close double"), "date")
    got = win.ema(df, bars, {"e": ("close", 5)}).where("e is not null").select("e").distinct().collect()
    assert len(got) == 1 and abs(got[0][0] - 100) < 1e-9


def test_a_span_that_is_too_short_for_the_layout_is_refused(spark):
    df, bars = win.lay_out(spark.createDataFrame([("A", dt.date(2000, 1, 1), 1.0)], "symbol string, date date, close double"), "date")
    with pytest.raises(ValueError):
        win.ema(df, bars, {"e": ("close", 3)})


def test_sliding_means_and_deviations_equal_plain_frames(spark):
    closes = walk(5, 90)
    closes[40] = None
    closes[70] = 1e15  # leaves nothing behind once it is out of the frame
    histories = {"A": closes, "B": [0.1] * 90, "C": walk(6, 3)}
    rows = [
        (symbol, START + dt.timedelta(days=7 * i), c) for symbol, xs in histories.items() for i, c in enumerate(xs)
    ]
    df = spark.createDataFrame(rows, "symbol string, week_start date, close double")
    lengths = (1, 3, 4, 5, 20, 33)
    slid = win.sliding(
        df, win.PLAIN_WEEKLY, {f"mean_{n}": ("close", n) for n in lengths}, {f"std_{n}": ("close", n) for n in lengths if n > 1}
    )
    assert slid.columns[:3] == ["symbol", "week_start", "close"]
    for r in slid.collect():
        i = (r["week_start"] - START).days // 7
        for n in lengths:
            frame = histories[r["symbol"]][max(0, i + 1 - n): i + 1]
            known = len(frame) == n and None not in frame
            assert r[f"mean_{n}"] == (pytest.approx(sum(frame) / n, rel=1e-13) if known else None)
            if n > 1:
                assert r[f"std_{n}"] == (pytest.approx(statistics.stdev(frame), rel=1e-9, abs=1e-15) if known else None)


def test_sliding_frames_need_few_distances_of_lags(spark):
    """Each distance is compiled by itself, and Spark keeps a hundred compiled classes."""
    df = spark.createDataFrame([("A", START, 1.0)], "symbol string, week_start date, close double")
    slid = win.sliding(df, win.PLAIN_WEEKLY, {f"m{n}": ("close", n) for n in (20, 33, 40, 66)}, {"std": ("close", 20)})
    plan = slid._jdf.queryExecution().optimizedPlan().toString()
    assert len(set(re.findall(r"specifiedwindowframe\(RowFrame, (-\d+), -\d+\)", plan))) <= 10


def test_constant_values_have_exact_means_in_long_frames(spark):
    rows = [("A", START + dt.timedelta(days=7 * i), 0.1) for i in range(80)]
    df = spark.createDataFrame(rows, "symbol string, week_start date, close double")
    last = win.sliding(df, win.PLAIN_WEEKLY, {f"m{n}": ("close", n) for n in (20, 33, 40, 66)}).orderBy("week_start").tail(1)[0]
    assert [last[f"m{n}"] for n in (20, 33, 40, 66)] == [0.1] * 4


def test_rsi_has_its_own_losses(spark):
    closes = walk(9, 60)
    df, bars = win.lay_out(frame(spark, {"A": closes}), "week_start", days_per_bar=7)
    got = [r["rsi"] for r in win.wilder_rsi(df, bars, "close", 14, "rsi").orderBy("week_start").collect()]
    gain = loss = None
    for i, (was, now) in enumerate(itertools.pairwise(closes), 1):
        up, down = max(now - was, 0.0), max(was - now, 0.0)
        gain = up if gain is None else gain * 13 / 14 + up / 14
        loss = down if loss is None else loss * 13 / 14 + down / 14
        assert got[i] == (pytest.approx(100 - 100 / (1 + gain / loss), rel=1e-9) if i >= 14 else None)
