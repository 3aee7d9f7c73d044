"""Weekly tables carried on from a stored state, marks with batches, and work by slices."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barwright.plans import jobs, rolling
from barwright.session import new_workspace
from barwright.sources.candles import resample_weekly
from barwright.sources.tables import Store

BAR = "symbol string, date date, open double, high double, low double, close double, volume double, arrival int"
START = dt.date(1996, 1, 1)  # a Monday


def days(spark, symbols, first, n, seed=1, arrival=1):
    """Random walks with a gap now and then; a symbol's bars do not depend on the cut."""
    rows = []
    for s in symbols:
        rng, x = random.Random(f"{s}{seed}"), 50.0
        for i in range(first + n):
            x = max(1.0, x * (1 + rng.uniform(-0.04, 0.04)))
            bar = (round(x, 2), round(x * (1 + rng.random() * 0.05), 2), round(x * (1 - rng.random() * 0.05), 2), round(x * 1.001, 2))
            if i >= first and rng.random() > 0.3:
                rows.append((s, START + dt.timedelta(days=i), *bar, float(i % 9), arrival))
    return spark.createDataFrame(rows, BAR)


def same(a, b, key=("symbol", "week_start")):
    """Equal rows, doubles to within the order of additions."""
    assert sorted(a.columns) == sorted(b.columns)
    names = sorted(a.columns)
    left, right = ({tuple(r[k] for k in key): r for r in df.select(*names).collect()} for df in (a, b))
    assert left.keys() == right.keys()
    for k, r in left.items():
        for n in names:
            x, y = r[n], right[k][n]
            assert x == (pytest.approx(y, rel=1e-7, abs=1e-7) if isinstance(y, float) else y), (k, n)


def forced(spark, store):
    fresh = Store(spark, new_workspace(spark), buckets=3)
    fresh.ingest_bars(store.read("daily").withColumn("arrival", F.lit(1)))
    jobs.run_weekly(fresh, force=True)
    return fresh.read("weekly"), fresh.read("weekly_snapshot")


def folders(store, table):
    fs, path = store._files(store.path(table))
    return {s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("year=")}


def test_a_days_load_opens_no_older_year(spark):
    store = Store(spark, new_workspace(spark), buckets=2)
    n = 1500
    store.ingest_bars(days(spark, "ABC", 0, n))
    assert rolling.run_weekly_from_state(store) and not rolling.run_weekly_from_state(store)
    for first, count in ((n, 1), (n + 1, 9), (n + 10, 33)):
        store.ingest_bars(days(spark, "ABC", first, count))
        # what an older year holds is out of reach while the load is carried on
        away = [(t, y) for t in ("daily", rolling.STAGE) for y in folders(store, t) if y < "year=2000"]
        assert len(away) == 8
        for t, y in away:
            store._rename(f"{store.path(t)}/{y}", f"{store.root}/away_{t}_{y}")
        assert rolling.run_weekly_from_state(store)
        for t, y in away:
            store._rename(f"{store.root}/away_{t}_{y}", f"{store.path(t)}/{y}")
        spark.catalog.refreshByPath(store.root)
    weekly, snapshot = forced(spark, store)
    same(rolling.read_weekly(store), weekly)
    same(store.read(rolling.SNAPSHOT), snapshot, ("symbol",))


def test_new_symbols_corrections_repairs_and_short_histories(spark):
    store = Store(spark, new_workspace(spark), buckets=2)
    store.ingest_bars(days(spark, "AB", 0, 800))
    rolling.run_weekly_from_state(store)
    late = days(spark, "A", 300, 3, seed=9, arrival=5)  # before the cut: A starts anew, B goes on
    store.ingest_bars(late.unionByName(days(spark, "B", 800, 20)).unionByName(days(spark, "C", 795, 3)).unionByName(days(spark, "D", 0, 500)))
    rolling.run_weekly_from_state(store)
    weekly, snapshot = forced(spark, store)
    same(rolling.read_weekly(store), weekly)
    same(store.read(rolling.SNAPSHOT), snapshot, ("symbol",))
    newest = store.read("daily").where("symbol = 'B'").agg(F.max("date")).first()[0]
    jobs.run_repair(store, store.read("daily").where((F.col("date") > F.lit(newest - dt.timedelta(days=12))) | (F.col("symbol") == "D")))
    rolling.run_weekly_from_state(store)
    weekly, snapshot = forced(spark, store)
    assert {r.symbol for r in weekly.select("symbol").distinct().collect()} == {"A", "B", "C"}
    same(rolling.read_weekly(store), weekly)
    same(store.read(rolling.SNAPSHOT), snapshot, ("symbol",))


def test_a_mark_set_while_a_stage_runs_stays(spark, monkeypatch):
    store = Store(spark, new_workspace(spark), buckets=2)
    store.ingest_bars(days(spark, "AB", 0, 200))
    write = Store.write_bars

    def landing_meanwhile(self, df, table, *more):
        write(self, df, table, *more)
        if table == "weekly_indicators":
            monkeypatch.setattr(Store, "write_bars", write)
            other = Store(spark, store.root, buckets=2)
            other.ingest_bars(days(spark, "A", 100, 2, seed=4, arrival=7))  # no newer date than the state

    monkeypatch.setattr(Store, "write_bars", landing_meanwhile)
    jobs.run_indicators(store, "weekly")
    assert {r.symbol for r in store.read_dirty("weekly_indicators").collect()} == {"A"}
    assert jobs.run_weekly(store)
    same(store.read("weekly"), forced(spark, store)[0])
    assert store.read_dirty("weekly_indicators").count() == 0


# --- slices ---------------------------------------------------------------------------------


def weekly_rows(spark, seed):
    """Weekly rows with all that signals and cycles read, as random as they come."""
    rng, rows = random.Random(seed), []
    for s in "ABCDE":
        x = 50.0
        for i in range(rng.randint(1, 160)):
            x = max(1.0, x * (1 + rng.uniform(-0.06, 0.06)))
            lower, upper = x * rng.uniform(0.7, 1.0), x * rng.uniform(0.95, 1.2)
            target = x * rng.uniform(0.95, 1.3) if rng.random() > 0.1 else None
            rows.append((s, START + dt.timedelta(days=7 * i), x * 1.05, x * 0.95, x, lower, upper, int(rng.random() < 0.7), int(rng.random() < 0.25), target))
    return spark.createDataFrame(
        rows, "symbol string, week_start date, high double, low double, close double, fvb_lower_thresh double, fvb_upper_thresh double,"
        " fvb_band_green int, bx_monthly_dark_red int, tpx1 double",
    )


@pytest.mark.parametrize("width", [1, 2, 9, 500])
def test_any_cut_gives_the_same_positions_trades_and_cycles(spark, width):
    from barwright.operators import signals, slices
    from barwright.operators.windows import lay_out
    from barwright.plans.stages import signals_from_indicators

    df = weekly_rows(spark, width).withColumn("open", F.col("close")).cache()
    whole = signals_from_indicators(df)
    cut = df.withColumn("slice", F.floor(F.datediff("week_start", F.lit(START)) / (7 * width)).cast("int"))
    names = ["symbol", "week_start", *signals.SIGNAL_COLUMNS]
    same(slices.signals_by_slice(cut).select(*names), whole.select(*names))
    bars = lay_out(df, "week_start", days_per_bar=7)[1]
    same(slices.trades_by_slice(cut), signals.trades(whole, type(bars)("week_start", ())), ("symbol", "trade_id"))
    stats = slices.cycle_stats_by_slice(cut)
    same(stats, whole.select(stats.columns).distinct(), ("symbol",))


def test_ends_of_slices_are_worked_out_once(spark):
    """Three groupings: the maps of the slices, for their bars and for where they end, and these ends."""
    from barwright.operators import slices

    columns = "symbol string, week_start date, slice int, high double, close double, fvb_band_green int, bx_monthly_dark_red int, tpx1 double"
    bars = spark.createDataFrame([], columns + ", fvb_lower_thresh double, fvb_upper_thresh double")
    plan = slices.signals_by_slice(bars)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Aggregate [") == 3


def test_maps_compose_in_any_grouping(spark):
    import itertools

    from barwright.operators.slices import compose

    maps = [[0, 1, 2], [1, 1, 1], [0, 2, 2], [0, 0, 2], [1, 2, 1]]
    rows = [(a, b, c) for a, b, c in itertools.product(maps, repeat=3)]
    df = spark.createDataFrame(rows, "a array<int>, b array<int>, c array<int>")
    ab, bc = compose("a", "b"), compose("b", "c")
    got = df.selectExpr("a", "b", "c", f"{compose(ab.replace('s ->', 'q ->').replace('s + 1', 'q + 1'), 'c')} as l", f"{compose('a', bc.replace('s ->', 'q ->').replace('s + 1', 'q + 1'))} as r").collect()
    assert all(r.l == r.r == [r.c[r.b[s]] for s in r.a] for r in got)


# --- layout ----------------------------------------------------------------------------------


def test_a_stop_at_any_step_of_a_relayout_loses_nothing(spark, monkeypatch):
    for stop in range(12):
        store = Store(spark, new_workspace(spark), buckets=2)
        store.ingest_bars(days(spark, "ABCDEFG", 0, 60))
        want = store.read("daily").count()
        steps = iter(range(100))

        def step(name, known, stop=stop, steps=steps):
            def run(self, *args):
                if next(steps) == stop:
                    raise KeyboardInterrupt(name)
                return known(self, *args)

            return run

        with monkeypatch.context() as m:
            for name in ("_delete", "_rename", "_note_layout", "write_bars"):
                m.setattr(Store, name, step(name, getattr(Store, name)))
            try:
                store.relayout("daily", 5)
                done = True
            except KeyboardInterrupt:
                done = False
        fresh = Store(spark, store.root, buckets=7)
        assert fresh.read("daily").count() == want
        assert all(fresh.candles("daily", [s]).count() * 7 > want / 2 for s in "ABCDEFG")
        fresh.relayout("daily", 5)
        assert fresh.candles("daily", ["C"]).count() == store.candles("daily", ["C"]).count() and fresh._layout("daily")[0] == 5
        if done:
            break
    assert done and stop > 4


def test_bars_without_a_note_are_refused(spark):
    store = Store(spark, new_workspace(spark), buckets=2)
    store.write_bars(days(spark, "A", 0, 9), "daily")
    store._delete(store._note("daily"))
    with pytest.raises(ValueError):
        Store(spark, store.root, buckets=8).candles("daily", ["A"])


def test_a_year_needs_the_year_before_and_no_older_one(spark):
    from barwright.operators import windows as win

    store = Store(spark, new_workspace(spark), buckets=2)
    store.write_bars(days(spark, "AB", 0, 1200).unionByName(days(spark, "C", 1095, 50)).drop("arrival"), "daily")
    assert folders(store, "daily") == {f"year={y}" for y in (1996, 1997, 1998, 1999)}

    def want(df, n):
        high, low = win.rolling_high(F.col("high"), n, win.PLAIN_DAILY), win.rolling_low(F.col("low"), n, win.PLAIN_DAILY)
        return df.select("symbol", "date", high.alias(f"high_{n}"), low.alias(f"low_{n}")).where("year(date) = 1999")

    whole = store.read("daily").cache()
    whole.count()
    for n in (2, 150, 400):  # the last one reaches further back than the year before
        same(rolling.rolling_range_of_year(store, "daily", 1999, n), want(whole, n), ("symbol", "date"))
    for y in (1996, 1997):
        store._rename(f"{store.path('daily')}/year={y}", f"{store.root}/away_{y}")
    spark.catalog.refreshByPath(store.root)
    without_c = rolling.rolling_range_of_year(store, "daily", 1999, 150).where("symbol <> 'C'")
    same(without_c, want(whole, 150).where("symbol <> 'C'"), ("symbol", "date"))


# --- summaries -------------------------------------------------------------------------------


def test_equal_slices_are_not_compared_row_by_row(spark, monkeypatch):
    from barwright.operators import quality

    rows = [(s, START + dt.timedelta(days=7 * i), float(i)) for s in "ABCDEFGH" for i in range(120)]
    source = spark.createDataFrame(rows, "symbol string, week_start date, close double").cache()
    wrong = (F.col("symbol") == "C") & (F.col("week_start") == START + dt.timedelta(days=70))
    layers = {
        "source": source, "daily": source.repartition(5), "weekly": source.withColumn("close", F.when(wrong, 1.5).otherwise(F.col("close"))),
        "snapshot": source.where(F.col("week_start") == START + dt.timedelta(days=7 * 119)),
    }
    assert {r.year for r in quality.unequal_slices(layers, ["snapshot"]).collect()} == {1996, 1998}
    seen = []
    known = quality.reconcile_layers
    monkeypatch.setattr(quality, "reconcile_layers", lambda parts, ref: seen.append(parts["source"].count()) or known(parts, ref))
    got = quality.reconcile_by_digests(layers, "source")
    names = sorted(got.columns)
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, known(layers, "source").select(names).collect()))
    assert seen[0] < source.count() / 2
    missing = {**layers, "weekly": source.where("symbol <> 'B'")}
    got = quality.reconcile_by_digests(missing, "source")
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, known(missing, "source").select(names).collect()))


def test_correlation_by_tiles(spark):
    import numpy as np

    from barwright.operators.correlation import correlation_tiles

    dice = np.random.default_rng(1)
    common = dice.normal(0, 0.02, 300)
    closes = {f"S{i}": 50 * np.cumprod(1 + common * (i % 3) + dice.normal(0, 0.01, 300)) for i in range(23)}
    rows = [(s, START + dt.timedelta(days=t), float(v)) for s, x in closes.items() for t, v in enumerate(x) if not (s == "S4" and t % 50 == 7)]
    df = spark.createDataFrame(rows, "symbol string, date date, close double")
    kept = [t for t in range(300) if t % 50 != 7]
    returns = {s: np.diff(x[kept]) / x[kept][:-1] for s, x in closes.items()}
    for tile, block in ((64, 128), (4, 32), (1, 7)):
        got = {(r.sym_a, r.sym_b): r.corr for r in correlation_tiles(df, "date", tile, block).collect()}
        assert len(got) == 23 * 22 / 2
        assert all(c == pytest.approx(np.corrcoef(returns[a], returns[b])[0, 1]) for (a, b), c in got.items())
    assert correlation_tiles(df.limit(0), "date").count() == 0


def test_bitmaps_count_like_sets(spark):
    from barwright.operators import bitmaps

    rng = random.Random(3)
    rows = [(f"S{rng.randrange(40_000)}", dt.date(rng.choice((1996, 1997, 1998)), rng.randint(1, 12), 5), rng.choice((None, 1.0))) for _ in range(60_000)]
    df = spark.createDataFrame(rows, "symbol string, date date, x double").cache()
    measures = {"all": F.lit(True), "x": F.col("x").isNotNull()}
    numbers = bitmaps.number_symbols(df.where("year(date) < 1998"))
    stored = bitmaps.presence(df.where("year(date) < 1998"), numbers, "date", measures)
    more = bitmaps.number_symbols(df, numbers).cache()
    assert more.count() == more.select("number").distinct().count() == df.select("symbol").distinct().count()
    assert numbers.join(more, ["symbol", "number"]).count() == numbers.count()
    got = bitmaps.merged(bitmaps.replace_years(stored, bitmaps.presence(df.where("year(date) = 1998"), more, "date", measures), [1998]))
    result = {r.measure: (r.symbols, r.total_rows) for r in got.collect()}
    known = [r for r in rows if r[2] is not None]
    assert result == {"all": (len({r[0] for r in rows}), len(rows)), "x": (len({r[0] for r in known}), len(known))}


def test_a_replayed_batch_is_passed_over(spark):
    store = Store(spark, new_workspace(spark), buckets=2)
    first = days(spark, "AB", 0, 50)
    store.ingest_bars(first, batch=("s", 0))
    mark = store.newest_mark()
    store.ingest_bars(days(spark, "AB", 0, 50, seed=2, arrival=9), batch=("s", 0))  # the number decides
    store.ingest_bars(first.withColumn("arrival", F.lit(3)), batch=("s", 1))  # equal bars, later arrival
    assert store.newest_mark() == mark
    changed = first.where("symbol = 'B'").orderBy("date").limit(30).orderBy(F.col("date").desc()).limit(1).withColumn("close", F.lit(1.0)).withColumn("arrival", F.lit(9))
    store.ingest_bars(changed, batch=("s", 2))
    marks = {r.symbol: r.since for r in store.read_dirty("weekly_rolled").where(F.col("batch") > mark).collect()}
    assert marks.keys() == {"B"}
    store.ingest_bars(first.withColumn("close", F.lit(2.0)), batch=("other", 0))  # older than what is stored
    assert store.newest_mark() == mark + 1
    store.ingest_bars(first.withColumns({"close": F.lit(2.0), "arrival": F.lit(99)}), batch=("other", 1))
    assert store.newest_mark() == mark + 2


def test_only_the_cut_carries_the_next_state(spark):
    """The state as of the cut is built on one row per symbol, and the indicators' own columns end with them."""
    weeks = resample_weekly(days(spark, "AB", 0, 400).drop("arrival"))
    none = F.lit(None).cast(rolling.SEED_TYPE).alias(rolling.SEED)
    out = rolling.with_state_columns(weeks.select("symbol", *rolling.BAR, F.lit(False).alias(rolling.HALO), none))
    ages = [(r["symbol"], r[rolling.AGE]) for r in out.where("__after IS NOT NULL").select("symbol", rolling.AGE).collect()]
    assert sorted(ages) == [("A", 1), ("B", 1)] and out.count() == weeks.count()
    assert not {"__row", "__tr", "__src", "__mclose", "__done", "__ind"} & set(out.columns)
