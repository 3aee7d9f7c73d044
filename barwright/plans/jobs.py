"""Jobs that write stage tables.  Each is safe to repeat: slices are replaced from staged
files, and state and marks are written last.

Stages: ``daily`` and ``weekly_indicators`` read the daily bars, ``weekly`` (signals) reads the
weekly indicators.  A stage's state says up to which daily bar its input reached.  A symbol is
due when its input was marked as changed, when it has no state, when its state has another
logic version, or when its input is newer than its state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.operators.incremental import versioned_recompute
from barwright.operators.indicators import compute_indicators
from barwright.operators.quality import repair_anti_join, reset_state
from barwright.operators.signals import SIGNAL_VERSION
from barwright.plans.stages import build_snapshot, signals_from_indicators
from barwright.sources.candles import resample_weekly
from barwright.sources.tables import SLICES, Store, time_column

STAGE_OF = {"daily": "daily", "weekly": "weekly_indicators"}


def _due(store: Store, stage: str, inputs: DataFrame, force: bool) -> DataFrame:
    """Symbols a stage has to recompute, staged; ``inputs`` holds (symbol, newest)."""
    symbols = store.read_dirty(stage).select("symbol")
    if force:
        return store.staged(symbols.unionByName(inputs.select("symbol")).distinct())
    stale = versioned_recompute(inputs, store.read_state(stage), SIGNAL_VERSION).select("symbol")
    return store.staged(symbols.unionByName(stale).distinct())


def _newest_bars(store: Store) -> DataFrame:
    return store.read("daily").groupBy("symbol").agg(F.max("date").alias("newest"))


def _finish(store: Store, stage: str, symbols: DataFrame, inputs: DataFrame, read: int) -> None:
    """State of the symbols as their input was read; a symbol without input has none."""
    done = symbols.select(F.lit(stage).alias("period"), "symbol")
    fresh = inputs.join(symbols, "symbol", "left_semi").select(
        F.lit(stage).alias("period"), "symbol", F.col("newest").alias("last_date"), F.lit(SIGNAL_VERSION).alias("logic_version")
    )
    store.write_state(fresh, done)
    store.clear_dirty(symbols, stage, read)


def _rewrite(store: Store, table: str, source: str, symbols: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> None:
    """Compute all buckets of a table that hold one of the symbols anew from the bars of ``source``, in
    passes over a few buckets; slices of these buckets that have no row any more are emptied.  A pass
    exchanges its bars once, before they are computed, and writes its rows where they were computed."""
    exists = store.exists(table)
    buckets, _ = store._layout(table)
    for held in store.passes(table, symbols, source):
        bars = store.of_buckets(source, held, buckets)
        scope = times = None
        if exists:
            ts = time_column(bars.columns)
            label = F.date_trunc("week", ts).cast("date").alias("week_start") if "weekly" in table else F.col(ts)
            times, scope = bars.select("symbol", label), store.of_buckets(table, held, buckets)
        parts, few = store.by_bucket(bars.drop(*SLICES, "arrival"), buckets, len(held))
        store.write_bars(compute(parts), table, scope, times, few)


def run_indicators(store: Store, period: str = "weekly", force: bool = False) -> bool:
    """Indicators of the symbols that are due; False when nothing was to be done.  A bucket is
    rewritten whole, with the whole history of its symbols."""
    stage = STAGE_OF[period]
    read = store.newest_mark()
    newest = store.staged(_newest_bars(store))
    symbols = _due(store, stage, newest, force)
    if symbols.isEmpty():
        store.clean()
        return False
    candles = resample_weekly if period == "weekly" else lambda bars: bars
    _rewrite(store, f"{period}_indicators", "daily", symbols, lambda bars: compute_indicators(candles(bars), period))
    if period == "weekly":
        store.mark_dirty(symbols, "weekly")
    _finish(store, stage, symbols, newest, read)
    store.clean()
    return True


def run_signals(store: Store, force: bool = False) -> bool:
    """Signals of the symbols that are due, from the stored weekly indicators and no newer
    bars, then the snapshot and the state."""
    read = store.newest_mark()
    inputs = store.staged(store.read_state("weekly_indicators").select("symbol", F.col("last_date").alias("newest")))
    symbols = _due(store, "weekly", inputs, force)
    if symbols.isEmpty():
        store.clean()
        return False
    _rewrite(store, "weekly", "weekly_indicators", symbols, signals_from_indicators)
    write_snapshot(store)
    _finish(store, "weekly", symbols, inputs, read)
    store.clean()
    return True


def run_weekly(store: Store, force: bool = False) -> bool:
    """Indicators and signals: only symbols that are due, unless forced."""
    changed = run_indicators(store, "weekly", force)
    return run_signals(store, force) or changed


def run_full(store: Store, landing: DataFrame | None = None, force: bool = False) -> bool:
    """Landed bars, daily indicators, weekly indicators, signals, snapshot."""
    if landing is not None:
        store.ingest_bars(landing)
    changed = run_indicators(store, "daily", force)
    return run_weekly(store, force) or changed


def newest_slices(store: Store, table: str) -> DataFrame:
    """All rows of the slices that hold some symbol's newest bar.  Which these are is known from symbols
    and times alone, so whole rows are read of few slices instead of all."""
    bars = store.read(table)
    ts = time_column(bars.columns)
    newest = bars.groupBy("symbol").agg(F.max(ts).alias(ts))
    return store.slices_of(table, newest).drop(*SLICES, "arrival")


def write_snapshot(store: Store) -> int:
    store.overwrite(build_snapshot(newest_slices(store, "weekly")), "weekly_snapshot")
    return store.read("weekly_snapshot").count()


def _drop_bars(store: Store, bad: DataFrame) -> None:
    """Remove the named daily bars; slices without any other bar are emptied."""
    stored = store.same_slices("daily", bad)
    kept = repair_anti_join(stored.drop(*SLICES), bad, "date")
    store.replace_slices(kept, "daily", stored.select(*SLICES).distinct())
    store.mark_dirty(bad.select("symbol").distinct(), "daily", "weekly_indicators", "weekly_rolled")


def run_repair(store: Store, bad: DataFrame) -> None:
    """Delete bad daily bars, set their symbols back so that the next load refills them, and
    mark them, so that the next run recomputes them even if no bar comes."""
    bad = store.staged(bad.select("symbol", "date").distinct())
    _drop_bars(store, bad)
    state = store.read_state()
    for stage in ("daily", "weekly_indicators", "weekly"):
        state = reset_state(state, bad, "date", stage)
    store.write_state(state)
    store.clean()


def run_repair_all(store: Store, from_date: str) -> None:
    """Drop every daily bar from a date on, set all symbols of all periods back to it, and
    recompute what was derived from the bars."""
    day = F.lit(from_date).cast("date")
    bad = store.staged(store.read("daily").where(F.col("date") >= day).select("symbol", "date"))
    _drop_bars(store, bad)
    state = store.read_state().withColumn("last_date", F.least("last_date", F.date_sub(day, 1)))
    store.write_state(state)
    for period in ("daily", "weekly"):
        if store.exists(f"{period}_indicators"):
            run_indicators(store, period)
    if store.exists("weekly"):
        run_signals(store)
    store.clean()
