"""Stages of the weekly job as lazy frames: candles -> indicators -> signals -> snapshot.

Nothing here triggers a Spark job; ``plans.jobs`` writes the results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.operators.cycles import (
    CYCLE_COLUMNS,
    CYCLE_STAT_COLUMNS,
    closing_marks,
    cycle_levels,
    cycle_stat_columns,
    finish_cycle_stats,
    with_drawdown,
)
from barwright.operators.indicators import append_indicators, append_signal_inputs
from barwright.operators.signals import (
    EXIT_GAIN,
    SIGNAL_COLUMNS,
    STAT_COLUMNS,
    finish_stats,
    in_entry_zone,
    signal_levels,
    stat_columns,
)
from barwright.operators.windows import (
    CLOSE_WAS,
    ERA,
    NEWEST,
    Bars,
    drop_internal,
    lay_out,
    pack,
    run_levels,
    unpack,
)

# What the passes after the indicators read; the rest travels packed.
_READ_BY_SIGNALS = {
    "symbol", "week_start", "high", "low", "close", "fvb_upper_thresh", "fvb_lower_thresh",
    "fvb_band_green", "bx_monthly_dark_red", "tpx1", ERA, NEWEST, CLOSE_WAS,
}
_READ_BY_STATS = ["symbol", "week_start", "low", "close", ERA, NEWEST]


def append_signal_stage(df: DataFrame, bars: Bars) -> DataFrame:
    """Signals, cycles, and the statistics of both.  The two chains share their window
    passes level by level, then their statistics share one.  Finished columns travel
    packed by stage, so a query that reads none of a stage's columns still prunes it."""
    names = list(df.columns)
    df = pack(df, [c for c in names if c not in _READ_BY_SIGNALS], "__ind")
    df = run_levels(in_entry_zone(df), signal_levels(bars), [[], *cycle_levels(bars)])
    df = df.selectExpr("*", EXIT_GAIN)
    for_stats = ["sig_tp", "sig_in_position"]
    df = df.select(
        *_READ_BY_STATS, *for_stats, "cycle_bull", "cycle_pct", "__pct", "__exit_before",
        "__run", "__run_ends", "__ind",
        F.struct(*[c for c in names if c in _READ_BY_SIGNALS and c not in _READ_BY_STATS]).alias("__zone"),
        F.struct(*[c for c in SIGNAL_COLUMNS if c not in for_stats], "cycle_months").alias("__sig"),
    )
    df = with_drawdown(df).withColumns(closing_marks())
    aggregates = stat_columns() | cycle_stat_columns()
    df = df.withColumns({name: c.over(bars.whole) for name, c in aggregates.items()})
    df = finish_cycle_stats(finish_stats(df))
    for packed in ("__zone", "__sig", "__ind"):
        df = unpack(df, packed)
    return df.select(
        *names, *SIGNAL_COLUMNS, *STAT_COLUMNS, *CYCLE_COLUMNS, *CYCLE_STAT_COLUMNS
    )


def weekly_signals(candles: DataFrame, newest_only: bool = False) -> DataFrame:
    """Signals, cycles and statistics straight from weekly candles, in one exchange.
    ``newest_only`` keeps each symbol's last bar: the snapshot, without a sort of its own."""
    df, bars = lay_out(candles, "week_start", days_per_bar=7)
    df = append_signal_stage(append_signal_inputs(df, bars), bars)
    if newest_only:
        df = df.where(NEWEST)
    return drop_internal(df)


def signals_from_indicators(weekly: DataFrame) -> DataFrame:
    """The same stage on a stored weekly indicator table."""
    df, bars = lay_out(weekly, "week_start", days_per_bar=7)
    return drop_internal(append_signal_stage(df, bars))


def full_weekly(candles: DataFrame, newest_only: bool = False) -> DataFrame:
    """Every weekly column: indicators, signals, cycles and statistics, on one layout of the bars.
    ``newest_only`` keeps each symbol's last bar."""
    df, bars = lay_out(candles, "week_start", days_per_bar=7)
    laid_out = [NEWEST, ERA, CLOSE_WAS]
    df = append_indicators(df, bars, weekly=True)
    shown = [c for c in df.columns if not c.startswith("__")]
    ohlcv = [c for c in candles.columns if c in shown]
    df = df.select(*ohlcv, *[c for c in shown if c not in ohlcv], *laid_out)
    df = append_signal_stage(df, bars)
    if newest_only:
        df = df.where(NEWEST)
    return drop_internal(df)


def build_snapshot(weekly: DataFrame) -> DataFrame:
    """Latest weekly row of each symbol.  Spark cuts each input partition to one row per
    symbol before the exchange (window group limit)."""
    newest = Window.partitionBy("symbol").orderBy(F.col("week_start").desc())
    return (
        weekly.withColumn("__age", F.row_number().over(newest)).where("__age = 1").drop("__age")
    )
