"""Positions, trades and cycles computed slice by slice.

A slice is any integer column that grows with time inside a symbol, such as the year.  What
a slice does to the running state is summed up in a few values, the summaries of one symbol are
combined in order (one row per slice), and with the state before it known every slice is worked
out by itself.  Slices of one symbol thus run side by side, and a new slice needs the stored
summaries only.

* Position: each bar maps the states {flat, long, flat after a target} to themselves, so does a
  slice, and maps combine by composition, which is associative.
* Trades: the last entry of a slice stays open until a later slice closes it.
* Cycles: a slice is cut into pieces, its runs of bull and bear weeks.  Pieces that touch across a
  border are one run: its peak is the larger one, and since x / max(a, b) is the smaller of x / a and
  x / b for prices, its drawdown is the smallest of those of the pieces and of each piece's low
  against the peaks before it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.functions.numeric import ratio
from barwright.operators.cycles import cycle_stat_columns, finish_cycle_stats
from barwright.operators.signals import SIGNAL_COLUMNS, in_entry_zone, signal_levels
from barwright.operators.windows import HALO, SEED, Bars, run_levels

FLAT, LONG, FLAT_AFTER_TARGET = 0, 1, 2
_EVENTS = {
    "e": "fvb_band_green = 1 and bx_monthly_dark_red = 0 and in_entry_zone = 1 and tpx1 is not null",
    "t": "high >= tpx1",
    "l": "bx_monthly_dark_red = 1",
}


def slice_bars(slice_column: str, seeded: bool = True) -> Bars:
    return Bars("week_start", (), seeded=seeded, by=("symbol", slice_column))


def year_slices(df: DataFrame, name: str = "slice") -> DataFrame:
    return df.withColumn(name, F.year("week_start"))


def carried_in(summaries: DataFrame, slice_column: str, values: Mapping[str, str]) -> DataFrame:
    """(symbol, slice) with the last non-NULL value of each column in earlier slices."""
    earlier = Window.partitionBy("symbol").orderBy(slice_column).rowsBetween(Window.unboundedPreceding, -1)
    return summaries.select(
        "symbol", slice_column, *[F.last(c, ignorenulls=True).over(earlier).alias(out) for c, out in values.items()]
    )


# --- position ------------------------------------------------------------------------------


def position_maps(df: DataFrame, slice_column: str) -> DataFrame:
    """(symbol, slice, map): the state after the slice for each state before it."""
    events = [F.expr(f"coalesce({text}, false)").alias(name) for name, text in _EVENTS.items()]
    bars = in_entry_zone(df.drop(*SIGNAL_COLUMNS)).select("symbol", slice_column, F.struct("week_start", *events).alias("bar"))
    step = (
        f"case when s = {LONG} then case when b.t then {FLAT_AFTER_TARGET} when b.l then {FLAT} else {LONG} end"
        f" when b.e then {LONG} else s end"
    )
    fold = (
        f"aggregate(array_sort(collect_list(bar)), array({FLAT}, {LONG}, {FLAT_AFTER_TARGET}),"
        f" (m, b) -> transform(m, s -> {step}))"
    )
    return bars.groupBy("symbol", slice_column).agg(F.expr(fold).alias("map"))


def compose(first: str, then: str) -> str:
    """SQL of the map that applies one map and then another."""
    return f"transform({first}, s -> element_at({then}, s + 1))"


def states_before(maps: DataFrame, slice_column: str, start: Column | None = None) -> DataFrame:
    """(symbol, slice, state): the state in which each slice begins.  ``start`` is the state before
    the first slice of the frame, flat unless stored slices come before it."""
    earlier = Window.partitionBy("symbol").orderBy(slice_column).rowsBetween(Window.unboundedPreceding, -1)
    begin = F.lit(FLAT) if start is None else start
    lists = maps.select("symbol", slice_column, F.collect_list("map").over(earlier).alias("maps"), begin.alias("begin"))
    whole = f"aggregate(maps, array({FLAT}, {LONG}, {FLAT_AFTER_TARGET}), (a, m) -> {compose('a', 'm')})"
    return lists.select("symbol", slice_column, F.expr(f"element_at({whole}, begin + 1)").alias("state"))


def signals_by_slice(df: DataFrame, slice_column: str = "slice") -> DataFrame:
    """``sig_*`` columns and ``__entry``, ``__trade`` (see ``signals.with_exits``), every slice by itself
    once the state before it is known."""
    df = df.drop(*SIGNAL_COLUMNS)
    names = list(df.columns)
    states = states_before(position_maps(df, slice_column), slice_column).select(
        "symbol", slice_column,
        F.struct(
            (F.col("state") == LONG).cast("int").alias("long"), F.lit(None).cast("double").alias("entry_close"),
            F.when(F.col("state") == FLAT_AFTER_TARGET, "TP").otherwise("SL").alias("exit_kind"),
        ).alias(SEED),
    )
    bars = slice_bars(slice_column)
    own = run_levels(in_entry_zone(df.join(states, ["symbol", slice_column]).withColumn(HALO, F.lit(False))), signal_levels(bars))
    opened = "sig_entry = 1 or sig_reentry = 1"
    own = own.selectExpr(
        "*",
        f"last(if({opened}, named_struct('day', week_start, 'price', close, 'again', sig_reentry), null), true)"
        f" over ({bars.sql_upto}) as __opened",
        f"sum(int({opened})) over ({bars.sql_upto}) as __trade_here",
    )
    ends = own.groupBy("symbol", slice_column).agg(
        F.max_by("__opened", "week_start").alias("__opened"), F.max("__trade_here").alias("__trades")
    )
    order = Window.partitionBy("symbol").orderBy(slice_column).rowsBetween(Window.unboundedPreceding, -1)
    # One frame: what the bars of a slice come to is worked out once for both columns.
    before = ends.select(
        "symbol", slice_column, F.last("__opened", ignorenulls=True).over(order).alias("__open_before"),
        F.coalesce(F.sum("__trades").over(order), F.lit(0)).alias("__trades_before"),
    )
    both = own.join(before, ["symbol", slice_column]).withColumn("__entry", F.coalesce("__opened", "__open_before"))
    both = both.withColumns({
        "__trade": F.col("__trade_here") + F.col("__trades_before"),
        "sig_entry_price": F.when(F.col("sig_in_position") == 1, F.col("__entry.price")),
    })
    return both.select(*names, *SIGNAL_COLUMNS, "__entry", "__trade")


def trades_by_slice(df: DataFrame, slice_column: str = "slice") -> DataFrame:
    """Completed trades (see ``signals.trades``), also those that were opened in an earlier slice."""
    closed = signals_by_slice(df, slice_column).where("(sig_tp = 1 or sig_sl = 1) and __entry is not null")
    price = F.when(F.col("sig_tp") == 1, F.col("tpx1")).otherwise(F.col("close"))
    entry = F.col("__entry.price")
    return closed.select(
        "symbol", F.col("__trade").alias("trade_id"), F.col("__entry.day").alias("entry_date"), F.col("week_start").alias("exit_date"),
        F.when(F.col("__entry.again") == 1, "Re-Entry").otherwise("Entry").alias("entry_type"),
        F.when(F.col("sig_tp") == 1, "TP").otherwise("SL").alias("exit_type"),
        entry.alias("entry_price"), price.alias("exit_price"), (ratio(price - entry, entry) * 100.0).alias("pct_gain"),
        (F.datediff("week_start", "__entry.day") / 7.0).alias("hold_weeks"),
    )


# --- cycles ----------------------------------------------------------------------------------


def cycle_pieces(df: DataFrame, slice_column: str = "slice") -> DataFrame:
    """One row per run of equal ``cycle_bull`` inside a slice: its first day, first and last close, peak,
    low and drawdown (a fraction).  Store these and a new slice needs no older bars."""
    bars = slice_bars(slice_column, seeded=False)
    event = "case when bx_monthly_dark_red = 0 and fvb_band_green = 1 then 1 when bx_monthly_dark_red = 1 then 0 end"
    turns = df.withColumn("__event", F.expr(event))
    last = turns.groupBy("symbol", slice_column).agg(
        F.max_by("__event", F.when(F.col("__event").isNotNull(), F.col("week_start"))).alias("__event")
    )
    before = carried_in(last, slice_column, {"__event": "__bull_before"})
    own = turns.join(before, ["symbol", slice_column]).selectExpr(
        "symbol", slice_column, "week_start", "close", "low",
        f"coalesce(last(__event, true) over ({bars.sql_upto}), __bull_before, 0) as bull",
    ).selectExpr("*", f"coalesce(lag(bull, 1) over ({bars.sql_order}) <> bull, true) as __starts").selectExpr(
        "*", f"sum(int(__starts)) over ({bars.sql_upto}) as piece"
    )
    run = Window.partitionBy("symbol", slice_column, "piece").orderBy("week_start").rowsBetween(Window.unboundedPreceding, 0)
    dip = ratio(F.col("low"), F.max("close").over(run)) - 1.0
    return own.withColumn("__dip", dip).groupBy("symbol", slice_column, "piece").agg(
        F.first("bull").alias("bull"), F.min("week_start").alias("first_week"),
        F.min_by("close", "week_start").alias("first_close"), F.max_by("close", "week_start").alias("last_close"),
        F.max("close").alias("peak"), F.min("low").alias("low"), F.min("__dip").alias("dip"),
    )


def cycles_from_pieces(pieces: DataFrame, slice_column: str = "slice") -> DataFrame:
    """Runs over all slices: bull, start day and price, end close, drawdown in percent, and whether
    a later run has completed them."""
    order = Window.partitionBy("symbol").orderBy(slice_column, "piece")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    linked = pieces.withColumns({
        "__starts": F.coalesce(F.lag("bull").over(order) != F.col("bull"), F.lit(True)),
        "__close_was": F.lag("last_close").over(order),
    }).withColumn("run", F.sum(F.col("__starts").cast("int")).over(upto))
    inside = Window.partitionBy("symbol", "run").orderBy(slice_column, "piece")
    peak_before = F.max("peak").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    linked = linked.withColumn("__dip", F.least("dip", ratio(F.col("low"), peak_before) - 1.0))
    runs = linked.groupBy("symbol", "run").agg(
        F.first("bull").alias("bull"), F.min("first_week").alias("start_day"),
        F.min_by(F.coalesce("__close_was", "first_close"), F.col("first_week")).alias("start_price"),
        F.max_by("last_close", "first_week").alias("end_close"),
        (F.min("__dip") * 100.0).alias("drawdown"),
    )
    later = Window.partitionBy("symbol").orderBy("run")
    return runs.withColumn("completed", F.lead("run").over(later).isNotNull())


def cycle_stats_by_slice(df: DataFrame, slice_column: str = "slice") -> DataFrame:
    """Statistics of completed bull cycles per symbol (see ``cycles.cycle_stat_columns``)."""
    runs = cycles_from_pieces(cycle_pieces(df, slice_column), slice_column)
    closing = F.col("completed") & (F.col("bull") == 1)
    gain = ratio(F.col("end_close") - F.col("start_price"), F.col("start_price")) * 100.0
    marked = runs.select("symbol", F.when(closing, gain).alias("__gain"), F.when(closing, F.col("drawdown")).alias("__dip"))
    totals = marked.groupBy("symbol").agg(*[c.alias(n) for n, c in cycle_stat_columns().items()])
    out = finish_cycle_stats(totals)
    return out.select([c for c in out.columns if not c.startswith("__")])
