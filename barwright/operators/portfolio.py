"""Weekly candidates, capacity-limited selection and scores.

The selection and score formulas are this package's own definitions: the job names
are known, their rules are not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.functions.numeric import half_up, ratio
from barwright.operators.incremental import new_weeks_only, universe_semi_join
from barwright.operators.screens import upside_to_tp_pct

CAPS = (60, 50, 40, 30)
RELATIVE_STRENGTH_WEEKS = 52


def no_penny_stocks(df: DataFrame, minimum: float = 5.0) -> DataFrame:
    return df.where(F.col("close") >= minimum)


def weekly_candidates(
    signals: DataFrame, universe: DataFrame | None = None, entries_only: bool = True
) -> DataFrame:
    """Entry and re-entry rows (or all rows with a target) with their upside to it; with a
    universe, only those of index members.  ``next_return`` is passed on where it is known."""
    rows = signals.where("sig_entry = 1 or sig_reentry = 1" if entries_only else "tpx1 is not null")
    if universe is not None:
        rows = universe_semi_join(rows, universe)
    return upside_to_tp_pct(rows).select(
        "symbol", "week_start", "close", "tpx1", F.col("_upside_to_tp_pct").alias("upside_pct"),
        *[c for c in ("next_return",) if c in signals.columns],
    )


def select_top_by_upside(candidates: DataFrame, cap: int) -> DataFrame:
    """The ``cap`` best of each week.  Every input partition first keeps its own best
    ``cap`` per week (window group limit), so a crowded week is never shuffled whole."""
    best = Window.partitionBy("week_start").orderBy(
        F.col("upside_pct").desc_nulls_last(), "symbol"
    )
    return candidates.withColumn("pick", F.row_number().over(best)).where(F.col("pick") <= cap)


def with_next_return(weekly: DataFrame) -> DataFrame:
    """Return from this bar's close to the symbol's next one; NULL on its last bar."""
    following = F.lead("close", 1).over(Window.partitionBy("symbol").orderBy("week_start"))
    return weekly.withColumn("next_return", ratio(following, F.col("close")) - 1.0)


def weekly_basket_return(candidates: DataFrame, cap: int, digits: int = 6) -> DataFrame:
    """Equal-weight return of each week's selection and its compounded value, from candidates
    with ``next_return`` (see ``with_next_return``, taken in the pass that gives the signals).  After
    the weekly aggregate there is one row per calendar week.  Returns are compounded as they are
    shown, with ``digits`` places."""
    baskets = (
        select_top_by_upside(candidates, cap)
        .where(F.col("next_return").isNotNull())
        .groupBy("week_start")
        .agg(F.count(F.lit(1)).alias("names"), half_up(F.avg("next_return"), digits).alias("basket_return"))
    )
    sofar = Window.orderBy("week_start").rowsBetween(Window.unboundedPreceding, 0)
    return baskets.withColumn("growth", F.product(1.0 + F.col("basket_return")).over(sofar))


# --- reference series ---------------------------------------------------------------


def load_reference_series(
    candles: DataFrame, universe: DataFrame | None = None, ts: str = "week_start"
) -> DataFrame:
    """Equal-weight close of all symbols per time, which stands in for the index fund, or
    with a universe one series per sector for the sector funds."""
    if universe is None:
        return candles.groupBy(ts).agg(F.avg("close").alias("close"))
    sectors = universe.where(F.col("sector").isNotNull()).select("symbol", "sector")
    return candles.join(sectors, "symbol").groupBy("sector", ts).agg(F.avg("close").alias("close"))


def landed_series(candles: DataFrame, funds: DataFrame | str, ts: str = "week_start") -> DataFrame:
    """Reference series from landed fund bars: of one fund symbol, or with a frame (sector,
    symbol) one series per sector."""
    if isinstance(funds, str):
        return candles.where(F.col("symbol") == funds).select(ts, "close")
    return candles.join(funds.select("sector", "symbol"), "symbol").select("sector", ts, "close")


def sector_relative(
    weekly: DataFrame, universe: DataFrame, series: DataFrame | None = None
) -> DataFrame:
    """Each bar next to the series of its symbol's sector: landed fund bars, or the mean of the
    sector's symbols."""
    series = load_reference_series(weekly, universe) if series is None else series
    series = series.withColumnRenamed("close", "sector_close")
    return (
        weekly.select("symbol", "week_start", "close")
        .join(universe.where(F.col("sector").isNotNull()).select("symbol", "sector"), "symbol")
        .join(series, ["sector", "week_start"])
        .withColumn("relative", ratio(F.col("close"), F.col("sector_close")))
    )


# --- scores -----------------------------------------------------------------------


def score_rs(
    weekly: DataFrame, weeks: int = RELATIVE_STRENGTH_WEEKS, market: DataFrame | None = None, kept: Sequence[Column] = ()
) -> DataFrame:
    """Return over the last ``weeks`` bars less that of the market series: landed bars of an
    index fund, or the mean of all symbols.  The series has one row per calendar week, some
    5,200 a century, so it is broadcast.  ``kept`` are further columns of the bars."""

    def grown(order) -> Column:
        return ratio(F.col("close"), F.lag("close", weeks).over(order)) - 1.0

    market = load_reference_series(weekly) if market is None else market
    market = market.select("week_start", grown(Window.orderBy("week_start")).alias("market_return"))
    own = weekly.withColumn("__own", grown(Window.partitionBy("symbol").orderBy("week_start")))
    return own.join(F.broadcast(market), "week_start").select(
        "symbol", "week_start", (F.col("__own") - F.col("market_return")).alias("score_rs"), *kept
    )


def score_rvr(signals: DataFrame) -> DataFrame:
    return signals.select("symbol", "week_start", F.col("cycle_rvr").alias("score_rvr"))


def band_position() -> Column:
    return ratio(
        F.col("close") - F.col("fvb_lower_thresh"),
        F.col("fvb_upper_thresh") - F.col("fvb_lower_thresh"),
    )


def score_band_position(signals: DataFrame) -> DataFrame:
    return signals.select("symbol", "week_start", band_position().alias("score_band"))


def _bin(value: str, slices: int) -> Column:
    """A whole number that grows with the value: ``slices`` numbers for each doubling of its size."""
    x = F.col(value)
    size = F.floor(F.least(F.greatest(F.log2(F.abs(x)), F.lit(-1100.0)), F.lit(1100.0)) * slices) + 1101 * slices
    return F.when(x == 0, F.lit(0).cast("bigint")).when(x < 0, -size).otherwise(size)


def percent_rank_within(
    df: DataFrame, groups: list[str], value: str, out: str, slices: int = 64
) -> DataFrame:
    """``percent_rank`` of a value inside large groups, without one task per group.

    A histogram of each group, with bins as wide as a fixed share of the value, says how many rows
    lie in lower bins; it is a sum, so it is combined before the exchange and may be kept and added to.
    Inside a bin rows are ranked exactly.  No task sees more of a group than one bin."""
    ranked = df.where(F.col(value).isNotNull()).withColumn("__bin", _bin(value, slices))
    by_bin = Window.partitionBy(*groups).orderBy("__bin")
    histogram = ranked.groupBy(*groups, "__bin").agg(F.count(F.lit(1)).alias("__n")).select(
        *groups, "__bin",
        F.coalesce(F.sum("__n").over(by_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__lower"),
        F.sum("__n").over(Window.partitionBy(*groups)).alias("__all"),
    )
    inside = F.rank().over(Window.partitionBy(*groups, "__bin").orderBy(value)) - 1
    place = (F.col("__lower") + F.col("__inside")).cast("double") / F.nullif((F.col("__all") - 1).cast("double"), F.lit(0.0))
    return (
        ranked.withColumn("__inside", inside)
        .join(histogram, [*groups, "__bin"])
        .withColumn(out, F.coalesce(place, F.lit(0.0)))
        .drop("__bin", "__inside", "__lower", "__all")
    )


SCORES = ["score_rs", "score_rvr", "score_band"]


def scores(
    signals: DataFrame, done: DataFrame | None = None, force: bool = False
) -> DataFrame:
    """Mean of the percent ranks of the three scores among all symbols of a week.  With
    the scores already ``done``, only newer weeks are ranked unless forced."""
    rows = score_rs(signals, kept=[F.col("cycle_rvr").alias("score_rvr"), band_position().alias("score_band")])
    if done is not None:
        rows = new_weeks_only(rows, done, force)
    metric = F.explode(
        F.array(*[F.struct(F.lit(s).alias("metric"), F.col(s).alias("value")) for s in SCORES])
    )
    long = rows.select("symbol", "week_start", metric.alias("m")).select(
        "symbol", "week_start", "m.metric", "m.value"
    )
    ranked = percent_rank_within(long, ["week_start", "metric"], "value", "rank")
    return ranked.groupBy("symbol", "week_start").agg(
        *[F.max(F.when(F.col("metric") == s, F.col("rank"))).alias(f"{s}_rank") for s in SCORES],
        F.avg("rank").alias("score"),
    )
