"""Snapshot columns computed at query time, filters and the screens built on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.functions.numeric import pct_from
from barwright.operators.reports import last_n
from barwright.operators.signals import STAT_COLUMNS, deep_dive_metrics, equity_curve, trades
from barwright.operators.windows import PLAIN_WEEKLY

NO_VALUE = "--"

SIGNAL_BADGES = {
    "sig_entry": "Entry", "sig_reentry": "Re-Entry", "sig_add": "Add", "sig_tp": "TP Hit",
    "sig_sl": "SL",
}

CYCLE = ["cycle_bull", "cycle_months", "cycle_pct"]
LABELS = ["_fvb33_label", "_bx_monthly_label", "_bx_mo_wk"]


def dist_upper_pct(df: DataFrame) -> DataFrame:
    return df.withColumn("_dist_upper_pct", pct_from(F.col("fvb_upper_thresh"), F.col("close")))


def upside_to_tp_pct(df: DataFrame) -> DataFrame:
    return df.withColumn("_upside_to_tp_pct", pct_from(F.col("close"), F.col("tpx1")))


def unrealised_pct(df: DataFrame) -> DataFrame:
    gain = pct_from(F.col("sig_entry_price"), F.col("close"))
    return df.withColumn("_unrealised_pct", F.when(F.col("sig_in_position") == 1, gain))


def labels(df: DataFrame) -> DataFrame:
    def word(positive: str, up: str, down: str):
        return F.expr(f"if(coalesce({positive}, false), '{up}', '{down}')")

    monthly = F.when(F.col("bx_monthly_completed").isNull(), NO_VALUE).otherwise(
        word("bx_monthly_completed > 0", "Bullish", "Bearish")
    )
    return df.withColumns(
        {
            "_fvb33_label": word("fvb_band_green = 1", "Bullish", "Bearish"),
            "_bx_monthly_label": monthly,
            "_bx_weekly_label": word("bx > 0", "Bullish", "Bearish"),
            "_bx_mo_wk": F.concat_ws(
                "/", word("bx_monthly_completed > 0", "Bull", "Bear"), word("bx > 0", "Bull", "Bear")
            ),
        }
    )


def join_sector(df: DataFrame, universe: DataFrame) -> DataFrame:
    """Sector by symbol, a dash where there is none.  The universe grows with the
    symbols, so it is not hinted: Spark broadcasts it only below its size threshold."""
    sectors = universe.select("symbol", "sector")
    return df.join(sectors, "symbol", "left").withColumn(
        "sector", F.coalesce("sector", F.lit(NO_VALUE))
    )


def load_backtest_snapshot(snapshot: DataFrame, universe: DataFrame) -> DataFrame:
    """Snapshot with the derived columns and the sector; nothing of it is stored."""
    return join_sector(labels(unrealised_pct(upside_to_tp_pct(dist_upper_pct(snapshot)))), universe)


def filter_snapshot(
    df: DataFrame,
    band: str | None = None,
    monthly: str | None = None,
    mo_wk: str | None = None,
    sectors: Iterable[str] | None = None,
    min_price: float = 5.0,
) -> DataFrame:
    for column, wanted in zip(LABELS, (band, monthly, mo_wk), strict=True):
        if wanted is not None:
            df = df.where(F.col(column) == wanted)
    if sectors is not None:
        df = df.where(F.col("sector").isin(list(sectors)))
    return df.where(F.col("close") >= min_price)


def filter_signals(df: DataFrame, kinds: Iterable[str] = tuple(SIGNAL_BADGES)) -> DataFrame:
    wanted = F.lit(False)
    for kind in kinds:
        wanted = wanted | (F.col(kind) == 1)
    return df.where(wanted)


def filter_in_position(df: DataFrame) -> DataFrame:
    return df.where(F.col("sig_in_position") == 1)


def filter_leaderboard(
    df: DataFrame,
    min_trades: int = 5,
    min_win: float = 0.0,
    min_pf: float = 1.0,
    sector: str | None = None,
) -> DataFrame:
    df = df.where(
        (F.col("bt_trades") >= min_trades)
        & (F.col("bt_win_rate") >= min_win)
        & (F.col("bt_profit_factor") >= min_pf)
    )
    return df if sector is None else df.where(F.col("sector") == sector)


def signal_badge() -> Column:
    return F.concat_ws(
        " + ", *[F.when(F.col(flag) == 1, F.lit(text)) for flag, text in SIGNAL_BADGES.items()]
    )


def screen_active_signals(
    view: DataFrame, kinds: Iterable[str] = tuple(SIGNAL_BADGES), **filters
) -> DataFrame:
    rows = filter_signals(filter_snapshot(view, **filters), kinds)
    return rows.select(
        "symbol", "sector", signal_badge().alias("signal"), F.col("close").alias("price"),
        "_dist_upper_pct", "_upside_to_tp_pct", *LABELS, *CYCLE,
        "bt_win_rate", "bt_profit_factor", "bt_geo_return", "bt_trades",
    ).orderBy("symbol")


def screen_in_position(view: DataFrame) -> DataFrame:
    return filter_in_position(view).select(
        "symbol", "sector", F.col("close").alias("price"),
        F.col("sig_entry_price").alias("entry_price"), "_unrealised_pct", "tpx1",
        "_upside_to_tp_pct", *LABELS, *CYCLE, "bt_win_rate", "bt_profit_factor",
        "bt_weeks_in_trade",
    ).orderBy("symbol")


def position_summary(view: DataFrame) -> DataFrame:
    """One row over the held positions; ties for the best go to the first symbol."""
    held = filter_in_position(view)
    gain = F.col("_unrealised_pct")
    best = F.min_by("symbol", F.struct((-gain).alias("g"), F.col("symbol").alias("s")))
    return held.agg(
        F.count(F.lit(1)).alias("positions"),
        F.count(F.when(gain > 0, 1)).alias("profitable"),
        F.avg(gain).alias("avg_unrealised"),
        best.alias("best_symbol"),
        F.max(gain).alias("best_unrealised"),
    )


def rank_leaderboard(view: DataFrame, **filters) -> DataFrame:
    """Best compounded return first, then by symbol."""
    return filter_leaderboard(view, **filters).orderBy(
        F.col("bt_geo_return").desc_nulls_last(), "symbol"
    )


def screen_leaderboard(view: DataFrame, **filters) -> DataFrame:
    return rank_leaderboard(view, **filters).select("symbol", "sector", *STAT_COLUMNS)


def current_status(view: DataFrame) -> DataFrame:
    held = F.col("sig_in_position") == 1
    return view.select(
        "symbol", F.col("close").alias("price"), *LABELS, "sig_in_position",
        F.when(held, F.col("sig_entry_price")).alias("entry_price"),
        F.when(held, F.col("_unrealised_pct")).alias("unrealised_pct"),
        F.when(held, F.col("tpx1")).alias("target"),
    )


def price_history_window(weekly: DataFrame, years: int = 5) -> DataFrame:
    """The last years of each symbol's chart series, counted from its own last bar."""
    newest = F.max("week_start").over(Window.partitionBy("symbol"))
    return (
        weekly.select(
            "symbol", "week_start", "close", "fvb_upper_thresh", "fvb_lower_thresh", "tpx1",
            newest.alias("__newest"),
        )
        .where(F.col("week_start") >= F.add_months("__newest", -12 * years))
        .drop("__newest")
    )


def screen_deep_dive(
    weekly: DataFrame, universe: DataFrame, symbol: str | None = None
) -> dict[str, DataFrame]:
    """Five frames from the full weekly history; ``symbol`` is only a filter on it, all
    symbols are computed alike."""
    if symbol is not None:
        weekly = weekly.where(F.col("symbol") == symbol)
    trade_list = trades(weekly, PLAIN_WEEKLY)
    return {
        "metrics": deep_dive_metrics(weekly, PLAIN_WEEKLY),
        "status": current_status(load_backtest_snapshot(last_n(weekly, 1, "week_start"), universe)),
        "equity": equity_curve(trade_list),
        "prices": price_history_window(weekly),
        "trades": trade_list,
    }
