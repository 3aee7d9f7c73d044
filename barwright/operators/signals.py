"""Weekly position signals, trades and backtest statistics.

The position machine is FLAT -> LONG -> FLAT, where an entry after a target exit is
a re-entry.  It is written with window functions only.  Per bar, with E = entry
condition, T = high reached the target, L = monthly oscillator dark red (E excludes L):

    E without T           position becomes 1
    T or L without E      position becomes 0
    E and T               position flips (a target exit when long, an entry when flat)
    otherwise             position stays

So the position is the value set by the last unconditional event, flipped once for
every E-and-T bar since."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.functions.numeric import half_up, ratio
from barwright.operators.windows import Bars, run_levels

# Fixed values of the entry zone.
ZONE_BELOW_LOWER, ZONE_ABOVE_UPPER = 0.75, 1.03
SIGNAL_VERSION = "1.3"

SIGNAL_COLUMNS = [
    "in_entry_zone", "sig_entry", "sig_reentry", "sig_add", "sig_tp", "sig_sl",
    "sig_in_position", "sig_entry_price",
]


def in_entry_zone(df: DataFrame) -> DataFrame:
    inside = (
        f"close >= {ZONE_BELOW_LOWER}D * fvb_lower_thresh"
        f" and close <= {ZONE_ABOVE_UPPER}D * fvb_upper_thresh"
    )
    return df.selectExpr("*", f"int(coalesce({inside}, false)) as in_entry_zone")


def signal_rule_versions(df: DataFrame) -> DataFrame:
    """Bars where the earlier gate (completed month above zero) and the present one
    (completed month not dark red) decide differently."""
    gates = df.selectExpr(
        "*",
        "int(coalesce(bx_monthly_completed > 0, false)) as gate_v12",
        "int(bx_monthly_dark_red = 0) as gate_v13",
    )
    return gates.where("gate_v12 <> gate_v13")


def position_levels(bars: Bars, entry: str, target: str, stop: str) -> list[list[str]]:
    """Levels (see ``windows.run_levels``) that give ``__long`` (after the bar) and
    ``__was_long`` (before it) for three boolean SQL conditions without NULLs, of which
    ``entry`` and ``stop`` exclude each other."""
    return [
        [
            f"case when ({entry}) and not ({target}) then 1"
            f" when not ({entry}) and (({target}) or ({stop})) then 0 end as __event",
            f"int(({entry}) and ({target})) as __flip",
        ],
        [
            f"last(__event, true) over ({bars.sql_upto}) as __set",
            f"sum(__flip) over ({bars.sql_upto}) as __flips",
        ],
        [f"last(if(__event is null, null, __flips), true) over ({bars.sql_upto}) as __flips_then"],
        [f"int(pmod(coalesce({bars.known('__set', 'long')}, 0) + __flips - coalesce(__flips_then, 0), 2)) as __long"],
        [f"coalesce({bars.known(f'lag(__long, 1) over ({bars.sql_order})', 'long')}, 0) as __was_long"],
    ]


def signal_levels(bars: Bars) -> list[list[str]]:
    """Levels from ``in_entry_zone`` and the indicator columns to the ``sig_*`` columns.
    ``__entry_close`` is the price of the latest entry and ``__exit_before`` the kind of
    the latest exit before the bar; on a bar that closes a trade they tell how and at
    what price it was opened."""
    events = {
        "__e": "fvb_band_green = 1 and bx_monthly_dark_red = 0 and in_entry_zone = 1 and tpx1 is not null",
        "__t": "high >= tpx1",
        "__l": "bx_monthly_dark_red = 1",
    }
    conditions = [f"coalesce({bars.own(text)}, false) as {name}" for name, text in events.items()]
    return [
        conditions,
        *position_levels(bars, "__e", "__t", "__l"),
        [
            "__was_long = 0 and __long = 1 as __entered",
            "int(__was_long = 1 and __long = 0 and __t) as sig_tp",
            "int(__was_long = 1 and __long = 0 and not __t) as sig_sl",
            "int(__was_long = 1 and __e and not __t) as sig_add",
        ],
        [
            "coalesce("
            + bars.known(f"last(case when sig_tp = 1 then 'TP' when sig_sl = 1 then 'SL' end, true) over ({bars.sql_before})", "exit_kind")
            + ", 'SL') as __exit_before",
            bars.known(f"last(if(__entered, close, null), true) over ({bars.sql_upto})", "entry_close") + " as __entry_close",
        ],
        [
            "int(__entered and __exit_before = 'SL') as sig_entry",
            "int(__entered and __exit_before = 'TP') as sig_reentry",
            "__long as sig_in_position",
            "if(__long = 1, __entry_close, null) as sig_entry_price",
        ],
    ]


def append_signals(df: DataFrame, bars: Bars) -> DataFrame:
    """``sig_*`` columns from the weekly indicator columns."""
    kept = list(df.columns)
    return run_levels(in_entry_zone(df), signal_levels(bars)).select(*kept, *SIGNAL_COLUMNS)


# --- trades -----------------------------------------------------------------------

TRADE_COLUMNS = [
    "symbol", "trade_id", "entry_date", "exit_date", "entry_type", "exit_type",
    "entry_price", "exit_price", "pct_gain", "hold_weeks",
]


def with_exits(df: DataFrame, bars: Bars) -> DataFrame:
    """Describe the trade on the bar that closes it: ``__entry`` holds the entry bar's
    date, price and kind, ``__pct`` the gain; NULL gain on all other bars."""
    opened = "sig_entry = 1 or sig_reentry = 1"
    return df.selectExpr(
        "*",
        f"last(if({opened}, named_struct('day', week_start, 'price', close, 'again', sig_reentry),"
        f" null), true) over ({bars.sql_upto}) as __entry",
        f"sum(int({opened})) over ({bars.sql_upto}) as __trade",
    ).selectExpr(
        "*",
        "case when sig_tp = 1 then (tpx1 - __entry.price) / nullif(__entry.price, 0D) * 100D"
        " when sig_sl = 1 then (close - __entry.price) / nullif(__entry.price, 0D) * 100D"
        " end as __pct",
    )


def trades(df: DataFrame, bars: Bars) -> DataFrame:
    """One row per completed trade, rebuilt from the signal columns of full histories.
    An open trade at the end has no exit bar and so no row."""
    return (
        with_exits(df, bars)
        .where("(sig_tp = 1 or sig_sl = 1) and __entry is not null")
        .selectExpr(
            "symbol",
            "__trade as trade_id",
            "__entry.day as entry_date",
            "week_start as exit_date",
            "if(__entry.again = 1, 'Re-Entry', 'Entry') as entry_type",
            "if(sig_tp = 1, 'TP', 'SL') as exit_type",
            "__entry.price as entry_price",
            "if(sig_tp = 1, tpx1, close) as exit_price",
            "__pct as pct_gain",
            "datediff(week_start, __entry.day) / 7D as hold_weeks",
        )
    )


def _stats(pct: Column, target: Column, again: Column) -> dict[str, Column]:
    """Aggregates over completed trades; ``pct`` is NULL where no trade is completed."""
    done = pct.isNotNull()
    return {
        "bt_trades": F.count(pct),
        "bt_tp_count": F.count(F.when(done & target, 1)),
        "bt_sl_count": F.count(F.when(done & ~target, 1)),
        "bt_reentry_count": F.count(F.when(done & again, 1)),
        "__wins": F.count(F.when(pct > 0, 1)),
        "bt_avg_tp_pct": F.avg(F.when(target, pct)),
        "bt_avg_sl_pct": F.avg(F.when(~target, pct)),
        "__won": F.sum(F.when(pct > 0, pct)),
        "__lost": F.sum(F.when(pct <= 0, pct)),
        "__trade_growth": F.product(1.0 + pct / 100.0),
        "__again_wins": F.count(F.when(again & (pct > 0), 1)),
    }


def finish_stats(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "bt_win_rate": ratio(F.col("__wins") * 100.0, F.col("bt_trades").cast("double")),
            "bt_profit_factor": ratio(F.col("__won"), F.abs(F.col("__lost"))),
            "bt_geo_return": (F.col("__trade_growth") - 1.0) * 100.0,
            "bt_reentry_win_rate": ratio(
                F.col("__again_wins") * 100.0, F.col("bt_reentry_count").cast("double")
            ),
        }
    ).drop("__wins", "__won", "__lost", "__trade_growth", "__again_wins")


STAT_COLUMNS = [
    "bt_trades", "bt_tp_count", "bt_sl_count", "bt_reentry_count", "bt_win_rate", "bt_avg_tp_pct",
    "bt_avg_sl_pct", "bt_profit_factor", "bt_geo_return", "bt_reentry_win_rate",
    "bt_weeks_in_trade",
]


def backtest_stats(trade_list: DataFrame) -> DataFrame:
    """Statistics per symbol from a trade list (all but the weeks in trade)."""
    aggregates = _stats(
        F.col("pct_gain"), F.col("exit_type") == "TP", F.col("entry_type") == "Re-Entry"
    )
    return finish_stats(
        trade_list.groupBy("symbol").agg(*[c.alias(name) for name, c in aggregates.items()])
    )


EXIT_GAIN = (
    "case when sig_tp = 1 then (tpx1 - __entry_close) / nullif(__entry_close, 0D) * 100D"
    " when sig_sl = 1 then (close - __entry_close) / nullif(__entry_close, 0D) * 100D end as __pct"
)


def stat_columns() -> dict[str, Column]:
    """The same statistics on every bar of the symbol, to be taken over the whole
    partition the bars are already in: no aggregate to join back."""
    return _stats(
        F.col("__pct"), F.col("sig_tp") == 1, F.col("__exit_before") == "TP"
    ) | {"bt_weeks_in_trade": F.sum("sig_in_position")}


def deep_dive_metrics(weekly: DataFrame, bars: Bars) -> DataFrame:
    """Per-symbol performance figures, rebuilt from the signal columns of full histories
    in one aggregate.  The pullback is a cycle figure and is taken from the latest bar."""
    held = F.datediff("week_start", "__entry.day") / 7.0
    aggregates = _stats(F.col("__pct"), F.col("sig_tp") == 1, F.col("__entry.again") == 1) | {
        "bt_weeks_in_trade": F.sum("sig_in_position"),
        "avg_hold": F.avg(F.when(F.col("__pct").isNotNull(), held)),
        "cycle_avg_pullback": F.max_by("cycle_avg_pullback", "week_start"),
    }
    stats = with_exits(weekly, bars).groupBy("symbol").agg(
        *[c.alias(name) for name, c in aggregates.items()]
    )
    return finish_stats(stats).select(
        "symbol",
        F.col("bt_trades").alias("trades"),
        F.col("bt_win_rate").alias("accuracy"),
        F.col("bt_avg_tp_pct").alias("avg_tp_gain"),
        F.col("bt_avg_sl_pct").alias("avg_sl_loss"),
        F.col("bt_profit_factor").alias("profit_factor"),
        F.col("bt_geo_return").alias("geo_return"),
        F.abs(ratio(F.col("bt_avg_tp_pct"), F.col("bt_avg_sl_pct"))).alias("risk_reward"),
        F.col("bt_weeks_in_trade").alias("weeks_in_trade"),
        "avg_hold",
        F.col("cycle_avg_pullback").alias("avg_bull_pullback"),
    )


def shown_trades(trade_list: DataFrame, digits: int = 4) -> DataFrame:
    """Trades as they are listed: prices with ``digits`` places and the gain between these."""
    entry, exit_ = (half_up(F.col(c), digits) for c in ("entry_price", "exit_price"))
    return trade_list.withColumns({"entry_price": entry, "exit_price": exit_}).withColumn(
        "pct_gain", ratio(F.col("exit_price") - F.col("entry_price"), F.col("entry_price")) * 100.0
    )


def equity_curve(trade_list: DataFrame, base: float = 100.0) -> DataFrame:
    """Compounded value after each trade, from a starting row 0.  A running product, so a
    loss of 100 % or more is no special case."""
    order = Window.partitionBy("symbol").orderBy("trade_id")
    growth = F.product(1.0 + F.col("pct_gain") / 100.0).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    grown = trade_list.select(
        "symbol", F.row_number().over(order).alias("no"), (base * growth).alias("value")
    )

    def point(no: Column, value: Column) -> Column:
        return F.struct(no.alias("trade_no"), value.alias("equity"))

    own = point(F.col("no"), F.col("value"))
    points = F.when(F.col("no") == 1, F.array(point(F.lit(0), F.lit(base)), own)).otherwise(
        F.array(own)
    )
    return grown.select("symbol", F.explode(points).alias("p")).select("symbol", "p.*")


def stats_vs_snapshot(trade_list: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Recomputed statistics next to the stored ones, with a mismatch flag.  Sums are
    compared with a relative tolerance, as their terms may be added in another order."""
    live = backtest_stats(trade_list)
    names = ["bt_trades", "bt_tp_count", "bt_sl_count", "bt_win_rate", "bt_profit_factor",
             "bt_geo_return"]
    joined = snapshot.select("symbol", *[F.col(n).alias(f"stored_{n}") for n in names]).join(
        live.select("symbol", *[F.col(n).alias(f"live_{n}") for n in names]), "symbol", "left"
    )
    for n in names[:3]:
        joined = joined.withColumn(f"live_{n}", F.coalesce(f"live_{n}", F.lit(0).cast("bigint")))

    def differs(n: str) -> Column:
        stored, now = F.col(f"stored_{n}").cast("double"), F.col(f"live_{n}").cast("double")
        close = F.abs(stored - now) <= 1e-9 * F.greatest(F.abs(stored), F.abs(now), F.lit(1.0))
        return ~F.coalesce(close, stored.isNull() & now.isNull())

    wrong = differs(names[0])
    for n in names[1:]:
        wrong = wrong | differs(n)
    return joined.withColumn("mismatch", wrong.cast("int"))


