"""Weekly bull/bear cycle tracker and its statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.functions.numeric import ratio
from barwright.operators.windows import CLOSE_WAS, ERA, HALO, SEED, Bars

CYCLE_COLUMNS = ["cycle_bull", "cycle_months", "cycle_pct"]
CYCLE_STAT_COLUMNS = [
    "cycle_count", "cycle_win_rate", "cycle_geo_avg_gain", "cycle_avg_win", "cycle_avg_loss",
    "cycle_rvr", "cycle_profit_factor", "cycle_avg_pullback", "cycle_signal_return",
]


def cycle_levels(bars: Bars) -> list[list[str]]:
    """Levels (see ``windows.run_levels``) of the cycle columns.  ``cycle_bull`` turns on
    with a green band outside dark red and off with dark red.  A cycle's entry price is
    the close before its first bar (its own first close for the first cycle of a
    history).  Also gives ``__run`` and ``__run_ends``."""
    turn = bars.own("case when bx_monthly_dark_red = 0 and fvb_band_green = 1 then 1 when bx_monthly_dark_red = 1 then 0 end")
    start = (
        f"last(if(__starts, named_struct('day', week_start, 'price', coalesce({CLOSE_WAS}, close)), null), true)"
        f" over ({bars.sql_upto})"
    )
    return [
        [],
        [f"coalesce({bars.known(f'last({turn}, true) over ({bars.sql_upto})', 'bull')}, 0) as cycle_bull"],
        [
            f"coalesce({bars.known(f'lag(cycle_bull, 1) over ({bars.sql_order})', 'bull')} <> cycle_bull, true) as __starts",
            f"coalesce(lead(cycle_bull, 1) over ({bars.sql_order}) <> cycle_bull, false)"
            " as __run_ends",
        ],
        [],
        [
            f"sum(int(__starts)) over ({bars.sql_upto}) as __run",
            f"{bars.known(start, 'start')} as __start",
        ],
        [
            "(year(week_start) - year(__start.day)) * 12 + month(week_start) - month(__start.day)"
            " as cycle_months",
            "(close - __start.price) / nullif(__start.price, 0D) * 100D as cycle_pct",
        ],
    ]


def with_drawdown(df: DataFrame, bars: Bars | None = None) -> DataFrame:
    """``__drawdown``: lowest low against the running peak close of the same run, in
    percent.  Runs are numbered in the order of time, so the greatest (run, close) so far holds the
    peak of the present run, and the rows need no sort by runs.  Run 0 of a seeded frame goes on
    from the stored peak and drawdown."""
    upto = Window.partitionBy("symbol").orderBy(ERA, "week_start").rowsBetween(Window.unboundedPreceding, 0)

    def highest(x: Column) -> Column:
        return F.max(F.struct("__run", x.alias("x"))).over(upto)["x"]

    def lowest(x: Column) -> Column:
        return F.min(F.struct(-F.col("__run"), x.isNull(), x.alias("x"))).over(upto)["x"]

    if bars is None or not bars.seeded:
        peak = df.withColumn("__peak", highest(F.col("close")))
        dip = ratio(F.col("low"), F.col("__peak")) - 1.0
        return peak.withColumn("__drawdown", lowest(dip) * 100.0)
    goes_on = F.col("__run") == 0
    df = df.withColumn("__peak", F.greatest(highest(F.expr(bars.own("close"))), F.when(goes_on, F.col(f"{SEED}.peak"))))
    dip = F.when(~F.col(HALO), ratio(F.col("low"), F.col("__peak")) - 1.0)
    return df.withColumn("__drawdown", F.least(lowest(dip) * 100.0, F.when(goes_on, F.col(f"{SEED}.drawdown"))))


def closing_marks() -> dict[str, Column]:
    """A cycle's gain and dip on its last bar; the cycle still running has none."""
    closing = F.col("__run_ends") & (F.col("cycle_bull") == 1)
    return {
        "__gain": F.when(closing, F.col("cycle_pct")),
        "__dip": F.when(closing, F.col("__drawdown")),
    }


def cycle_stat_columns() -> dict[str, Column]:
    """Aggregates over the completed bull cycles, to be taken over the symbol."""
    gain = F.col("__gain")
    return {
        "cycle_count": F.count(gain),
        "__cwins": F.count(F.when(gain > 0, 1)),
        "cycle_avg_win": F.avg(F.when(gain > 0, gain)),
        "cycle_avg_loss": F.avg(F.when(gain <= 0, gain)),
        "__cwon": F.sum(F.when(gain > 0, gain)),
        "__clost": F.sum(F.when(gain <= 0, gain)),
        "cycle_avg_pullback": F.avg("__dip"),
        "__cycle_growth": F.product(1.0 + gain / 100.0),
    }


def finish_cycle_stats(df: DataFrame) -> DataFrame:
    count = F.col("cycle_count").cast("double")
    growth = F.col("__cycle_growth")
    mean = F.pow(growth, 1.0 / F.nullif(count, F.lit(0.0))) - 1.0
    return df.withColumns(
        {
            "cycle_win_rate": ratio(F.col("__cwins") * 100.0, count),
            "cycle_geo_avg_gain": F.when(count > 0, mean * 100.0),
            "cycle_signal_return": (growth - 1.0) * 100.0,
            "cycle_rvr": ratio(F.col("cycle_avg_win"), F.abs(F.col("cycle_avg_loss"))),
            "cycle_profit_factor": ratio(F.col("__cwon"), F.abs(F.col("__clost"))),
        }
    )
