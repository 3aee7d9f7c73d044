"""Indicator columns for daily and weekly bars.

Every operator takes a frame prepared by ``windows.lay_out`` and appends columns;
``compute_indicators`` runs the whole chain in one exchange and one sort."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.functions.numeric import flag, ratio
from barwright.operators.windows import (
    AGE,
    CLOSE_WAS,
    Bars,
    Counter,
    alpha_of_span,
    drop_internal,
    ema,
    gains_and_losses,
    lay_out,
    month_counter,
    pack,
    recursive_means,
    rsi_from_means,
    sliding,
    true_range,
    unpack,
    value_counters,
)

# Fixed values of the indicator definitions.
BAND_WIDTHS = {"thresh": 0.4, "x1": 3.4, "x2": 6.4}
FAST_SPAN, SLOW_SPAN, RSI_LENGTH = 5, 20, 5
TARGET_MULTIPLES = {"tpx1": 4.3, "tpx2": 8.6}
DOUBLE_BAND_DEVIATIONS = 3.0


def typical_price() -> Column:
    return (F.col("open") + F.col("high") + F.col("low") + F.col("close")) / 4.0


def with_price_basis(df: DataFrame) -> DataFrame:
    """Source columns that several indicators share."""
    return df.withColumns({"fvb_src": typical_price(), "__tr": true_range(F.col(CLOSE_WAS))})


def base_mas(df: DataFrame, bars: Bars) -> DataFrame:
    df = slides(df, bars, ["sma_20", "sma_33"])
    return ema(df, bars, {"ema_20": ("close", 20), "ema_33": ("close", 33)})


def _bands(prefix: str) -> dict[str, Column]:
    basis, dev = F.col(f"{prefix}_basis"), F.col(f"{prefix}_dev")
    return {
        f"{prefix}_{side}_{name}": basis + sign * width * dev
        for name, width in BAND_WIDTHS.items()
        for side, sign in (("upper", 1.0), ("lower", -1.0))
    }


def fvb33(df: DataFrame, bars: Bars) -> DataFrame:
    """Centre line and width of the 33-bar fair-value band."""
    return slides(df, bars, ["fvb_basis", "fvb_dev"])


def fvb33_bands(df: DataFrame) -> DataFrame:
    return df.withColumns(_bands("fvb"))


def fvb33_color(df: DataFrame, bars: Bars) -> DataFrame:
    """Band colour: smoothed typical price against the centre line."""
    df = df.withColumn("fvb_vwap", F.col("fvb_src"))
    df = ema(df, bars, {"fvb_smooth_vwap": ("fvb_vwap", 5)})
    return df.withColumn("fvb_band_green", flag(F.col("fvb_smooth_vwap") >= F.col("fvb_basis")))


def fvb20(df: DataFrame, bars: Bars) -> DataFrame:
    """20-bar variant; its colour follows the close, not the typical price."""
    df = slides(df, bars, ["fvb20_basis", "fvb20_dev"]).withColumns(_bands("fvb20"))
    df = ema(df, bars, {"__close_ema5": ("close", 5)})
    return df.withColumn(
        "fvb20_band_green", flag(F.col("__close_ema5") >= F.col("fvb20_basis"))
    ).drop("__close_ema5")


def bx(df: DataFrame, bars: Bars) -> DataFrame:
    """Momentum oscillator on the chart's own bars: RSI of EMA5 - EMA20, minus 50."""
    return oscillators(df, bars, chart=True, months=False)


def bx_monthly(df: DataFrame, bars: Bars) -> DataFrame:
    """The oscillator of the monthly closes, seen from every bar."""
    return oscillators(df, bars, chart=False, months=True)


def oscillators(
    df: DataFrame,
    bars: Bars,
    chart: bool,
    months: bool,
    means: Mapping[str, tuple[str, int]] | None = None,
) -> DataFrame:
    """Chart and monthly oscillator, with further exponential means (output -> (input,
    span)) computed in the same window passes.

    The monthly series is averaged in place on the month-end rows: the state just
    before a bar is the state of the last completed month.  This needs neither a
    second copy of the bars nor a join.

    * ``bx_monthly_completed``: previous month, constant inside a month;
    * ``bx_monthly_prev``: the month before that;
    * ``bx_monthly_realtime``: completed months plus this bar's close as the value
      of the current month, by one more step of each recursion.

    On a seeded layout with both oscillators, ``__after`` holds what a later frame needs to go
    on from the last bar but one: all means and counts after it, and those of the months before it.
    It is NULL on the other bars, so that they do not carry it."""
    means = dict(means or {})
    kept = [f"`{c}`" for c in df.columns]
    df, counts = value_counters(df, bars, [*(x for x, _ in means.values()), *(["close"] if chart else [])], differences=["__tr"])
    wanted = {out: (x, alpha_of_span(n), counts[x]) for out, (x, n) in means.items()}
    if chart:
        wanted["__fast"] = ("close", alpha_of_span(FAST_SPAN), counts["close"])
        wanted["__slow"] = ("close", alpha_of_span(SLOW_SPAN), counts["close"])
    if months:
        df, by_month = month_counter(df, bars)
        wanted["__mfast"] = ("__mclose", alpha_of_span(FAST_SPAN), by_month)
        wanted["__mslow"] = ("__mclose", alpha_of_span(SLOW_SPAN), by_month)
    df = recursive_means(df, bars, wanted)

    spreads, previous, steps, smooth = [], [], [], {}
    if chart:
        seen = counts["close"].seen
        counter = Counter(f"greatest({seen} - {SLOW_SPAN}, 0)", counts["close"].in_era)
        spreads.append(f"if({bars.own('close')} is not null and {seen} >= {SLOW_SPAN}, __fast - __slow, null) as __spread")
        previous.append(f"{bars.known(f'last(__spread, true) over ({bars.sql_before})', 'spread')} as __spread_was")
        up, down = gains_and_losses("__spread", "__spread_was")
        steps += [f"{up} as __up", f"{down} as __down"]
        smooth |= {"__gain": ("__up", counter), "__loss": ("__down", counter)}
    if months:
        mcounter = Counter(f"({by_month.seen} - {SLOW_SPAN})", by_month.in_era)
        spreads.append(
            f"if(__month_ends and {by_month.seen} >= {SLOW_SPAN}, __mfast - __mslow, null)"
            " as __mspread"
        )
        previous.append(f"{bars.known(f'last(__mspread, true) over ({bars.sql_before})', 'mspread')} as __mspread_was")
        up, down = gains_and_losses("__mspread", "__mspread_was")
        steps += [f"{up} as __mup", f"{down} as __mdown"]
        smooth |= {"__mgain": ("__mup", mcounter), "__mloss": ("__mdown", mcounter)}
    df = df.selectExpr("*", *spreads).selectExpr("*", *previous).selectExpr("*", *steps)
    df = recursive_means(
        df, bars, {out: (x, 1.0 / RSI_LENGTH, count) for out, (x, count) in smooth.items()}
    )

    results = [
        f"if({counts[x].seen} >= {n}, {out}, null) as {out}" for out, (x, n) in means.items()
    ]
    names = list(means)
    if chart:
        rsi = rsi_from_means("__gain", "__loss")
        results.append(f"if({counter.seen} >= {RSI_LENGTH}, {rsi}, null) - 50D as bx")
        names.append("bx")
    if not months:
        return df.selectExpr(*kept, *results)

    keeps = bars.seeded and chart
    if keeps:
        after = {out: f"`{out}`" for out in [*means, "__fast", "__slow", "__gain", "__loss"]}
        results.append(
            f"if({AGE} = 1, named_struct('means', {_fields(after)}, 'counts', {_fields({x: c.seen for x, c in counts.items()})},"
            " 'spread', coalesce(__spread, __spread_was)), null) as __after"
        )
        names.append("__after")
    rsi = rsi_from_means("__mgain", "__mloss")
    state = f"""named_struct('months', {by_month.seen}, 'fast', __mfast, 'slow', __mslow,
        'spread', coalesce(__mspread, __mspread_was), 'gain', __mgain, 'loss', __mloss,
        'bx', if({mcounter.seen} >= {RSI_LENGTH}, {rsi}, null) - 50D)"""
    kept += names
    df = df.selectExpr(
        *kept[: len(kept) - len(names)],
        *results,
        "__month_ends",
        f"lag({state}, 1) over ({bars.sql_order}) as __was",
    )
    # At a month's last bar, "__was" describes the month before it.
    df = df.selectExpr(
        *kept,
        "__was",
        "__was.bx as bx_monthly_completed",
        bars.known(f"last(if(__month_ends, named_struct('bx', __was.bx), null), true) over ({bars.sql_before})", "earlier")
        + " as __earlier",
        f"lag(__was.bx, 1) over ({bars.sql_order}) as __completed_was",
    )
    if keeps:
        months = {f"__m{c}": f"__was.{c}" for c in ("fast", "slow", "gain", "loss")}
        kept = [c for c in kept if c != "__after"]
        df = df.withColumn("__after", F.expr(
            f"if({AGE} = 1, named_struct('means', named_struct({_each('__after.means', [*after])}, {_pairs(months)}),"
            f" 'counts', named_struct({_each('__after.counts', [*counts])}, '__mclose', coalesce(__was.months, 0)),"
            " 'spread', __after.spread, 'mspread', __was.spread, 'earlier', __earlier), null)"
        ))
        kept.append("__after")
    df = df.selectExpr(
        *kept,
        "bx_monthly_completed",
        "__earlier.bx as bx_monthly_prev",
        *_one_month_more(),
        "__completed_was",
        "__was",
    )
    enough = f"__was.months + 1 - {SLOW_SPAN} >= {RSI_LENGTH}"
    df = df.selectExpr(
        *kept,
        "bx_monthly_completed",
        "bx_monthly_prev",
        f"if({enough}, {_rsi_one_month_more()}, null) - 50D as bx_monthly_realtime",
        "__completed_was",
    )
    return df.selectExpr(
        *kept,
        "bx_monthly_completed",
        "bx_monthly_prev",
        "bx_monthly_realtime",
        "int(coalesce(bx_monthly_completed < 0 and bx_monthly_completed <= bx_monthly_prev, false))"
        " as bx_monthly_dark_red",
        "int(coalesce(bx_monthly_realtime < 0 and bx_monthly_realtime <= __completed_was, false))"
        " as bx_realtime_dark_red",
    )


def _pairs(fields: Mapping[str, str]) -> str:
    return ", ".join(f"'{name}', {value}" for name, value in fields.items())


def _fields(fields: Mapping[str, str]) -> str:
    return f"named_struct({_pairs(fields)})"


def _each(struct: str, names: Iterable[str]) -> str:
    return _pairs({n: f"{struct}.`{n}`" for n in names})


def _mean_step(mean: str, value: str, alpha: float) -> str:
    return f"if({mean} is null, {value}, {mean} * {1.0 - alpha!r}D + ({value}) * {alpha!r}D)"


def _one_month_more() -> list[str]:
    """Change of the EMA difference after taking ``close`` as one more monthly value."""
    fast = _mean_step("__was.fast", "close", alpha_of_span(FAST_SPAN))
    slow = _mean_step("__was.slow", "close", alpha_of_span(SLOW_SPAN))
    return [f"({fast} - {slow}) - __was.spread as __change"]


def _rsi_one_month_more() -> str:
    gain = _mean_step("__was.gain", "greatest(__change, 0D)", 1.0 / RSI_LENGTH)
    loss = _mean_step("__was.loss", "greatest(-__change, 0D)", 1.0 / RSI_LENGTH)
    return rsi_from_means(gain, loss)


def volume_stats(df: DataFrame, bars: Bars) -> DataFrame:
    volume = F.col("volume").cast("double")
    df = slides(df, bars, ["avg_vol_20w"])
    return df.withColumns(
        {
            "rel_vol": ratio(volume, F.col("avg_vol_20w")),
            "vol_up": flag(F.col("close") >= F.col("open")),
        }
    )


def dbb_upper(df: DataFrame, bars: Bars) -> DataFrame:
    df = sliding(df, bars, {"__sma_20": SLIDES["sma_20"]}, {"__std_20": ("close", 20)})
    upper = F.col("__sma_20") + DOUBLE_BAND_DEVIATIONS * F.col("__std_20")
    return df.withColumn("dbb_upper", upper).drop("__sma_20", "__std_20")


def legacy_signals(df: DataFrame) -> DataFrame:
    """Row-by-row entry and exit flags without any position state."""
    return df.withColumns(
        {
            "entry_signal": flag(
                (F.col("fvb_band_green") == 1)
                & (F.col("bx_monthly_dark_red") == 0)
                & (F.col("close") <= F.col("fvb_upper_thresh"))
            ),
            "exit_signal": F.col("bx_monthly_dark_red"),
        }
    )


def tpx(df: DataFrame, bars: Bars) -> DataFrame:
    """Target prices above the 20-bar typical-price mean."""
    df = ema(df, bars, {"__tr_ema": ("__tr", 66)}, differences=["__tr"])
    df = slides(df, bars, ["fvb20_basis"])
    return df.withColumns(_targets()).drop("__tr_ema")


def _targets() -> dict[str, Column]:
    return {
        name: F.col("fvb20_basis") + k * F.col("__tr_ema") for name, k in TARGET_MULTIPLES.items()
    }


SLIDES = {
    "sma_20": ("close", 20),
    "sma_33": ("close", 33),
    "fvb_basis": ("fvb_src", 33),
    "fvb_dev": ("__tr", 66),
    "fvb20_basis": ("fvb_src", 20),
    "fvb20_dev": ("__tr", 40),
    "avg_vol_20w": ("volume", 20),
}


def slides(df: DataFrame, bars: Bars, names: Iterable[str], deviations: Mapping[str, tuple[str, int]] | None = None) -> DataFrame:
    """Append sliding means by their names; a column that was there already is replaced."""
    names = list(names)
    return sliding(df.drop(*names), bars, {name: SLIDES[name] for name in names}, deviations)


BAR_COLUMNS = ["open", "high", "low", "volume", "trading_days"]


def append_indicators(df: DataFrame, bars: Bars, weekly: bool) -> DataFrame:
    """The whole chain.  Columns are grouped by the depth of their dependencies, so
    that each level is one window pass over the same sorted rows, and finished columns
    travel packed."""
    df = slides(with_price_basis(df), bars, SLIDES, {"__std_20": ("close", 20)})
    packed = ["fvb_src", *SLIDES, "__std_20", *[c for c in BAR_COLUMNS if c in df.columns]]
    df = df.withColumn("__src", F.col("fvb_src"))
    df = pack(df, packed)
    means = {
        "ema_20": ("close", 20),
        "ema_33": ("close", 33),
        "__close_ema5": ("close", 5),
        "fvb_smooth_vwap": ("__src", 5),
    }
    if weekly:
        means["__tr_ema"] = ("__tr", 66)
    df = unpack(oscillators(df, bars, chart=True, months=True, means=means))
    close, volume = F.col("close"), F.col("volume").cast("double")
    columns = {
        **_bands("fvb"),
        **_bands("fvb20"),
        "fvb_vwap": F.col("fvb_src"),
        "fvb_band_green": flag(F.col("fvb_smooth_vwap") >= F.col("fvb_basis")),
        "fvb20_band_green": flag(F.col("__close_ema5") >= F.col("fvb20_basis")),
        "rel_vol": ratio(volume, F.col("avg_vol_20w")),
        "vol_up": flag(close >= F.col("open")),
        "dbb_upper": F.col("sma_20") + DOUBLE_BAND_DEVIATIONS * F.col("__std_20"),
    }
    if weekly:
        columns |= _targets()
    return legacy_signals(df.withColumns(columns))


def append_signal_inputs(df: DataFrame, bars: Bars) -> DataFrame:
    """Only the weekly columns that signals, cycles and the screens read."""
    bases = ["fvb_basis", "fvb_dev", "fvb20_basis"]
    df = slides(with_price_basis(df), bars, bases)
    df = pack(df.withColumn("__src", F.col("fvb_src")), [*bases, "open", "high", "low"])
    means = {"fvb_smooth_vwap": ("__src", 5), "__tr_ema": ("__tr", 66)}
    df = unpack(oscillators(df, bars, chart=True, months=True, means=means))
    bands = {k: v for k, v in _bands("fvb").items() if k.endswith("thresh")}
    return df.withColumns(
        {
            **bands,
            **_targets(),
            "fvb_band_green": flag(F.col("fvb_smooth_vwap") >= F.col("fvb_basis")),
        }
    ).drop("__src", "__tr", "__tr_ema", "fvb_smooth_vwap", "fvb_src", *bases)


def compute_indicators(candles: DataFrame, period: str) -> DataFrame:
    """All indicator columns of a period (``daily`` or ``weekly``) for all symbols."""
    weekly = period == "weekly"
    df, bars = lay_out(
        candles, "week_start" if weekly else "date", days_per_bar=7 if weekly else 1
    )
    df = drop_internal(append_indicators(df, bars, weekly))
    ohlcv = [c for c in candles.columns if c in df.columns]
    return df.select(*ohlcv, *[c for c in df.columns if c not in ohlcv])
