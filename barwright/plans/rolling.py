"""Weekly bars, signals and statistics carried on from a stored state.

``weekly_rolled_state`` has one row per symbol, as of its cut: the last week but one, which no
new day can change.  It holds the recursive means and counts, the months before the cut, the
position, the open cycle, the totals of completed trades and cycles, and the last bars that
sliding frames look back on.  A run reads this row and the days after the cut, so a day's load opens
the newest year of ``daily`` and of the written rows and nothing older, and its work does not
depend on the length of the history.

A frame to compute has both kinds of symbols: those that go on (the bars of the state as a halo of
older rows, then new weeks) and those that start anew because they have no state, an outdated one, or a
change at or before their cut.  Both pass through the same window chain (``Bars.seeded``).

Statistics depend on all weeks, so they are not stored with every week: ``weekly_rolled`` holds the
weeks, ``weekly_rolled_snapshot`` each symbol's newest week with its statistics, and ``read_weekly``
puts them together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.operators.cycles import CYCLE_COLUMNS, CYCLE_STAT_COLUMNS, cycle_levels, finish_cycle_stats, with_drawdown
from barwright.operators.indicators import append_indicators
from barwright.operators.signals import (
    EXIT_GAIN,
    SIGNAL_COLUMNS,
    SIGNAL_VERSION,
    STAT_COLUMNS,
    finish_stats,
    in_entry_zone,
    signal_levels,
)
from barwright.operators.windows import (
    AGE,
    CLOSE_WAS,
    ERA,
    HALO,
    SEED,
    Bars,
    lay_out,
    pack,
    rolling_high,
    rolling_low,
    run_levels,
    unpack,
)
from barwright.sources.candles import resample_weekly
from barwright.sources.tables import SLICES, Store

STAGE = "weekly_rolled"
STATE, SNAPSHOT = f"{STAGE}_state", f"{STAGE}_snapshot"
LOOK_BACK = 67  # the longest frame has 66 bars; the oldest only lends its close
BAR = ["week_start", "open", "high", "low", "close", "volume", "trading_days"]
_MEANS = (
    "ema_20 ema_33 __close_ema5 fvb_smooth_vwap __tr_ema __fast __slow __gain __loss __mfast __mslow __mgain __mloss"
)
_COUNTS = "trades tp sl again wins again_wins"
_SUMS = "tp_sum sl_sum won lost growth"
_INTERNAL = [ERA, CLOSE_WAS, HALO, SEED, AGE, "__after"]  # what is left of the indicators' own columns
_READ_BY_SIGNALS = {
    "symbol", "week_start", "high", "low", "close", "fvb_upper_thresh", "fvb_lower_thresh", "fvb_band_green",
    "bx_monthly_dark_red", "tpx1",
}
SEED_TYPE = (
    f"struct<means: struct<{', '.join(f'{m}: double' for m in _MEANS.split())}>,"
    " counts: struct<close: bigint, __tr: bigint, __src: bigint, __mclose: bigint>,"
    " spread: double, mspread: double, earlier: struct<bx: double>,"
    " long: int, entry_close: double, exit_kind: string,"
    " bull: int, start: struct<day: date, price: double>, peak: double, drawdown: double,"
    f" totals: struct<{', '.join(f'{c}: bigint' for c in _COUNTS.split())}, {', '.join(f'{c}: double' for c in _SUMS.split())},"
    " weeks: bigint, cycles: bigint, cycle_wins: bigint, cycle_won: double, cycle_lost: double, dips: double,"
    " dip_count: bigint, cycle_growth: double>>"
)


# --- frames ------------------------------------------------------------------------------


def with_state_columns(frame: DataFrame) -> DataFrame:
    """All weekly columns of a frame of bars with ``__halo`` and ``__seed``, and those that make up
    the next state, in one exchange.  Finished columns travel packed through the signal passes, and those
    that only the indicators read end there."""
    df, bars = lay_out(frame, "week_start", days_per_bar=7, seeded=True)
    df = df.withColumn(AGE, F.count(F.lit(1)).over(bars.whole) - F.col("__row"))
    df = append_indicators(df, bars, weekly=True)
    shown = [c for c in df.columns if not c.startswith("__")]
    df = df.select(*shown, *_INTERNAL)
    df = pack(df, [c for c in shown if c not in _READ_BY_SIGNALS], "__ind")
    df = run_levels(in_entry_zone(df), signal_levels(bars), [[], *cycle_levels(bars)])
    df = with_drawdown(df.selectExpr("*", EXIT_GAIN), bars)
    return unpack(df, "__ind")


def seeded_frame(continuing: DataFrame, weeks: DataFrame, anew: DataFrame | None) -> DataFrame:
    """``continuing`` are states, ``weeks`` the bars after their cuts, ``anew`` whole histories."""
    state = continuing.select("symbol", F.col("state").alias(SEED), "ring")
    older = state.select("symbol", SEED, F.lit(True).alias(HALO), F.explode("ring").alias("r")).select("symbol", "r.*", HALO, SEED)
    newer = weeks.withColumn(HALO, F.lit(False)).join(state.drop("ring"), "symbol")
    frame = older.unionByName(newer.select(*older.columns))
    if anew is None:
        return frame
    none = F.lit(None).cast(state.schema[SEED].dataType)
    return frame.unionByName(anew.select("symbol", *BAR, F.lit(False).alias(HALO), none.alias(SEED)))


# --- totals -------------------------------------------------------------------------------


def _totals(until: Column, closed: Column) -> dict[str, Column]:
    """Sums over completed trades of rows ``until`` and over the bull cycles ``closed`` there."""
    pct, again, target = F.col("__pct"), F.col("__exit_before") == "TP", F.col("sig_tp") == 1
    own = until & ~F.col(HALO)
    # Halo rows count here: a cycle that ended with the cut is completed by the bar after it.
    closing = F.col("__run_ends") & (F.col("cycle_bull") == 1) & closed
    gain, dip = F.when(closing, F.col("cycle_pct")), F.when(closing, F.col("__drawdown"))

    def number(*conditions: Column) -> Column:
        hit = own & pct.isNotNull()
        for c in conditions:
            hit = hit & c
        return F.count(F.when(hit, 1))

    def total(x: Column, *conditions: Column) -> Column:
        hit = F.lit(True)
        for c in conditions:
            hit = hit & c
        return F.coalesce(F.sum(F.when(hit, x)), F.lit(0.0))

    def product(x: Column) -> Column:
        return F.coalesce(F.product(x), F.lit(1.0))

    mine = F.when(own, pct)
    return {
        "trades": number(), "tp": number(target), "sl": number(~target), "again": number(again),
        "wins": number(pct > 0), "again_wins": number(again & (pct > 0)),
        "tp_sum": total(mine, target), "sl_sum": total(mine, ~target), "won": total(mine, pct > 0), "lost": total(mine, pct <= 0),
        "growth": product(1.0 + mine / 100.0),
        "weeks": F.coalesce(F.sum(F.when(own, F.col("sig_in_position").cast("bigint"))), F.lit(0).cast("bigint")),
        "cycles": F.count(gain), "cycle_wins": F.count(F.when(gain > 0, 1)),
        "cycle_won": total(gain, gain > 0), "cycle_lost": total(gain, gain <= 0),
        "dips": total(dip), "dip_count": F.count(dip), "cycle_growth": product(1.0 + gain / 100.0),
    }


def _added(now: str, names: list[str]) -> Column:
    """Stored totals and those of a frame together."""
    products = ("growth", "cycle_growth")
    return F.struct(*[
        F.expr(f"if(before is null, {now}.{n}, {now}.{n} {'*' if n in products else '+'} before.{n})").alias(n) for n in names
    ])


def _statistics(df: DataFrame, t: str) -> DataFrame:
    """The statistic columns from a struct of totals."""

    def mean(total: str, count: Column) -> Column:
        return F.when(count > 0, F.col(f"{t}.{total}") / count)

    def present(total: str, count: Column) -> Column:
        return F.when(count > 0, F.col(f"{t}.{total}"))

    n, lost = F.col(f"{t}.trades"), F.col(f"{t}.trades") - F.col(f"{t}.wins")
    c, cycle_lost = F.col(f"{t}.cycles"), F.col(f"{t}.cycles") - F.col(f"{t}.cycle_wins")
    df = df.withColumns({
        "bt_trades": n, "bt_tp_count": F.col(f"{t}.tp"), "bt_sl_count": F.col(f"{t}.sl"), "bt_reentry_count": F.col(f"{t}.again"),
        "__wins": F.col(f"{t}.wins"), "__again_wins": F.col(f"{t}.again_wins"),
        "bt_avg_tp_pct": mean("tp_sum", F.col(f"{t}.tp")), "bt_avg_sl_pct": mean("sl_sum", F.col(f"{t}.sl")),
        "__won": present("won", F.col(f"{t}.wins")), "__lost": present("lost", lost), "__trade_growth": present("growth", n),
        "bt_weeks_in_trade": F.col(f"{t}.weeks"),
        "cycle_count": c, "__cwins": F.col(f"{t}.cycle_wins"),
        "cycle_avg_win": mean("cycle_won", F.col(f"{t}.cycle_wins")), "cycle_avg_loss": mean("cycle_lost", cycle_lost),
        "__cwon": present("cycle_won", F.col(f"{t}.cycle_wins")), "__clost": present("cycle_lost", cycle_lost),
        "cycle_avg_pullback": mean("dips", F.col(f"{t}.dip_count")), "__cycle_growth": present("cycle_growth", c),
    })
    return finish_cycle_stats(finish_stats(df))


def by_symbol(rows: DataFrame, kept: list[str]) -> DataFrame:
    """One row per symbol of a computed frame: ``latest`` (the newest week's columns), ``now`` (all
    totals) and, as of the cut, ``state``, ``ring`` and ``cut``; these are NULL for a symbol of one week.

    A cycle is completed by the bar after its last, so the totals of the cut leave out one that ends
    with the cut itself."""
    at_cut, everywhere = F.col(AGE) == 1, F.lit(True)
    after = {
        "long": F.col("sig_in_position"), "entry_close": F.col("__entry_close"),
        "exit_kind": F.when(F.col("sig_tp") == 1, "TP").when(F.col("sig_sl") == 1, "SL").otherwise(F.col("__exit_before")),
        "bull": F.col("cycle_bull"), "start": F.col("__start"), "peak": F.col("__peak"), "drawdown": F.col("__drawdown"),
    }
    last = F.struct("__after.*", *[c.alias(n) for n, c in after.items()])
    totals_now, totals_cut = _totals(everywhere, everywhere), _totals(F.col(AGE) >= 1, F.col(AGE) >= 2)
    names = list(totals_now)
    bars = F.when(F.col(AGE).between(1, LOOK_BACK), F.struct(*BAR))
    out = rows.groupBy("symbol").agg(
        F.first(F.when(F.col(AGE) == 0, F.struct(*[c for c in kept if c != "symbol"])), ignorenulls=True).alias("latest"),
        F.struct(*[c.alias(n) for n, c in totals_now.items()]).alias("now"),
        F.struct(*[c.alias(n) for n, c in totals_cut.items()]).alias("then"),
        F.first(F.when(at_cut, last), ignorenulls=True).alias("last"),
        F.first("__before", ignorenulls=True).alias("before"),
        F.sort_array(F.collect_list(bars)).alias("ring"),
        F.max(F.when(at_cut, F.col("week_start"))).alias("cut"),
    )
    return out.select(
        "symbol", "latest", _added("now", names).alias("now"),
        F.when(F.col("cut").isNotNull(), F.struct("last.*", _added("then", names).alias("totals"))).alias("state"),
        "ring", "cut",
    )


# --- job ----------------------------------------------------------------------------------


def run_weekly_from_state(store: Store, force: bool = False) -> bool:
    """Bring the rolled tables up to the landed bars; False when nothing was to be done.  ``force``
    computes all symbols anew."""
    read = store.newest_mark()
    marks = store.read_dirty(STAGE).select("symbol", "since")
    if force:
        marks = marks.unionByName(store.read("daily").select("symbol", F.lit(None).cast("date").alias("since")).distinct())
    if store.exists(STATE):
        states = store.read(STATE)
        old = states.where(~F.col("logic_version").eqNullSafe(F.lit(SIGNAL_VERSION)))
        marks = marks.unionByName(old.select("symbol", F.lit(None).cast("date").alias("since")))
    else:
        states = None
    # A missing date means the whole history.
    due = store.staged(marks.groupBy("symbol").agg(F.min(F.coalesce("since", F.lit("0001-01-01").cast("date"))).alias("since")))
    if due.isEmpty():
        store.clean()
        return False
    whole = states is None or not due.join(states.select("symbol", "cut"), "symbol", "left").where(~_goes_on()).isEmpty()
    buckets, _ = store._layout(STAGE)
    before = len(store._temporary)
    for held in store.passes(STAGE, due, "daily", None if whole else LOOK_BACK + 1, wide=4):
        _carry_on(store, store.staged(due.where(store.bucket(buckets=buckets).isin(*held))))
        store.clean(before)
    store.clear_dirty(due.select("symbol"), STAGE, read)
    store.clean()
    return True


def _goes_on() -> Column:
    """Whether a due symbol's state holds: nothing has changed up to its cut."""
    return F.coalesce((F.col("since") >= F.date_add("cut", 7)), F.lit(False))


def _carry_on(store: Store, due: DataFrame) -> None:
    """Compute and write the due symbols of some buckets."""
    if not store.exists(STATE):
        continuing, anew = None, due
    else:
        known = due.join(store.read(STATE), "symbol", "left")
        continuing = store.staged(known.where(_goes_on()).drop("since"))
        anew = store.staged(known.where(~_goes_on()).select("symbol"))
        if anew.isEmpty():
            anew = None
    whole = None
    if anew is not None:
        daily = store.same_buckets("daily", anew).join(anew.select("symbol"), "symbol", "left_semi")
        whole = resample_weekly(daily.drop(*SLICES, "arrival"))
    first = None if continuing is None else continuing.agg(F.min("cut")).first()[0]
    if first is None:
        frame = whole.select("symbol", *BAR, F.lit(False).alias(HALO), F.lit(None).cast(SEED_TYPE).alias(SEED))
    else:
        # Only days after the oldest cut are read: the year folders before it stay closed.
        days = store.candles("daily", start=str(first)).join(continuing.select("symbol", "cut"), "symbol")
        weeks = resample_weekly(days.where(F.col("date") >= F.date_add("cut", 7)).drop("cut"))
        frame = seeded_frame(continuing, weeks, whole)
    computed = with_state_columns(frame)
    kept = [c for c in computed.columns if not c.startswith("__")]
    internal = [HALO, AGE, "__before", "__after", "__pct", "__exit_before", "__entry_close", "__run_ends", "__start", "__peak", "__drawdown"]
    # One row per symbol is enough to hand the stored totals on.
    computed = computed.withColumn("__before", F.when(F.col(AGE) == 0, F.col(f"{SEED}.totals")))
    rows = store.staged(computed.select(*kept, *internal))
    _write_rows(store, rows.where(~F.col(HALO)).select(*kept), due, continuing, anew)
    fresh = store.staged(by_symbol(rows, kept))
    _replace(store, STATE, fresh.where("cut IS NOT NULL").select("symbol", "cut", "state", "ring", F.lit(SIGNAL_VERSION).alias("logic_version")), due)
    snapshot = _statistics(fresh.select("symbol", "latest.*", "now"), "now").drop("now")
    _replace(store, SNAPSHOT, snapshot.select(*kept, *STAT_COLUMNS, *CYCLE_STAT_COLUMNS), due)


def _replace(store: Store, table: str, fresh: DataFrame, due: DataFrame) -> None:
    """Replace the rows of the due symbols of a table with one row per symbol."""
    if store.exists(table):
        kept = store.read(table).join(due.select("symbol"), "symbol", "left_anti")
        fresh = kept.unionByName(fresh, allowMissingColumns=True)
    store.overwrite(fresh, table)


def _write_rows(store: Store, fresh: DataFrame, due: DataFrame, continuing: DataFrame | None, anew: DataFrame | None) -> None:
    """Replace the weeks after the cuts of continuing symbols, and all weeks of the others; only
    slices that hold such weeks are read and written."""
    if not store.exists(STAGE):
        store.write_bars(fresh, STAGE)
        return
    begin = due.select("symbol").join(continuing.select("symbol", "cut"), "symbol", "left") if continuing is not None else due.select("symbol", F.lit(None).cast("date").alias("cut"))
    stored = store.same_slices(STAGE, fresh)
    if anew is not None:
        theirs = store.same_buckets(STAGE, anew)
        slices = theirs.select(*SLICES).distinct().unionByName(stored.select(*SLICES).distinct()).distinct()
        # years times buckets at most
        stored = store._load(STAGE).join(F.broadcast(store.staged(slices)), SLICES, "left_semi")
    kept = stored.join(begin.withColumn("__due", F.lit(True)), "symbol", "left").where(
        F.col("__due").isNull() | (F.col("week_start") <= F.col("cut"))
    )
    store.replace_slices(kept.select(*fresh.columns).unionByName(fresh), STAGE, stored.select(*SLICES).distinct())


def read_weekly(store: Store) -> DataFrame:
    """All weeks with the statistics of their symbol, like the table ``weekly``."""
    snapshot = store.read(SNAPSHOT).select("symbol", *STAT_COLUMNS, *CYCLE_STAT_COLUMNS)
    return store.read(STAGE).join(snapshot, "symbol")


# --- one slice of years ------------------------------------------------------------------------


def year_with_halo(store: Store, table: str, year: int, n: int) -> DataFrame:
    """Bars of a year and, marked ``__halo``, each symbol's last ``n - 1`` bars before it, for frames of
    n bars.  The year before is opened by its folder; only symbols that do not have enough bars
    there (and their buckets) are looked up in older ones."""
    ts = "week_start" if "weekly" in table else "date"
    older = Window.partitionBy("symbol").orderBy(F.col(ts).desc())
    near = store._load(table).where(F.col("year").isin(year, year - 1)).drop("arrival")
    now = near.where(F.col("year") == year).withColumn(HALO, F.lit(False))
    before = near.where(F.col("year") == year - 1)
    found = before.groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"))
    short = now.select("symbol").distinct().join(found.where(F.col("bars") >= n - 1), "symbol", "left_anti")
    short = store.staged(short)
    if not short.isEmpty():
        far = store.same_buckets(table, short).where(F.col("year") < year - 1).join(short, "symbol", "left_semi")
        before = before.unionByName(far.select(*before.columns))
    kept = before.withColumn("__place", F.row_number().over(older)).where(F.col("__place") < n).drop("__place")
    return now.unionByName(kept.withColumn(HALO, F.lit(True))).drop(*SLICES)


def rolling_range_of_year(store: Store, table: str, year: int, n: int) -> DataFrame:
    """Highest high and lowest low of the last n bars on each bar of a year (``windows.rolling_high``),
    without the history before its halo."""
    ts = "week_start" if "weekly" in table else "date"
    bars = Bars(ts, ())
    frame = year_with_halo(store, table, year, n)
    return frame.select(
        "symbol", ts, HALO, rolling_high(F.col("high"), n, bars).alias(f"high_{n}"), rolling_low(F.col("low"), n, bars).alias(f"low_{n}")
    ).where(~F.col(HALO)).drop(HALO)
