"""Indicators, cycles, signals, trades, statistics and screens."""

from __future__ import annotations

from pyspark.sql import functions as F

from barwright.operators import indicators as ind
from barwright.operators import reports, screens, signals, slices
from barwright.operators import windows as win
from barwright.operators.cycles import CYCLE_STAT_COLUMNS
from barwright.plans.stages import full_weekly
from checks import base_sql
from checks.base_sql import columns, query, rounded, table
from checks.registry import Inputs, register

KEY = ["symbol", "week_start"]


def laid_weekly(x: Inputs):
    return win.lay_out(x.weekly(), "week_start", days_per_bar=7)


def priced(x: Inputs):
    df, bars = laid_weekly(x)
    return ind.with_price_basis(df), bars


def marked(names: list[str], digits: str = "") -> str:
    return " ".join(f"{n}~{digits}" for n in names)


def w_sql(source: str, doubles: list[str], flags: list[str] = ()) -> str:
    return table(source, " ".join(["symbol week_start", marked(doubles), *flags]))


BANDS = [f"{s}_{n}" for n in ("thresh", "x1", "x2") for s in ("upper", "lower")]
FVB_BANDS, FVB20_BANDS = [f"fvb_{b}" for b in BANDS], [f"fvb20_{b}" for b in BANDS]
MONTHLY = ["bx_monthly_completed", "bx_monthly_prev", "bx_monthly_realtime"]
MAS = ["sma_20", "sma_33", "ema_20", "ema_33"]


@register("base_mas", w_sql("w_ind", MAS))
def _(x):
    df, bars = laid_weekly(x)
    return ind.base_mas(df, bars).select(*KEY, *MAS)


@register("fvb33", w_sql("w_ind", ["fvb_src", "fvb_basis", "fvb_dev"]))
def _(x):
    df, bars = priced(x)
    return ind.fvb33(df, bars).select(*KEY, "fvb_src", "fvb_basis", "fvb_dev")


@register("fvb33_bands", w_sql("w_ind", FVB_BANDS))
def _(x):
    df, bars = priced(x)
    return ind.fvb33_bands(ind.fvb33(df, bars)).select(*KEY, *FVB_BANDS)


@register("fvb33_color", w_sql("w_ind", ["fvb_vwap", "fvb_smooth_vwap"], ["fvb_band_green"]))
def _(x):
    df, bars = priced(x)
    return ind.fvb33_color(ind.fvb33(df, bars), bars).select(
        *KEY, "fvb_vwap", "fvb_smooth_vwap", "fvb_band_green")


FVB20 = ["fvb20_basis", "fvb20_dev", *FVB20_BANDS]


@register("fvb20", w_sql("w_ind", FVB20, ["fvb20_band_green"]))
def _(x):
    df, bars = priced(x)
    return ind.fvb20(df, bars).select(*KEY, *FVB20, "fvb20_band_green")


@register("bx", w_sql("w_ind", ["bx"]))
def _(x):
    df, bars = laid_weekly(x)
    return ind.bx(df, bars).select(*KEY, "bx")


def monthly(name: str, doubles: list[str], flags: list[str]):
    @register(name, w_sql("w_ind", doubles, flags))
    def _(x):
        df, bars = laid_weekly(x)
        return ind.bx_monthly(df, bars).select(*KEY, *doubles, *flags)


monthly("bx_monthly_completed", ["bx_monthly_completed"], [])
monthly("bx_monthly_prev", ["bx_monthly_prev"], [])
monthly("bx_monthly_dark_red", ["bx_monthly_completed", "bx_monthly_prev"], ["bx_monthly_dark_red"])
monthly("bx_monthly_realtime", ["bx_monthly_realtime"], [])
monthly("bx_realtime_dark_red", ["bx_monthly_realtime", "bx_monthly_completed"], ["bx_realtime_dark_red"])


@register("volume_stats", w_sql("w_ind", ["avg_vol_20w", "rel_vol"], ["vol_up"]))
def _(x):
    df, bars = laid_weekly(x)
    return ind.volume_stats(df, bars).select(*KEY, "avg_vol_20w", "rel_vol", "vol_up")


@register("dbb_upper", w_sql("w_ind", ["dbb_upper"]))
def _(x):
    df, bars = laid_weekly(x)
    return ind.dbb_upper(df, bars).select(*KEY, "dbb_upper")


@register("legacy_signals", w_sql("w_ind", [], ["entry_signal", "exit_signal"]))
def _(x):
    return ind.legacy_signals(x.signals()).select(*KEY, "entry_signal", "exit_signal")


@register("tpx", w_sql("w_tgt", ["tpx1", "tpx2"]))
def _(x):
    df, bars = priced(x)
    return ind.tpx(df, bars).select(*KEY, "tpx1", "tpx2")


ALL_DOUBLES = [*MAS, "fvb_src", "fvb_basis", "fvb_dev", *FVB_BANDS, "fvb_vwap", "fvb_smooth_vwap",
               *FVB20, "bx", *MONTHLY, "avg_vol_20w", "rel_vol", "dbb_upper"]
ALL_FLAGS = ["fvb_band_green", "fvb20_band_green", "bx_monthly_dark_red", "bx_realtime_dark_red",
             "vol_up", "entry_signal", "exit_signal"]
BAR = ["open", "high", "low", "close", "volume"]


@register("compute_indicators_weekly", table("w_tgt", " ".join([
    "symbol week_start trading_days", marked([*BAR, *ALL_DOUBLES, "tpx1", "tpx2"]), *ALL_FLAGS])))
def _(x):
    return ind.compute_indicators(x.weekly(), "weekly")


@register("compute_indicators_daily", table("d_ind", " ".join(["symbol date", marked([*BAR, *ALL_DOUBLES]), *ALL_FLAGS])))
def _(x):
    return ind.compute_indicators(x.daily(), "daily")


# --- cycles -----------------------------------------------------------------------------


def part_of_signals(name: str, doubles: list[str], plain: list[str], where: str = "true"):
    @register(name, table("w_sig", " ".join(["symbol week_start", marked(doubles), *plain]), where))
    def _(x):
        return x.signals().where(where).select(*KEY, *doubles, *plain)


part_of_signals("cycle_bull", [], ["cycle_bull"])
part_of_signals("cycle_months", [], ["cycle_bull", "cycle_months"])
part_of_signals("cycle_pct", ["cycle_pct"], [])
CYCLE_DOUBLES = [c for c in CYCLE_STAT_COLUMNS if c not in ("cycle_count", "cycle_avg_pullback")]
part_of_signals("cycle_stats", CYCLE_DOUBLES, ["cycle_count"])
part_of_signals("cycle_avg_pullback", ["cycle_avg_pullback"], [])

# --- signals ----------------------------------------------------------------------------

part_of_signals("in_entry_zone", ["close", "fvb_lower_thresh", "fvb_upper_thresh"], ["in_entry_zone"])
part_of_signals("position_state", [], ["sig_in_position", "sig_tp", "sig_sl"])
part_of_signals("sig_entry", [], ["sig_entry", "sig_reentry"])
part_of_signals("sig_add", [], ["sig_add"])
part_of_signals("sig_exits", ["tpx1"], ["sig_tp", "sig_sl"], "sig_tp = 1 OR sig_sl = 1")
part_of_signals("sig_in_position", ["sig_entry_price"], ["sig_in_position"])

TRADE_SPEC = ("symbol trade_id entry_date exit_date entry_type exit_type entry_price~ exit_price~"
              " pct_gain~ hold_weeks~")


@register("trades", table("trades", TRADE_SPEC))
def _(x):
    return x.trades()


BT_DOUBLES = ["bt_win_rate", "bt_avg_tp_pct", "bt_avg_sl_pct", "bt_profit_factor", "bt_geo_return",
              "bt_reentry_win_rate"]
BT_COUNTS = ["bt_trades", "bt_tp_count", "bt_sl_count", "bt_reentry_count"]


@register("backtest_stats", table("bt", " ".join(["symbol", *BT_COUNTS, marked(BT_DOUBLES)])))
def _(x):
    return signals.backtest_stats(x.trades())


part_of_signals("broadcast_stats", BT_DOUBLES, [*BT_COUNTS, "bt_weeks_in_trade"])

DIVE = f"""SELECT symbol, bt_trades AS trades, {rounded('bt_win_rate')} AS accuracy, {rounded('bt_avg_tp_pct')} AS avg_tp_gain,
  {rounded('bt_avg_sl_pct')} AS avg_sl_loss, {rounded('bt_profit_factor')} AS profit_factor, {rounded('bt_geo_return')} AS geo_return,
  {rounded('rr')} AS risk_reward, bt_weeks_in_trade AS weeks_in_trade, {rounded('avg_hold')} AS avg_hold,
  {rounded('cycle_avg_pullback')} AS avg_bull_pullback
  FROM (SELECT *, abs(bt_avg_tp_pct / nullif(bt_avg_sl_pct, 0)) AS rr FROM snap)"""


@register("deep_dive_metrics", query(DIVE))
def _(x):
    return screens.screen_deep_dive(x.signals(), x.universe())["metrics"]


@register("deep_dive_status", query(f"""SELECT symbol, {rounded('close')} AS price, _fvb33_label, _bx_monthly_label, _bx_mo_wk,
  sig_in_position, {rounded('sig_entry_price')} AS entry_price, {rounded('_unrealised_pct')} AS unrealised_pct,
  {rounded('tgt')} AS target FROM (SELECT *, CASE WHEN sig_in_position = 1 THEN tpx1 END AS tgt FROM screen)"""))
def _(x):
    return screens.screen_deep_dive(x.signals(), x.universe())["status"]


@register("deep_dive_prices", query(f"""SELECT symbol, week_start, {rounded("close")} AS close,
  {rounded("fvb_upper_thresh")} AS fvb_upper_thresh, {rounded("fvb_lower_thresh")} AS fvb_lower_thresh, {rounded("tpx1")} AS tpx1
  FROM (SELECT *, max(week_start) OVER (PARTITION BY symbol) AS newest FROM w_tgt)
  WHERE week_start >= newest - INTERVAL 60 MONTH"""))
def _(x):
    return screens.screen_deep_dive(x.signals(), x.universe())["prices"]


@register("deep_dive_one_symbol", table("trades", TRADE_SPEC, "symbol = 'SYM00003'"))
def _(x):
    return screens.screen_deep_dive(x.signals(), x.universe(), "SYM00003")["trades"]


EQUITY = {
    "shown": f"SELECT symbol, trade_id, (x - e) / nullif(e, 0) * 100 AS pct FROM (SELECT symbol, trade_id, {rounded('entry_price')} AS e, {rounded('exit_price')} AS x FROM trades)",
    "grown": f"""SELECT symbol, CAST(row_number() OVER w AS INTEGER) AS trade_no,
      100 * {base_sql.compounded("pct / 100", "PARTITION BY symbol ORDER BY trade_id")} AS v
      FROM shown WINDOW w AS (PARTITION BY symbol ORDER BY trade_id)""",
}


@register("equity_curve", query("""SELECT symbol, trade_no, v AS equity FROM grown
  UNION ALL SELECT DISTINCT symbol, 0, 100.0::DOUBLE FROM trades""", EQUITY), None)
def _(x):
    """All digits: both sides multiply the listed trades in their order."""
    return signals.equity_curve(signals.shown_trades(x.trades()))


@register("signal_rule_versions", query(f"""SELECT symbol, week_start, {rounded('bx_monthly_completed')} AS bx_monthly_completed,
  gate_v12, gate_v13 FROM (SELECT *, CAST(coalesce(bx_monthly_completed > 0, false) AS INTEGER) AS gate_v12,
  CAST(bx_monthly_dark_red = 0 AS INTEGER) AS gate_v13 FROM w_ind) WHERE gate_v12 <> gate_v13"""))
def _(x):
    return signals.signal_rule_versions(x.signals()).select(
        *KEY, "bx_monthly_completed", "gate_v12", "gate_v13")


SIG_SPEC = " ".join([
    "symbol week_start", marked(["close", "tpx1", "sig_entry_price", "cycle_pct", *BT_DOUBLES, *CYCLE_DOUBLES]),
    "in_entry_zone sig_entry sig_reentry sig_add sig_tp sig_sl sig_in_position cycle_bull cycle_months cycle_count bt_weeks_in_trade",
    *BT_COUNTS])


@register("compute_signals", table("w_sig", SIG_SPEC))
def _(x):
    stored = x.settled(ind.compute_indicators(x.weekly(), "weekly"))
    from barwright.plans.stages import signals_from_indicators

    names = [c.partition("~")[0] for c in SIG_SPEC.split()]
    return signals_from_indicators(stored).select(*names)


@register("stats_vs_snapshot", query(f"""SELECT symbol, bt_trades AS live_bt_trades, bt_trades AS stored_bt_trades,
  {rounded('bt_geo_return')} AS live_bt_geo_return, {rounded('bt_geo_return')} AS stored_bt_geo_return, 0 AS mismatch FROM snap"""))
def _(x):
    from barwright.plans.stages import build_snapshot

    weekly = x.settled(x.signals())
    live = signals.trades(weekly, win.PLAIN_WEEKLY)
    return signals.stats_vs_snapshot(live, build_snapshot(weekly)).select(
        "symbol", "live_bt_trades", "stored_bt_trades", "live_bt_geo_return",
        "stored_bt_geo_return", "mismatch")


SPOILT = {"spoilt": """SELECT symbol, bt_trades AS live_bt_trades, bt_geo_return AS live_geo,
    CASE WHEN CAST(substr(symbol, 4) AS BIGINT) % 7 = 0 THEN bt_trades + 1 ELSE bt_trades END AS stored_bt_trades,
    CASE CAST(substr(symbol, 4) AS BIGINT) % 11 WHEN 0 THEN bt_geo_return * 1.01::DOUBLE WHEN 1 THEN NULL ELSE bt_geo_return END AS stored_geo FROM snap"""}


@register("stats_vs_spoilt_snapshot", query(f"""SELECT symbol, live_bt_trades, stored_bt_trades, {rounded('live_geo')} AS live_bt_geo_return,
  {rounded('stored_geo')} AS stored_bt_geo_return, CAST(live_bt_trades <> stored_bt_trades OR live_geo IS DISTINCT FROM stored_geo AS INTEGER) AS mismatch FROM spoilt""", SPOILT))
def _(x):
    """A snapshot with wrong counts, wrong and missing returns: each is found, and nothing else."""
    from barwright.plans.stages import build_snapshot

    weekly = x.settled(x.signals())
    number = F.substring("symbol", 4, 20).cast("bigint")
    geo = F.when(number % 11 == 0, F.col("bt_geo_return") * 1.01).when(number % 11 != 1, F.col("bt_geo_return"))
    spoilt = build_snapshot(weekly).withColumns({
        "bt_trades": F.col("bt_trades") + F.when(number % 7 == 0, 1).otherwise(0), "bt_geo_return": geo})
    return signals.stats_vs_snapshot(signals.trades(weekly, win.PLAIN_WEEKLY), spoilt).select(
        "symbol", "live_bt_trades", "stored_bt_trades", "live_bt_geo_return", "stored_bt_geo_return", "mismatch")


# --- the same by slices ---------------------------------------------------------------------


def sliced(x):
    """Weekly indicators, stored, with the year as slice."""
    return slices.year_slices(x.settled(x.signals()))


@register("position_state_by_slice", table("w_sig", "symbol week_start sig_entry sig_reentry sig_add sig_tp sig_sl sig_in_position sig_entry_price~"))
def _(x):
    return slices.signals_by_slice(sliced(x)).select(
        *KEY, "sig_entry", "sig_reentry", "sig_add", "sig_tp", "sig_sl", "sig_in_position", "sig_entry_price")


@register("trades_by_slice", table("trades", TRADE_SPEC))
def _(x):
    return slices.trades_by_slice(sliced(x))


@register("cycle_stats_by_slice", query("SELECT s.symbol, coalesce(cycle_count, 0) AS cycle_count, "
    + columns(marked([c for c in CYCLE_STAT_COLUMNS if c != "cycle_count"])) + """ FROM (SELECT DISTINCT symbol FROM weekly) s LEFT JOIN cyc USING (symbol)"""))
def _(x):
    return slices.cycle_stats_by_slice(sliced(x))


# --- snapshot columns and screens ---------------------------------------------------------


def part_of_view(name: str, doubles: list[str], plain: list[str], where: str = "true"):
    @register(name, table("screen", " ".join(["symbol", marked(doubles), *plain]), where))
    def _(x):
        return x.view().where(where).select("symbol", *doubles, *plain)


LABELS = ["_fvb33_label", "_bx_monthly_label", "_bx_weekly_label", "_bx_mo_wk"]
part_of_view("dist_upper_pct", ["_dist_upper_pct"], [])
part_of_view("upside_to_tp_pct", ["_upside_to_tp_pct"], [])
part_of_view("unrealised_pct", ["_unrealised_pct"], ["sig_in_position"])
part_of_view("labels", [], LABELS)
part_of_view("join_sector", [], ["sector"])
part_of_view("load_backtest_snapshot", ["close", "tpx1", "_dist_upper_pct", "_upside_to_tp_pct", "_unrealised_pct"],
             [*LABELS, "sector", "sig_in_position"])


@register("filter_snapshot", table("screen", "symbol close~ sector _fvb33_label",
    "_fvb33_label = 'Bearish' AND _bx_mo_wk = 'Bear/Bear' AND sector IN ('ASIA', 'EUROPE') AND screen.close >= 5"))
def _(x):
    return screens.filter_snapshot(x.view(), band="Bearish", mo_wk="Bear/Bear", sectors=["ASIA", "EUROPE"]).select(
        "symbol", "close", "sector", "_fvb33_label")


ANY = "sig_entry = 1 OR sig_reentry = 1 OR sig_add = 1 OR sig_tp = 1 OR sig_sl = 1"
FLAGS = ["sig_entry", "sig_reentry", "sig_add", "sig_tp", "sig_sl"]


@register("filter_signals", table("screen", "symbol close~ " + " ".join(FLAGS), ANY))
def _(x):
    return screens.filter_signals(x.view()).select("symbol", "close", *FLAGS)


@register("filter_signals_history", table("w_sig", "symbol week_start " + " ".join(FLAGS), ANY))
def _(x):
    return screens.filter_signals(x.signals()).select(*KEY, *FLAGS)


@register("filter_in_position", table("screen", "symbol close~ sig_entry_price~", "sig_in_position = 1"))
def _(x):
    return screens.filter_in_position(x.view()).select("symbol", "close", "sig_entry_price")


BOARD = "bt_trades >= 5 AND bt_win_rate >= 0 AND bt_profit_factor >= 1.0"


@register("filter_leaderboard", table("screen", "symbol bt_trades bt_win_rate~ bt_profit_factor~", BOARD))
def _(x):
    return screens.filter_leaderboard(x.view()).select("symbol", "bt_trades", "bt_win_rate", "bt_profit_factor")


@register("rank_leaderboard", table("screen", "symbol bt_geo_return~", BOARD))
def _(x):
    return screens.rank_leaderboard(x.view()).select("symbol", "bt_geo_return")


@register("position_summary", query(f"""SELECT count(*) AS positions, count(*) FILTER (_unrealised_pct > 0) AS profitable,
  {rounded('avg(_unrealised_pct)')} AS avg_unrealised, arg_min(symbol, ROW(-_unrealised_pct, symbol)) AS best_symbol,
  {rounded('max(_unrealised_pct)')} AS best_unrealised FROM screen WHERE sig_in_position = 1"""))
def _(x):
    return screens.position_summary(x.view())


CYCLE = "cycle_bull cycle_months cycle_pct~"
BADGE = ", ".join(f"CASE WHEN {f} = 1 THEN '{t}' END" for f, t in zip(FLAGS, ["Entry", "Re-Entry", "Add", "TP Hit", "SL"]))


ACTIVE = (f"symbol sector signal price~ _dist_upper_pct~ _upside_to_tp_pct~ _fvb33_label _bx_monthly_label"
          f" _bx_mo_wk {CYCLE} bt_win_rate~ bt_profit_factor~ bt_geo_return~ bt_trades")
HELD = (f"symbol sector price~ entry_price~ _unrealised_pct~ tpx1~ _upside_to_tp_pct~ _fvb33_label"
        f" _bx_monthly_label _bx_mo_wk {CYCLE} bt_win_rate~ bt_profit_factor~ bt_weeks_in_trade")


@register("screen_active_signals", query(f"""SELECT {columns(ACTIVE)} FROM (SELECT *, close AS price,
  concat_ws(' + ', {BADGE}) AS signal FROM screen WHERE ({ANY}) AND close >= 5)"""))
def _(x):
    return screens.screen_active_signals(x.view())


@register("screen_in_position", query(f"""SELECT {columns(HELD)} FROM (SELECT *, close AS price,
  sig_entry_price AS entry_price FROM screen WHERE sig_in_position = 1)"""))
def _(x):
    return screens.screen_in_position(x.view())


@register("screen_leaderboard", table("screen", " ".join(["symbol sector", *BT_COUNTS, marked(BT_DOUBLES), "bt_weeks_in_trade"]), BOARD))
def _(x):
    return screens.screen_leaderboard(x.view())


R252 = "OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)"
RANGE = {"w52": f"SELECT symbol, date, close, max(high) {R252} AS hi, min(low) {R252} AS lo FROM daily"}


def range_sql(where: str) -> str:
    return query(f"""SELECT symbol, {rounded('close', 2)} AS last_close, {rounded('hi', 2)} AS high_52w, {rounded('lo', 2)} AS low_52w,
      {rounded('p', 1)} AS pct_of_range FROM (SELECT *, (close - lo) / nullif(hi - lo, 0) * 100 AS p FROM w52)
      WHERE date = (SELECT max(date) FROM daily){where}""", RANGE)


@register("screen_52w_range", range_sql(""))
def _(x):
    return reports.screen_52w_range(x.daily())


@register("screen_52w_range_listed", range_sql(" AND symbol IN (" + ", ".join(f"'SYM{i:05d}'" for i in range(1, 15)) + ")"))
def _(x):
    return reports.screen_52w_range(x.daily(), [f"SYM{i:05d}" for i in range(1, 15)])


FULL = [*ALL_DOUBLES, "tpx1", "tpx2", "sig_entry_price", "cycle_pct", *BT_DOUBLES, *CYCLE_DOUBLES, "cycle_avg_pullback"]


@register("full_weekly_snapshot", table("snap", " ".join(["symbol week_start trading_days", marked([*BAR, *FULL]), *ALL_FLAGS,
    *FLAGS, "in_entry_zone sig_in_position cycle_bull cycle_months cycle_count bt_weeks_in_trade", *BT_COUNTS])))
def _(x):
    from barwright.plans.stages import build_snapshot

    return build_snapshot(full_weekly(x.weekly(), newest_only=True))
