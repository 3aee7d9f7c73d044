"""DuckDB building blocks: named common table expressions and their composition.

They are written against the rules, not against the Spark code: recursive means and
the position machine are plain row-by-row recursion here."""

from __future__ import annotations

import re

A5, A20, A33, A66 = (f"(CAST({n} AS DOUBLE) / {d})" for n, d in ((2, 6), (2, 21), (2, 34), (2, 67)))

CTES: dict[str, str] = {}


def cte(name: str, body: str, materialized: bool = False) -> None:
    CTES[name] = f"{name} AS {'MATERIALIZED ' if materialized else ''}({body})"


def rounded(name: str, digits: int = 4) -> str:
    """The same rounding rule as functions.numeric.half_up, on a column name."""
    x = f'"{name}"' if re.match(r"^[a-zA-Z_]\w*$", name) else f"({name})"
    exact = f"TRY_CAST({x} AS DECIMAL(38, 8))"
    return f"coalesce(CAST(round({exact}, {digits}) AS DOUBLE), {x})"


def compounded(x: str, window: str) -> str:
    """Running product of 1 + x, multiplied in the order of the window."""
    return f"list_reduce(list(1 + {x}) OVER ({window} ROWS UNBOUNDED PRECEDING), lambda a, b: a * b)"


def columns(spec: str) -> str:
    """``"a b~ c~2"``: plain a, b rounded to 4 and c to 2 digits."""
    out = []
    for item in spec.split():
        name, mark, digits = item.partition("~")
        out.append(f'{rounded(name, int(digits or 4))} AS "{name}"' if mark else f'"{name}"')
    return ", ".join(out)


def query(select: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a SELECT with the expressions it uses, directly or through others."""
    extra = extra or {}
    known = {**CTES, **{k: f"{k} AS ({v})" for k, v in extra.items()}}
    needed: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name in known:
            if name != own and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text, re.I):
                if name not in needed:
                    visit(known[name], name)
                    if name not in needed:
                        needed.append(name)

    visit(select)
    ordered = [n for n in needed]
    prefix = ",\n".join(known[n] for n in ordered)
    return f"WITH RECURSIVE {prefix}\n{select}" if ordered else select


def table(source: str, spec: str, where: str = "", tail: str = "") -> str:
    condition = f" WHERE {where}" if where else ""
    return query(f"SELECT {columns(spec)} FROM {source}{condition}{tail}")


SYMBOL = "'SYM' || lpad(CAST({k} AS VARCHAR), greatest(5, CAST(length(CAST({k} AS VARCHAR)) AS INTEGER)), '0')"

cte("px", f"""SELECT {SYMBOL.format(k="l_suppkey")} AS symbol, CAST(l_shipdate AS DATE) AS date,
  floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS price, l_quantity AS q,
  ROW(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS k FROM lineitem""")
cte("daily", """SELECT symbol, date, arg_min(price, k) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, k) AS close, sum(q) AS volume FROM px GROUP BY symbol, date""", True)
cte("weekly", """SELECT symbol, CAST(date_trunc('week', date) AS DATE) AS week_start,
  arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close,
  sum(volume) AS volume, count(*) AS trading_days FROM daily GROUP BY 1, 2""", True)
cte("universe", f"""SELECT {SYMBOL.format(k="s_suppkey")} AS symbol,
  CASE WHEN s_suppkey % 16 = 0 THEN NULL ELSE r_name END AS sector,
  CAST(CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS INTEGER) AS in_index, s_acctbal AS market_cap,
  CAST(DATE '2001-11-04' - CAST(s_suppkey % 61 AS INTEGER) AS DATE) AS cap_fetched_at
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey""")
# the symbols of the bars are suppliers of trade lines


def _sma(x: str, n: int, name: str) -> str:
    frame = f"OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {frame} = {n} THEN avg({x}) {frame} END AS {name}"


def _period(p: str, source: str, ts: str) -> None:
    extra = ", trading_days" if p == "w" else ""
    cte(f"{p}_bar", f"""SELECT symbol, {ts} AS ts, open, high, low, close, volume{extra},
      (open + high + low + close) / 4 AS src, i,
      CASE WHEN pc IS NULL THEN high - low
           ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr,
      CAST(date_trunc('month', {ts}) AS DATE) AS month
      FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY {ts}) AS pc,
        row_number() OVER (PARTITION BY symbol ORDER BY {ts}) AS i FROM {source})""", True)
    up, down = "greatest(s.e5 - s.e20 - s.d, 0)", "greatest(s.d - (s.e5 - s.e20), 0)"
    cte(f"{p}_rec", f"""SELECT symbol, i, close AS e5, close AS e20, close AS e33, src AS v5, tr AS t66,
        0.0::DOUBLE AS d, 0.0::DOUBLE AS g, 0.0::DOUBLE AS l FROM {p}_bar WHERE i = 1
      UNION ALL
      SELECT symbol, i, e5, e20, e33, v5, t66, e5 - e20,
        CASE WHEN i = 21 THEN {up} WHEN i > 21 THEN s.g * 0.8::DOUBLE + {up} * 0.2::DOUBLE ELSE 0 END,
        CASE WHEN i = 21 THEN {down} WHEN i > 21 THEN s.l * 0.8::DOUBLE + {down} * 0.2::DOUBLE ELSE 0 END
      FROM (SELECT b.symbol, b.i,
          r.e5 * (1 - {A5}) + {A5} * b.close AS e5, r.e20 * (1 - {A20}) + {A20} * b.close AS e20,
          r.e33 * (1 - {A33}) + {A33} * b.close AS e33, r.v5 * (1 - {A5}) + {A5} * b.src AS v5,
          r.t66 * (1 - {A66}) + {A66} * b.tr AS t66, r.d, r.g, r.l
        FROM {p}_rec r JOIN {p}_bar b ON b.symbol = r.symbol AND b.i = r.i + 1) s""")
    cte(f"{p}_month", f"""SELECT symbol, month, arg_max(close, ts) AS close,
      row_number() OVER (PARTITION BY symbol ORDER BY month) AS i
      FROM {p}_bar GROUP BY symbol, month""", True)
    cte(f"{p}_mrec", f"""SELECT symbol, i, close AS e5, close AS e20,
        0.0::DOUBLE AS d, 0.0::DOUBLE AS g, 0.0::DOUBLE AS l FROM {p}_month WHERE i = 1
      UNION ALL
      SELECT symbol, i, e5, e20, e5 - e20,
        CASE WHEN i = 21 THEN {up} WHEN i > 21 THEN s.g * 0.8::DOUBLE + {up} * 0.2::DOUBLE ELSE 0 END,
        CASE WHEN i = 21 THEN {down} WHEN i > 21 THEN s.l * 0.8::DOUBLE + {down} * 0.2::DOUBLE ELSE 0 END
      FROM (SELECT b.symbol, b.i,
          r.e5 * (1 - {A5}) + {A5} * b.close AS e5, r.e20 * (1 - {A20}) + {A20} * b.close AS e20,
          r.d, r.g, r.l
        FROM {p}_mrec r JOIN {p}_month b ON b.symbol = r.symbol AND b.i = r.i + 1) s""")
    rsi = "CASE WHEN l > 0 THEN 100 - 100 / (1 + g / l) WHEN g > 0 THEN 100 END"
    cte(f"{p}_mbx", f"""SELECT m.symbol, m.month, r.i, r.e5, r.e20, r.d, r.g, r.l,
      CASE WHEN r.i >= 25 THEN {rsi} - 50 END AS bx
      FROM {p}_mrec r JOIN {p}_month m ON m.symbol = r.symbol AND m.i = r.i""")
    rup, rdown = "greatest(rd - d, 0)", "greatest(d - rd, 0)"
    cte(f"{p}_osc", f"""SELECT symbol, ts, completed AS bx_monthly_completed, prev AS bx_monthly_prev,
        realtime AS bx_monthly_realtime,
        CAST(coalesce(completed < 0 AND completed <= prev, false) AS INTEGER) AS bx_monthly_dark_red,
        CAST(coalesce(realtime < 0 AND realtime <= lag(completed) OVER (PARTITION BY symbol ORDER BY ts),
          false) AS INTEGER) AS bx_realtime_dark_red
      FROM (SELECT symbol, ts, completed, prev, CASE WHEN i >= 24 THEN
          CASE WHEN rl > 0 THEN 100 - 100 / (1 + rg / rl) WHEN rg > 0 THEN 100 END - 50 END AS realtime
        FROM (SELECT *, CASE WHEN i = 20 THEN {rup} ELSE g * 0.8::DOUBLE + {rup} * 0.2::DOUBLE END AS rg,
            CASE WHEN i = 20 THEN {rdown} ELSE l * 0.8::DOUBLE + {rdown} * 0.2::DOUBLE END AS rl
          FROM (SELECT b.symbol, b.ts, m.i, m.d, m.g, m.l, m.bx AS completed, m.prev,
              (m.e5 * (1 - {A5}) + {A5} * b.close) - (m.e20 * (1 - {A20}) + {A20} * b.close) AS rd
            FROM {p}_bar b LEFT JOIN (
              SELECT symbol, lead(month) OVER w AS month, i, e5, e20, d, g, l, bx, lag(bx) OVER w AS prev
              FROM {p}_mbx WINDOW w AS (PARTITION BY symbol ORDER BY month)) m
            ON m.symbol = b.symbol AND m.month = b.month)))""")
    frame = "OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    cte(f"{p}_win", f"""SELECT *, {_sma("close", 20, "sma_20")}, {_sma("close", 33, "sma_33")},
      {_sma("src", 33, "fvb_basis")}, {_sma("tr", 66, "fvb_dev")}, {_sma("src", 20, "fvb20_basis")},
      {_sma("tr", 40, "fvb20_dev")}, {_sma("volume", 20, "avg_vol_20w")},
      CASE WHEN count(close) {frame} = 20 THEN stddev_samp(close) {frame} END AS std_20
      FROM {p}_bar""")
    bands = ", ".join(
        f"{b}_basis {sign} {b}_dev * {width}::DOUBLE AS {b}_{side}_{name}"
        for b in ("fvb", "fvb20")
        for name, width in (("thresh", "0.4"), ("x1", "3.4"), ("x2", "6.4"))
        for side, sign in (("upper", "+"), ("lower", "-"))
    )
    targets = (
        ", fvb20_basis + 4.3::DOUBLE * __t66 AS tpx1, fvb20_basis + 8.6::DOUBLE * __t66 AS tpx2"
        if p == "w" else ""
    )
    cte(f"{p}_ind", f"""SELECT *,
      CAST(fvb_band_green = 1 AND bx_monthly_dark_red = 0 AND coalesce(close <= fvb_upper_thresh, false)
        AS INTEGER) AS entry_signal, bx_monthly_dark_red AS exit_signal
      FROM (SELECT w.*, w.ts AS {ts}, src AS fvb_src, src AS fvb_vwap, {bands},
        CASE WHEN r.i >= 20 THEN r.e20 END AS ema_20, CASE WHEN r.i >= 33 THEN r.e33 END AS ema_33,
        CASE WHEN r.i >= 5 THEN r.v5 END AS fvb_smooth_vwap,
        CAST(coalesce(r.i >= 5 AND r.v5 >= fvb_basis, false) AS INTEGER) AS fvb_band_green,
        CAST(coalesce(r.i >= 5 AND r.e5 >= fvb20_basis, false) AS INTEGER) AS fvb20_band_green,
        CASE WHEN r.i >= 25 THEN {rsi.replace("l >", "r.l >").replace("g / l", "r.g / r.l").replace("g >", "r.g >")} - 50 END AS bx,
        volume / nullif(avg_vol_20w, 0) AS rel_vol, CAST(close >= open AS INTEGER) AS vol_up,
        sma_20 + 3 * std_20 AS dbb_upper, CASE WHEN r.i >= 66 THEN r.t66 END AS __t66,
        o.bx_monthly_completed, o.bx_monthly_prev, o.bx_monthly_realtime, o.bx_monthly_dark_red,
        o.bx_realtime_dark_red
        FROM {p}_win w JOIN {p}_rec r ON r.symbol = w.symbol AND r.i = w.i
        JOIN {p}_osc o ON o.symbol = w.symbol AND o.ts = w.ts)""")
    if targets:
        cte("w_tgt", f"SELECT *{targets} FROM w_ind", True)
    # d_ind keeps its name; weekly users read w_tgt


_period("d", "daily", "date")
_period("w", "weekly", "week_start")

cte("w_evt", """SELECT *, fvb_band_green = 1 AND bx_monthly_dark_red = 0 AND in_entry_zone = 1
    AND tpx1 IS NOT NULL AS e, coalesce(high >= tpx1, false) AS t, bx_monthly_dark_red = 1 AS l
  FROM (SELECT *, CAST(coalesce(close >= 0.75 * fvb_lower_thresh AND close <= 1.03::DOUBLE * fvb_upper_thresh,
    false) AS INTEGER) AS in_entry_zone FROM w_tgt)""", True)
# state 0 flat after a stop, 1 long, 2 flat after a target
cte("w_pos", """SELECT symbol, CAST(0 AS BIGINT) AS i, 0 AS s, 0 AS was, CAST(NULL AS DOUBLE) AS ep, CAST(NULL AS DATE) AS ed,
    0 AS kind, 0 AS bull, CAST(NULL AS DATE) AS cs, CAST(NULL AS DOUBLE) AS cp,
    CAST(NULL AS DOUBLE) AS peak, CAST(NULL AS DOUBLE) AS dip, CAST(NULL AS DOUBLE) AS pc
    FROM (SELECT DISTINCT symbol FROM w_evt)
  UNION ALL
  SELECT symbol, i, s, was, CASE WHEN opened THEN close ELSE ep END, CASE WHEN opened THEN ts ELSE ed END,
    CASE WHEN opened THEN was ELSE kind END, bull, CASE WHEN turned THEN ts ELSE cs END,
    CASE WHEN turned THEN coalesce(pc, close) ELSE cp END,
    CASE WHEN turned THEN close ELSE greatest(peak, close) END,
    CASE WHEN turned THEN low / nullif(close, 0) - 1
         ELSE least(dip, low / nullif(greatest(peak, close), 0) - 1) END, close
  FROM (SELECT x.*, s = 1 AND was <> 1 AS opened, i = 1 OR bull <> bull_was AS turned FROM (
    SELECT b.symbol, b.i, b.ts, b.close, b.low, r.s AS was, r.ep, r.ed, r.kind, r.cs, r.cp, r.peak, r.dip, r.pc,
      r.bull AS bull_was,
      CASE WHEN r.s = 1 THEN CASE WHEN b.t THEN 2 WHEN b.l THEN 0 ELSE 1 END
           WHEN b.e THEN 1 ELSE r.s END AS s,
      CASE WHEN b.l THEN 0 WHEN b.fvb_band_green = 1 THEN 1 ELSE r.bull END AS bull
    FROM w_pos r JOIN w_evt b ON b.symbol = r.symbol AND b.i = r.i + 1) x)""")
cte("w_sig0", """SELECT b.*, p.was, p.s, p.ep, p.ed, p.kind, p.dip, p.bull AS cycle_bull,
    CAST(p.was = 0 AND p.s = 1 AS INTEGER) AS sig_entry, CAST(p.was = 2 AND p.s = 1 AS INTEGER) AS sig_reentry,
    CAST(p.was = 1 AND b.e AND NOT b.t AS INTEGER) AS sig_add,
    CAST(p.was = 1 AND p.s = 2 AS INTEGER) AS sig_tp, CAST(p.was = 1 AND p.s = 0 AS INTEGER) AS sig_sl,
    CAST(p.s = 1 AS INTEGER) AS sig_in_position, CASE WHEN p.s = 1 THEN p.ep END AS sig_entry_price,
    CAST(date_diff('month', date_trunc('month', p.cs), date_trunc('month', b.ts)) AS INTEGER) AS cycle_months,
    (b.close - p.cp) / nullif(p.cp, 0) * 100 AS cycle_pct,
    lead(p.bull) OVER (PARTITION BY b.symbol ORDER BY b.i) AS bull_next
  FROM w_evt b JOIN w_pos p ON p.symbol = b.symbol AND p.i = b.i""", True)
cte("trades", """SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS trade_id, ed AS entry_date, ts AS exit_date,
    CASE WHEN kind = 2 THEN 'Re-Entry' ELSE 'Entry' END AS entry_type,
    CASE WHEN sig_tp = 1 THEN 'TP' ELSE 'SL' END AS exit_type, ep AS entry_price,
    CASE WHEN sig_tp = 1 THEN tpx1 ELSE close END AS exit_price,
    (CASE WHEN sig_tp = 1 THEN tpx1 ELSE close END - ep) / nullif(ep, 0) * 100 AS pct_gain,
    date_diff('day', ed, ts) / 7.0::DOUBLE AS hold_weeks
  FROM w_sig0 WHERE sig_tp = 1 OR sig_sl = 1""", True)
cte("bt", """SELECT symbol, count(*) AS bt_trades, count(*) FILTER (exit_type = 'TP') AS bt_tp_count,
    count(*) FILTER (exit_type = 'SL') AS bt_sl_count, count(*) FILTER (entry_type = 'Re-Entry') AS bt_reentry_count,
    count(*) FILTER (pct_gain > 0) * 100.0::DOUBLE / count(*) AS bt_win_rate,
    avg(pct_gain) FILTER (exit_type = 'TP') AS bt_avg_tp_pct, avg(pct_gain) FILTER (exit_type = 'SL') AS bt_avg_sl_pct,
    sum(pct_gain) FILTER (pct_gain > 0) / nullif(abs(sum(pct_gain) FILTER (pct_gain <= 0)), 0) AS bt_profit_factor,
    (product(1 + pct_gain / 100) - 1) * 100 AS bt_geo_return,
    count(*) FILTER (entry_type = 'Re-Entry' AND pct_gain > 0) * 100.0::DOUBLE
      / nullif(count(*) FILTER (entry_type = 'Re-Entry'), 0) AS bt_reentry_win_rate, avg(hold_weeks) AS avg_hold
  FROM trades GROUP BY symbol""")
cte("cyc", """SELECT symbol, count(*) AS cycle_count, count(*) FILTER (cycle_pct > 0) * 100.0::DOUBLE / count(*) AS cycle_win_rate,
    (pow(product(1 + cycle_pct / 100), 1.0::DOUBLE / count(*)) - 1) * 100 AS cycle_geo_avg_gain,
    avg(cycle_pct) FILTER (cycle_pct > 0) AS cycle_avg_win, avg(cycle_pct) FILTER (cycle_pct <= 0) AS cycle_avg_loss,
    avg(cycle_pct) FILTER (cycle_pct > 0) / nullif(abs(avg(cycle_pct) FILTER (cycle_pct <= 0)), 0) AS cycle_rvr,
    sum(cycle_pct) FILTER (cycle_pct > 0) / nullif(abs(sum(cycle_pct) FILTER (cycle_pct <= 0)), 0) AS cycle_profit_factor,
    avg(dip * 100) AS cycle_avg_pullback, (product(1 + cycle_pct / 100) - 1) * 100 AS cycle_signal_return
  FROM w_sig0 WHERE cycle_bull = 1 AND bull_next = 0 GROUP BY symbol""")
cte("w_sig", """SELECT s.* , coalesce(bt_trades, 0) AS bt_trades, coalesce(bt_tp_count, 0) AS bt_tp_count,
    coalesce(bt_sl_count, 0) AS bt_sl_count, coalesce(bt_reentry_count, 0) AS bt_reentry_count, bt_win_rate,
    bt_avg_tp_pct, bt_avg_sl_pct, bt_profit_factor, bt_geo_return, bt_reentry_win_rate, avg_hold,
    CAST(sum(sig_in_position) OVER (PARTITION BY s.symbol) AS BIGINT) AS bt_weeks_in_trade,
    coalesce(cycle_count, 0) AS cycle_count, cycle_win_rate, cycle_geo_avg_gain, cycle_avg_win, cycle_avg_loss,
    cycle_rvr, cycle_profit_factor, cycle_avg_pullback, cycle_signal_return
  FROM w_sig0 s LEFT JOIN bt ON bt.symbol = s.symbol LEFT JOIN cyc ON cyc.symbol = s.symbol""", True)
cte("snap", "SELECT * FROM w_sig QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY week_start DESC) = 1", True)
cte("screen", """SELECT *, concat(CASE WHEN bx_monthly_completed > 0 THEN 'Bull' ELSE 'Bear' END, '/',
      CASE WHEN bx > 0 THEN 'Bull' ELSE 'Bear' END) AS _bx_mo_wk
  FROM (SELECT s.*, (close - fvb_upper_thresh) / nullif(fvb_upper_thresh, 0) * 100 AS _dist_upper_pct,
    (tpx1 - close) / nullif(close, 0) * 100 AS _upside_to_tp_pct,
    CASE WHEN sig_in_position = 1 THEN (close - sig_entry_price) / nullif(sig_entry_price, 0) * 100 END AS _unrealised_pct,
    CASE WHEN fvb_band_green = 1 THEN 'Bullish' ELSE 'Bearish' END AS _fvb33_label,
    CASE WHEN bx_monthly_completed > 0 THEN 'Bullish' WHEN bx_monthly_completed <= 0 THEN 'Bearish' ELSE '--' END AS _bx_monthly_label,
    CASE WHEN bx > 0 THEN 'Bullish' ELSE 'Bearish' END AS _bx_weekly_label, coalesce(u.sector, '--') AS sector
    FROM snap s LEFT JOIN universe u ON u.symbol = s.symbol)""", True)
