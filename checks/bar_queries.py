"""Scans, reports, window primitives and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from barwright.functions.numeric import flag, half_up, month_index, ratio
from barwright.operators import indicators as ind
from barwright.operators import reports
from barwright.operators import windows as win
from barwright.operators.portfolio import load_reference_series
from barwright.sources import candles
from checks.base_sql import query, rounded, table
from checks.registry import Inputs, register

NAMES = [f"SYM{i:05d}" for i in range(1, 8)]
IN_LIST = "(" + ", ".join(f"'{n}'" for n in NAMES) + ")"
BAR = "open~ high~ low~ close~ volume~"
MAS = "sma_20~ sma_33~ ema_20~ ema_33~"


def laid_daily(x: Inputs):
    return win.lay_out(x.daily(), "date")


def daily_mas(x: Inputs):
    df, bars = laid_daily(x)
    return win.drop_internal(ind.base_mas(df, bars))


# --- scans --------------------------------------------------------------------------


@register("read_candles", table("daily", f"symbol date {BAR}", f"symbol IN {IN_LIST} AND date >= DATE '1998-01-01'"))
def _(x):
    store = x.store()
    store.write_bars(x.daily(), "daily")
    return store.candles("daily", NAMES, "1998-01-01")


@register("register_views", table("weekly", f"symbol week_start {BAR} trading_days"))
def _(x):
    candles.register_views(x.daily(), x.weekly())
    return x.spark.table("weekly")


@register("sql", query(f"""SELECT yr, {rounded("avg_close")} AS avg_close, symbols FROM (SELECT year(date) AS yr,
  avg(close) AS avg_close, count(DISTINCT symbol) AS symbols FROM daily
  WHERE date::DATE <= (SELECT max(week_start) FROM weekly) GROUP BY yr)"""))
def _(x):
    candles.register_views(x.daily(), x.weekly())
    return candles.sql(x.spark, """
        WITH d AS (SELECT symbol, date::DATE AS day, close FROM daily)
        SELECT year(day) AS yr, avg(close) AS avg_close, count(DISTINCT symbol) AS symbols
        FROM d WHERE day <= (SELECT max(week_start) FROM weekly) GROUP BY yr""")


@register("load_symbol_history", table("weekly", f"symbol week_start {BAR} trading_days", "symbol = 'SYM00003'"))
def _(x):
    store = x.store()
    store.write_bars(x.weekly(), "weekly")
    return store.candles("weekly", ["SYM00003"])


# --- projections and filters ----------------------------------------------------------


@register("scan_not_null", table("d_ind", f"symbol date {BAR} sma_20~ sma_33~", "sma_20 IS NOT NULL"))
def _(x):
    d = x.daily()
    close = F.col("close")
    d = d.withColumns({f"sma_{n}": win.sma(close, n, win.PLAIN_DAILY) for n in (20, 33)})
    return reports.scan_not_null(d)


@register("filter_symbol_in", table("daily", "date symbol close~", f"symbol IN {IN_LIST} AND date >= DATE '1998-01-01'"))
def _(x):
    return candles.select_candles(x.daily(), "daily", NAMES, "1998-01-01").select(
        "date", "symbol", "close"
    ).orderBy("symbol", "date")


@register("filter_symbol_since", table("d_ind", "date close~ sma_20~ sma_33~", "symbol = 'SYM00001' AND date >= DATE '1998-01-01'"))
def _(x):
    close = F.col("close")
    d = x.daily().withColumns({f"sma_{n}": win.sma(close, n, win.PLAIN_DAILY) for n in (20, 33)})
    return candles.select_candles(d, "daily", ["SYM00001"], "1998-01-01").select(
        "date", "close", "sma_20", "sma_33"
    ).orderBy("date")


@register("latest_candles", table("d_ind", f"date symbol {BAR} sma_20~2 sma_33~2 ema_20~2 ema_33~2", "true",
    " QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 20"))
def _(x):
    return reports.latest_candles(daily_mas(x))


@register("latest_candles_one_symbol", table("d_ind", f"date symbol {BAR} sma_20~2 sma_33~2 ema_20~2 ema_33~2",
    "symbol = 'SYM00002' AND date >= DATE '2000-01-01'", " ORDER BY d_ind.date DESC LIMIT 30"))
def _(x):
    recent = daily_mas(x).where("date >= date'2000-01-01'")
    return reports.latest_candles(recent, "SYM00002", 30)


@register("screen_sma_cross", table("d_ind", "symbol close~2 sma_20~2 sma_33~2 ema_20~2 ema_33~2",
    "date = (SELECT max(date) FROM daily) AND sma_20 > sma_33 AND sma_20 IS NOT NULL", " ORDER BY symbol LIMIT 50"))
def _(x):
    return reports.screen_sma_cross(daily_mas(x))


@register("price_history_window", query(f"""SELECT symbol, week_start, {rounded("close")} AS close,
  {rounded("fvb_upper_thresh")} AS fvb_upper_thresh, {rounded("fvb_lower_thresh")} AS fvb_lower_thresh, {rounded("tpx1")} AS tpx1
  FROM (SELECT *, max(week_start) OVER (PARTITION BY symbol) AS newest FROM w_tgt)
  WHERE week_start >= newest - INTERVAL 60 MONTH"""))
def _(x):
    from barwright.operators.screens import price_history_window

    return price_history_window(x.signals())


# --- joins on bars ----------------------------------------------------------------------


@register("as_of_latest", table("daily", f"symbol date {BAR}", "date = (SELECT max(date) FROM daily)"))
def _(x):
    return reports.latest_day(x.daily())


@register("attach_monthly", query(f"""SELECT b.symbol, b.week_start, m.prev_month, {rounded("m.prev_close")} AS prev_close
  FROM weekly b LEFT JOIN (SELECT symbol, month, lag(month) OVER w AS prev_month, lag(close) OVER w AS prev_close
    FROM w_month WINDOW w AS (PARTITION BY symbol ORDER BY month)) m
  ON m.symbol = b.symbol AND m.month = date_trunc('month', b.week_start)"""))
def _(x):
    weekly = x.weekly()
    return candles.attach_monthly(weekly, candles.resample_monthly_close(weekly, "week_start"), "week_start").select(
        "symbol", "week_start", "prev_month", "prev_close"
    )


# --- aggregates -------------------------------------------------------------------------


@register("overview", query("""SELECT 'daily' AS tbl, count(DISTINCT symbol) AS symbols, count(*) AS total_rows,
  min(date) AS first_date, max(date) AS last_date FROM daily UNION ALL
  SELECT 'weekly', count(DISTINCT symbol), count(*), min(week_start), max(week_start) FROM weekly"""))
def _(x):
    return reports.overview(x.daily(), x.weekly())


@register("indicator_coverage", query("""SELECT count(DISTINCT symbol) AS total_symbols,
  count(DISTINCT CASE WHEN sma_20 IS NOT NULL THEN symbol END) AS have_sma20,
  count(DISTINCT CASE WHEN sma_33 IS NOT NULL THEN symbol END) AS have_sma33,
  count(DISTINCT CASE WHEN ema_20 IS NOT NULL THEN symbol END) AS have_ema20,
  count(DISTINCT CASE WHEN ema_33 IS NOT NULL THEN symbol END) AS have_ema33 FROM d_ind"""))
def _(x):
    return reports.indicator_coverage(daily_mas(x))


@register("yearly_averages", query(f"""SELECT symbol, yr, {rounded("v", 1)} AS avg_volume_m, {rounded("c", 2)} AS avg_close
  FROM (SELECT symbol, year(date) AS yr, avg(volume) / 1e6 AS v, avg(close) AS c FROM daily GROUP BY 1, 2)"""))
def _(x):
    return reports.yearly_averages(x.daily())


@register("resample_weekly", table("weekly", f"symbol week_start {BAR} trading_days"))
def _(x):
    return x.weekly()


@register("resample_monthly_close", table("w_month", "symbol month close~"))
def _(x):
    return candles.resample_monthly_close(x.weekly(), "week_start")


LAST = " QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY week_start DESC) = 1"


@register("build_snapshot", table("weekly", f"symbol week_start {BAR} trading_days", "true", LAST))
def _(x):
    from barwright.plans.stages import build_snapshot

    return build_snapshot(x.weekly())


@register("read_snapshot", table("weekly", f"symbol week_start {BAR} trading_days", "true", LAST))
def _(x):
    from barwright.plans.jobs import write_snapshot

    store = x.store()
    store.write_bars(x.weekly(), "weekly")
    write_snapshot(store)
    return store.read("weekly_snapshot")


@register("week_distribution", query(f"SELECT week_start, count(*) AS n FROM (SELECT * FROM weekly{LAST}) GROUP BY 1"))
def _(x):
    from barwright.plans.stages import build_snapshot

    return reports.week_distribution(build_snapshot(x.weekly()))


@register("snapshot_range", query(f"SELECT count(*) AS n, min(week_start) AS first_week, max(week_start) AS last_week FROM (SELECT * FROM weekly{LAST})"))
def _(x):
    from barwright.plans.stages import build_snapshot

    return reports.snapshot_range(build_snapshot(x.weekly()))


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
SERIES = {"sector_daily": "SELECT sector AS symbol, date, avg(close) AS close FROM daily JOIN universe USING (symbol) WHERE sector IS NOT NULL GROUP BY 1, 2"}


def _corr_sql(source: str, ts: str, names: list[str], start: str, extra: dict | None = None) -> str:
    picked = ", ".join(f"max(close) FILTER (symbol = '{n}') AS s{i}" for i, n in enumerate(names))
    full = " AND ".join(f"s{i} IS NOT NULL" for i in range(len(names)))
    rets = ", ".join(f"s{i} / nullif(lag(s{i}) OVER (ORDER BY {ts}), 0) - 1 AS r{i}" for i in range(len(names)))
    ok = " AND ".join(f"r{i} IS NOT NULL" for i in range(len(names)))
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS sym_a, '{b}' AS sym_b, corr(r{i}, r{j}) AS c FROM returns_ok"
        for i, a in enumerate(names) for j, b in enumerate(names))
    extra = dict(extra or {})
    extra["wide_closes"] = f"SELECT {ts}, {picked} FROM {source} WHERE {ts} >= DATE '{start}' GROUP BY {ts}"
    extra["returns_ok"] = f"SELECT * FROM (SELECT {rets} FROM wide_closes WHERE {full}) WHERE {ok}"
    return query(f"SELECT sym_a, sym_b, {rounded('c', 6)} AS corr FROM ({cells})", extra)


@register("daily_return_correlation", _corr_sql("sector_daily", "date", REGIONS, "1998-01-01", SERIES), 6)
def _(x):
    series = load_reference_series(x.daily(), x.universe(), "date").withColumnRenamed("sector", "symbol")
    return reports.return_correlation(series, REGIONS, "date", "1998-01-01")


@register("weekly_return_correlation", _corr_sql("weekly", "week_start", NAMES, "1998-01-01"), 6)
def _(x):
    return reports.return_correlation(x.weekly(), NAMES, "week_start", "1998-01-01")


@register("pivot_close", query("SELECT date, " + ", ".join(
    f"max(close) FILTER (symbol = '{n}') AS \"{n}\"" for n in NAMES) + f" FROM daily WHERE symbol IN {IN_LIST} GROUP BY date"))
def _(x):
    return reports.pivot_close(x.daily(), NAMES, "date")


@register("distinct_symbols", query("SELECT DISTINCT symbol FROM weekly WHERE week_start >= DATE '2000-01-01'"))
def _(x):
    return reports.distinct_symbols(candles.select_candles(x.weekly(), "weekly", start="2000-01-01"))


# --- window primitives ------------------------------------------------------------------

W = "PARTITION BY symbol ORDER BY week_start"


def plain(name: str, sql_expr: str, digits: int = 4):
    """A one-column operator over all weekly bars."""
    text = query(f"SELECT symbol, week_start, {rounded('v', digits)} AS {name} FROM (SELECT symbol, week_start, {sql_expr} AS v FROM weekly)")
    return register(name, text, digits)


def one(x: Inputs, name: str, column):
    return x.weekly().select("symbol", "week_start", column.alias(name))


@register("sma", table("w_ind", "symbol week_start sma_20~"))
def _(x):
    return one(x, "sma_20", win.sma(F.col("close"), 20, win.PLAIN_WEEKLY))


def laid_weekly(x: Inputs):
    return win.lay_out(x.weekly(), "week_start", days_per_bar=7)


@register("ema", table("w_ind", "symbol week_start ema_20~ ema_33~"))
def _(x):
    df, bars = laid_weekly(x)
    return win.ema(df, bars, {"ema_20": ("close", 20), "ema_33": ("close", 33)}).select(
        "symbol", "week_start", "ema_20", "ema_33")


# Every seventh week has no close; it neither counts nor decays.
GAP = "((ts - DATE '1900-01-01') // 7) % 7 = 3"
GAPS = f"""SELECT symbol, i, ts, CASE WHEN {GAP} THEN NULL ELSE close END AS e, CASE WHEN {GAP} THEN 0 ELSE 1 END AS k FROM w_bar WHERE i = 1
  UNION ALL SELECT b.symbol, b.i, b.ts,
    CASE WHEN {GAP.replace('ts', 'b.ts')} THEN r.e WHEN r.e IS NULL THEN b.close ELSE r.e * (1 - 2.0::DOUBLE / 21) + b.close * (2.0::DOUBLE / 21) END,
    CASE WHEN {GAP.replace('ts', 'b.ts')} THEN r.k ELSE r.k + 1 END
  FROM gap_rows r JOIN w_bar b ON b.symbol = r.symbol AND b.i = r.i + 1"""


@register("ema_with_gaps", query(f"SELECT symbol, ts AS week_start, {rounded('v')} AS ema_20 FROM (SELECT symbol, ts, CASE WHEN k >= 20 THEN e END AS v FROM gap_rows)", {"gap_rows": GAPS}))
def _(x):
    gap = F.pmod(F.floor(F.datediff("week_start", F.lit("1900-01-01").cast("date")) / 7), F.lit(7)) == 3
    holed = x.weekly().withColumn("close", F.when(~gap, F.col("close")))
    df, bars = win.lay_out(holed, "week_start", days_per_bar=7)
    return win.ema(df, bars, {"ema_20": ("close", 20)}).select("symbol", "week_start", "ema_20")


SHORT = "SELECT symbol, i, ts, close AS e2, close AS e3, close AS e4, close FROM w_bar WHERE i = 1 UNION ALL SELECT b.symbol, b.i, b.ts, " + ", ".join(
    f"r.e{n} * (1 - 2.0::DOUBLE / {n + 1}) + b.close * (2.0::DOUBLE / {n + 1})" for n in (2, 3, 4)
) + ", b.close FROM short_rows r JOIN w_bar b ON b.symbol = r.symbol AND b.i = r.i + 1"


@register("ema_short_spans", query(f"SELECT symbol, ts AS week_start, {rounded('close')} AS ema_1, " + ", ".join(
    f"{rounded(f'v{n}')} AS ema_{n}" for n in (2, 3, 4)) + " FROM (SELECT *, " + ", ".join(
    f"CASE WHEN i >= {n} THEN e{n} END AS v{n}" for n in (2, 3, 4)) + " FROM short_rows)", {"short_rows": SHORT}))
def _(x):
    df, bars = win.lay_out(x.weekly(), "week_start", alpha=win.alpha_of_span(2), days_per_bar=7)
    return win.ema(df, bars, {f"ema_{n}": ("close", n) for n in (1, 2, 3, 4)}).select(
        "symbol", "week_start", *[f"ema_{n}" for n in (1, 2, 3, 4)])


RSI14 = """SELECT symbol, i, ts, close, CAST(0 AS DOUBLE) AS g, CAST(0 AS DOUBLE) AS l FROM w_bar WHERE i = 1 UNION ALL
  SELECT b.symbol, b.i, b.ts, b.close,
    CASE WHEN b.i = 2 THEN greatest(b.close - r.close, 0) ELSE r.g * (1 - 1.0::DOUBLE / 14) + greatest(b.close - r.close, 0) * (1.0::DOUBLE / 14) END,
    CASE WHEN b.i = 2 THEN greatest(r.close - b.close, 0) ELSE r.l * (1 - 1.0::DOUBLE / 14) + greatest(r.close - b.close, 0) * (1.0::DOUBLE / 14) END
  FROM rsi_rows r JOIN w_bar b ON b.symbol = r.symbol AND b.i = r.i + 1"""


@register("wilder_rsi", query(f"""SELECT symbol, ts AS week_start, {rounded("v")} AS rsi FROM (SELECT symbol, ts, CASE WHEN i >= 15 THEN
  CASE WHEN l > 0 THEN 100 - 100 / (1 + g / l) WHEN g > 0 THEN 100 END END AS v FROM rsi_rows)""", {"rsi_rows": RSI14}))
def _(x):
    df, bars = laid_weekly(x)
    return win.wilder_rsi(df, bars, "close", 14, "rsi").select("symbol", "week_start", "rsi")


@register("true_range", query(f"SELECT symbol, ts AS week_start, {rounded('tr')} AS true_range FROM w_bar"))
def _(x):
    return one(x, "true_range", win.true_range(win.previous(F.col("close"), 1, win.PLAIN_WEEKLY)))


@register("rolling_std", query(f"SELECT symbol, ts AS week_start, {rounded('std_20')} AS rolling_std FROM w_win"))
def _(x):
    return one(x, "rolling_std", win.rolling_std(F.col("close"), 20, win.PLAIN_WEEKLY))


R252 = "OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)"


@register("rolling_high_low", query(f"SELECT symbol, date, max(high) {R252} AS high_252, min(low) {R252} AS low_252 FROM daily"), None)
def _(x):
    return x.daily().select(
        "symbol", "date",
        win.rolling_high(F.col("high"), 252, win.PLAIN_DAILY).alias("high_252"),
        win.rolling_low(F.col("low"), 252, win.PLAIN_DAILY).alias("low_252"),
    )


@plain("lag", f"lag(close, 2) OVER ({W})")
def _(x):
    return one(x, "lag", win.previous(F.col("close"), 2, win.PLAIN_WEEKLY))


@register("last_n", table("daily", f"symbol date {BAR}", "true", " QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 3"))
def _(x):
    return reports.last_n(x.daily(), 3, "date")


@plain("carry_forward", f"last_value(CASE WHEN close > open THEN close END IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING)")
def _(x):
    return one(x, "carry_forward", win.carry_forward(F.when(F.col("close") > F.col("open"), F.col("close")), win.PLAIN_WEEKLY))


LATCH = f"CAST(coalesce(last_value(CASE WHEN close > open * 1.5::DOUBLE THEN 1 WHEN close < open * 0.7::DOUBLE THEN 0 END IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING), 0) AS INTEGER)"


def latched(x: Inputs):
    on, off = F.col("close") > F.col("open") * 1.5, F.col("close") < F.col("open") * 0.7
    return one(x, "latch", win.latch(on, off, win.PLAIN_WEEKLY))


@register("latch", query(f"SELECT symbol, week_start, {LATCH} AS latch FROM weekly"))
def _(x):
    return latched(x)


LATCHED = {"latched": f"SELECT symbol, week_start, close, {LATCH} AS latch FROM weekly"}
TURN = {**LATCHED, "turns": f"SELECT *, CASE WHEN lag(latch) OVER ({W}) IS DISTINCT FROM latch THEN 1 ELSE 0 END AS turn FROM latched",
        "runs": f"SELECT *, CAST(sum(turn) OVER ({W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM turns"}


def run_frame(x: Inputs):
    on, off = F.col("close") > F.col("open") * 1.5, F.col("close") < F.col("open") * 0.7
    df = x.weekly().withColumn("latch", win.latch(on, off, win.PLAIN_WEEKLY))
    df = df.withColumn("turn", win.changed(F.col("latch"), win.PLAIN_WEEKLY))
    return df.withColumn("run", win.run_number(F.col("turn"), win.PLAIN_WEEKLY))


@register("islands", query("SELECT symbol, week_start, latch, run FROM runs", TURN))
def _(x):
    return run_frame(x).select("symbol", "week_start", "latch", "run")


@register("running_peak", query(f"SELECT symbol, week_start, {rounded('v')} AS peak FROM (SELECT *, max(close) OVER (PARTITION BY symbol, run ORDER BY week_start) AS v FROM runs)", TURN))
def _(x):
    return run_frame(x).select("symbol", "week_start", win.running_peak("close", "run", "week_start").alias("peak"))


@plain("pct_change", f"close / nullif(lag(close) OVER ({W}), 0) - 1", 6)
def _(x):
    return one(x, "pct_change", win.pct_change(F.col("close"), win.PLAIN_WEEKLY))


@register("normalise_to_100", query(f"SELECT symbol, date, {rounded('v')} AS norm FROM (SELECT symbol, date, close / nullif(first_value(close) OVER (PARTITION BY symbol ORDER BY date), 0) * 100 AS v FROM daily WHERE date >= DATE '1998-01-01')"))
def _(x):
    return reports.normalise_to_100(x.daily(), "date", "1998-01-01")


@register("bar_ratio", query(f"SELECT symbol, date, close, {rounded('v', 6)} AS bar_ratio FROM (SELECT symbol, date, close, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) AS v FROM daily)"), 6)
def _(x):
    return reports.bar_ratio(x.daily(), "date")


# --- sort, limit, sets ------------------------------------------------------------------


@register("order_by", table("weekly", "symbol week_start close~ volume~"))
def _(x):
    return x.weekly().select("symbol", "week_start", "close", "volume").orderBy(
        F.col("close").desc_nulls_last(), "symbol", "week_start")


@register("limit", table("weekly", "symbol week_start close~", "true", " ORDER BY symbol, week_start DESC LIMIT 50"))
def _(x):
    return x.weekly().select("symbol", "week_start", "close").orderBy("symbol", F.col("week_start").desc()).limit(50)


@register("top_k_by", table("daily", "symbol date close~ volume~", "true", " ORDER BY daily.volume DESC, symbol, date LIMIT 20"))
def _(x):
    return reports.top_k_by(x.daily().select("symbol", "date", "close", "volume"), "volume", 20, "symbol", "date")


@register("head", table("daily", "symbol date close~", "daily.close < 1000", " ORDER BY symbol, date LIMIT 20"))
def _(x):
    return reports.head(x.daily().where("close < 1000").select("symbol", "date", "close"), 20, "symbol", "date")


@register("union_all", query(f"""SELECT symbol, ts, {rounded('close')} AS close FROM (SELECT symbol, date AS ts, close FROM daily
  UNION ALL SELECT symbol, week_start, close FROM weekly)"""))
def _(x):
    return x.daily().select("symbol", F.col("date").alias("ts"), "close").unionByName(
        x.weekly().select("symbol", F.col("week_start").alias("ts"), "close"))


# --- scalar functions -------------------------------------------------------------------


@register("round", query(f"SELECT symbol, date, {rounded('v', 1)} AS r1, {rounded('v', 2)} AS r2 FROM (SELECT symbol, date, (open + close) / 2 AS v FROM daily)"), None)
def _(x):
    mid = (F.col("open") + F.col("close")) / 2
    return x.daily().select("symbol", "date", half_up(mid, 1).alias("r1"), half_up(mid, 2).alias("r2"))


@register("nullif", query(f"SELECT symbol, date, {rounded('v', 6)} AS share FROM (SELECT symbol, date, (close - low) / nullif(high - low, 0) AS v FROM daily)"), 6)
def _(x):
    c = F.col
    return x.daily().select("symbol", "date", ratio(c("close") - c("low"), c("high") - c("low")).alias("share"))


@register("cast_date", query("SELECT o_orderkey, o_orderdate::DATE AS day, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS parsed FROM orders"))
def _(x):
    day = F.col("o_orderdate").cast("date")
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return x.table("orders").select("o_orderkey", day.alias("day"), F.to_date(text).alias("parsed"))


@register("year", query("SELECT year(date) AS yr, count(*) AS n FROM daily GROUP BY 1"))
def _(x):
    return x.daily().groupBy(F.year("date").alias("yr")).agg(F.count(F.lit(1)).alias("n"))


@register("case_when", query("SELECT CASE WHEN close > open THEN 'up' WHEN close < open THEN 'down' ELSE 'flat' END AS kind, count(*) AS n FROM daily GROUP BY 1"))
def _(x):
    c, o = F.col("close"), F.col("open")
    return x.daily().groupBy(F.when(c > o, "up").when(c < o, "down").otherwise("flat").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@register("arithmetic", query(f"SELECT symbol, date, {rounded('a')} AS gap, {rounded('b')} AS top FROM (SELECT symbol, date, abs(close - open) AS a, greatest(high - open, open - low) AS b FROM daily)"))
def _(x):
    c = F.col
    return x.daily().select("symbol", "date", F.abs(c("close") - c("open")).alias("gap"),
        F.greatest(c("high") - c("open"), c("open") - c("low")).alias("top"))


@register("range_position", query(f"SELECT symbol, date, {rounded('v')} AS place FROM (SELECT symbol, date, (close - low) / nullif(high - low, 0) * 100 AS v FROM daily)"))
def _(x):
    c = F.col
    return x.daily().select("symbol", "date", (ratio(c("close") - c("low"), c("high") - c("low")) * 100).alias("place"))


@register("date_difference", query(f"""SELECT symbol, week_start, {rounded('v')} AS weeks, months FROM (SELECT symbol, week_start,
  date_diff('day', first_value(week_start) OVER ({W}), week_start) / 7.0::DOUBLE AS v,
  CAST(date_diff('month', first_value(week_start) OVER ({W}), week_start) AS INTEGER) AS months FROM weekly)"""))
def _(x):
    first = F.min("week_start").over(win.PLAIN_WEEKLY.upto)
    now = F.col("week_start")
    return x.weekly().select("symbol", "week_start", (F.datediff(now, first) / 7.0).alias("weeks"),
        (month_index(now) - month_index(first)).alias("months"))


@register("labels_text", query("SELECT symbol, date, concat(CASE WHEN close >= open THEN 'Bull' ELSE 'Bear' END, '/', CASE WHEN volume > 30 THEN 'Busy' ELSE 'Calm' END) AS label FROM daily"))
def _(x):
    return x.daily().select("symbol", "date", F.concat_ws("/",
        F.when(F.col("close") >= F.col("open"), "Bull").otherwise("Bear"),
        F.when(F.col("volume") > 30, "Busy").otherwise("Calm")).alias("label"))


@register("null_flag", query(f"SELECT symbol, week_start, CAST(coalesce(close > lag(close) OVER ({W}), false) AS INTEGER) AS rising FROM weekly"))
def _(x):
    return one(x, "rising", flag(F.col("close") > win.previous(F.col("close"), 1, win.PLAIN_WEEKLY)))


@register("geometric_mean", query(f"""SELECT symbol, {rounded('v', 6)} AS geo_mean FROM (SELECT symbol, pow(product(1 + (close - open) / open), 1.0::DOUBLE / count(*)) - 1 AS v
  FROM daily GROUP BY symbol)"""), 6)
def _(x):
    growth = 1.0 + (F.col("close") - F.col("open")) / F.col("open")
    return x.daily().groupBy("symbol").agg(
        (F.pow(F.product(growth), 1.0 / F.count(F.lit(1))) - 1.0).alias("geo_mean"))
