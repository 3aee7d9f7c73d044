"""Stored tables, quality checks and repair, incremental runs, selection and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from barwright.operators import bitmaps, correlation, incremental, portfolio, quality, signals
from barwright.operators import windows as win
from barwright.plans import jobs, rolling
from barwright.operators.indicators import compute_indicators
from barwright.plans.stages import build_snapshot
from barwright.sources import tables
from barwright.sources.candles import by_symbol, resample_monthly_close, resample_weekly
from checks import base_sql
from checks.base_sql import columns, query, rounded, table
from checks.registry import Inputs, register
from checks.signal_queries import SIG_SPEC

BAR = "open~ high~ low~ close~ volume~"
NUMBER = "CAST(substr(symbol, 4) AS BIGINT)"


def number():
    return F.substring("symbol", 4, 20).cast("bigint")


STATE = {
    f"state_{p}": f"""SELECT '{p}' AS period, symbol, CAST(max({ts}) - CAST({NUMBER} % 3 * 7 AS INTEGER) AS DATE) AS last_date,
      CASE WHEN {NUMBER} % 5 = 0 THEN '1.2' ELSE '1.3' END AS logic_version FROM {p} GROUP BY symbol"""
    for p, ts in (("daily", "date"), ("weekly", "week_start"))
}

# --- sources and sinks ----------------------------------------------------------------


@register("read_state", query("SELECT period, symbol, last_date, logic_version FROM state_weekly", STATE))
def _(x):
    store = x.store()
    before = store.read_state("weekly")  # no table yet: empty
    store.write_state(x.state("daily"))
    store.write_state(before.unionByName(x.state("weekly")))
    return store.read_state("weekly")


# Landed bars: everything from 2000 on, nested, and each third bar again with a later
# arrival and one more unit of volume.
INGESTED = f"""SELECT symbol, date, open, high, low, close,
  CASE WHEN date >= DATE '2000-01-01' AND (date - DATE '1990-01-01') % 3 = 0 THEN volume + 1 ELSE volume END AS volume FROM daily"""


def landed(x: Inputs):
    fresh = x.daily().where("date >= date'2000-01-01'")
    again = fresh.where(F.datediff("date", F.lit("1990-01-01").cast("date")) % 3 == 0)
    both = fresh.withColumn("arrival", F.lit(1)).unionByName(
        again.withColumn("volume", F.col("volume") + 1).withColumn("arrival", F.lit(2))
    )
    return both.select(
        "symbol", "date",
        F.struct(*[F.col(c).alias(c.capitalize()) for c in ("open", "high", "low", "close", "volume")]).alias("px"),
        "arrival",
    )


@register("ingest_bars", query(f"SELECT {columns('symbol date ' + BAR)} FROM ingested", {"ingested": INGESTED}))
def _(x):
    store = x.store()
    store.write_bars(x.daily().where("date < date'2000-07-01'"), "daily")
    store.ingest_bars(landed(x))
    return store.read("daily")


ALL_INGESTED = """SELECT symbol, date, open, high, low, close,
  CASE WHEN (date - DATE '1990-01-01') % 3 = 0 THEN volume + 1 ELSE volume END AS volume FROM daily"""


@register("drain_landing", query(f"SELECT {columns('symbol date ' + BAR)} FROM ingested", {"ingested": ALL_INGESTED}))
def _(x):
    """All bars, in three batches; corrections come before some of the records they replace."""
    from barwright.streaming.landing import drain_landing

    store = x.store()
    first = x.settled(x.daily().withColumn("arrival", F.lit(1)))  # the lines are read once
    third = F.datediff("date", F.lit("1990-01-01").cast("date")) % 3 == 0
    fixed = first.where(third).withColumns({"volume": F.col("volume") + 1, "arrival": F.lit(2)})
    early = F.col("date") < F.lit("1998-01-01").cast("date")
    batches = [
        first.where(early),
        first.where(~early & ~third).unionByName(fixed),
        first.withColumns({"volume": F.lit(-1.0), "arrival": F.lit(0)}).unionByName(first.where(~early & third)),
    ]
    for i, files in enumerate(batches):
        files.write.mode("append").parquet(store.path("landing"))
        drain_landing(store, store.path("landing"), store.path("_progress"), files.schema).awaitTermination()
    return store.read("daily")


@register("ingest_late_record", query(f"SELECT {columns('symbol date ' + BAR)} FROM daily"))
def _(x):
    store = x.store()
    daily = x.settled(x.daily())  # the lines are read once
    store.ingest_bars(daily.withColumn("arrival", F.lit(2)))
    store.ingest_bars(daily.withColumns({"arrival": F.lit(1), "close": F.lit(-1.0)}))
    return store.read("daily")


@register("replayed_batch_marks_nothing", query("SELECT 0 AS symbols_marked, count(*) AS bars FROM daily"))
def _(x):
    """A batch that comes twice, once by its number and once as new files with the same bars."""
    store = x.store()
    bars = x.settled(x.daily().withColumn("arrival", F.lit(1)))
    store.ingest_bars(bars, batch=("feed", 0))
    store.clear_dirty(bars.select("symbol").distinct(), "weekly_rolled", store.newest_mark())
    store.ingest_bars(bars, batch=("feed", 0))
    store.ingest_bars(bars.withColumn("arrival", F.lit(2)), batch=("feed", 1))
    marked = store.read_dirty("weekly_rolled").select(F.count(F.lit(1)).cast("int").alias("symbols_marked"))
    return marked.crossJoin(store.read("daily").agg(F.count(F.lit(1)).alias("bars")))  # one row each


def year_by_year(x: Inputs, df, ts: str, measures: dict):
    """Bitmaps of all years but the newest, then the newest year made anew from its bars alone;
    symbols first seen in it get new numbers."""
    newest = df.agg(F.max(F.year(ts))).first()[0]
    older = df.where(F.year(ts) < newest)
    numbers = x.settled(bitmaps.number_symbols(older))
    stored = x.settled(bitmaps.presence(older, numbers, ts, measures))
    late = df.where(F.year(ts) == newest)
    numbers = x.settled(bitmaps.number_symbols(late, numbers))
    return bitmaps.merged(bitmaps.replace_years(stored, bitmaps.presence(late, numbers, ts, measures), [newest]))


@register("overview_from_bitmaps", query("""SELECT 'daily' AS tbl, count(DISTINCT symbol) AS symbols, count(*) AS total_rows,
  min(date) AS first_date, max(date) AS last_date FROM daily UNION ALL
  SELECT 'weekly', count(DISTINCT symbol), count(*), min(week_start), max(week_start) FROM weekly"""))
def _(x):
    daily = x.settled(x.daily())
    parts = [
        year_by_year(x, df, ts, {name: F.lit(True)})
        for name, df, ts in (("daily", daily, "date"), ("weekly", x.settled(resample_weekly(daily)), "week_start"))
    ]
    return parts[0].unionByName(parts[1]).withColumnRenamed("measure", "tbl")


@register("indicator_coverage_from_bitmaps", query("""SELECT m AS measure, count(DISTINCT symbol) AS symbols FROM (
  SELECT symbol, unnest(['total', CASE WHEN sma_20 IS NOT NULL THEN 'sma_20' END, CASE WHEN sma_33 IS NOT NULL THEN 'sma_33' END,
    CASE WHEN ema_20 IS NOT NULL THEN 'ema_20' END, CASE WHEN ema_33 IS NOT NULL THEN 'ema_33' END]) AS m FROM w_ind) WHERE m IS NOT NULL GROUP BY m"""))
def _(x):
    weekly = x.settled(compute_indicators(x.weekly(), "weekly"))
    measures = {"total": F.lit(True)} | {c: F.col(c).isNotNull() for c in ("sma_20", "sma_33", "ema_20", "ema_33")}
    return year_by_year(x, weekly, "week_start", measures).select("measure", "symbols")


MONTHLY_RETURNS = {
    "complete": "SELECT month, row_number() OVER (ORDER BY month) AS place FROM w_month GROUP BY month HAVING count(close) = (SELECT count(DISTINCT symbol) FROM w_month)",
    "changes": """SELECT symbol, place, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY place), 0) - 1 AS r
      FROM w_month JOIN complete USING (month)""",
}


@register("monthly_return_correlation_all", query(f"""SELECT sym_a, sym_b, {rounded('c', 6)} AS corr FROM (
  SELECT a.symbol AS sym_a, b.symbol AS sym_b, corr(a.r, b.r) AS c FROM changes a JOIN changes b ON a.place = b.place AND a.symbol < b.symbol
  WHERE a.place > 1 GROUP BY 1, 2)""", MONTHLY_RETURNS), 6)
def _(x):
    """All symbols against all, on the months that every one of them has."""
    monthly = x.settled(resample_monthly_close(x.weekly(), "week_start"))
    return correlation.correlation_tiles(monthly, "month")


LISTED = [f"SYM{i:05d}" for i in range(1, 8)]


@register("read_with_other_buckets", query(f"SELECT {columns('symbol date ' + BAR)} FROM daily WHERE symbol IN ({', '.join(repr(s) for s in LISTED)})"))
def _(x):
    store = x.store()
    store.write_bars(x.daily(), "daily")
    return tables.Store(x.spark, store.root, buckets=store.buckets * 2).candles("daily", LISTED)


@register("sync_sectors", query("""SELECT symbol, coalesce(CASE WHEN right(symbol, 1) = '3' THEN 'NEW' END, sector) AS sector FROM universe"""))
def _(x):
    store = x.store()
    store.overwrite(x.universe().select("symbol", "sector"), "universe")
    store.sync_sectors(x.universe().where("symbol like '%3'").select(
        "symbol", F.lit("NEW").alias("sector"), F.lit(1).alias("arrival")))
    return store.read("universe")


EXPORT_SPEC = "symbol trade_id entry_date exit_date entry_type exit_type pct_gain~"
UPSIDE = {
    "candidates": "SELECT symbol, week_start, close, tpx1, (tpx1 - close) / nullif(close, 0) * 100 AS upside_pct FROM w_sig WHERE sig_entry = 1 OR sig_reentry = 1",
    "picks": "SELECT *, row_number() OVER (PARTITION BY week_start ORDER BY upside_pct DESC NULLS LAST, symbol) AS pick FROM candidates",
    "index_candidates": "SELECT c.* FROM candidates c JOIN universe u ON u.symbol = c.symbol WHERE u.in_index = 1",
}


@register("export_trades", query("SELECT cap, " + columns(EXPORT_SPEC) + """ FROM (SELECT t.*, caps.cap FROM trades t JOIN picks p
  ON p.symbol = t.symbol AND p.week_start = t.entry_date JOIN (SELECT unnest([60, 50, 40, 30])::INTEGER AS cap) caps ON p.pick <= caps.cap)""", UPSIDE))
def _(x):
    weekly = x.settled(x.signals())
    picked = portfolio.select_top_by_upside(portfolio.weekly_candidates(weekly), max(portfolio.CAPS))
    levels = picked.select(
        "symbol", F.col("week_start").alias("entry_date"), "pick",
        F.explode(F.array(*[F.lit(c) for c in portfolio.CAPS])).alias("cap"),
    ).where("pick <= cap").drop("pick")
    chosen = signals.trades(weekly, win.PLAIN_WEEKLY).join(levels, ["symbol", "entry_date"])
    place = x.store().path("export")
    names = [c.partition("~")[0] for c in EXPORT_SPEC.split()]
    tables.export_trades(chosen.select("cap", *names), place, "parquet")
    return x.spark.read.parquet(place)


@register("table_inventory", query(f"""SELECT tbl, total_rows, latest_day, {rounded('c')} AS latest_close, status FROM (
  SELECT 'daily' AS tbl, count(*) AS total_rows, max(date) FILTER (symbol = 'SYM00002') AS latest_day,
    arg_max(close, date) FILTER (symbol = 'SYM00002') AS c, 'found' AS status FROM daily
  UNION ALL SELECT 'weekly', count(*), max(week_start) FILTER (symbol = 'SYM00002'),
    arg_max(close, week_start) FILTER (symbol = 'SYM00002'), 'found' FROM weekly
  UNION ALL SELECT 'orders', count(*), NULL, NULL, 'not found' FROM orders
  UNION ALL SELECT 'broken', NULL, NULL, NULL, 'not readable')"""))
def _(x):
    store = x.store()
    store.write_bars(x.daily(), "daily")
    store.write_bars(x.weekly(), "weekly")
    store.overwrite(x.table("orders"), "orders")
    return store.inventory(["daily", "weekly", "orders", "broken"], "SYM00002")


@register("load_reference_series", query(f"SELECT week_start, {rounded('close')} AS close FROM (SELECT week_start, avg(close) AS close FROM weekly GROUP BY 1)"))
def _(x):
    return portfolio.load_reference_series(x.weekly())


@register("load_sector_series", query(f"SELECT sector, week_start, {rounded('close')} AS close FROM (SELECT sector, week_start, avg(close) AS close FROM weekly JOIN universe USING (symbol) WHERE sector IS NOT NULL GROUP BY 1, 2)"))
def _(x):
    return portfolio.load_reference_series(x.weekly(), x.universe())


@register("market_caps_due", query(f"SELECT symbol, {rounded('market_cap')} AS market_cap, cap_fetched_at, CAST(DATE '2001-11-04' - cap_fetched_at AS INTEGER) AS age_days FROM universe WHERE DATE '2001-11-04' - cap_fetched_at > 30"))
def _(x):
    return tables.market_caps_due(x.universe(), "2001-11-04")


# --- joins ------------------------------------------------------------------------------

LAYERS = {**STATE,
    "old_weekly": "SELECT w.* FROM weekly w JOIN state_weekly s ON s.symbol = w.symbol WHERE w.week_start <= s.last_date",
    "old_daily": "SELECT d.* FROM daily d JOIN state_daily s ON s.symbol = d.symbol WHERE d.date <= s.last_date",
    "old_rolled": "SELECT symbol, CAST(date_trunc('week', date) AS DATE) AS week_start, arg_max(close, date) AS close FROM old_daily GROUP BY 1, 2",
    "old_snap": "SELECT * FROM old_weekly QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY week_start DESC) = 1",
}


def old(x: Inputs, period: str):
    bars, ts = (x.daily(), "date") if period == "daily" else (x.weekly(), "week_start")
    return bars.join(x.state(period).select("symbol", "last_date"), "symbol").where(f"{ts} <= last_date").drop("last_date")


RECONCILED = query(f"""SELECT symbol, week_start, {rounded('a')} AS source_close, {rounded('b')} AS daily_close,
  {rounded('w')} AS weekly_close, {rounded('c')} AS snapshot_close, {rounded('b - a')} AS daily_diff, {rounded('w - a')} AS weekly_diff, {rounded('c - a')} AS snapshot_diff,
  concat_ws(',', CASE WHEN a IS NULL THEN 'source' END, CASE WHEN b IS NULL THEN 'daily' END, CASE WHEN w IS NULL THEN 'weekly' END,
    CASE WHEN c IS NULL THEN 'snapshot' END) AS not_found
  FROM (SELECT symbol, week_start, s.close AS a, d.close AS b, o.close AS w, n.close AS c FROM weekly s
    FULL JOIN old_rolled d USING (symbol, week_start) FULL JOIN old_weekly o USING (symbol, week_start)
    FULL JOIN old_snap n USING (symbol, week_start))""", LAYERS)


def four_layers(x: Inputs):
    daily = by_symbol(x.settled(x.daily()))  # the lines are read once; all layers start from stored bars
    state = daily.groupBy("symbol").agg(F.max("date").alias("newest"))
    shift = (number() % 3 * 7).cast("int")
    dated = daily.join(state, "symbol")
    stored_weekly = x.settled(
        resample_weekly(daily)
        .join(resample_weekly(daily).groupBy("symbol").agg(F.max("week_start").alias("newest")), "symbol")
        .where(F.col("week_start") <= F.date_sub("newest", shift)).drop("newest")
    )
    kept = dated.where(F.col("date") <= F.date_sub("newest", shift)).drop("newest")
    return {"source": resample_weekly(daily), "daily": resample_weekly(kept), "weekly": stored_weekly, "snapshot": build_snapshot(stored_weekly)}


@register("reconcile_layers", RECONCILED)
def _(x):
    return quality.reconcile_layers(four_layers(x), "source")


@register("reconcile_layers_by_digest", RECONCILED)
def _(x):
    return quality.reconcile_by_digests(four_layers(x), "source")


@register("snapshot_vs_weekly", query(f"""SELECT w.symbol, w.week_start, {rounded('w.close')} AS close, n.week_start AS snapshot_week,
  {rounded('n.close')} AS snapshot_close, CAST(n.week_start IS DISTINCT FROM w.newest AS INTEGER) AS stale
  FROM (SELECT *, max(week_start) OVER (PARTITION BY symbol) AS newest FROM weekly
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY week_start DESC) <= 3) w LEFT JOIN old_snap n ON n.symbol = w.symbol""", LAYERS))
def _(x):
    return quality.snapshot_vs_weekly(build_snapshot(old(x, "weekly")), x.weekly())


# Corrupt bars: in June, low and close of every tenth symbol divided by 100,000.
def bad_sql(period: str, ts: str) -> dict[str, str]:
    hit = f"{NUMBER} % 10 = 0 AND month({ts}) = 6"
    return {f"bad_{period}": f"""SELECT * REPLACE (CASE WHEN {hit} THEN low / 100000 ELSE low END AS low,
      CASE WHEN {hit} THEN close / 100000 ELSE close END AS close) FROM {period}"""}


BAD = {**bad_sql("weekly", "week_start"), **bad_sql("daily", "date")}


def spoiled(df, ts: str):
    hit = (number() % 10 == 0) & (F.month(ts) == 6)
    return df.withColumns({c: F.when(hit, F.col(c) / 100000).otherwise(F.col(c)) for c in ("low", "close")})


@register("repair_anti_join", query(f"SELECT {columns('symbol week_start ' + BAR)} FROM bad_weekly WHERE NOT (close < 0.5 AND high > 5)", BAD))
def _(x):
    bad = spoiled(x.weekly(), "week_start")
    return quality.repair_anti_join(bad, quality.detect_extreme_low(bad), "week_start").drop("trading_days")


@register("incremental_join", query(f"SELECT {columns('symbol date ' + BAR)} FROM (SELECT d.* FROM daily d LEFT JOIN state_daily s ON s.symbol = d.symbol AND {NUMBER.replace('symbol', 's.symbol')} % 7 <> 0 WHERE s.last_date IS NULL OR d.date > s.last_date)", STATE))
def _(x):
    return incremental.incremental_join(x.daily(), x.state("daily").where(number() % 7 != 0), "date")


@register("universe_semi_join", query(f"SELECT {columns('symbol week_start close~')} FROM weekly WHERE symbol IN (SELECT symbol FROM universe WHERE in_index = 1)"))
def _(x):
    return incremental.universe_semi_join(x.weekly(), x.universe()).select("symbol", "week_start", "close")


@register("adjusted_vs_raw", query(f"""SELECT symbol, date, {rounded('open')} AS open, {rounded('close')} AS close, {rounded('o')} AS adj_open, {rounded('c')} AS adj_close,
  {rounded('c / nullif(close, 0)')} AS adj_factor FROM (SELECT *, open * f AS o, close * f AS c FROM (SELECT *, 1 - month(date) / 100.0::DOUBLE AS f FROM daily
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 4))"""))
def _(x):
    factor = 1.0 - F.month("date") / 100.0
    adjusted = x.daily().withColumns({c: F.col(c) * factor for c in ("open", "close")})
    return quality.adjusted_vs_raw(x.daily(), adjusted)


# --- quality ------------------------------------------------------------------------------


@register("detect_corrupt_bars", query(f"""SELECT symbol, week_start, {columns('open~ high~ low~ close~')}, {rounded('r')} AS hc_ratio FROM (SELECT *, high / nullif(close, 0) AS r FROM weekly)
  WHERE r > 1.08 ORDER BY r DESC, symbol, week_start LIMIT 20"""))
def _(x):
    return quality.detect_corrupt_bars(x.weekly(), "week_start")


@register("corrupt_bars", query(f"SELECT symbol, week_start, {rounded('r')} AS hc_ratio FROM (SELECT *, high / nullif(close, 0) AS r FROM weekly) WHERE r > 1.08"))
def _(x):
    return quality.corrupt_bars(x.weekly()).select("symbol", "week_start", "hc_ratio")


@register("detect_extreme_low", query(f"SELECT {columns('symbol week_start high~ close~6')} FROM bad_weekly WHERE close < 0.5 AND high > 5", BAD), 6)
def _(x):
    return quality.detect_extreme_low(spoiled(x.weekly(), "week_start")).select("symbol", "week_start", "high", "close")


@register("detect_price_break", query(f"""SELECT u.symbol, {rounded('c0')} AS close_0, {rounded('c1')} AS close_1, {rounded('lc')} AS latest_close, {rounded('r')} AS ratio,
  CASE WHEN lc IS NULL THEN 'no data' WHEN r IS NULL THEN 'missing day' WHEN r < 0.5 THEN 'BAD' ELSE 'OK' END AS status
  FROM universe u LEFT JOIN (SELECT *, CASE WHEN c0 IS NOT NULL AND c1 IS NOT NULL THEN coalesce(c1 / nullif(c0, 0), 0) END AS r FROM (
    SELECT symbol, max(close) FILTER (date = DATE '2000-06-20') AS c0, max(close) FILTER (date = DATE '2000-06-22') AS c1, arg_max(close, date) AS lc
    FROM daily GROUP BY symbol)) d ON d.symbol = u.symbol"""))
def _(x):
    return quality.detect_price_break(x.daily(), x.universe(), "2000-06-20", "2000-06-22")


def fresh_state(x: Inputs):
    return x.state("daily").unionByName(x.state("weekly"))


RESET = {**STATE, **BAD, "firsts": "SELECT symbol, min(date) - 1 AS back FROM bad_daily WHERE close < 0.5 AND high > 5 GROUP BY symbol"}


@register("repair_prices", query(f"SELECT {columns('symbol date ' + BAR)} FROM bad_daily WHERE NOT (close < 0.5 AND high > 5)", BAD))
def _(x):
    store = x.store()
    store.write_bars(spoiled(x.daily(), "date"), "daily")
    store.write_state(fresh_state(x))
    jobs.run_repair(store, quality.detect_extreme_low(store.read("daily")))
    return store.read("daily")


@register("repair_prices_state", query("""SELECT period, s.symbol, CAST(least(last_date, coalesce(back, last_date)) AS DATE) AS last_date, logic_version
  FROM (SELECT * FROM state_daily UNION ALL SELECT * FROM state_weekly) s LEFT JOIN firsts f ON f.symbol = s.symbol""", RESET))
def _(x):
    store = x.store()
    store.write_bars(spoiled(x.daily(), "date"), "daily")
    store.write_state(fresh_state(x))
    jobs.run_repair(store, quality.detect_extreme_low(store.read("daily")))
    return store.read_state()


@register("repair_prices_all", query(f"SELECT {columns('symbol date ' + BAR)} FROM daily WHERE date < DATE '2001-01-01'"))
def _(x):
    return quality.repair_prices_all(x.daily(), fresh_state(x), "date", "daily", "2001-01-01")[0]


@register("repair_prices_all_state", query("""SELECT period, symbol, CAST(CASE WHEN period = 'daily' THEN least(last_date, DATE '2000-12-31') ELSE last_date END AS DATE) AS last_date,
  logic_version FROM (SELECT * FROM state_daily UNION ALL SELECT * FROM state_weekly)""", STATE))
def _(x):
    return quality.repair_prices_all(x.daily(), fresh_state(x), "date", "daily", "2001-01-01")[1]


@register("weekly_vs_daily_check", query("SELECT symbol, week_start, " + ", ".join(
    f"{rounded(f'{t}.{c}', 6)} AS {n}_{c}" for n, t in (("daily", "d"), ("weekly", "w")) for c in ("open", "high", "low", "close"))
    + """, CAST(d.open IS DISTINCT FROM w.open OR d.high IS DISTINCT FROM w.high OR d.low IS DISTINCT FROM w.low OR d.close IS DISTINCT FROM w.close AS INTEGER) AS mismatch
  FROM weekly d FULL JOIN bad_weekly w USING (symbol, week_start)""", BAD), 6)
def _(x):
    return quality.weekly_vs_daily_check(x.daily(), spoiled(x.weekly(), "week_start"))


@register("sector_coverage", query(f"SELECT count(*) AS symbols, count(sector) AS with_sector, {rounded('count(sector) * 100.0::DOUBLE / count(*)')} AS pct_with_sector FROM universe"))
def _(x):
    return quality.sector_coverage(x.universe())


# --- incremental ----------------------------------------------------------------------------


@register("state_lag", query("""SELECT period, count(*) FILTER (last_date <= DATE '2001-10-20') AS pending, count(*) AS symbols
  FROM (SELECT * FROM state_daily UNION ALL SELECT * FROM state_weekly) GROUP BY period""", STATE))
def _(x):
    return incremental.state_lag(fresh_state(x), "2001-10-20")


@register("pending_symbols", query("SELECT period, symbol, last_date, logic_version FROM state_daily WHERE last_date <= DATE '2001-10-20'", STATE))
def _(x):
    return incremental.pending_symbols(x.state("daily"), "2001-10-20")


@register("versioned_recompute", query("""SELECT n.symbol, newest, last_date, logic_version,
  CASE WHEN logic_version <> '1.3' THEN 'logic version' ELSE 'new bars' END AS reason
  FROM (SELECT symbol, max(date) AS newest FROM daily GROUP BY symbol) n JOIN state_daily s ON s.symbol = n.symbol
  WHERE logic_version <> '1.3' OR newest > last_date""", STATE))
def _(x):
    newest = x.daily().groupBy("symbol").agg(F.max("date").alias("newest"))
    return incremental.versioned_recompute(newest, x.state("daily"), signals.SIGNAL_VERSION)


@register("new_weeks_only", query(f"SELECT {columns('symbol week_start close~')} FROM weekly WHERE week_start > (SELECT max(week_start) FROM weekly WHERE week_start < DATE '2001-06-01')"))
def _(x):
    target = x.weekly().where("week_start < date'2001-06-01'")
    return incremental.new_weeks_only(x.weekly(), target).select("symbol", "week_start", "close")


WEEKLY_SPEC = SIG_SPEC
ROLLED_SPEC = WEEKLY_SPEC + " " + " ".join(
    f"{c}~" for c in "sma_20 sma_33 ema_20 ema_33 bx bx_monthly_completed bx_monthly_prev bx_monthly_realtime fvb_basis fvb_dev fvb20_dev dbb_upper rel_vol fvb_smooth_vwap".split()
) + " fvb_band_green fvb20_band_green bx_monthly_dark_red bx_realtime_dark_red trading_days"


@register("run_weekly", table("w_sig", WEEKLY_SPEC))
def _(x):
    store = x.store()
    daily = x.daily()
    store.ingest_bars(daily.where("date < date'2001-03-01'").withColumn("arrival", F.lit(1)))
    jobs.run_weekly(store)
    store.ingest_bars(daily.where("date >= date'2001-03-01'").withColumn("arrival", F.lit(1)))
    jobs.run_weekly(store)
    return store.read("weekly").select(*[c.partition("~")[0] for c in WEEKLY_SPEC.split()])


@register("run_weekly_from_state", table("w_sig", ROLLED_SPEC))
def _(x):
    """A first load, two loads of new days (the second in the middle of a week), and a corrected
    old bar for some symbols, each carried on from the stored state."""
    store = x.store()
    daily = x.settled(x.daily().withColumn("arrival", F.lit(2)))
    old = daily.where("date < date'2001-03-01'")
    wrong = (F.col("date") == F.lit("1996-04-10").cast("date")) & (number() % 3 == 0)
    spoilt = old.withColumns({"close": F.when(wrong, -1.0).otherwise(F.col("close")), "arrival": F.when(wrong, 1).otherwise(2)})
    store.ingest_bars(spoilt)
    rolling.run_weekly_from_state(store)
    for first, last in (("2001-03-01", "2001-07-19"), ("2001-07-19", "2002-01-01")):
        store.ingest_bars(daily.where(f"date >= date'{first}' and date < date'{last}'"))
        rolling.run_weekly_from_state(store)
    store.ingest_bars(old.where(wrong))
    rolling.run_weekly_from_state(store)
    return rolling.read_weekly(store).select(*[c.partition("~")[0] for c in ROLLED_SPEC.split()])


R252 = "OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)"


@register("rolling_range_newest_year", query(f"""SELECT * FROM (SELECT symbol, date, max(high) {R252} AS high_252, min(low) {R252} AS low_252 FROM daily)
  WHERE year(date) = (SELECT max(year(date)) FROM daily)"""), None)
def _(x):
    store = x.store()
    store.write_bars(x.daily(), "daily")
    year = store._load("daily").agg(F.max("year")).first()[0]
    return rolling.rolling_range_of_year(store, "daily", year, 252)


def loaded(x: Inputs, before: str | None = None):
    """A store with all bars, or those before a day, landed and computed."""
    store = x.store()
    daily = x.daily().withColumn("arrival", F.lit(1))
    store.ingest_bars(daily if before is None else daily.where(F.col("date") < F.lit(before).cast("date")))
    jobs.run_weekly(store)
    return store, daily


@register("run_signals_then_weekly", table("w_sig", WEEKLY_SPEC))
def _(x):
    store, daily = loaded(x, "2001-03-01")
    store.ingest_bars(daily.where("date >= date'2001-03-01'"))
    jobs.run_signals(store)  # the indicators have not seen the new bars: nothing to do yet
    jobs.run_weekly(store)
    return store.read("weekly").select(*[c.partition("~")[0] for c in WEEKLY_SPEC.split()])


@register("run_full", table("w_sig", WEEKLY_SPEC))
def _(x):
    store = x.store()
    jobs.run_full(store, x.daily().withColumn("arrival", F.lit(1)))
    return store.read("weekly").select(*[c.partition("~")[0] for c in WEEKLY_SPEC.split()])


@register("daily_second_run_writes_nothing", query("""SELECT stage, count(DISTINCT symbol) AS symbols, 0 AS second_run
  FROM daily, (SELECT unnest(['daily', 'weekly', 'weekly_indicators']) AS stage) GROUP BY stage"""))
def _(x):
    store = x.store()
    jobs.run_full(store, x.daily().withColumn("arrival", F.lit(1)))
    again = [jobs.run_indicators(store, "daily"), jobs.run_weekly(store)]
    return store.read_state().groupBy(F.col("period").alias("stage")).agg(
        F.count(F.lit(1)).alias("symbols"), F.lit(int(any(again))).alias("second_run"))


CUT = "2001-03-05"  # a Monday: no week is cut in two
BEFORE_CUT = query(f"SELECT {columns('symbol week_start close~ ema_20~ fvb_basis~')} FROM w_ind WHERE week_start < DATE '{CUT}'")


@register("repair_newest_bars", BEFORE_CUT)
def _(x):
    store, _ = loaded(x)
    jobs.run_repair(store, store.read("daily").where(F.col("date") >= F.lit(CUT).cast("date")))
    jobs.run_weekly(store)
    return store.read("weekly").select("symbol", "week_start", "close", "ema_20", "fvb_basis")


@register("run_repair_all", BEFORE_CUT)
def _(x):
    store, _ = loaded(x)
    jobs.run_repair_all(store, CUT)
    return store.read("weekly").select("symbol", "week_start", "close", "ema_20", "fvb_basis")


@register("repair_empties_bucket", query(f"SELECT {columns('symbol week_start close~')} FROM weekly WHERE {NUMBER} % 4 = 0"))
def _(x):
    store, _ = loaded(x)
    jobs.run_repair(store, store.read("daily").where(number() % 4 != 0))
    jobs.run_weekly(store)
    return store.read("weekly").select("symbol", "week_start", "close")


# --- selection and scores ---------------------------------------------------------------------


@register("weekly_candidates", query(f"SELECT {columns('symbol week_start close~ tpx1~ upside_pct~')} FROM index_candidates", UPSIDE))
def _(x):
    return portfolio.weekly_candidates(x.signals(), x.universe())


def selection(cap: int):
    @register(f"select_top_by_upside_{cap}", query(f"SELECT {columns('symbol week_start close~ tpx1~ upside_pct~ pick')} FROM picks WHERE pick <= {cap}", UPSIDE))
    def _(x):
        return portfolio.select_top_by_upside(portfolio.weekly_candidates(x.signals()), cap)


for _cap in (60, 50, 40, 30, 3):
    selection(_cap)

WATCHED = {"watched": """SELECT symbol, week_start, close, tpx1, upside_pct, CAST(row_number() OVER (PARTITION BY week_start
    ORDER BY upside_pct DESC NULLS LAST, symbol) AS INTEGER) AS pick
  FROM (SELECT symbol, week_start, close, tpx1, (tpx1 - close) / nullif(close, 0) * 100 AS upside_pct FROM w_sig WHERE tpx1 IS NOT NULL)"""}


def watch_list(cap: int):
    @register(f"watch_list_{cap}", query(f"SELECT {columns('symbol week_start close~ tpx1~ upside_pct~ pick')} FROM watched WHERE pick <= {cap}", WATCHED))
    def _(x):
        """All symbols with a target compete for the places of a week, so that each capacity binds."""
        return portfolio.select_top_by_upside(portfolio.weekly_candidates(x.signals(), entries_only=False), cap)


for _cap in portfolio.CAPS:
    watch_list(_cap)

BASKET = {**UPSIDE,
    "nexts": "SELECT symbol, week_start, lead(close) OVER (PARTITION BY symbol ORDER BY week_start) / nullif(close, 0) - 1 AS nr FROM weekly",
    "baskets": f"""SELECT week_start, names, {rounded('r', 6)} AS r FROM (SELECT p.week_start, count(*) AS names, avg(nr) AS r FROM picks p
      JOIN nexts n ON n.symbol = p.symbol AND n.week_start = p.week_start WHERE pick <= 30 AND nr IS NOT NULL GROUP BY 1)"""}


@register("weekly_basket_return", query(f"SELECT week_start, names, r AS basket_return, {base_sql.compounded('r', 'ORDER BY week_start')} AS growth FROM baskets", BASKET), None)
def _(x):
    """All digits of the growth: both sides multiply the shown returns in their order."""
    rows = portfolio.with_next_return(x.signals())
    return portfolio.weekly_basket_return(portfolio.weekly_candidates(rows), 30)


@register("no_penny_stocks", query(f"SELECT {columns('symbol week_start close~')} FROM bad_weekly WHERE close >= 5", BAD))
def _(x):
    return portfolio.no_penny_stocks(spoiled(x.weekly(), "week_start")).select("symbol", "week_start", "close")


SCORE = {
    "market": "SELECT week_start, close / nullif(lag(close, 52) OVER (ORDER BY week_start), 0) - 1 AS mr FROM (SELECT week_start, avg(close) AS close FROM weekly GROUP BY 1)",
    "rs": "SELECT w.symbol, w.week_start, w.orr - m.mr AS score_rs FROM (SELECT symbol, week_start, close / nullif(lag(close, 52) OVER (PARTITION BY symbol ORDER BY week_start), 0) - 1 AS orr FROM weekly) w JOIN market m USING (week_start)",
    "scored": "SELECT s.symbol, s.week_start, r.score_rs, s.cycle_rvr AS score_rvr, (close - fvb_lower_thresh) / nullif(fvb_upper_thresh - fvb_lower_thresh, 0) AS score_band FROM w_sig s JOIN rs r ON r.symbol = s.symbol AND r.week_start = s.week_start",
    "ranked": " UNION ALL ".join(f"SELECT symbol, week_start, '{m}' AS metric, percent_rank() OVER (PARTITION BY week_start ORDER BY {m}) AS p FROM scored WHERE {m} IS NOT NULL" for m in ("score_rs", "score_rvr", "score_band")),
}


@register("score_rs", query(f"SELECT symbol, week_start, {rounded('score_rs', 6)} AS score_rs FROM rs", SCORE), 6)
def _(x):
    return portfolio.score_rs(x.weekly())


LANDED = {
    "fund": "SELECT week_start, close / nullif(lag(close, 52) OVER (ORDER BY week_start), 0) - 1 AS mr FROM weekly WHERE symbol = 'SYM00001'",
    "rs_fund": SCORE["rs"].replace("JOIN market m", "JOIN fund m"),
}


@register("score_rs_landed", query(f"SELECT symbol, week_start, {rounded('score_rs', 6)} AS score_rs FROM rs_fund", LANDED), 6)
def _(x):
    weekly = x.weekly()
    return portfolio.score_rs(weekly, market=portfolio.landed_series(weekly, "SYM00001"))


@register("score_rvr", query(f"SELECT symbol, week_start, {rounded('score_rvr')} AS score_rvr FROM scored", SCORE))
def _(x):
    return portfolio.score_rvr(x.signals())


@register("score_band_position", query(f"SELECT symbol, week_start, {rounded('score_band', 6)} AS score_band FROM scored", SCORE), 6)
def _(x):
    return portfolio.score_band_position(x.signals())


SCORE_SELECT = f"""SELECT symbol, week_start, {rounded('a', 6)} AS score_rs_rank, {rounded('b', 6)} AS score_rvr_rank, {rounded('c', 6)} AS score_band_rank,
  {rounded('s', 6)} AS score FROM (SELECT symbol, week_start, max(p) FILTER (metric = 'score_rs') AS a, max(p) FILTER (metric = 'score_rvr') AS b,
  max(p) FILTER (metric = 'score_band') AS c, avg(p) AS s FROM ranked GROUP BY 1, 2)"""


@register("scores", query(SCORE_SELECT, SCORE), 6)
def _(x):
    return portfolio.scores(x.settled(x.signals()))


@register("scores_new_weeks", query(SCORE_SELECT + " WHERE week_start > (SELECT max(week_start) FROM weekly WHERE week_start < DATE '2001-06-01')", SCORE), 6)
def _(x):
    weekly = x.settled(x.signals())
    return portfolio.scores(weekly, weekly.where("week_start < date'2001-06-01'"))


SECTOR = {"sector_weeks": "SELECT sector, week_start, avg(close) AS sc FROM weekly JOIN universe USING (symbol) WHERE sector IS NOT NULL GROUP BY 1, 2"}


@register("sector_relative", query(f"""SELECT symbol, week_start, sector, {rounded('close')} AS close, {rounded('sc')} AS sector_close, {rounded('close / nullif(sc, 0)')} AS relative
  FROM (SELECT w.symbol, w.week_start, u.sector, w.close, s.sc FROM weekly w JOIN universe u ON u.symbol = w.symbol JOIN sector_weeks s ON s.sector = u.sector AND s.week_start = w.week_start)""", SECTOR))
def _(x):
    return portfolio.sector_relative(x.weekly(), x.universe())
