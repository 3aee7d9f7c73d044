"""Data-quality checks, reconciliation between table layers, and repair."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.functions.numeric import flag, ratio
from barwright.operators.reports import last_n, top_k_by
from barwright.sources.candles import resample_weekly

# Fixed thresholds of the checks.
HIGH_TO_CLOSE_LIMIT = 1.08
LOW_CLOSE, HIGH_HIGH = 0.50, 5.0
BREAK_RATIO = 0.5


def corrupt_bars(df: DataFrame, threshold: float = HIGH_TO_CLOSE_LIMIT) -> DataFrame:
    """Bars whose high is implausibly far above the close."""
    return df.withColumn("hc_ratio", ratio(F.col("high"), F.col("close"))).where(
        F.col("hc_ratio") > threshold
    )


def detect_corrupt_bars(df: DataFrame, ts: str, worst: int = 20) -> DataFrame:
    columns = ["symbol", ts, "open", "high", "low", "close", "hc_ratio"]
    return top_k_by(corrupt_bars(df), "hc_ratio", worst, "symbol", ts).select(*columns)


def detect_extreme_low(df: DataFrame) -> DataFrame:
    return df.where((F.col("close") < LOW_CLOSE) & (F.col("high") > HIGH_HIGH))


def detect_price_break(
    daily: DataFrame, universe: DataFrame, day0: str, day1: str, threshold: float = BREAK_RATIO
) -> DataFrame:
    """Compare the closes of two named days per symbol of the universe."""

    def close_on(day: str) -> Column:
        return F.max(F.when(F.col("date") == F.lit(day).cast("date"), F.col("close")))

    seen = daily.groupBy("symbol").agg(
        close_on(day0).alias("close_0"),
        close_on(day1).alias("close_1"),
        F.max_by("close", "date").alias("latest_close"),
    )
    step = F.coalesce(ratio(F.col("close_1"), F.col("close_0")), F.lit(0.0))
    return (
        universe.select("symbol")
        .join(seen, "symbol", "left")
        .withColumn("ratio", F.when(F.col("close_0").isNotNull() & F.col("close_1").isNotNull(), step))
        .withColumn(
            "status",
            F.when(F.col("latest_close").isNull(), "no data")
            .when(F.col("ratio").isNull(), "missing day")
            .when(F.col("ratio") < threshold, "BAD")
            .otherwise("OK"),
        )
    )


def weekly_vs_daily_check(daily: DataFrame, weekly: DataFrame) -> DataFrame:
    """Stored weekly rows against the roll-up of the daily rows, both ways."""
    fields = ["open", "high", "low", "close"]
    rolled = resample_weekly(daily).select(
        "symbol", "week_start", *[F.col(c).alias(f"daily_{c}") for c in fields]
    )
    stored = weekly.select(
        "symbol", "week_start", *[F.col(c).alias(f"weekly_{c}") for c in fields]
    )
    same = F.lit(True)
    for c in fields:
        same = same & F.col(f"daily_{c}").eqNullSafe(F.col(f"weekly_{c}"))
    return rolled.join(stored, ["symbol", "week_start"], "full").withColumn(
        "mismatch", (~same).cast("int")
    )


def sector_coverage(universe: DataFrame) -> DataFrame:
    known = F.count("sector")
    return universe.agg(
        F.count(F.lit(1)).alias("symbols"),
        known.alias("with_sector"),
        (known * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("pct_with_sector"),
    )


# --- reconciliation ---------------------------------------------------------------


def reconcile_layers(layers: Mapping[str, DataFrame], reference: str) -> DataFrame:
    """Close of every (symbol, week) in each layer, the difference to the reference
    layer, and the layers that lack the week.  The layers are stacked and grouped, one
    exchange in all, instead of joined pairwise."""
    stacked = None
    for name, df in layers.items():
        part = df.select("symbol", "week_start", "close", F.lit(name).alias("layer"))
        stacked = part if stacked is None else stacked.unionByName(part)
    side_by_side = stacked.groupBy("symbol", "week_start").agg(
        *[F.max(F.when(F.col("layer") == n, F.col("close"))).alias(f"{n}_close") for n in layers]
    )
    absent = F.concat_ws(
        ",", *[F.when(F.col(f"{n}_close").isNull(), F.lit(n)) for n in layers]
    )
    return side_by_side.select(
        "*",
        *[
            (F.col(f"{n}_close") - F.col(f"{reference}_close")).alias(f"{n}_diff")
            for n in layers
            if n != reference
        ],
        absent.alias("not_found"),
    )


DIGEST_BUCKETS = 64


def _slice_of(df: DataFrame) -> DataFrame:
    bucket = F.pmod(F.hash("symbol"), F.lit(DIGEST_BUCKETS))
    return df.select("symbol", "week_start", "close", F.year("week_start").alias("year"), bucket.alias("bucket"))


def slice_digests(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Per layer and slice (year, symbol bucket) the number of rows and two sums of row hashes that
    do not depend on the order.  Combined before the exchange: a few numbers a slice."""
    stacked = None
    for name, df in layers.items():
        part = _slice_of(df).select("year", "bucket", F.xxhash64("symbol", "week_start", "close").alias("h"), F.lit(name).alias("layer"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy("layer", "year", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.pmod("h", F.lit(1 << 31))).alias("s")
    )


def unequal_slices(layers: Mapping[str, DataFrame], partial: Collection[str]) -> DataFrame:
    """Slices whose digests are not the same in all layers, and those in which a partial layer has
    rows.  At most years times DIGEST_BUCKETS rows."""
    whole = [n for n in layers if n not in partial]
    digests = slice_digests(layers)
    ours = ~F.col("layer").isin(list(partial)) if partial else F.lit(True)
    same = F.lit(True)
    for c in ("n", "x", "s"):
        same = same & (F.min(F.when(ours, F.col(c))) == F.max(F.when(ours, F.col(c))))
    found = digests.groupBy("year", "bucket").agg(
        (F.coalesce(same, F.lit(False)) & (F.count(F.when(ours, 1)) == len(whole)) & (F.count(F.when(~ours, 1)) == 0)).alias("equal")
    )
    return found.where(~F.col("equal")).select("year", "bucket")


def reconcile_by_digests(layers: Mapping[str, DataFrame], reference: str, partial: Collection[str] = ("snapshot",)) -> DataFrame:
    """The rows of ``reconcile_layers``, but only slices whose digests differ are brought together
    row by row; for the others the reference layer speaks for all.  ``partial`` layers, such as a
    snapshot, hold few rows by nature; only slices that they touch are compared with them."""
    slices = F.broadcast(unequal_slices(layers, [n for n in partial if n in layers]))
    apart = {n: _slice_of(df).join(slices, ["year", "bucket"], "left_semi") for n, df in layers.items()}
    rows = reconcile_layers(apart, reference)
    equal = _slice_of(layers[reference]).join(slices, ["year", "bucket"], "left_anti")
    value = {n: F.lit(None).cast("double") if n in partial else F.col("close") for n in layers}
    close_missing = F.when(F.col("close").isNull(), F.concat_ws(",", *[F.lit(n) for n in layers]))
    return rows.unionByName(
        equal.select(
            "symbol", "week_start", *[v.alias(f"{n}_close") for n, v in value.items()],
            *[(v - F.col("close")).alias(f"{n}_diff") for n, v in value.items() if n != reference],
            F.coalesce(close_missing, F.concat_ws(",", *[F.lit(n) for n in layers if n in partial])).alias("not_found"),
        )
    )


def snapshot_vs_weekly(snapshot: DataFrame, weekly: DataFrame, n: int = 3) -> DataFrame:
    """Snapshot close next to the last weekly rows; stale where the newest week differs."""
    recent = last_n(weekly.select("symbol", "week_start", "close"), n, "week_start")
    newest = recent.groupBy("symbol").agg(F.max("week_start").alias("newest"))
    stored = snapshot.select(
        "symbol", F.col("week_start").alias("snapshot_week"), F.col("close").alias("snapshot_close")
    )
    return (
        recent.join(newest, "symbol")
        .join(stored, "symbol", "left")
        .select(
            "symbol", "week_start", "close", "snapshot_week", "snapshot_close",
            flag(~F.col("snapshot_week").eqNullSafe(F.col("newest"))).alias("stale"),
        )
    )


def adjusted_vs_raw(raw: DataFrame, adjusted: DataFrame, n: int = 4) -> DataFrame:
    """Unadjusted and adjusted prices of the last n bars side by side."""
    left = last_n(raw.select("symbol", "date", "open", "close"), n, "date")
    right = adjusted.select(
        "symbol", "date", F.col("open").alias("adj_open"), F.col("close").alias("adj_close")
    )
    return left.join(right, ["symbol", "date"]).withColumn(
        "adj_factor", ratio(F.col("adj_close"), F.col("close"))
    )


def table_inventory(tables: Mapping[str, DataFrame], symbol: str | None = None) -> DataFrame:
    """Rows of every table and, per symbol or for the given one, its latest row.  A table
    without the symbol keeps its row, a table without a symbol or close column too."""
    reports = None
    for name, df in tables.items():
        ts = "week_start" if "week_start" in df.columns else "date"
        has_bars = {"symbol", "close", ts} <= set(df.columns)
        latest_of = F.lit(None).cast("struct<day:date,close:double>")
        if has_bars:
            bar = F.struct(F.col(ts).alias("day"), F.col("close").alias("close"))
            mine = F.col("symbol") == symbol if symbol is not None else F.lit(True)
            latest_of = F.max(F.when(mine, bar))
        part = df.agg(
            F.lit(name).alias("tbl"), F.count(F.lit(1)).alias("total_rows"), latest_of.alias("latest")
        ).select(
            "tbl",
            "total_rows",
            F.col("latest.day").alias("latest_day"),
            F.col("latest.close").alias("latest_close"),
            F.when(F.col("latest").isNull(), "not found").otherwise("found").alias("status"),
        )
        reports = part if reports is None else reports.unionByName(part)
    return reports


# --- repair -----------------------------------------------------------------------


def repair_anti_join(df: DataFrame, bad: DataFrame, ts: str) -> DataFrame:
    """Rows that are not listed as corrupt."""
    return df.join(bad.select("symbol", ts).distinct(), ["symbol", ts], "left_anti")


def reset_state(state: DataFrame, bad: DataFrame, ts: str, period: str) -> DataFrame:
    """Set the state of affected symbols back to the day before their first bad bar."""
    first_bad = bad.groupBy("symbol").agg(F.date_sub(F.min(ts), 1).alias("back_to"))
    mine = F.col("period") == period
    return state.join(first_bad, "symbol", "left").withColumn(
        "last_date",
        F.when(mine, F.least("last_date", "back_to")).otherwise(F.col("last_date")),
    ).drop("back_to")


def repair_prices(
    df: DataFrame, bad: DataFrame, state: DataFrame, ts: str, period: str
) -> tuple[DataFrame, DataFrame]:
    return repair_anti_join(df, bad, ts), reset_state(state, bad, ts, period)


def repair_prices_all(
    df: DataFrame, state: DataFrame, ts: str, period: str, from_date: str
) -> tuple[DataFrame, DataFrame]:
    """Drop every row from a date on and set all symbols of the period back to it."""
    day = F.lit(from_date).cast("date")
    back = F.when(F.col("period") == period, F.least("last_date", F.date_sub(day, 1))).otherwise(
        F.col("last_date")
    )
    return df.where(F.col(ts) < day), state.withColumn("last_date", back)
