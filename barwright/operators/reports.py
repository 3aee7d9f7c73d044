"""Queries over the daily and weekly tables: projections, overviews, top lists, and
series for charts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.functions.numeric import half_up, ratio

MOVING_AVERAGES = ["sma_20", "sma_33", "ema_20", "ema_33"]
BARS_PER_YEAR = 252


def scan_not_null(df: DataFrame, column: str = "sma_20") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def latest_day(df: DataFrame, ts: str = "date") -> DataFrame:
    """Rows of the newest day in the table, by an uncorrelated scalar subquery."""
    return df.where(F.col(ts) == df.select(F.max(ts)).scalar())


def last_n(df: DataFrame, n: int, ts: str) -> DataFrame:
    """Newest n rows per symbol; each input partition is cut to n per symbol first."""
    newest = Window.partitionBy("symbol").orderBy(F.col(ts).desc())
    return df.withColumn("__age", F.row_number().over(newest)).where(f"__age <= {n}").drop("__age")


def latest_candles(df: DataFrame, symbol: str | None = None, n: int = 20) -> DataFrame:
    """Newest n daily bars with rounded averages, for one symbol or for each."""
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    columns = [
        "date", "symbol", "open", "high", "low", "close", "volume",
        *[half_up(F.col(c), 2).alias(c) for c in MOVING_AVERAGES],
    ]
    return last_n(df, n, "date").select(*columns).orderBy("symbol", F.col("date").desc())


def screen_sma_cross(df: DataFrame, limit: int = 50) -> DataFrame:
    """Symbols whose short mean is above the long one on the newest day."""
    return (
        latest_day(df)
        .where(F.col("sma_20").isNotNull() & (F.col("sma_20") > F.col("sma_33")))
        .select("symbol", *[half_up(F.col(c), 2).alias(c) for c in ["close", *MOVING_AVERAGES]])
        .orderBy("symbol")
        .limit(limit)
    )


def screen_52w_range(daily: DataFrame, symbols: Iterable[str] | None = None) -> DataFrame:
    """Where the last close stands in the range of the last 252 bars, for symbols with a
    bar on the newest day.  The rolling extremes at a symbol's last bar are those of its
    last 252 bars, so only these rows are shuffled and no frame slides."""
    newest_day = daily.select(F.max("date")).scalar()
    wanted = daily.select("symbol", "date", "close", "high", "low")
    if symbols is not None:
        wanted = wanted.where(F.col("symbol").isin(list(symbols)))
    ranged = last_n(wanted, BARS_PER_YEAR, "date").groupBy("symbol").agg(
        F.max("date").alias("date"),
        F.max_by("close", "date").alias("last_close"),
        F.max("high").alias("high_52w"),
        F.min("low").alias("low_52w"),
    )
    low, high = F.col("low_52w"), F.col("high_52w")
    place = ratio(F.col("last_close") - low, high - low) * 100
    return (
        ranged.where(F.col("date") == newest_day)
        .select(
            "symbol",
            half_up(F.col("last_close"), 2).alias("last_close"),
            half_up(high, 2).alias("high_52w"),
            half_up(low, 2).alias("low_52w"),
            half_up(place, 1).alias("pct_of_range"),
        )
        .orderBy(F.col("pct_of_range").desc_nulls_last(), "symbol")
    )


def overview(daily: DataFrame, weekly: DataFrame) -> DataFrame:
    """Symbols, rows and date range of both tables.  Symbols are counted after a
    per-symbol aggregate, which combines before the exchange."""

    def one(df: DataFrame, name: str, ts: str) -> DataFrame:
        per_symbol = df.groupBy("symbol").agg(
            F.count(F.lit(1)).alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi")
        )
        return per_symbol.agg(
            F.lit(name).alias("tbl"),
            F.count("symbol").alias("symbols"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.min("lo").alias("first_date"),
            F.max("hi").alias("last_date"),
        )

    return one(daily, "daily", "date").unionByName(one(weekly, "weekly", "week_start"))


def indicator_coverage(df: DataFrame) -> DataFrame:
    """How many symbols have each average at all.  One row per symbol is formed first,
    so the five distinct counts do not multiply the input."""
    have = {"have_" + c.replace("_", ""): c for c in MOVING_AVERAGES}
    per_symbol = df.groupBy("symbol").agg(
        *[F.count(c).alias(name) for name, c in have.items()]
    )
    return per_symbol.agg(
        F.count("symbol").alias("total_symbols"),
        *[F.count(F.when(F.col(name) > 0, 1)).alias(name) for name in have],
    )


def yearly_averages(daily: DataFrame, symbol: str | None = None) -> DataFrame:
    if symbol is not None:
        daily = daily.where(F.col("symbol") == symbol)
    return (
        daily.groupBy("symbol", F.year("date").alias("yr"))
        .agg(F.avg("volume").alias("v"), F.avg("close").alias("c"))
        .select(
            "symbol",
            "yr",
            half_up(F.col("v") / 1e6, 1).alias("avg_volume_m"),
            half_up(F.col("c"), 2).alias("avg_close"),
        )
        .orderBy("symbol", "yr")
    )


def week_distribution(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("week_start").agg(F.count(F.lit(1)).alias("n")).orderBy("week_start")


def snapshot_range(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("week_start").alias("first_week"),
        F.max("week_start").alias("last_week"),
    )


def top_k_by(df: DataFrame, column: str, n: int = 20, *ties: str) -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last(), *ties).limit(n)


def head(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def distinct_symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct()


def normalise_to_100(df: DataFrame, ts: str, start: str, symbols: Iterable[str] | None = None) -> DataFrame:
    """Close as an index with 100 at each symbol's first bar in the range."""
    df = df.where(F.col(ts) >= F.lit(start).cast("date"))
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    first = F.first("close").over(
        Window.partitionBy("symbol").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    )
    return df.select("symbol", ts, (ratio(F.col("close"), first) * 100.0).alias("norm"))


def bar_ratio(df: DataFrame, ts: str) -> DataFrame:
    prev = F.lag("close", 1).over(Window.partitionBy("symbol").orderBy(ts))
    return df.select("symbol", ts, "close", ratio(F.col("close"), prev).alias("bar_ratio"))


def pivot_close(df: DataFrame, symbols: Sequence[str], ts: str) -> DataFrame:
    """One row per time, one column per named symbol; naming them saves a pass."""
    wanted = df.where(F.col("symbol").isin(list(symbols)))
    return wanted.groupBy(ts).pivot("symbol", list(symbols)).agg(F.first("close"))


def return_correlation(df: DataFrame, symbols: Sequence[str], ts: str, start: str) -> DataFrame:
    """Pearson correlation of one-bar returns between named series, over the times at
    which all of them have a close.  After the pivot there is one row per time, so the
    lag runs over a calendar, not over the bars; all coefficients come from one
    aggregate."""
    wide = pivot_close(df.where(F.col(ts) >= F.lit(start).cast("date")), symbols, ts).na.drop()
    order = Window.orderBy(ts)
    returns = wide.select(
        *[
            (ratio(F.col(f"`{s}`"), F.lag(f"`{s}`", 1).over(order)) - 1.0).alias(f"r{i}")
            for i, s in enumerate(symbols)
        ]
    ).na.drop()
    pairs = [(i, j) for i in range(len(symbols)) for j in range(len(symbols))]
    row = returns.agg(*[F.corr(f"r{i}", f"r{j}").alias(f"c{i}_{j}") for i, j in pairs])
    cells = F.array(
        *[
            F.struct(
                F.lit(symbols[i]).alias("sym_a"), F.lit(symbols[j]).alias("sym_b"),
                F.col(f"c{i}_{j}").alias("corr"),
            )
            for i, j in pairs
        ]
    )
    return row.select(F.explode(cells).alias("cell")).select("cell.*")
