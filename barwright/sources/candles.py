"""Bars: reading stored tables, deriving daily bars from trade lines, resampling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TIME_COLUMN = {"daily": "date", "weekly": "week_start"}


def select_candles(
    df: DataFrame,
    period: str,
    symbols: Iterable[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Optional symbol list and date range; both reach the file scan as pushed filters."""
    ts = F.col(TIME_COLUMN[period])
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    if start is not None:
        df = df.where(ts >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(ts <= F.lit(end).cast("date"))
    return df


BARS_PER_TASK = 250_000


def by_symbol(bars: DataFrame) -> DataFrame:
    """Stored bars dealt by symbol into parts of some ``BARS_PER_TASK`` rows.  Joins and groups by symbol, or
    by symbol and week, then need no exchange of their own, and what a task keeps in sorters and hash
    tables depends neither on the number of bars nor on a session's settings."""
    return bars.repartition(1 + bars.count() // BARS_PER_TASK, "symbol")


def register_views(daily: DataFrame, weekly: DataFrame) -> None:
    daily.createOrReplaceTempView("daily")
    weekly.createOrReplaceTempView("weekly")


def sql(spark: SparkSession, text: str) -> DataFrame:
    """Free SQL over the registered views; the result is a frame for later steps."""
    return spark.sql(text)


# --- daily bars from the trade lines ------------------------------------------


def symbol_name(key: Column) -> Column:
    """Ticker of a supplier key: at least five digits, never cut off."""
    text = key.cast("string")
    return F.concat(F.lit("SYM"), F.lpad(text, F.greatest(F.lit(5), F.length(text)), F.lit("0")))


def daily_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One bar per supplier and ship day.  Trade lines are reduced before the exchange
    (all five aggregates combine), so a supplier with a third of all lines costs no more
    after it than its number of days."""
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5) / 100
    arrival = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    return (
        lineitem.select(
            "l_suppkey",
            F.col("l_shipdate").cast("date").alias("date"),
            price.alias("price"),
            "l_quantity",
            arrival.alias("arrival"),
        )
        .groupBy("l_suppkey", "date")
        .agg(
            F.min_by("price", "arrival").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "arrival").alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
        .select(
            symbol_name(F.col("l_suppkey")).alias("symbol"),
            "date", "open", "high", "low", "close", "volume",
        )
    )


def universe_from_suppliers(
    supplier: DataFrame, nation: DataFrame, region: DataFrame, as_of: str = "2001-11-04"
) -> DataFrame:
    """Symbol table: sector (region, missing for every sixteenth supplier), index
    membership, market capitalisation and the day that was fetched."""
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("s_nationkey"), "r_name"
    )
    return supplier.join(places, "s_nationkey", "left").select(
        symbol_name(F.col("s_suppkey")).alias("symbol"),
        F.when(F.col("s_suppkey") % 16 != 0, F.col("r_name")).alias("sector"),
        F.when(F.col("s_acctbal") > 0, 1).otherwise(0).alias("in_index"),
        F.col("s_acctbal").alias("market_cap"),
        F.date_sub(F.lit(as_of).cast("date"), (F.col("s_suppkey") % 61).cast("int")).alias(
            "cap_fetched_at"
        ),
    )


# --- resampling -----------------------------------------------------------------


def _rolled_up(ts: str) -> list[Column]:
    return [
        F.min_by("open", ts).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", ts).alias("close"),
        F.sum("volume").alias("volume"),
    ]


def resample_weekly(daily: DataFrame) -> DataFrame:
    """Monday-to-Sunday weeks labelled by their Monday."""
    return daily.groupBy(
        "symbol", F.date_trunc("week", F.col("date")).cast("date").alias("week_start")
    ).agg(*_rolled_up("date"), F.count(F.lit(1)).alias("trading_days"))


def resample_monthly_close(candles: DataFrame, ts: str) -> DataFrame:
    """Last close of each calendar month."""
    return candles.groupBy("symbol", F.trunc(F.col(ts), "MM").alias("month")).agg(
        F.max_by("close", ts).alias("close")
    )


def attach_monthly(candles: DataFrame, monthly: DataFrame, ts: str) -> DataFrame:
    """Bring the close of the previous month with bars to each bar: lag on the monthly
    frame, then an equi join keyed by symbol and month."""
    by_month = Window.partitionBy("symbol").orderBy("month")
    shifted = monthly.select(
        "symbol",
        "month",
        F.lag("month", 1).over(by_month).alias("prev_month"),
        F.lag("close", 1).over(by_month).alias("prev_close"),
    )
    return candles.withColumn("month", F.trunc(F.col(ts), "MM")).join(
        shifted, ["symbol", "month"], "left"
    )
