"""Which symbols and rows an incremental run has to touch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def state_lag(state: DataFrame, cutoff: str) -> DataFrame:
    """Symbols at or before a cut-off date, and all symbols, per period."""
    behind = F.col("last_date") <= F.lit(cutoff).cast("date")
    return state.groupBy("period").agg(
        F.count(F.when(behind, 1)).alias("pending"), F.count(F.lit(1)).alias("symbols")
    )


def pending_symbols(state: DataFrame, cutoff: str) -> DataFrame:
    return state.where(F.col("last_date") <= F.lit(cutoff).cast("date"))


def incremental_join(bars: DataFrame, state: DataFrame, ts: str) -> DataFrame:
    """Rows newer than their symbol's state, and all rows of symbols without state."""
    last = state.select("symbol", "last_date")
    return (
        bars.join(last, "symbol", "left")
        .where(F.col("last_date").isNull() | (F.col(ts) > F.col("last_date")))
        .drop("last_date")
    )


def versioned_recompute(newest: DataFrame, state: DataFrame, version: str) -> DataFrame:
    """Symbols to recompute, with the reason: no state, other logic version, new bars.
    ``newest`` holds (symbol, newest) from the source table."""
    return (
        newest.join(state.select("symbol", "last_date", "logic_version"), "symbol", "left")
        .withColumn(
            "reason",
            F.when(F.col("last_date").isNull(), "new symbol")
            .when(~F.col("logic_version").eqNullSafe(F.lit(version)), "logic version")
            .when(F.col("newest") > F.col("last_date"), "new bars"),
        )
        .where(F.col("reason").isNotNull())
    )


def new_weeks_only(source: DataFrame, target: DataFrame, force: bool = False) -> DataFrame:
    """Rows of weeks after the newest week of the target; all if forced or empty."""
    if force:
        return source
    done = target.select(F.max("week_start").alias("m")).scalar()
    return source.where(done.isNull() | (F.col("week_start") > done))


def universe_semi_join(df: DataFrame, universe: DataFrame) -> DataFrame:
    """Restrict to index members."""
    return df.join(universe.where(F.col("in_index") == 1), "symbol", "left_semi")
