"""Registered queries: each runs an operator over the whole given tables, next to the
DuckDB text that must give the same rows."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.functions.numeric import round_doubles
from barwright.operators.screens import load_backtest_snapshot
from barwright.operators.signals import trades
from barwright.operators.windows import PLAIN_WEEKLY
from barwright.plans.stages import weekly_signals
from barwright.sources.candles import (
    daily_from_lineitem,
    resample_weekly,
    universe_from_suppliers,
)
from barwright.sources.tables import Store
from barwright.session import new_workspace

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


@dataclass(frozen=True)
class Inputs:
    """Lazy frames derived from the given tables."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def daily(self) -> DataFrame:
        return daily_from_lineitem(self.table("lineitem"))

    def weekly(self) -> DataFrame:
        return resample_weekly(self.daily())

    def universe(self) -> DataFrame:
        return universe_from_suppliers(
            self.table("supplier"), self.table("nation"), self.table("region")
        )

    def signals(self) -> DataFrame:
        return weekly_signals(self.weekly())

    def trades(self) -> DataFrame:
        return trades(self.signals(), PLAIN_WEEKLY)

    def snapshot(self) -> DataFrame:
        return weekly_signals(self.weekly(), newest_only=True)

    def view(self) -> DataFrame:
        return load_backtest_snapshot(self.snapshot(), self.universe())

    def state(self, period: str = "weekly") -> DataFrame:
        """Newest date per symbol, less zero to two weeks by supplier number."""
        bars, ts = (self.daily(), "date") if period == "daily" else (self.weekly(), "week_start")
        number = F.substring("symbol", 4, 20).cast("bigint")
        return bars.groupBy("symbol").agg(F.max(ts).alias("newest")).select(
            F.lit(period).alias("period"),
            "symbol",
            F.date_sub("newest", (number % 3 * 7).cast("int")).alias("last_date"),
            F.when(number % 5 == 0, "1.2").otherwise("1.3").alias("logic_version"),
        )

    def store(self) -> Store:
        return Store(self.spark, new_workspace(self.spark), buckets=4)

    def settled(self, df: DataFrame) -> DataFrame:
        """A stage table: written to the shared folder and read back."""
        place = new_workspace(self.spark)
        df.write.parquet(place)
        return self.spark.read.parquet(place)


def with_folder(run: Callable[[SparkSession, str], DataFrame]):
    """A single-machine session without ``spark.checkpoint.dir``, as in tests, gets a folder of
    its own; anywhere else the setting is required."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        unset = not spark.conf.get("spark.checkpoint.dir", None) and not context._jsc.sc().getCheckpointDir().isDefined()
        if unset and context.master.startswith("local") and not context.master.startswith("local-cluster"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="barwright-"))
        return run(spark, sf_dir)

    return prepared


def register(name: str, sql: str | None, digits: int | None = 4):
    """Add a query; its double columns are rounded like the columns of the SQL."""

    def wrap(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(Inputs(spark, sf_dir))
            return df if digits is None else round_doubles(df, digits)

        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = (run, sql)
        return build

    return wrap
