"""Stored tables: layout, upsert of landed bars, state, exports.

Tables are files of one format (Parquet by default) under one root.  Bar tables are
partitioned by year and by a symbol bucket.  A day's bars touch the slices of one year, a
recompute touches all years of the buckets of its symbols; only touched slices are rewritten.

The bucket count and the schema of a bar table are noted inside its folder before its first file,
so every reader uses the count the table was written with, and a table and its note can only move
together.  Tables are replaced by writing a new folder and renaming it into place; a reader that
finds a half-done replacement finishes it."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from math import gcd

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from barwright.operators.quality import table_inventory
from barwright.session import shuffles_go
from barwright.sources.candles import BARS_PER_TASK, TIME_COLUMN, select_candles

STATE_SCHEMA = "period string, symbol string, last_date date, logic_version string"
DIRTY_SCHEMA = "stage string, symbol string, since date, batch bigint"
WHOLE_HISTORY = "0001-01-01"
SLICES = ["year", "bucket"]
BARS_PER_PASS = 4_000_000


def flatten(df: DataFrame) -> DataFrame:
    """Expand struct columns to their fields and lower-case all names."""
    columns: list[Column] = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct":
            columns += [F.col(f"`{f.name}`.`{n}`").alias(n.lower()) for n in f.dataType.names]
        else:
            columns.append(F.col(f"`{f.name}`").alias(f.name.lower()))
    return df.select(*columns)


def newest_record(
    df: DataFrame, keys: list[str], arrival: str = "arrival", keep_arrival: bool = False
) -> DataFrame:
    """One record per key, the last to arrive (of equal arrivals the largest record).  An
    aggregate, so copies are combined before the exchange, however many a single key has."""
    rest = [c for c in df.columns if c not in (*keys, arrival)]
    out = df.groupBy(*keys).agg(F.max(F.struct(arrival, *rest)).alias("r")).select(*keys, "r.*")
    return out if keep_arrival else out.drop(arrival)


def time_column(columns: Iterable[str]) -> str:
    return "week_start" if "week_start" in columns else "date"


@dataclass(frozen=True)
class Store:
    """``buckets`` is the count for tables that this store creates; an existing table keeps
    its own until ``relayout``."""

    spark: SparkSession
    root: str
    buckets: int = 32
    fmt: str = "parquet"
    _temporary: list[str] = field(default_factory=list, compare=False, repr=False)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # --- files ----------------------------------------------------------------

    def _files(self, path: str):
        """The file system of a path, and the path as its own kind of object."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _delete(self, path: str) -> None:
        fs, p = self._files(path)
        fs.delete(p, True)

    def _complete(self, path: str) -> bool:
        fs, p = self._files(f"{path}/_SUCCESS")
        return fs.exists(p)

    def _rename(self, old: str, new: str) -> None:
        fs, p = self._files(old)
        if not fs.rename(p, self._files(new)[1]):
            raise OSError(f"cannot rename {old} to {new}")

    def _recover(self, table: str) -> None:
        """Finish a replacement that stopped between its renames."""
        path = self.path(table)
        fs, p = self._files(path)
        if fs.exists(p):
            return
        if self._complete(f"{path}.next"):
            self._rename(f"{path}.next", path)
        elif fs.exists(self._files(f"{path}.old")[1]):  # a whole table that was moved away
            self._rename(f"{path}.old", path)

    def exists(self, table: str) -> bool:
        """Whether there is such a table.  Errors other than a missing path are raised."""
        self._recover(table)
        try:
            self._load(table)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    # --- layout ---------------------------------------------------------------

    def _note(self, table: str) -> str:
        return f"{self.path(table)}/_layout/note"

    def _layout(self, table: str) -> tuple[int, StructType | None]:
        """Bucket count and schema of a bar table.  Without a note there is no bar table yet, and the
        store's own count holds; bar files without a note are refused, as any count would be a guess."""
        try:
            row = self.spark.read.schema("buckets int, columns string").json(self._note(table)).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            row = None
        if row is None:
            fs, path = self._files(self.path(table))
            if fs.exists(path) and any(f.getPath().getName().startswith("year=") for f in fs.listStatus(path)):
                raise ValueError(f"{self.path(table)} holds bars but no note of its bucket count")
            return self.buckets, None
        return row["buckets"], StructType.fromJson(json.loads(row["columns"]))

    def _note_layout(self, table: str, buckets: int, schema: StructType) -> None:
        if self._layout(table) != (buckets, schema):
            row = self.spark.createDataFrame([(buckets, schema.json())], "buckets int, columns string")
            row.coalesce(1).write.mode("overwrite").json(f"{self._note(table)}.next")
            self._delete(self._note(table))
            self._rename(f"{self._note(table)}.next", self._note(table))

    def _load(self, table: str) -> DataFrame:
        """All columns, slice columns and arrival included."""
        schema = self._layout(table)[1]
        reader = self.spark.read.format(self.fmt)
        return (reader.schema(schema) if schema is not None else reader).load(self.path(table))

    def read(self, table: str) -> DataFrame:
        self._recover(table)
        return self._load(table).drop(*SLICES, "arrival")

    def bucket(self, symbol: Column | str = "symbol", buckets: int | None = None) -> Column:
        return F.pmod(F.hash(symbol), F.lit(buckets or self.buckets))

    def candles(
        self,
        table: str,
        symbols: list[str] | None = None,
        start: str | None = None,
        end: str | None = None,
    ) -> DataFrame:
        """Filtered read of a bar table.  A symbol list prunes the bucket folders and a date
        range the year folders; within a file rows are sorted by symbol, so it skips row
        groups as well."""
        buckets, _ = self._layout(table)
        df = self._load(table)
        if symbols is not None:
            df = df.where(F.col("bucket").isin(*[self.bucket(F.lit(s), buckets) for s in symbols]))
        for day, compare in ((start, "__ge__"), (end, "__le__")):
            if day is not None:
                df = df.where(getattr(F.col("year"), compare)(F.year(F.lit(day).cast("date"))))
        period = "weekly" if "weekly" in table else "daily"
        return select_candles(df, period, symbols, start, end).drop(*SLICES, "arrival")

    # --- writing --------------------------------------------------------------

    def _writer(self, df: DataFrame) -> DataFrameWriter:
        """Prices and indicators are doubles of many digits, which take much less room with zstd than
        with Spark's default."""
        writer = df.write.format(self.fmt)
        return writer.option("compression", "zstd") if self.fmt == "parquet" else writer

    def overwrite(self, df: DataFrame, table: str) -> None:
        """Replace a small unpartitioned table; df may read the old one.  There is a whole
        table under one of its names at every moment."""
        self._recover(table)
        path = self.path(table)
        self._delete(f"{path}.next")
        with shuffles_go(self.spark):
            self._writer(df).save(f"{path}.next")
        self._delete(f"{path}.old")
        fs, p = self._files(path)
        if fs.exists(p):
            self._rename(path, f"{path}.old")
        self._rename(f"{path}.next", path)
        self._delete(f"{path}.old")
        self.spark.catalog.refreshByPath(path)

    def write_bars(
        self, df: DataFrame, table: str, scope: DataFrame | None = None, source: DataFrame | None = None, dealt: bool = False
    ) -> None:
        """Replace exactly the slices (year, bucket) that occur in df, and empty those of
        ``scope`` (rows of slices) that do not.  ``source`` are symbols and times that df was computed
        from, at least one for each of its rows and none besides: their slices are known without computing
        df twice.  Rebalancing lets Spark size the files: small slices share a task, large ones are split.
        Rows that are ``dealt`` (``by_bucket``) are written by the tasks that computed them, without an
        exchange of whole rows."""
        buckets, known = self._layout(table)
        ts = time_column(df.columns)
        laid_out = df.withColumns({"year": F.year(ts), "bucket": self.bucket(buckets=buckets)})
        gone = []
        if scope is not None:
            # One row per slice: years times buckets at most.
            bars = df if source is None else source
            present = bars.select(F.year(ts).alias("year"), self.bucket(buckets=buckets).alias("bucket")).distinct()
            gone = scope.select(*SLICES).distinct().join(present, SLICES, "left_anti").collect()
        schema = StructType([f for f in laid_out.schema.fields if f.name not in SLICES])
        for f in known.fields if known is not None else []:
            if f.name not in schema.names and f.name not in SLICES:
                schema = schema.add(f)
        self._note_layout(table, buckets, schema.add("year", IntegerType()).add("bucket", IntegerType()))
        rows = laid_out if dealt else laid_out.hint("rebalance", *SLICES)
        writer = self._writer(rows.sortWithinPartitions(*SLICES, "symbol", ts)).mode("overwrite")
        with shuffles_go(self.spark):
            writer.option("partitionOverwriteMode", "dynamic").partitionBy(*SLICES).save(self.path(table))
        for r in gone:
            self._delete(f"{self.path(table)}/year={r['year']}/bucket={r['bucket']}")
        self.spark.catalog.refreshByPath(self.path(table))

    def replace_slices(self, df: DataFrame, table: str, scope: DataFrame | None = None) -> None:
        """``write_bars`` for rows that are read from the table itself: slices are replaced when all rows
        of df have been written beside them, so the rows need no copy before that."""
        self.write_bars(df, table, scope)

    def passes(self, table: str, symbols: DataFrame, source: str, per_symbol: int | None = None, wide: int = 1) -> list[list[int]]:
        """Buckets of a table that hold one of the symbols, in groups whose bars of ``source`` (or
        ``per_symbol`` of each of the symbols) are some ``BARS_PER_PASS`` or, on many cores, enough for all of
        them; ``wide`` times as many for a job whose passes take long to start.  A job that rewrites one group after the other keeps the shuffled rows and the replaced files of
        one group on disk, not of all."""
        buckets, _ = self._layout(table)
        touched = sorted(r["bucket"] for r in symbols.select(self.bucket(buckets=buckets).alias("bucket")).distinct().collect())
        bars = self.of_buckets(source, touched, buckets).count() if per_symbol is None else symbols.count() * per_symbol
        most = max(BARS_PER_PASS, 4 * BARS_PER_TASK * self.spark.sparkContext.defaultParallelism)
        n = max(1, min(len(touched), -(-bars // (wide * most))))
        return [touched[i * len(touched) // n : (i + 1) * len(touched) // n] for i in range(n)]

    def of_buckets(self, table: str, held: list[int], buckets: int) -> DataFrame:
        """Stored rows, slice columns included, of symbols in some of ``buckets`` buckets.  Where the table has
        as many itself, only their folders are opened."""
        own = F.col("bucket") if self._layout(table)[0] == buckets else self.bucket(buckets=buckets)
        return self._load(table).where(own.isin(*held) if held else F.lit(False))

    def by_bucket(self, bars: DataFrame, buckets: int, held: int) -> tuple[DataFrame, bool]:
        """Bars of ``held`` buckets dealt by symbol into parts of ``BARS_PER_TASK`` rows at most, and whether
        a part has symbols of so few buckets that its task can write a file for each.  Spark deals by the hash that
        buckets are made of: if the number of parts is a multiple of theirs, a part has one bucket; if
        only some buckets are there and the numbers have no divisor in common, no part is left empty."""
        rows = bars.count()
        parts = max(1, -(-rows // max(50_000, min(BARS_PER_TASK, rows // self.spark.sparkContext.defaultParallelism))))
        if held == buckets and parts > 1:
            parts = buckets * -(-parts // buckets)
        while held < buckets and gcd(parts, buckets) > 1:
            parts += 1
        return bars.repartition(parts, "symbol"), held in (1, 2, 3, 4, buckets)

    def relayout(self, table: str, buckets: int) -> None:
        """Rewrite a bar table with another bucket count.  The new table is complete, note included,
        before the old one moves away, so a stop at any moment leaves one that reads all rows."""
        self._recover(table)
        following = f"{table}.next"
        self._delete(self.path(following))
        Store(self.spark, self.root, buckets, self.fmt).write_bars(self._load(table).drop(*SLICES), following)
        fs, done = self._files(f"{self.path(following)}/_SUCCESS")  # overwriting slices leaves no such file
        fs.create(done, True).close()
        self._delete(f"{self.path(table)}.old")
        self._rename(self.path(table), f"{self.path(table)}.old")
        self._rename(self.path(following), self.path(table))
        self._delete(f"{self.path(table)}.old")
        self.spark.catalog.refreshByPath(self.path(table))

    def same_buckets(self, table: str, symbols: DataFrame) -> DataFrame:
        """Stored rows, slice columns included, of every bucket that holds one of the symbols.
        The list of buckets has at most ``buckets`` rows, so broadcasting it is safe, and it
        prunes the partition folders."""
        buckets, _ = self._layout(table)
        touched = symbols.select(self.bucket(buckets=buckets).alias("bucket")).distinct()
        return self._load(table).join(F.broadcast(touched), "bucket", "left_semi")

    def same_slices(self, table: str, bars: DataFrame) -> DataFrame:
        """Stored rows of the slices that the given bars fall into; the list has at most one
        row per year and bucket."""
        buckets, _ = self._layout(table)
        touched = bars.select(F.year(time_column(bars.columns)).alias("year"), self.bucket(buckets=buckets).alias("bucket")).distinct()
        return self._load(table).join(F.broadcast(touched), SLICES, "left_semi")

    def slices_of(self, table: str, bars: DataFrame) -> DataFrame:
        """Like ``same_slices``, and bars without time count as well.  The slices are listed first, at most one
        per year and bucket, so folders of other ones are never opened."""
        buckets, _ = self._layout(table)
        touched = bars.select(F.year(time_column(bars.columns)).alias("year"), self.bucket(buckets=buckets).alias("bucket"))
        years = touched.distinct().groupBy("year").agg(F.collect_list("bucket").alias("held")).collect()
        wanted = F.lit(False)
        for r in years:
            wanted = wanted | (F.col("year").eqNullSafe(F.lit(r["year"])) & F.col("bucket").isin(*r["held"]))
        return self._load(table).where(wanted)

    def staged(self, df: DataFrame) -> DataFrame:
        place = f"{self.root}/_staging/{uuid.uuid4().hex}"
        self._temporary.append(place)
        with shuffles_go(self.spark):
            self._writer(df).save(place)
        return self.spark.read.format(self.fmt).schema(df.schema).load(place)

    def clean(self, kept: int = 0) -> None:
        """Remove what this store staged, but for the first ``kept`` frames.  Jobs call it after the state is
        written."""
        while len(self._temporary) > kept:
            self._delete(self._temporary.pop())

    # --- state --------------------------------------------------------------

    def read_state(self, period: str | None = None) -> DataFrame:
        """Last processed date per period and symbol; empty while there is no state table."""
        if not self.exists("state"):
            return self.spark.createDataFrame([], STATE_SCHEMA)
        state = self.read("state")
        return state if period is None else state.where(F.col("period") == period)

    def write_state(self, fresh: DataFrame, done: DataFrame | None = None) -> None:
        """Upsert by (period, symbol).  ``done`` (period, symbol) names rows that go where
        ``fresh`` has none for them."""
        fresh = fresh.select("period", "symbol", "last_date", "logic_version")
        old = fresh.select("period", "symbol")
        old = old if done is None else old.unionByName(done.select("period", "symbol")).distinct()
        kept = self.read_state().join(old, ["period", "symbol"], "left_anti")
        self.overwrite(kept.unionByName(fresh), "state")

    def read_dirty(self, stage: str | None = None) -> DataFrame:
        """Symbols whose input of a stage has changed since it ran, the first day that did, and
        the number of the batch that marked them last."""
        if not self.exists("dirty"):
            return self.spark.createDataFrame([], DIRTY_SCHEMA)
        dirty = self.read("dirty")
        return dirty if stage is None else dirty.where(F.col("stage") == stage)

    def newest_mark(self) -> int:
        """The number of the last batch of marks.  A stage asks for it before it reads its input
        and clears marks up to it only, so what is marked meanwhile stays marked."""
        return self.read_dirty().agg(F.max("batch")).first()[0] or 0

    def mark_dirty(self, symbols: DataFrame, *stages: str) -> None:
        """Mark symbols for stages, from the day in ``since`` on if there is that column, else
        for their whole history."""
        since = F.col("since") if "since" in symbols.columns else F.lit(WHOLE_HISTORY).cast("date")
        marks = symbols.select(
            F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage"), "symbol", since.alias("since"),
            F.lit(self.newest_mark() + 1).cast("bigint").alias("batch"),
        )
        both = self.read_dirty().unionByName(marks).groupBy("stage", "symbol")
        self.overwrite(both.agg(F.min("since").alias("since"), F.max("batch").alias("batch")), "dirty")

    def clear_dirty(self, symbols: DataFrame, stage: str, upto: int) -> None:
        """Drop a stage's marks of symbols that were set by batches up to one."""
        done = symbols.select(F.lit(stage).alias("stage"), "symbol", F.lit(True).alias("__done"))
        left = self.read_dirty().join(done, ["stage", "symbol"], "left")
        self.overwrite(left.where(F.col("__done").isNull() | (F.col("batch") > upto)).drop("__done"), "dirty")

    # --- ingest -------------------------------------------------------------

    def was_applied(self, source: str, batch: int) -> bool:
        """Whether a batch of a source is in the ledger of applied batches."""
        if not self.exists("ledger"):
            return False
        return not self.read("ledger").where((F.col("source") == source) & (F.col("batch") >= batch)).isEmpty()

    def _apply(self, source: str, batch: int) -> None:
        """Batches of a source come in order, so the ledger keeps the last one of each."""
        row = self.spark.createDataFrame([(source, batch)], "source string, batch bigint")
        if self.exists("ledger"):
            row = self.read("ledger").where(F.col("source") != source).unionByName(row)
        self.overwrite(row, "ledger")

    def ingest_bars(self, landing: DataFrame, table: str = "daily", batch: tuple[str, int] | None = None) -> None:
        """Upsert landed bars: flatten, keep the newest record per (symbol, time) of landed and
        stored ones.  The arrival is stored with a bar, so a late copy of an older record
        changes nothing; a stored bar without arrival is older than any other.  Only slices
        of the landed times are read and written.  Symbols whose stored bars come out different
        are marked for the stages that read the table, from the first such day on.

        ``batch`` names the source and number of a batch: one that was applied before is passed
        over.  The ledger is written last, so a batch that stopped half way is applied again."""
        if batch is not None and self.was_applied(*batch):
            return
        ts = TIME_COLUMN["weekly" if "weekly" in table else "daily"]
        if self.exists(table):
            rows, changed = self._merged(self.staged(flatten(landing)), table, ts)
        else:
            rows = self.staged(newest_record(flatten(landing), ["symbol", ts], keep_arrival=True))
            changed = rows.select("symbol", ts)
        if not changed.isEmpty():
            if table == "daily":  # marked first: a stop before the bars are written costs a recompute, not a change
                since = changed.groupBy("symbol").agg(F.min(ts).alias("since"))
                self.mark_dirty(since, "daily", "weekly_indicators", "weekly_rolled")
            self.write_bars(rows, table)
        if batch is not None:
            self._apply(*batch)
        self.clean()

    def _merged(self, fresh: DataFrame, table: str, ts: str) -> tuple[DataFrame, DataFrame]:
        """Staged rows of the slices that landed bars fall into, the newest record per (symbol, time), and
        those (symbol, time) whose values are not those of the newest stored record.  Landed and stored
        rows meet in one exchange, which finds both."""
        stored = self.same_slices(table, fresh).drop(*SLICES)
        if "arrival" not in stored.columns:
            stored = stored.withColumn("arrival", F.lit(None).cast(fresh.schema["arrival"].dataType))
        mine = stored.withColumn("__stored", F.lit(True))
        both = mine.unionByName(fresh.withColumn("__stored", F.lit(False)), allowMissingColumns=True)
        rest = [c for c in both.columns if c not in ("symbol", ts, "arrival", "__stored")]
        record = F.struct("arrival", *rest)
        newest = both.groupBy("symbol", ts).agg(
            F.max(record).alias("r"), F.max(F.when(F.col("__stored"), record)).alias("was")
        )
        same = F.col("was").isNotNull()
        for c in rest:
            same = same & F.col("r")[c].eqNullSafe(F.col("was")[c])
        rows = self.staged(newest.select("symbol", ts, "r.*", (~same).alias("__changed")))
        return rows.drop("__changed"), rows.where("__changed").select("symbol", ts)

    def sync_sectors(self, landing: DataFrame) -> None:
        """Refresh sectors from a bulk file; a symbol the file lacks, or lists without a
        sector, stays in the table."""
        fresh = newest_record(flatten(landing), ["symbol"]).select(
            "symbol", F.col("sector").alias("new_sector")
        )
        if not self.exists("universe"):
            self.overwrite(fresh.withColumnRenamed("new_sector", "sector"), "universe")
            return
        merged = self.read("universe").join(fresh, "symbol", "full")
        self.overwrite(
            merged.withColumn("sector", F.coalesce("new_sector", "sector")).drop("new_sector"),
            "universe",
        )

    # --- inventory and export -------------------------------------------------

    def inventory(self, tables: list[str], symbol: str | None = None) -> DataFrame:
        """Inventory of stored tables, one row each.  A table that cannot be opened or counted
        is reported as such, and the others still are."""
        schema = (
            "tbl string, total_rows bigint, latest_day date, latest_close double, status string"
        )
        rows = []
        for name in tables:
            try:
                found = table_inventory({name: self.read(name)}, symbol).select(*[f.split()[0] for f in schema.split(", ")])
                rows += [tuple(r) for r in found.collect()]
            except (PySparkException, Py4JError):
                rows.append((name, None, None, None, "not readable"))
        return self.spark.createDataFrame(rows, schema)


def export_trades(trade_list: DataFrame, path: str, fmt: str = "csv") -> None:
    """Trade lists per capacity level (column ``cap``), one folder each."""
    writer = trade_list.write.mode("overwrite").partitionBy("cap")
    writer.option("header", True).format(fmt).save(path)


def market_caps_due(
    universe: DataFrame, as_of: str, days: int = 30, force: bool = False
) -> DataFrame:
    """Symbols whose market capitalisation is missing or older than the given days."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col("cap_fetched_at"))
    due = F.lit(True) if force else age.isNull() | F.col("market_cap").isNull() | (age > days)
    return universe.where(due).select("symbol", "market_cap", "cap_fetched_at", age.alias("age_days"))


def state_of(df: DataFrame, period: str, version: str) -> DataFrame:
    return df.groupBy("symbol").agg(F.max(TIME_COLUMN[period]).alias("last_date")).select(
        F.lit(period).alias("period"), "symbol", "last_date", F.lit(version).alias("logic_version")
    )


def register(frames: Mapping[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
