"""What jobs leave on disk while they run: passes over buckets, no exchange of whole rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barwright.functions.numeric import round_doubles
from barwright.plans import jobs, rolling
from barwright.session import new_workspace
from barwright.sources import tables
from barwright.sources.tables import Store


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


def shuffled(spark) -> int:
    """Shuffle files on this machine."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle") for i in range(files.size()))


def bars(spark, symbols: int = 12, days: int = 400):
    start = dt.date(2019, 3, 4)
    made = [
        (f"S{s}", start + dt.timedelta(days=d), p - 0.5, p + 1.0, p - 1.0, p, 100.0 + d)
        for s in range(symbols)
        for d in range(days)
        for p in [50.0 + (d * (s + 3) % 37) / 4 + d * (s % 3) / 50]
    ]
    schema = "symbol string, date date, open double, high double, low double, close double, volume double"
    return spark.createDataFrame(made, schema).withColumn("arrival", F.lit(1))


@pytest.fixture
def small_passes(monkeypatch):
    """One bucket at a time."""
    monkeypatch.setattr(tables, "BARS_PER_PASS", 1)
    monkeypatch.setattr(tables, "BARS_PER_TASK", 1)


@pytest.fixture
def written(monkeypatch):
    """The calls of ``write_bars``: table, whether rows are dealt, and the buckets they hold."""
    calls, write = [], Store.write_bars

    def noted(self, df, table, scope=None, source=None, dealt=False):
        bucket = self.bucket(buckets=self._layout(table)[0]).alias("bucket")
        calls.append((table, dealt, {r["bucket"] for r in df.select(bucket).distinct().collect()}))
        write(self, df, table, scope, source, dealt)

    monkeypatch.setattr(Store, "write_bars", noted)
    return calls


def test_indicators_in_passes_are_the_same_rows(spark, request):
    def store_after_repair():
        store = Store(spark, new_workspace(spark), buckets=2)
        store.ingest_bars(bars(spark, days=150))
        assert jobs.run_indicators(store)
        jobs.run_repair(store, store.read("daily").where("symbol = 'S5' or date >= date'2019-07-01' and symbol = 'S2'"))
        assert jobs.run_indicators(store)
        return store

    whole = store_after_repair()
    request.getfixturevalue("small_passes")
    calls = request.getfixturevalue("written")
    parts = store_after_repair()
    for table in ("daily", "weekly_indicators", "state"):
        assert rows(whole.read(table)) == rows(parts.read(table))
    computed = [c for c in calls if c[0] == "weekly_indicators"]
    assert len(computed) > 2 and all(dealt and len(held) <= 1 for _, dealt, held in computed)
    assert parts.read("weekly_indicators").where("symbol = 'S5'").isEmpty()


def test_rolled_job_in_passes_gives_the_same_rows(spark, small_passes, written):
    made = bars(spark, symbols=6, days=150)
    right = Store(spark, new_workspace(spark), buckets=1)
    right.ingest_bars(made)
    rolling.run_weekly_from_state(right)
    store = Store(spark, new_workspace(spark), buckets=2)
    wrong = F.col("symbol").isin("S3") & (F.col("date") == F.lit("2019-05-06").cast("date"))
    store.ingest_bars(made.where("date < date'2019-07-01'").withColumns({"close": F.when(wrong, 1.0).otherwise(F.col("close")), "arrival": F.lit(0)}))
    rolling.run_weekly_from_state(store)
    store.ingest_bars(made.where((F.col("date") >= F.lit("2019-07-01").cast("date")) | wrong))
    rolling.run_weekly_from_state(store)
    found, expected = (round_doubles(rolling.read_weekly(s), 6) for s in (store, right))
    assert rows(found) == rows(expected)
    assert rows(store.read(rolling.STATE).select("symbol", "cut")) == rows(right.read(rolling.STATE).select("symbol", "cut"))
    held = [held for table, _, held in written if table == rolling.STAGE][1:]
    assert len(held) == 4 and all(len(h) <= 1 for h in held)


def test_one_pass_writes_one_file_per_slice(spark):
    store = Store(spark, new_workspace(spark), buckets=4)
    store.ingest_bars(bars(spark, days=150))
    jobs.run_indicators(store)
    files = store.read("weekly_indicators").inputFiles()
    assert len(files) == len({f.rpartition("/")[0] for f in files})


def test_other_bucket_counts_keep_all_symbols(spark):
    """Indicators with other buckets than the bars, and only one symbol due."""
    store = Store(spark, new_workspace(spark), buckets=4)
    store.ingest_bars(bars(spark, days=60))
    jobs.run_indicators(store)
    store.relayout("weekly_indicators", 5)
    store.mark_dirty(spark.createDataFrame([("S1",)], "symbol string"), "weekly_indicators")
    assert jobs.run_indicators(store)
    assert store.read("weekly_indicators").select("symbol").distinct().count() == 12


def test_written_rows_leave_no_shuffle_files(spark):
    store = Store(spark, new_workspace(spark), buckets=4)
    spark.sparkContext._jvm.System.gc()
    before = shuffled(spark)
    store.write_bars(bars(spark, days=60).drop("arrival").repartition(3, "symbol"), "daily")
    store.staged(store.read("daily").groupBy("symbol").count())
    store.overwrite(store.read("daily").groupBy("date").count(), "days")
    assert shuffled(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
