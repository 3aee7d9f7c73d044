"""Stored tables and incremental runs."""

import datetime as dt

from pyspark.sql import functions as F

from barwright.operators.signals import SIGNAL_VERSION
from barwright.plans import jobs
from barwright.session import new_workspace
from barwright.sources.tables import Store
from checks.registry import Inputs


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


def test_incremental_equals_force_and_second_run_does_nothing(spark, sf_dir):
    daily = Inputs(spark, sf_dir).daily().withColumn("arrival", F.lit(1))
    store = Store(spark, new_workspace(spark), buckets=3)
    store.ingest_bars(daily.where("date < date'2000-01-01'"))
    assert jobs.run_weekly(store)
    before = store.read("weekly").count()
    # new bars for some symbols only
    store.ingest_bars(daily.where("date >= date'2000-01-01' and symbol < 'SYM00004'"))
    assert jobs.run_weekly(store)
    assert store.read("weekly").count() > before
    assert not jobs.run_weekly(store)
    forced = Store(spark, new_workspace(spark), buckets=5)
    forced.ingest_bars(store.read("daily").withColumn("arrival", F.lit(1)))
    assert jobs.run_weekly(forced, force=True)
    assert rows(store.read("weekly")) == rows(forced.read("weekly"))
    assert rows(store.read("weekly_snapshot")) == rows(forced.read("weekly_snapshot"))
    versions = {r["logic_version"] for r in store.read_state("weekly").collect()}
    assert versions == {SIGNAL_VERSION}


def test_ingest_is_idempotent_and_takes_the_newest_record(spark):
    store = Store(spark, new_workspace(spark), buckets=2)
    day = dt.date(2020, 1, 6)
    landing = spark.createDataFrame(
        [("A", day, (1.0, 2.0), 1), ("A", day, (3.0, 4.0), 2), ("B", day, (5.0, 6.0), 1)],
        "symbol string, date date, px struct<Open:double,Close:double>, arrival int",
    )
    for _ in range(2):
        store.ingest_bars(landing)
        assert rows(store.read("daily")) == [("4.0", "2020-01-06", "3.0", "A"), ("6.0", "2020-01-06", "5.0", "B")]


def test_missing_state_is_empty(spark):
    assert Store(spark, new_workspace(spark)).read_state().count() == 0


def test_symbol_list_prunes_buckets_and_is_pushed_down(spark, sf_dir):
    store = Store(spark, new_workspace(spark), buckets=8)
    store.write_bars(Inputs(spark, sf_dir).daily(), "daily")
    df = store.candles("daily", ["SYM00001"], "1998-01-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert "EqualTo(symbol,SYM00001)" in plan and "GreaterThanOrEqual(date,1998-01-01)" in plan
    assert 0 < df.count() < store.read("daily").where("symbol = 'SYM00001'").count()


BAR = "symbol string, date date, open double, high double, low double, close double, volume double"


def day(i):
    return dt.date(1990, 1, 1) + dt.timedelta(days=i)


def bars(spark, n, symbols="AB", first=0, arrival=1, close=100.0):
    table = [(s, day(i), close, close + 1, close - 1, close + i % 7, 10.0) for s in symbols for i in range(first, first + n)]
    return spark.createDataFrame(table, BAR).withColumn("arrival", F.lit(arrival))


def files_of(store, table):
    return {f for f in store.spark.read.parquet(store.path(table)).inputFiles()}


def test_a_table_keeps_its_bucket_count(spark):
    root = new_workspace(spark)
    Store(spark, root, buckets=4).ingest_bars(bars(spark, 20, "ABCDEFG"))
    other = Store(spark, root, buckets=8)
    assert all(other.candles("daily", [s]).count() == 20 for s in "ABCDEFG")
    other.ingest_bars(bars(spark, 3, "ABCDEFG", arrival=2))
    assert other.read("daily").count() == 140
    other.relayout("daily", 8)
    assert Store(spark, root, buckets=2).candles("daily", ["C"], "1990-01-03", "1990-01-05").count() == 3
    assert other.read("daily").select("symbol", "date").distinct().count() == 140
    assert {r["bucket"] for r in other._load("daily").select("bucket").distinct().collect()} - {0, 1, 2, 3}


def test_one_day_leaves_other_years_alone(spark):
    store = Store(spark, new_workspace(spark), buckets=2)
    store.ingest_bars(bars(spark, 800))
    old = {f for f in files_of(store, "daily") if "year=1990" in f or "year=1991" in f}
    store.ingest_bars(bars(spark, 1, first=800))
    now = files_of(store, "daily")
    assert len(old) > 1 and old <= now and store.read("daily").count() == 1602


def test_late_older_copy_changes_nothing(spark):
    store = Store(spark, new_workspace(spark), buckets=2)
    store.ingest_bars(bars(spark, 5, arrival=2))
    store.ingest_bars(bars(spark, 5, arrival=1, close=-1.0))
    assert store.read("daily").agg(F.min("open")).first()[0] == 100.0
    store.ingest_bars(bars(spark, 5, arrival=3, close=50.0))
    assert store.read("daily").agg(F.max("open")).first()[0] == 50.0


def same_as_forced(spark, store):
    forced = Store(spark, new_workspace(spark), buckets=3)
    forced.ingest_bars(store.read("daily").withColumn("arrival", F.lit(1)))
    jobs.run_full(forced, force=True)
    return all(rows(store.read(t)) == rows(forced.read(t)) for t in ("daily_indicators", "weekly", "weekly_snapshot"))


def test_signals_alone_lose_no_update(spark):
    store = Store(spark, new_workspace(spark), buckets=2)
    assert jobs.run_full(store, bars(spark, 40))
    assert not jobs.run_full(store)
    store.ingest_bars(bars(spark, 40, first=40))
    assert not jobs.run_signals(store)
    assert jobs.run_full(store)
    assert same_as_forced(spark, store)
    # a correction of an old bar is an update as well
    assert jobs.run_full(store, bars(spark, 1, "A", first=3, arrival=5, close=70.0))
    assert same_as_forced(spark, store) and not jobs.run_full(store)


def test_repair_of_the_newest_bars_and_of_all_bars(spark):
    store = Store(spark, new_workspace(spark), buckets=2)
    jobs.run_full(store, bars(spark, 60, "ABC"))
    jobs.run_repair(store, store.read("daily").where("symbol = 'A' and date >= date'1990-02-19' or symbol = 'C'"))
    assert store.read("daily").groupBy("symbol").agg(F.max("date")).orderBy("symbol").collect()[0][1] == day(48)
    assert jobs.run_full(store)
    assert {r["symbol"] for r in store.read("weekly_snapshot").collect()} == {"A", "B"}
    assert {r["symbol"] for r in store.read_state().collect()} == {"A", "B"}
    assert same_as_forced(spark, store)
    jobs.run_repair(store, store.read("daily"))
    assert store.read("daily").count() == 0 and jobs.run_full(store)
    assert store.read("weekly").count() == store.read_state().count() == 0


def test_repair_all_from_a_date(spark):
    store = Store(spark, new_workspace(spark), buckets=2)
    jobs.run_full(store, bars(spark, 420))
    jobs.run_repair_all(store, "1990-12-01")
    assert store.read("weekly").agg(F.max("week_start")).first()[0] == dt.date(1990, 11, 26)
    assert same_as_forced(spark, store)


def test_a_damaged_table_does_not_stop_the_inventory(spark, tmp_path):
    store = Store(spark, new_workspace(spark))
    store.write_bars(bars(spark, 3), "daily")
    store.overwrite(spark.range(5), "bad")
    store.overwrite(spark.range(4), "worse")
    for name, broken in (("bad", None), ("worse", b"no table")):
        fs, folder = store._files(store.path(name))
        for status in fs.listStatus(folder):
            if status.getPath().getName().startswith("part"):
                out = fs.create(status.getPath(), True)
                out.write(bytearray(broken or b""))
                out.close()
    got = {r["tbl"]: (r["total_rows"], r["status"]) for r in store.inventory(["bad", "daily", "none", "worse"]).collect()}
    assert got["daily"] == (6, "found") and got["none"] == (None, "not readable") and got["worse"] == (None, "not readable")


def test_a_half_done_replacement_is_finished(spark):
    store = Store(spark, new_workspace(spark))
    store.overwrite(spark.range(3), "small")
    store._rename(store.path("small"), store.path("small.old"))
    assert store.exists("small") and store.read("small").count() == 3
    spark.range(4).write.parquet(store.path("small.next"))
    store._rename(store.path("small"), store.path("small.old"))
    assert store.read("small").count() == 4 and not store.exists("other")


def test_a_load_stages_landed_and_merged_rows_once(spark, monkeypatch):
    """Landed and stored bars meet in one pass, which also finds what has changed."""
    store = Store(spark, new_workspace(spark), buckets=2)
    schema = "symbol string, date date, close double, arrival int"
    days = [dt.date(2020, 1, d) for d in (6, 7, 8)]
    store.ingest_bars(spark.createDataFrame([("A", d, 1.0, 2) for d in days] + [("B", days[0], None, 2)], schema))
    store.clear_dirty(store.read("daily").select("symbol").distinct(), "weekly_rolled", store.newest_mark())
    staged = []
    once = Store.staged
    monkeypatch.setattr(Store, "staged", lambda self, df: staged.append(df.columns) or once(self, df))
    landing = [("A", days[0], 9.0, 1), ("A", days[1], 5.0, 3), ("A", days[2], 1.0, 3), ("A", days[2], 8.0, 0), ("B", days[0], None, 4), ("C", days[0], 7.0, 1)]
    store.ingest_bars(spark.createDataFrame(landing, schema))
    assert len(staged) == 2
    assert rows(store.read("daily")) == [
        ("1.0", "2020-01-06", "A"), ("1.0", "2020-01-08", "A"), ("5.0", "2020-01-07", "A"), ("7.0", "2020-01-06", "C"), ("None", "2020-01-06", "B")
    ]
    marks = {(r["symbol"], r["since"]) for r in store.read_dirty("weekly_rolled").collect()}
    assert marks == {("A", days[1]), ("C", days[0])}


def test_snapshot_reads_whole_rows_of_few_slices_only(spark):
    """The newest bar of a symbol that ended early or has no week is found as well."""
    store = Store(spark, new_workspace(spark), buckets=2)
    weeks = [dt.date(y, 3, 1) - dt.timedelta(days=dt.date(y, 3, 1).weekday()) for y in range(1990, 2002)]
    bars = [(s, w, float(i)) for s in "ABCDEF" for i, w in enumerate(weeks)]
    bars += [("GONE", weeks[4], 7.0), ("NEVER", None, 8.0), (None, weeks[2], 9.0)]
    store.write_bars(spark.createDataFrame(bars, "symbol string, week_start date, close double"), "weekly")
    whole = jobs.newest_slices(store, "weekly")
    assert {r[0] for r in whole.select(F.year("week_start")).distinct().collect()} == {1994, 1992, 2001, None}
    assert jobs.write_snapshot(store) == 9
    assert rows(store.read("weekly_snapshot")) == rows(jobs.build_snapshot(store.read("weekly")))
