"""Session settings for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: str | int = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session.  The window chains compile many small classes; the codegen cache
    must hold them all or every run compiles anew.  The same static setting is worth
    giving to executors of a cluster."""
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("barwright")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "4000")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir`` (or that was given to
    ``setCheckpointDir``): all executors reach it.  There is no other default."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not known.isDefined():
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder all executors reach")
        spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def new_workspace(spark: SparkSession) -> str:
    """A fresh folder name below the shared one."""
    return os.path.join(shared_folder(spark), f"work-{uuid.uuid4().hex[:12]}")


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What a query inside has shuffled leaves the disks when the query ends, not whenever the driver
    happens to collect its garbage.  For writes: nothing reads their exchanges again."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def settled(df: DataFrame) -> DataFrame:
    """Cut the lineage through the reliable checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
