"""Shared helpers of the text operators: staged tables, shipping code, byte-level words.

Python parts work on Arrow batches.  A batch is cut into slices of bounded text size, and
each slice is handled with numpy over one byte buffer, so memory does not depend on how
many long documents meet in a batch."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwright.session import new_workspace, shuffles_go

SLICE_BYTES = 2_000_000


# --- tables ---------------------------------------------------------------------


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: a cut of the lineage that
    outlives any executor."""
    place = f"{new_workspace(df.sparkSession)}/{name}"
    with shuffles_go(df.sparkSession):
        df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def drop_staged(df: DataFrame) -> None:
    """Remove the files behind a staged frame that nothing reads any more."""
    spark = df.sparkSession
    paths = {f.rpartition("/")[0] for f in df.inputFiles()}
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, wherever they were started."""
    sc = spark.sparkContext
    if getattr(sc, "_barwright_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "barwright_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._barwright_shipped = True


def chosen_by_hash(df: DataFrame, group: str, limit: int, key: str = "doc_id") -> DataFrame:
    """At most ``limit`` rows of each group, those with the smallest hash of ``key`` (unique
    in a group).  Group sizes come from an aggregate; rows that cannot be among the chosen
    ones are dropped where they are, so about twice the limit is ordered, not the group.  Groups are
    few (labels, languages): their sizes are sent to the rows."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__size"))
    place = F.pmod(F.xxhash64(key), F.lit(1 << 40)) / float(1 << 40)
    near = df.withColumn("__place", place).join(F.broadcast(sizes), group).where(F.col("__place") * F.col("__size") <= 2.0 * limit + 50)
    order = Window.partitionBy(group).orderBy("__place", key)
    return near.withColumn("__i", F.row_number().over(order)).where(F.col("__i") <= limit).select(*df.columns)


# --- slices of Arrow batches ------------------------------------------------------


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about ``size`` bytes of text; a longer text is a
    slice of its own."""
    for batch in batches:
        column = batch.column(text)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        sizes = np.asarray(pc.binary_length(column).fill_null(0))
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > size:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column as one buffer, and the offsets of its rows.  Null
    counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(bounds):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


# --- hashing ------------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            step = np.full(n, base, np.uint64)
            step[0] = 1
            _POWERS[i] = np.cumprod(step)
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte (or code point) span, from one running sum."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.multiply(data, up[: len(data)], out=sums[1:], dtype=np.uint64)
    np.cumsum(sums[1:], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


# --- words ---------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, 9, 10, 11, 12, 13]] = False


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words ``[^\\x20\\x09-\\x0D]+``; words end with their row."""
    inside = _IN_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles (A-Z lower-cased).  A row
    with fewer words has its whole sequence as one shingle; one without words has none."""
    data = lowered(data)
    starts, ends = word_spans(data, bounds)
    words = span_hashes(data, starts, ends)
    first = np.searchsorted(starts, bounds)  # first word of each row
    with np.errstate(over="ignore"):
        n = max(0, len(words) - k + 1)
        rolled = np.zeros(n, np.uint64)
        for j in range(k):
            rolled = mix(rolled * np.uint64(0x2545F4914F6CDD1D) + words[j : j + n])
        out = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= k:
                out.append(np.unique(rolled[a : b - k + 1]))
            elif b > a:
                h = np.full(1, b - a, np.uint64)
                for w in words[a:b]:
                    h = mix(h * np.uint64(0x9FB21C651E98DF25) + w)
                out.append(h)
            else:
                out.append(np.empty(0, np.uint64))
    return out
