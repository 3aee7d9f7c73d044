"""Token ids as binary files of patched frame-of-reference blocks.

A file is a run of segments, each followed by one line feed.  A segment holds whole
documents: a header, the document table, the block table (minimum, width, start of the
packed words, start of the exceptions), the packed words and the exceptions.  A block has
256 ids.  It stores id - minimum at the width that the given share of its ids fits in; the
other ids are exceptions (place in the block, id - minimum) and are patched on reading.
All numbers are little-endian.

Files are numbered in ascending doc_id order and can be read one by one; the block table
gives random access inside a segment (``ids_between``)."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwright.llm.common import ship, slices, text_bytes
from barwright.llm.tokens import ENCODE_BYTES, encode_rows

BLOCK, LANES, STEPS = 256, 8, 32
HEAD = struct.Struct("<4sIQIII")  # magic, documents, ids, blocks, packed words, exceptions
MAGIC = b"PFB1"
BLOCK_ROW = np.dtype([("low", "<u4"), ("width", "u1"), ("word", "<u4"), ("patch", "<u4")])
PATCH = np.dtype([("at", "u1"), ("value", "<u4")])
DOC_ROW = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("n", "<u8")])
FILE_BYTES = 24_000_000


# --- blocks -------------------------------------------------------------------------


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 256) values below 2**width as (blocks, 8 * width) words: lane by lane, the
    i-th value of a lane starts at bit i * width."""
    rows = values.reshape(-1, STEPS, LANES)
    out = np.zeros((len(rows), width, LANES), np.uint32)
    for i in range(STEPS):
        word, bit = divmod(i * width, 32)
        out[:, word] |= rows[:, i] << np.uint32(bit)
        if bit + width > 32:
            out[:, word + 1] |= rows[:, i] >> np.uint32(32 - bit)
    return out.reshape(len(rows), -1)


def _unpacked(words: np.ndarray, width: int) -> np.ndarray:
    rows = words.reshape(-1, width, LANES)
    out = np.empty((len(rows), STEPS, LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(STEPS):
        word, bit = divmod(i * width, 32)
        value = rows[:, word] >> np.uint32(bit)
        if bit + width > 32:
            value |= rows[:, word + 1] << np.uint32(32 - bit)
        out[:, i] = value & mask
    return out.reshape(len(rows), BLOCK)


def encode_blocks(ids: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block table, packed words and exceptions of an id sequence."""
    n = -(-len(ids) // BLOCK)
    grid = np.empty(n * BLOCK, np.uint32)
    grid[: len(ids)] = ids
    grid[len(ids) :] = ids[-1] if len(ids) else 0
    grid = grid.reshape(n, BLOCK)
    table = np.zeros(n, BLOCK_ROW)
    low = grid.min(axis=1, initial=np.uint32(0xFFFFFFFF))
    delta = grid - low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(share * BLOCK)) - 1)
    limit = np.partition(delta, rank, axis=1)[:, rank]
    width = np.frexp(limit.astype(np.float64))[1].astype(np.uint8)
    size = width.astype(np.int64) * LANES
    table["low"], table["width"], table["word"] = low, width, np.cumsum(size) - size
    over = delta >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    block, at = np.nonzero(over)
    patches = np.zeros(len(block), PATCH)
    patches["at"], patches["value"] = at, delta[block, at]
    table["patch"] = np.searchsorted(block, np.arange(n))
    delta[over] = 0
    words = np.zeros(int(size.sum()), np.uint32)
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        place = table["word"][mine].astype(np.int64)[:, None] + np.arange(int(w) * LANES)
        words[place] = _packed(delta[mine], int(w))
    return table, words, patches


def decode_blocks(
    table: np.ndarray, words: np.ndarray, patches: np.ndarray, first: int = 0, last: int | None = None
) -> np.ndarray:
    """Ids of the blocks first to last - 1 (the last block's filling included)."""
    last = len(table) if last is None else last
    part = table[first:last]
    grid = np.zeros((len(part), BLOCK), np.uint32)
    for w in np.unique(part["width"][part["width"] > 0]):
        mine = np.flatnonzero(part["width"] == w)
        place = part["word"][mine].astype(np.int64)[:, None] + np.arange(int(w) * LANES)
        grid[mine] = _unpacked(words[place], int(w))
    starts = np.append(table["patch"], len(patches)).astype(np.int64)
    own = patches[starts[first] : starts[last]]
    block = np.repeat(np.arange(len(part)), np.diff(starts[first : last + 1]))
    grid[block, own["at"]] = own["value"]
    grid += part["low"][:, None]
    return grid.reshape(-1)


# --- segments -----------------------------------------------------------------------


def segment(doc_ids: list[int | None], bounds: np.ndarray, ids: np.ndarray, share: float) -> bytes:
    docs = np.zeros(len(doc_ids), DOC_ROW)
    docs["doc_id"] = [d or 0 for d in doc_ids]
    docs["known"] = [d is not None for d in doc_ids]
    docs["n"] = np.diff(bounds)
    table, words, patches = encode_blocks(ids, share)
    head = HEAD.pack(MAGIC, len(docs), len(ids), len(table), len(words), len(patches))
    return b"".join([head, docs.tobytes(), table.tobytes(), words.tobytes(), patches.tobytes()])


def segments(content: bytes) -> Iterator[tuple[np.ndarray, int, tuple]]:
    """Document table, number of ids and block parts of each segment of a file."""
    at = 0
    while at < len(content):
        magic, docs, ids, blocks, words, patches = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a token block file")
        at += HEAD.size
        parts = []
        for kind, n in ((DOC_ROW, docs), (BLOCK_ROW, blocks), (np.dtype("<u4"), words), (PATCH, patches)):
            parts.append(np.frombuffer(content, kind, n, at))
            at += n * kind.itemsize
        at += 1  # the line feed
        yield parts[0], ids, tuple(parts[1:])


def ids_between(parts: tuple, start: int, end: int) -> np.ndarray:
    """Ids start to end - 1 of a segment; decodes only the blocks they lie in."""
    first, last = start // BLOCK, -(-end // BLOCK)
    return decode_blocks(*parts, first, max(first, last))[start - first * BLOCK : end - first * BLOCK]


# --- tables -------------------------------------------------------------------------


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, share: float = 0.9
) -> None:
    """Encode ``text`` of all rows and write the files in ascending doc_id order.

    Null or empty texts are documents of the end id alone.  A null doc_id sorts first;
    rows with one doc_id are ordered by text.  Other columns are not read."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def pack(batches):
        for part in slices(batches, size=ENCODE_BYTES):
            ids, bounds = encode_rows(*text_bytes(part.column("text")), vocabulary, end_id)
            row = segment(part.column("doc_id").to_pylist(), bounds, ids, share)
            yield pa.RecordBatch.from_pydict({"segment": pa.array([row], pa.binary())})

    ordered = docs.repartitionByRange(1 + total // FILE_BYTES, "doc_id").sortWithinPartitions("doc_id", "text")
    packed = ordered.mapInArrow(pack, "segment binary")
    packed.select(F.col("segment").cast("string").alias("value")).write.text(path)


def read_token_files(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """Documents of the files: file, place (in the file), doc_id, file_start (ids before it
    in the file), n_tokens, ids_crc32, and ids unless only digests are wanted."""
    ship(spark)
    schema = "file string, place long, doc_id long, file_start long, n_tokens long, ids_crc32 long"
    schema += "" if digest_only else ", ids array<int>"

    def unpack(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                place, start = 0, 0
                for docs, n_ids, parts in segments(content.as_buffer()):
                    ids = decode_blocks(*parts)[:n_ids]
                    to = np.append(0, np.cumsum(docs["n"])).astype(np.int64)
                    view = memoryview(ids.astype("<u4", copy=False)).cast("B")
                    crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(to[:-1], to[1:], strict=True)]
                    out = {
                        "file": pa.array([name.rpartition("/")[2]] * len(docs)),
                        "place": pa.array(place + np.arange(len(docs))),
                        "doc_id": pa.array(docs["doc_id"], mask=docs["known"] == 0),
                        "file_start": pa.array(start + to[:-1]),
                        "n_tokens": pa.array(np.diff(to)),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                    if not digest_only:
                        out["ids"] = pa.ListArray.from_arrays(to.astype(np.int32), ids.astype(np.int32))
                    yield pa.RecordBatch.from_pydict(out)
                    place, start = place + len(docs), start + n_ids

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(unpack, schema)


def with_global_start(rows: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before this one.  Sums per file are one row for
    some 24 MB of text, so their running sum is a small ordered pass.  Files are ordered by the
    number in their names, which has more digits from 100,000 files on."""
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("file_tokens"))
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("offset"))
    return rows.join(offsets, "file").withColumn("start", F.col("offset") + F.col("file_start"))
