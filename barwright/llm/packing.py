"""Best-fit packing by large-item matching.

Documents become pieces of at most ``capacity`` ids.  Pieces above a third of the capacity
meet at most twice in a sequence: each, from the longest down, is matched with the longest
other one that fits.  Smaller pieces, from the longest down, go to the smallest gap that
holds them, or open a sequence.

Equal lengths are interchangeable, so a plan is made on the number of pieces of each
length: at most ``capacity`` numbers.  It says, for the pieces of one length in order, which
sequences and offsets a run of them takes; each piece then finds its run by its rank among
pieces of its length.

Two rounds.  First every task packs its own documents in blocks of some thousand pieces and
keeps the sequences that are at least ``FULL`` filled; their ids are written where they were
encoded and never moved.  The pieces of all other sequences, a percent or so, are packed once more
over the whole table.  Ranks come from salted counts there, so a length that a third of all
pieces have is spread over many tasks."""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.common import ship, slices, staged, text_bytes
from barwright.llm.tokens import ENCODE_BYTES, encode_rows

RANK_ROWS = 200_000  # pieces a ranking task gets on average
BLOCK_IDS = 4_000_000  # ids of a block
BATCH_IDS = 250_000  # ids that leave a task at a time
FULL = 0.98  # share of the capacity from which a sequence of a block is left as it is


def pieces_in(part: pa.RecordBatch, vocabulary: str, end_id: int, capacity: int) -> dict[str, np.ndarray]:
    """Pieces of the documents of a slice, in their order: doc_id, piece, start, length, and all
    ids, which follow each other as the pieces do.

    Only documents above the capacity are cut; then the first piece takes what is over.
    Null or empty texts give one piece, the end id.  Repeated rows are packed each."""
    ids, bounds = encode_rows(*text_bytes(part.column("text")), vocabulary, end_id)
    n = np.diff(bounds)
    count = -(-n // capacity)
    row = np.repeat(np.arange(len(n)), count)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = n - (count - 1) * capacity
    start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
    length = np.where(piece == 0, first[row], capacity)
    doc_id = part.column("doc_id")
    return {
        "doc_id": doc_id.fill_null(0).to_numpy(zero_copy_only=False)[row], "known": np.asarray(doc_id.is_valid())[row],
        "piece": piece.astype(np.int32), "start": start, "length": length, "ids": ids,
    }


# --- the plan -----------------------------------------------------------------------


class Plan:
    """Runs: pieces ``rank .. rank + n - 1`` of a length go to sequences ``first ..`` at an
    offset, one each."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, rank, n, first, offset
        self._used: dict[int, int] = defaultdict(int)
        self.sequences = 0
        # open sequences by gap: runs of sequence numbers with that gap left
        self._gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
        left = {s: n for s, n in counts.items() if n > 0}
        self._match_large({s: n for s, n in left.items() if 3 * s > capacity})
        for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
            self._fit_small(s, left[s])

    def _put(self, length: int, n: int, first: int, offset: int) -> None:
        self.runs.append((length, self._used[length], n, first, offset))
        self._used[length] += n

    def _open(self, n: int) -> int:
        first = self.sequences
        self.sequences += n
        return first

    def _match_large(self, left: dict[int, int]) -> None:
        for s in sorted(left, reverse=True):
            while left[s]:
                mates = [t for t in left if left[t] and t <= self.capacity - s and (t != s or left[s] > 1)]
                mate = max(mates, default=0)
                if not mate:
                    n = left[s]
                elif mate == s:
                    n = left[s] // 2
                else:
                    n = min(left[s], left[mate])
                first = self._open(n)
                self._put(s, n, first, 0)
                left[s] -= n
                if mate:
                    self._put(mate, n, first, s)
                    left[mate] -= n
                self._gaps[self.capacity - s - mate].append((first, n))

    def _fit_small(self, s: int, count: int) -> None:
        while count:
            gap = min((g for g, runs in self._gaps.items() if g >= s and runs), default=0)
            if gap:
                first, size = self._gaps[gap].pop()
                n = min(size, count)
                if n < size:
                    self._gaps[gap].append((first + n, size - n))
                self._put(s, n, first, self.capacity - gap)
                self._gaps[gap - s].append((first, n))
                count -= n
            else:  # whole sequences of this length, then one with the rest
                each = min(self.capacity // s, count)
                n = count // each
                first = self._open(n)
                for k in range(each):
                    self._put(s, n, first, k * s)
                self._gaps[self.capacity - each * s].append((first, n))
                count -= n * each


# --- placing ------------------------------------------------------------------------


def ranked(rows: DataFrame, keys: list[str], order: list[str], total: int) -> DataFrame:
    """Add ``rank``, the number of rows before this one among rows with equal keys.  Keys are
    salted: salts are numbered one after the other, rows are numbered inside a salt."""
    salts = max(1, total // RANK_ROWS) * 4
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sizes = rows.groupBy(*keys, "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(*keys, "__salt").orderBy(*order)
    numbered = rows.withColumn("__i", F.row_number().over(inside) - 1)
    return numbered.join(sizes, [*keys, "__salt"]).withColumn("rank", F.col("__base") + F.col("__i")).drop("__salt", "__base", "__i")


def block_sequences(block: dict[str, np.ndarray], capacity: int) -> tuple[Iterator[pa.RecordBatch], int]:
    """Sequences of one block: those filled enough, and for the rest a row per piece (``done`` is
    false, with the crc of its ids).  ``sequence_id`` counts from 0; also returns how many there are.
    Ids are put together for some ``BATCH_IDS`` at a time, so that a block is never held twice."""
    length = block["length"]
    plan = Plan(dict(zip(*(x.tolist() for x in np.unique(length, return_counts=True)), strict=True)), capacity)
    by_length = np.argsort(length, kind="stable")
    begin = np.searchsorted(length[by_length], np.arange(capacity + 2))
    sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    for size, rank, n, first, at in plan.runs:
        mine = by_length[begin[size] + rank : begin[size] + rank + n]
        sequence[mine], offset[mine] = first + np.arange(n), at
    filled = np.bincount(sequence, length, plan.sequences)
    done = filled >= FULL * capacity
    # A sequence that is not full enough falls apart into rows of one piece.
    row = np.where(done[sequence], sequence, plan.sequences + np.arange(len(length)))
    offset = np.where(done[sequence], offset, 0)
    order = np.lexsort((offset, row))
    edges = np.append(np.flatnonzero(np.diff(row[order], prepend=-1)), len(order))
    begin_id = np.append(0, np.cumsum(length))[:-1][order]
    total = np.append(0, np.cumsum(length[order]))

    def rows(low: int, high: int) -> pa.RecordBatch:
        """The rows from one edge to another."""
        mine = order[edges[low] : edges[high]]
        size = length[mine]
        upto = np.cumsum(size)
        at = begin_id[edges[low] : edges[high]]
        ids = block["ids"][np.repeat(at - (upto - size), size) + np.arange(upto[-1])]
        parts = pa.StructArray.from_arrays(
            [pa.array(offset[mine]), pa.array(block["doc_id"][mine], mask=~block["known"][mine]),
             *(pa.array(block[c][mine]) for c in ("piece", "start", "length"))],
            ["offset", "doc_id", "piece", "start", "length"],
        )
        first = edges[low:high] - edges[low]
        id_edges = np.append((upto - size)[first], upto[-1])
        finished = done[sequence[mine][first]]
        view = memoryview(ids.astype("<u4", copy=False)).cast("B")
        crc = [0 if f else zlib.crc32(view[4 * a : 4 * b]) for a, b, f in zip(id_edges[:-1], id_edges[1:], finished, strict=True)]
        return pa.RecordBatch.from_pydict({
            "sequence_id": pa.array(np.where(finished, row[mine][first], -1)), "done": pa.array(finished), "crc": pa.array(crc, pa.int64()),
            "ids": pa.ListArray.from_arrays(id_edges.astype(np.int32), pa.array(ids.astype(np.int32, copy=False))),
            "pieces": pa.ListArray.from_arrays(np.append(first, len(mine)).astype(np.int32), parts),
        })

    # A row ends at most ``capacity`` ids after the mark of its batch.
    cuts = np.unique(np.append(np.searchsorted(total[edges], np.arange(0, total[-1], BATCH_IDS)), len(edges) - 1))
    return (rows(a, b) for a, b in itertools.pairwise(cuts.tolist())), plan.sequences


def packed_sequences(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """All documents in sequences: sequence_id, ids, and the pieces in them (offset, doc_id, piece,
    start, length).  Null texts count as empty, a null doc_id is kept, repeated rows are packed each;
    a text of any length is cut into pieces; an empty table gives no sequence.  Of equal lengths
    any piece may come first.  Ids of sequences are distinct; those of the second round are negative."""
    ship(docs.sparkSession)
    schema = "sequence_id long, done boolean, crc long, ids array<int>, pieces array<struct<offset long, doc_id long, piece int, start long, length long>>"

    def blocks(batches):
        from pyspark import TaskContext

        base, held, size = TaskContext.get().partitionId() << 40, [], 0

        def close():
            nonlocal base
            block = {name: np.concatenate([h.pop(name) for h in held]) for name in list(held[0])}
            batches, n = block_sequences(block, capacity)
            for batch in batches:
                yield batch.set_column(0, "sequence_id", pa.array(np.asarray(batch.column("sequence_id")) + base))
            base += n

        for part in slices(batches, size=ENCODE_BYTES):
            if part.num_rows:
                held.append(pieces_in(part, vocabulary, end_id, capacity))
                size += len(held[-1]["ids"])
            if size >= BLOCK_IDS:
                yield from close()
                held, size = [], 0
        if held:
            yield from close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    first = staged(rows.mapInArrow(blocks, schema), "blocks")
    left = first.where("NOT done").select(F.col("pieces")[0].alias("p"), F.col("crc").alias("ids_crc32"), "ids")
    again = sequences(pack(left.select("p.doc_id", "p.piece", "p.start", "p.length", "ids_crc32", "ids"), capacity))
    kept = ["sequence_id", "ids", "pieces"]
    return first.where("done").select(kept).unionByName(again.select((-1 - F.col("sequence_id")).alias("sequence_id"), "ids", "pieces"))


def pack(rows: DataFrame, capacity: int = 1024) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces (it is read twice).  The
    driver sees the number of pieces of each length only."""
    spark = rows.sparkSession
    ship(spark)
    counts = {int(r["length"]): int(r["n"]) for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = np.array(sorted(Plan(counts, capacity).runs), np.int64).reshape(-1, 5)
    where = ranked(rows, ["length"], ["doc_id", "piece", "ids_crc32"], sum(counts.values()))
    schema = where.schema.jsonValue()
    schema["fields"] += [{"name": n, "type": "long", "nullable": True, "metadata": {}} for n in ("sequence_id", "offset")]

    def place(batches):
        key = runs[:, 0] << 40 | runs[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            run = runs[np.searchsorted(key, length << 40 | rank, "right") - 1] if len(rank) else runs[:0]
            out = {n: batch.column(n) for n in batch.schema.names}
            out["sequence_id"] = pa.array(run[:, 3] + rank - run[:, 1])
            out["offset"] = pa.array(run[:, 4])
            yield pa.RecordBatch.from_pydict(out)

    from pyspark.sql.types import StructType

    return where.mapInArrow(place, StructType.fromJson(schema)).drop("rank")


def sequences(packed: DataFrame) -> DataFrame:
    """The id sequences themselves: sequence_id, ids, doc_ids and the pieces in them (offset,
    doc_id, piece, start, length); a group is one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"),
        F.transform("p", lambda x: x.dropFields("ids")).alias("pieces"),
    )


def pieces_of(built: DataFrame, with_ids: bool = True) -> DataFrame:
    """Pieces cut out of built sequences again: doc_id, piece, start, length, ids_crc32 of the
    ids found at the piece's place, sequence_id, offset and, if wanted, these ids."""
    ship(built.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    schema += ", ids array<int>" if with_ids else ""

    def cut(batches):
        for batch in batches:
            lists, parts = batch.column("ids"), batch.column("pieces")
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            begin = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            row = pa.compute.list_parent_indices(parts).to_numpy(zero_copy_only=False)
            fields = dict(zip([f.name for f in parts.type.value_type], parts.flatten().flatten(), strict=True))
            at = begin[row] + fields["offset"].to_numpy(zero_copy_only=False)
            to = at + fields["length"].to_numpy(zero_copy_only=False)
            found = [ids[a:b] for a, b in zip(at, to, strict=True)]
            out = {n: fields[n] for n in ("doc_id", "piece", "start", "length")}
            out["ids_crc32"] = pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64())
            out["sequence_id"] = batch.column("sequence_id").take(pa.array(row))
            out["offset"] = fields["offset"]
            if with_ids:
                out["ids"] = pa.array(found, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    return built.select("sequence_id", "ids", "pieces").mapInArrow(cut, schema)


def packed_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their places, cut out of the built sequences (``pieces_of``)."""
    return pieces_of(packed_sequences(docs, vocabulary, end_id, capacity), with_ids)
