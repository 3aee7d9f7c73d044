"""Ranked lexical search by exact inner products over ball trees.

A document is a sparse vector with one coordinate per term, an item the vector of its term
counts; their inner product is the score, in 64-bit integers.  Documents are dealt into trees
of bounded size.  A node holds the mean of its vectors and the largest distance to it, so no
score below it exceeds ``<item, mean> + |item| * radius``, with the item cut to the node's terms.
Sparse vectors lie far apart in few directions, so a node also holds its reach along each term
(largest value less mean); the smaller of the two bounds counts.  Sums in doubles are rounded up.
For each item the node with the highest bound is opened first, leaves are scored exactly, and
the search ends when no bound reaches the worst of the best k.  A task carries these over to
its next tree.

Terms that no item holds add nothing to any product and are left out of the vectors; they
count for the lengths.  Items are handled in blocks of ``block_bytes`` of text, so what is sent
to the tasks is bounded; a block reads the documents once and its vectors once."""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barwright.llm.common import lowered, ship, slices, span_hashes, staged, text_bytes

LEAF = 32  # documents of a leaf
TREE_DOCS, TREE_POSTINGS = 4096, 400_000  # a tree is closed when it has so many
BLOCK_BYTES = 8_000_000

_IN_TERM = np.zeros(256, bool)
_IN_TERM[128:] = True
for _first, _last in ("09", "AZ", "az"):
    _IN_TERM[ord(_first) : ord(_last) + 1] = True


def term_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of terms: runs of ASCII letters and digits and of all code points above
    ASCII (whose bytes are all above 127).  Terms end with their row."""
    inside = _IN_TERM[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def terms_of(text: str | None) -> list[bytes]:
    data, bounds = text_bytes(pa.array([text], pa.string()))
    data = lowered(data)
    return [data[a:b].tobytes() for a, b in zip(*term_spans(data, bounds), strict=True)]


# --- vectors ------------------------------------------------------------------------


class Vocabulary:
    """Numbers of the items' terms; a lookup by hash is confirmed byte by byte."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms])
        starts = ends - [len(t) for t in terms]
        hashes = span_hashes(data, starts, ends)
        order = np.argsort(hashes, kind="stable")
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms of the items share a hash")
        self.hashes, self.number = hashes[order], order.astype(np.int32)
        self.data, self.starts, self.sizes = data, starts, ends - starts

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which spans are known terms, and their numbers."""
        if not len(self.hashes) or not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.int32)
        hashes = span_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = self.number[at]
        which = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[number] == ends - starts))
        number, size = number[which], self.sizes[number[which]]
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        wrong = data[np.repeat(starts[which], size) + step] != self.data[np.repeat(self.starts[number], size) + step]
        if wrong.any():
            right = np.bincount(np.repeat(np.arange(len(size)), size), wrong, len(size)) == 0
            which, number = which[right], number[right]
        return which, number


def postings(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per row: doc_id, n (all terms with repeats), the numbers of the known terms and how often
    each occurs."""
    ship(docs.sparkSession)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, terms array<int>, counts array<int>"

    def count(batches):
        size = max(1, len(vocabulary.hashes))
        for part in slices(batches):
            data, bounds = text_bytes(part.column("text"))
            data = lowered(data)
            starts, ends = term_spans(data, bounds)
            first = np.searchsorted(starts, bounds)
            which, number = vocabulary.find(data, starts, ends)
            row = np.searchsorted(first, which, "right") - 1
            keys, counts = np.unique(row * size + number, return_counts=True)
            offsets = pa.array(np.searchsorted(keys, np.arange(part.num_rows + 1) * size).astype(np.int32))
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "n": pa.array(np.diff(first)),
                "terms": pa.ListArray.from_arrays(offsets, pa.array((keys % size).astype(np.int32))),
                "counts": pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32))),
            })

    return docs.select("doc_id", "text").mapInArrow(count, schema)


def term_weights(vectors: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and each known term's weight, over all rows."""
    total = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row per term of the items
    df = np.zeros(size, np.int64)
    for term, n in held:
        df[term] = n
    weight = [math.floor(1000 * math.log((2 * total[0] + 2) / (2 * int(n) + 1))) for n in df]
    return int(total[0]), int(total[1]), np.array(weight, np.int64)


# --- trees --------------------------------------------------------------------------


@dataclass
class Node:
    low: int
    high: int  # documents low .. high - 1 in the tree's order
    terms: np.ndarray
    mean: np.ndarray
    reach: np.ndarray
    radius: float
    children: tuple[int, ...] = ()


class Tree:
    """A balanced ball tree over sparse rows with non-negative integer values.  A node is split
    at the median of the difference of distances to two rows far apart."""

    def __init__(self, ids: list, first: np.ndarray, terms: np.ndarray, values: np.ndarray, leaf: int = LEAF):
        self.vocabulary, local = np.unique(terms, return_inverse=True)
        self.ids, self.first, self.terms, self.values = ids, first, local, values
        self.nodes: list[Node] = []
        order = np.arange(len(ids))
        todo = [(0, len(ids), -1)]
        while todo:
            low, high, parent = todo.pop()
            rows = order[low:high]
            number = len(self.nodes)
            at, row = self._entries(rows)
            term, value = self.terms[at], self.values[at].astype(np.float64)
            total = np.bincount(term, value, len(self.vocabulary))
            some = np.flatnonzero(total)
            mean, peak = total / len(rows), np.zeros(len(total))
            np.maximum.at(peak, term, value)
            norm = np.bincount(row, value * value, len(rows))
            far = self._squares(mean, term, value, row, norm)
            # The error of such a sum is far below the added share.
            radius = math.sqrt(max(0.0, far.max()) + 1e-9 * (norm.max() + float(mean @ mean)))
            self.nodes.append(Node(low, high, some, mean[some], (peak - mean)[some], radius))
            if parent >= 0:
                self.nodes[parent].children += (number,)
            if len(rows) > leaf:
                one = self._row(rows[int(far.argmax())])
                to_one = self._squares(one, term, value, row, norm)
                other = self._row(rows[int(to_one.argmax())])
                side = np.argsort(to_one - self._squares(other, term, value, row, norm), kind="stable")
                order[low:high] = rows[side]
                middle = (low + high) // 2
                todo += [(low, middle, number), (middle, high, number)]
        at, row = self._entries(order)
        self.ids = [ids[i] for i in order]
        self.terms, self.values = self.terms[at], self.values[at]
        self.first = np.searchsorted(row, np.arange(len(ids) + 1))

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of some rows, and the number of the row among them."""
        size = self.first[rows + 1] - self.first[rows]
        row = np.repeat(np.arange(len(rows)), size)
        return np.arange(len(row)) - (np.cumsum(size) - size)[row] + self.first[rows][row], row

    def _row(self, i: int) -> np.ndarray:
        out = np.zeros(len(self.vocabulary))
        part = slice(self.first[i], self.first[i + 1])
        out[self.terms[part]] = self.values[part]
        return out

    def _squares(self, point: np.ndarray, term: np.ndarray, value: np.ndarray, row: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Squared distances of rows to a point."""
        return norm - 2 * np.bincount(row, value * point[term], len(norm)) + float(point @ point)

    def search(self, terms: np.ndarray, counts: np.ndarray, best: Best) -> int:
        """Offer all rows that can be among the best; returns the number of scored rows."""
        at = np.searchsorted(self.vocabulary, terms)
        found = at < len(self.vocabulary)
        found[found] = self.vocabulary[at[found]] == terms[found]
        if not found.any():
            return 0
        exact = np.zeros(len(self.vocabulary), np.int64)
        exact[at[found]] = counts[found]
        plain = exact.astype(np.float64)

        def bound(i: int) -> float:
            node = self.nodes[i]
            own = plain[node.terms]
            beyond = min(math.sqrt(float(own @ own)) * node.radius, float(own @ node.reach))
            return (float(own @ node.mean) + beyond) * (1 + 1e-9) + 1.0

        agenda, scored = [(-bound(0), 0)], 0
        while agenda:
            ceiling, i = heapq.heappop(agenda)
            if -ceiling < best.floor():
                break
            node = self.nodes[i]
            if node.children:
                for child in node.children:
                    if (b := bound(child)) >= best.floor():
                        heapq.heappush(agenda, (-b, child))
                continue
            begin, end = self.first[node.low], self.first[node.high]
            sums = np.zeros(end - begin + 1, np.int64)
            np.cumsum(exact[self.terms[begin:end]] * self.values[begin:end], out=sums[1:])
            edges = self.first[node.low : node.high + 1] - begin
            scores = sums[edges[1:]] - sums[edges[:-1]]
            scored += len(scores)
            for j in np.flatnonzero(scores >= max(1, best.floor())):
                best.offer(int(scores[j]), self.ids[node.low + j])
        return scored


class Best:
    """The k best (score, doc_id) so far: high scores first, then small ids, null last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def floor(self) -> int:
        return -self.rows[-1][0] if len(self.rows) == self.k else 0

    def offer(self, score: int, doc_id) -> None:
        key = (-score, doc_id is None, 0 if doc_id is None else doc_id)
        if len(self.rows) < self.k or key < self.rows[-1]:
            self.rows = sorted([*self.rows, key])[: self.k]


# --- search -------------------------------------------------------------------------


@dataclass
class Item:
    item_id: object
    terms: np.ndarray  # numbers, ascending
    counts: np.ndarray


def _best_rows(vectors: DataFrame, items: list[Item], weight: np.ndarray, documents: int, total: int, k: int, schema: str) -> DataFrame:
    """Each task's best rows of every item: (item, item_id, doc_id, score)."""

    def trees(batches):
        ids, sizes, terms, counts, lengths, held = [], [], [], [], [], 0
        for batch in batches:
            columns = batch.column("terms"), batch.column("counts")
            size = np.diff(np.asarray(columns[0].offsets))
            flat = [np.asarray(c.flatten()).astype(np.int64) for c in columns]
            edges = np.append(0, np.cumsum(size))
            names, n = batch.column("doc_id").to_pylist(), np.asarray(batch.column("n"))
            for i in np.flatnonzero(size):
                if ids and (len(ids) >= TREE_DOCS or held + size[i] > TREE_POSTINGS):
                    yield tree(ids, sizes, terms, counts, lengths)
                    ids, sizes, terms, counts, lengths, held = [], [], [], [], [], 0
                ids.append(names[i])
                sizes.append(int(size[i]))
                terms.append(flat[0][edges[i] : edges[i + 1]])
                counts.append(flat[1][edges[i] : edges[i + 1]])
                lengths.append(int(n[i]))
                held += int(size[i])
        if ids:
            yield tree(ids, sizes, terms, counts, lengths)

    def tree(ids, sizes, terms, counts, lengths):
        term, count = np.concatenate(terms), np.concatenate(counts)
        norm = 25 + 75 * np.array(lengths, np.int64) * documents // total
        value = weight[term] * (1_000_000_000 * count // (1000 * count + 8 * np.repeat(norm, sizes)))
        return Tree(ids, np.append(0, np.cumsum(sizes)), term, value)

    def search(batches):
        best = [Best(k) for _ in items]
        for t in trees(batches):
            for item, found in zip(items, best, strict=True):
                t.search(item.terms, item.counts, found)
        rows = [(i, items[i].item_id, None if null else d, -s) for i, found in enumerate(best) for s, null, d in found.rows]
        columns = zip(*rows, strict=True) if rows else [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["item", "item_id", "doc_id", "score"])

    types = to_arrow_schema(StructType.fromDDL(schema)).types
    return vectors.mapInArrow(search, schema)


def top(rows: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k documents with the highest scores above 0 for each item: item_id, rank, doc_id,
    score; equal scores by ascending doc_id, null ids last.

    Every row of ``docs`` is a document, repeated ones too; a null or empty text has no term
    and is never found, a null id is returned as it is.  Items are the distinct pairs (item_id,
    text): repeated rows give one ranking, several texts of an id one each, a null id is an id,
    and an item without a known term has no row.  Other columns are not read.  Texts of any
    length are read whole; a document with more terms than a tree holds gets its own tree."""
    spark = docs.sparkSession
    ship(spark)
    kinds = (items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString())
    schema = f"item int, item_id {kinds[0]}, doc_id {kinds[1]}, score long"
    items = items.where("text IS NOT NULL").select("item_id", "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(2 * size // block_bytes) + 1  # twice as many as needed, as a hash deals unevenly
    out = None
    for b in range(blocks):
        listed = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        parsed = [terms_of(r.text) for r in listed]
        names = sorted({t for terms in parsed for t in terms})
        if not names:
            continue
        number = {t: i for i, t in enumerate(names)}
        asked = [Item(r.item_id, *np.unique([number[t] for t in terms], return_counts=True)) for r, terms in zip(listed, parsed, strict=True) if terms]
        vectors = staged(postings(docs, Vocabulary(names)), "vectors")
        documents, total, weight = term_weights(vectors, len(names))
        found = _best_rows(vectors, asked, weight, documents, total, k, schema)
        found = top(found.withColumn("part", F.spark_partition_id() % 64), k, "item", "part")
        found = top(found, k, "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    return out
