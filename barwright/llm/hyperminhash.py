"""Near-duplicate groups by HyperMinHash registers.

A document's set is its distinct k-word shingles (A-Z lower-cased).  The leading bits of a
shingle's hash choose one of 256 buckets; a bucket keeps its smallest remaining hash as a
16-bit register: the count of leading zeros (6 bits) and the 10 mantissa bits after them.
Runs of registers (bands) are join keys.  Candidates are pruned by the Jaccard estimate,
corrected for registers that agree by chance, then confirmed on the full sets.

Groups of copies are never expanded into pairs:
* documents with one set are one class; only classes are compared;
* in a band each class meets the band's pivot, the class that shares most bands with others;
  the links give components;
* classes of a small band that still lie in different components meet each other, if few
  enough buckets differ (two bits a bucket are compared inside the join);
* in a large band, classes far from the pivot (a shared passage in otherwise different texts)
  are compared with the others by the marks as well; those near it, which the marks cannot
  tell apart, meet through what sets them apart from the pivot.  Let D(x) be the
  shingles that x and the pivot p do not share, and s = (1 - t) / (1 + t) for the threshold t.
  x links with y exactly if the two differ in at most s (|x| + |y|) shingles.  If x does not
  link with p, then |D(x)| > s (|x| + |p|), so a link of x and y needs more than
  (1 - s) / 2 * |D(y)| shingles common to D(x) and D(y).  Edits made independently share
  hardly any.  So only the rarest shingles of D are join keys (prefix filter), and no link is
  lost by it.
A pair at the threshold shares some sixteen of 42 bands, so the chance to miss it is below
one in 10^8 at 0.85 (3 in 10^6 at 0.8)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.common import drop_staged, mix, shingle_sets, ship, slices, staged, text_bytes
from barwright.llm.components import components

BUCKET_BITS, MANTISSA = 8, 10
BUCKETS = 1 << BUCKET_BITS
BAND_ROWS = 6
BANDS = BUCKETS // BAND_ROWS
EMPTY = np.uint16(0xFFFF)
CHANCE = 0.169919487159739  # fixed value: chance agreements of the published estimator
NEAR = 96  # differing buckets up to which a class counts as near its pivot
CROWD = 64  # classes of one band that may all meet each other


# --- registers ------------------------------------------------------------------------


def registers(shingles: np.ndarray) -> np.ndarray:
    """Registers of a sorted array of distinct 64-bit hashes."""
    out = np.full(BUCKETS, EMPTY, np.uint16)
    if len(shingles):
        bucket = (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        rest = shingles[first] << np.uint64(BUCKET_BITS)
        high = (rest >> np.uint64(32)).astype(np.float64)
        low = (rest & np.uint64(0xFFFFFFFF)).astype(np.float64)
        length = np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1])
        zeros = np.minimum(64 - length, 56)
        mantissa = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
        out[bucket[first]] = zeros.astype(np.uint16) << np.uint16(MANTISSA) | mantissa.astype(np.uint16)
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of rows of registers, and the number of buckets behind each."""
    used = (a != EMPTY) | (b != EMPTY)
    n = used.sum(axis=1)
    same = (used & (a == b)).sum(axis=1)
    chance = np.minimum(CHANCE * 2.0 ** (BUCKET_BITS - MANTISSA + 1), same) * (n / BUCKETS)
    return np.maximum(same - chance, 0) / np.maximum(n, 1), n


def bucket_marks(row: np.ndarray) -> np.ndarray:
    """Two bits per bucket, 32 buckets in a 64-bit number: 0 for an empty one, else 1 to 3."""
    mark = np.where(row == EMPTY, 0, 1 + row % 3).astype(np.uint64).reshape(-1, 32)
    return np.bitwise_or.reduce(mark << (2 * np.arange(32, dtype=np.uint64)), axis=1).view(np.int64)


def band_keys(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all bands of all rows of registers, and which of them hold a register."""
    cut = rows[:, : BANDS * BAND_ROWS].reshape(len(rows), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), cut.shape[:2]).copy()
    for j in range(BAND_ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, j])
    return key.view(np.int64), (cut != EMPTY).any(axis=2)


def _register_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


# --- tables -----------------------------------------------------------------------------


def sketched(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, set_key (one per distinct set), registers, marks."""

    def sketch(batches):
        for part in slices(batches):
            sets = shingle_sets(*text_bytes(part.column("text")), k)
            rows = [registers(s) for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "set_key": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                "registers": pa.array([r.tobytes() for r in rows], pa.binary()),
                "marks": pa.array([bucket_marks(r) for r in rows], pa.list_(pa.int64())),
            })

    return docs.mapInArrow(sketch, "doc_id long, n_shingles long, set_key binary, registers binary, marks array<long>")


def _bands(classes: DataFrame) -> DataFrame:
    """(key, node, n): the band keys of every class."""

    def explode(batches):
        for batch in batches:
            if batch.num_rows:
                keys, used = band_keys(_register_rows(batch.column("registers")))
                row, band = np.nonzero(used)
                take = pa.array(row)
                yield pa.RecordBatch.from_pydict(
                    {"key": pa.array(keys[row, band]), "node": batch.column("node").take(take), "n": batch.column("n").take(take)}
                )

    return classes.select("node", "n", "registers").mapInArrow(explode, "key long, node long, n long")


def _similar_sizes(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _differing(a: str, b: str):
    """Number of buckets whose marks differ."""
    total = F.lit(0)
    for i in range(BUCKETS // 32):
        x = F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def _may_link(a: str, b: str, na: str, nb: str, percent: int):
    """False only for pairs that do not link: a shingle that one set lacks changes one bucket
    at most, and a link allows (1 - t) / (1 + t) * (|A| + |B|) such shingles; of large sets six
    standard deviations beyond the share of buckets that differ at the threshold."""
    usual = BUCKETS * (100 - percent) / 100 * 2 / 3
    most = F.least(F.floor((100 - percent) / (100 + percent) * (F.col(na) + F.col(nb)) + 1e-6), F.lit(int(usual + 6 * usual**0.5)))
    return _differing(a, b) <= most


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the pairs (a, b): by the bucket marks, by the estimate, by the full sets."""
    limit = percent / 100

    def likely(batches):
        for batch in batches:
            if batch.num_rows:
                j, n = estimate(_register_rows(batch.column("ra")), _register_rows(batch.column("rb")))
                keep = pa.array(j + 6 * np.sqrt(limit * (1 - limit) / np.maximum(n, 1)) >= limit)
                yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(keep) for c in ("a", "b")})

    def linked(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_pydict({"u": batch.column("a").filter(keep), "v": batch.column("b").filter(keep)})

    marks = classes.select("node", "marks", "n")
    pairs = pairs.join(marks.toDF("a", "ma", "na"), "a").join(marks.toDF("b", "mb", "nb"), "b")
    pairs = pairs.where(_may_link("ma", "mb", "na", "nb", percent)).select("a", "b")
    rows = classes.select("node", "registers")
    pairs = pairs.join(rows.toDF("a", "ra"), "a").join(rows.toDF("b", "rb"), "b")
    pairs = pairs.mapInArrow(likely, "a long, b long")
    pairs = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return pairs.mapInArrow(linked, "u long, v long")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with their node's component (itself while unlinked)."""
    return rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _unsettled(rows: DataFrame) -> DataFrame:
    """Rows of keys that hold several components, with the key's largest component and its
    number of classes.  All counts are aggregates per (key, component)."""
    sizes = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    keys = sizes.groupBy("key").agg(
        F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("members"), F.count(F.lit(1)).alias("parts")
    )
    keys = keys.where("parts > 1").select("key", F.col("top.component").alias("major"), "members")
    return rows.join(keys, "key")


def _meetings(rows: DataFrame, percent: int, where: str = "component != major") -> DataFrame:
    """Pairs of a key whose components differ and whose marks allow a link.  One of them is
    outside the largest component (small keys: at most CROWD meetings for each row) or, in
    large keys, far from the pivot."""
    out = rows.where(where).select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("marks").alias("ma"))
    every = rows.select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("marks").alias("mb"))
    met = out.join(every, "key").where(
        (F.col("ca") != F.col("cb"))
        & (F.col("a") != F.col("b"))
        & _similar_sizes("na", "nb", percent)
        & _may_link("ma", "mb", "na", "nb", percent)
    )
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(pivot, node, ..., parts): the shingles that a class and its pivot do not share."""

    def differ(batches):
        for batch in batches:
            pairs = zip(batch.column("sp").to_pylist(), batch.column("sx").to_pylist(), strict=True)
            parts = [
                np.setxor1d(np.frombuffer(p, np.uint64), np.frombuffer(x, np.uint64), assume_unique=True).view(np.int64)
                for p, x in pairs
            ]
            out = {c: batch.column(c) for c in ("pivot", "node", "n", "pivot_n", "component", "outside")}
            yield pa.RecordBatch.from_pydict(out | {"parts": pa.array(parts, pa.list_(pa.int64()))})

    both = members.join(sets.toDF("pivot", "sp"), "pivot").join(sets.toDF("node", "sx"), "node")
    schema = "pivot long, node long, n long, pivot_n long, component long, outside boolean, parts array<long>"
    return both.mapInArrow(differ, schema)


def _apart(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of large keys between components, found by the rarest shingles of what sets classes
    apart from the pivot and confirmed on all of them."""
    members = rows.groupBy("pivot", "node").agg(*[F.first(c).alias(c) for c in ("n", "pivot_n", "component", "pivot_component")])
    members = members.where("pivot != node").withColumn("outside", F.col("component") != F.col("pivot_component"))
    apart = staged(_differences(members, sets), "differences")
    met = _candidates(apart, percent)
    # Two sets differ exactly in what only one of their differences from the pivot has.
    left = apart.select("pivot", F.col("node").alias("a"), F.col("n").alias("na"), F.col("parts").alias("pa"))
    right = apart.select("pivot", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("parts").alias("pb"))
    both = met.join(left, ["pivot", "a"]).join(right, ["pivot", "b"])
    differing = F.size("pa") + F.size("pb") - 2 * F.size(F.array_intersect("pa", "pb"))
    total = F.col("na") + F.col("nb")
    # common = (total - differing) / 2 and union = (total + differing) / 2
    linked = 100 * (total - differing) >= percent * (total + differing)
    found = staged(both.where(linked).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "apart")
    drop_staged(apart)
    return found


def _candidates(apart: DataFrame, percent: int) -> DataFrame:
    """Pairs (pivot, a, b) that may link: they share one of their rarest parts.  All that they share comes
    at or after the first part they share, so its places say how much they can share at most; a pair for
    which that is too little for a link is not formed at this part.  Where edits were made
    independently, most parts of a class are its own and come first, so hardly any pair is left."""
    parts = apart.select("pivot", "node", F.explode("parts").alias("part"))
    seen = parts.groupBy("pivot", "part").agg(F.count(F.lit(1)).alias("seen"))
    order = Window.partitionBy("pivot", "node").orderBy("seen", "part")
    ranked = parts.join(seen.where("seen > 1"), ["pivot", "part"], "left").withColumn("seen", F.coalesce("seen", F.lit(1)))
    ranked = ranked.withColumn("i", F.row_number().over(order)).where("seen > 1")  # a part seen once joins nothing
    s = (100 - percent) / (100 + percent)
    size = F.size("parts")
    least = F.greatest(F.floor((1 - s) / 2 * size - 1e-6) + 1, F.lit(1))
    outside_least = F.greatest(F.ceil((size - s * (F.col("n") + F.col("pivot_n")) + 1 - s) / 2 - 1e-6), F.lit(1))
    about = apart.select(
        "pivot", "node", "n", "component", "outside", size.alias("d"), (size - least + 1).alias("inside_i"), (size - outside_least + 1).alias("outside_i")
    )
    keyed = ranked.join(about, ["pivot", "node"])
    out = keyed.where("outside AND i <= outside_i").select("pivot", "part", F.col("node").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("i").alias("ia"), F.col("d").alias("da"))
    every = keyed.where("i <= inside_i").select("pivot", "part", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("i").alias("ib"), F.col("d").alias("db"))
    shared = 1 + F.least(F.col("da") - F.col("ia"), F.col("db") - F.col("ib"))
    enough = 2 * shared >= F.col("da") + F.col("db") - s * (F.col("na") + F.col("nb")) - 1e-6
    met = out.join(every, ["pivot", "part"]).where((F.col("ca") != F.col("cb")) & _similar_sizes("na", "nb", percent) & enough)
    return met.select("pivot", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _named(classes: DataFrame) -> DataFrame:
    """Classes with their name ``node``: the owner, which is the smallest doc_id, for the first
    class of an owner, and a hash of the set for its other ones."""
    first = classes.groupBy("owner").agg(F.min("set_key").alias("set_key")).withColumn("first", F.lit(True))
    named = classes.join(first, ["owner", "set_key"], "left")
    return named.withColumn("node", F.when(F.col("first"), F.col("owner")).otherwise(F.xxhash64("set_key"))).drop("first")


def _class_components(links: DataFrame, others: DataFrame) -> DataFrame:
    """(node, component) by links of classes.  Components are those of the owners, so that a
    component's name is a doc_id; ``others`` are the classes not named by their owner."""
    if others.isEmpty():
        return components(links)
    for end in ("u", "v"):
        links = links.join(others.toDF(end, "to"), end, "left").withColumn(end, F.coalesce("to", end)).select("u", "v")
    labels = components(links)
    more = others.join(labels.toDF("owner", "component"), "owner", "left")
    return labels.unionByName(more.select("node", F.coalesce("component", "owner").alias("component")))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by 100 * |A & B| >= percent * |A | B|, over shingle sets.

    Returns per row: doc_id, n_shingles, component_id (smallest doc_id reachable) and kept
    (doc_id = component_id).  A text with fewer than k words has its whole sequence as one
    shingle; null, empty and blank texts have none and link with nothing.  Rows that share a
    doc_id count as one document with several texts.  A row without doc_id is compared with
    nothing: component_id is null, kept is true.  Other columns are not read."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = staged(sketched(docs, k), "sketches")
    known = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("set_key").agg(F.min("doc_id").alias("owner"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"), F.first("marks").alias("marks"))
    classes = staged(_named(classes), "classes")
    others = staged(classes.where("node != owner").select("node", "owner"), "others")
    bands = _bands(classes)
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    crowded = staged(bands.join(shared, "key"), "crowded")
    weight = crowded.groupBy("node").agg(F.sum("size").alias("weight"))
    first = F.max(F.struct("weight", "node", "n")).alias("p")
    pivots = crowded.join(weight, "node").groupBy("key").agg(first)
    pivots = pivots.select("key", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"))
    pivoted = staged(crowded.join(pivots, "key").drop("size"), "pivoted")
    drop_staged(crowded)
    crowded = pivoted
    # Full sets are needed for classes that share a band only.
    involved = crowded.select("node").distinct()
    chosen = classes.join(involved, "node", "left_semi")
    sets = staged(_sets(docs.join(chosen, docs["doc_id"] == chosen["owner"], "left_semi"), rows, chosen, k), "sets")

    stars = crowded.where("node != pivot").where(_similar_sizes("n", "pivot_n", percent))
    stars = stars.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = first_links = staged(_confirmed(stars, classes, sets, percent), "links")
    # A doc_id with several texts ties their classes together.
    owners = known.select("doc_id", "set_key").join(classes.select("set_key", "owner"), "set_key")
    shared = owners.groupBy("doc_id").agg(F.min("owner").alias("u"), F.max("owner").alias("v"), F.collect_set("owner").alias("all"))
    shared = shared.where("u != v").select("u", F.explode("all").alias("v"))
    links = links.unionByName(shared)

    labels = _class_components(links, others)
    open_rows = staged(_unsettled(_labelled(crowded, labels)), "unsettled")
    small = open_rows.where(F.col("members") <= CROWD).join(classes.select("node", "marks"), "node")
    few = _meetings(small, percent)
    home = labels.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_component"))
    crowds = open_rows.where(F.col("members") > CROWD).join(home, "pivot", "left")
    crowds = crowds.withColumn("pivot_component", F.coalesce("pivot_component", "pivot"))
    marks = classes.select("node", "marks")
    crowds = crowds.join(marks, "node").join(marks.toDF("pivot", "pivot_marks"), "pivot")
    crowds = staged(crowds.withColumn("far", _differing("marks", "pivot_marks") > NEAR).drop("pivot_marks"), "crowds")
    far = _meetings(crowds, percent, "far")
    late = few.unionByName(far).distinct().join(stars, ["a", "b"], "left_anti")
    late = _confirmed(late, classes, sets, percent)
    late = staged(late.unionByName(_apart(crowds.where("NOT far").drop("marks"), sets, percent)), "links")
    for used in (crowded, sets, open_rows, crowds):
        drop_staged(used)
    if not late.isEmpty():
        labels = _class_components(links.unionByName(late), others)
    named = classes.select("set_key", "node").join(labels, "node", "left").select("set_key", F.coalesce("component", "node").alias("component_id"))
    found = rows.drop("registers", "marks").join(named, "set_key", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    )
    found = found.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    found = found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    result = staged(found.select("doc_id", "n_shingles", "component_id", "kept"), "groups")
    for used in (rows, classes, others, first_links, late):
        drop_staged(used)
    return result


def _sets(docs: DataFrame, rows: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(node, set): the sorted shingle hashes of each class, from its owner."""

    def full(batches):
        for part in slices(batches):
            sets = [s.tobytes() for s in shingle_sets(*text_bytes(part.column("text")), k)]
            keys = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_pydict(
                {"owner": part.column("doc_id"), "set_key": pa.array(keys, pa.binary()), "set": pa.array(sets, pa.binary())}
            )

    # The key as well, as a doc_id may stand for several texts.
    wanted = classes.select("node", "owner", "set_key")
    return docs.mapInArrow(full, "owner long, set_key binary, set binary").join(wanted, ["owner", "set_key"]).select("node", "set").dropDuplicates(["node"])
