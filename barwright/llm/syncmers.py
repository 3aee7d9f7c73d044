"""Document fingerprints from closed syncmers.

Tokens are runs of non-blank characters.  Of the windows of four tokens (k-mers) those are
kept whose smallest pair of neighbouring tokens (inner substring, by hash) is the first or the
last pair.  Whether a window is kept depends on its own tokens only, so an edit changes the
anchors it touches and no others.  Three start marks stand before the first token, so that a
text of n tokens has n windows and short texts have anchors as well.

A fingerprint is the 64 smallest distinct anchor hashes, each with the place of its first anchor.  Two
fingerprints match by place: of the hashes in both, those count whose places lie the commonest
distance apart, so that passages in another order are not taken for the same text.  Everything is built from
array expressions; no Python runs on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.common import staged

SKETCH = 64
PLACE_BITS = 24  # the low bits of a fingerprint's entries: the place, counted modulo 2 ** 24
EDGE_ROWS = 500_000  # rows of a range whose neighbours are found together


def with_pairs(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the hashes of neighbouring tokens, start marks included."""
    tokens = F.transform(F.split(text, r"\s+"), lambda t: F.xxhash64(t))
    df = df.withColumn(name, F.concat(F.array(*[F.xxhash64(F.lit(f"start {i}")) for i in range(3)]), tokens))
    after = F.slice(name, 2, F.size(name) - 1)
    return df.withColumn(name, F.zip_with(F.col(name), after, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b))))


def _anchor(pairs: str, i: Column) -> Column:
    """Hash of the window that starts at token i if it is a closed syncmer, else null."""
    first, middle, last = (F.get(F.col(pairs), i + j) for j in range(3))
    return F.when(F.least(first, last) <= middle, F.when(last.isNotNull(), F.xxhash64(first, last)))


def anchors(df: DataFrame, text: str = "text", name: str = "anchors") -> DataFrame:
    """Add all anchors of a text in order: array<struct<position, hash>>, position being the
    window's last token (from 0).  For matching passages by their places."""
    df = with_pairs(df, text, "__pairs")
    each = F.transform(F.col("__pairs"), lambda _, i: F.struct(i.alias("position"), _anchor("__pairs", i).alias("hash")))
    return df.withColumn(name, F.filter(each, lambda a: a["hash"].isNotNull())).drop("__pairs")


def _entry(hashed: Column, place: Column | int) -> Column:
    """The leading 40 bits of a hash and a place as one long, ordered by hash, then place."""
    places = F.lit((1 << PLACE_BITS) - 1).cast("long")
    return hashed.bitwiseAND(F.bitwise_not(places)).bitwiseOR((F.lit(place) if isinstance(place, int) else place).cast("long").bitwiseAND(places))


def _hash_of(entry: Column) -> Column:
    return F.shiftright(entry, PLACE_BITS)


def with_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of a text as an array of entries (hash and place of its first anchor).  A text
    so short that no window is a syncmer has the hash of all its tokens, at place 0."""
    df = with_pairs(df, text, "__pairs")
    each = F.transform(F.col("__pairs"), lambda _, i: _entry(_anchor("__pairs", i), i))
    df = df.withColumn("__entries", F.sort_array(F.filter(each, lambda e: e.isNotNull())))
    first = F.filter("__entries", lambda e, i: (i == 0) | (_hash_of(e) != _hash_of(F.get(F.col("__entries"), i - 1))))
    df = df.withColumn(name, F.slice(first, 1, SKETCH))
    whole = F.array(_entry(F.xxhash64("__pairs"), 0))
    return df.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(whole)).drop("__pairs", "__entries")


def as_text(sketch: str) -> Column:
    """A fingerprint as hexadecimal text: 10 digits of each hash and 6 of its place."""
    return F.concat_ws("", F.transform(sketch, lambda e: F.lpad(F.hex(e), 16, "0")))


def likeness(a: str, b: str) -> Column:
    """Share of anchors that two texts have in common at one distance (Dice), estimated from the
    smallest hashes of both; exact while neither has more than 64.

    Of the hashes in both texts, those count whose places lie the commonest distance apart: the longest
    run of equal distances, in order."""
    hashes = {x: F.transform(x, _hash_of) for x in (a, b)}
    smallest = F.slice(F.sort_array(F.array_union(hashes[a], hashes[b])), 1, SKETCH)
    both = F.array_intersect(smallest, F.array_intersect(hashes[a], hashes[b]))
    found = F.struct(both.alias("inside"), F.size(smallest).alias("smallest"))
    # A lambda works out what it refers to for each entry; bound by an outer one it is worked out once.
    return F.get(F.transform(F.array(found), lambda f: _in_place(a, b, f["inside"], f["smallest"])), 0)


def _in_place(a: str, b: str, inside: Column, smallest: Column) -> Column:
    """Dice over the hashes ``inside`` both that agree on the commonest distance."""
    # Entries ascend by hash, so those of the hashes in both stand in the same order in a and b.
    mine, theirs = (F.filter(x, lambda e: F.array_contains(inside, _hash_of(e))) for x in (a, b))
    places = F.lit((1 << PLACE_BITS) - 1).cast("long")
    apart = F.sort_array(F.zip_with(mine, theirs, lambda x, y: (x - y).bitwiseAND(places)))
    start = F.struct(F.lit(-1).cast("long").alias("at"), F.lit(0).alias("run"), F.lit(0).alias("longest"))

    def step(acc: Column, d: Column) -> Column:
        run = F.when(acc["at"] == d, acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(d.alias("at"), run.alias("run"), F.greatest(acc["longest"], run).alias("longest"))

    shared = F.aggregate(apart, start, step, lambda acc: acc["longest"])
    return (2.0 * shared / F.greatest(shared + smallest, F.lit(1))).cast("double")


def neighbours(keys: DataFrame) -> DataFrame:
    """For distinct (doc_id, mark, need): the row before it in ascending order (after the last
    comes the first), as before_id, before_mark, and that row's need.

    Ranges of doc_id are ordered side by side; only the first and last row of each range meet
    in one place."""
    keys = keys.distinct()
    ranges = 1 + keys.count() // EDGE_ROWS
    parts = staged(keys.repartitionByRange(ranges, "doc_id").withColumn("part", F.spark_partition_id()), "ranges")
    row = F.struct("doc_id", "mark", "need")
    inside = Window.partitionBy("part").orderBy("doc_id", "mark")
    lasts = parts.groupBy("part").agg(F.max(row).alias("last"))
    lasts = lasts.withColumn("edge", F.lag("last").over(Window.orderBy("part")))
    end = lasts.agg(F.max(F.struct("part", "last")).alias("m")).select(F.col("m.last").alias("end"))
    # One row per range, a number fixed by the row count: bounded.
    edges = lasts.join(F.broadcast(end)).select("part", F.coalesce("edge", "end").alias("edge"))
    found = parts.withColumn("before", F.lag(row).over(inside)).join(F.broadcast(edges), "part")
    before = F.coalesce("before", "edge")
    return found.select(
        "doc_id", "mark", before["doc_id"].alias("before_id"), before["mark"].alias("before_mark"), before["need"].alias("need")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts (the last quarter replaced by the
    start of the next document).

    Returns per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.  A null text is empty; empty texts are alike.  Equal (doc_id, text) rows count once in the
    order and give equal rows; rows with one doc_id are ordered by a hash of their text, rows
    without doc_id come first.  Other columns are not read."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    docs = docs.withColumn("mark", F.xxhash64("text"))
    before = neighbours(docs.select("doc_id", "mark", F.floor(F.length("text") / 4).cast("int").alias("need")))
    own = with_sketch(docs, "text", "sketch")
    key = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.mark") == F.col("k.mark"))
    # What a document gives to the one before it: the start it needs, and its fingerprint.
    given = own.alias("d").join(before.alias("k"), key).select(
        "before_id", "before_mark", F.expr("substring(text, 1, need)").alias("given"), F.col("sketch").alias("next_sketch")
    ).dropDuplicates(["before_id", "before_mark"])
    met = own.alias("d").join(given.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.before_id")) & (F.col("d.mark") == F.col("g.before_mark")))
    met = met.withColumn("n_chars", F.length("text").cast("long"))
    kept = F.expr("substring(text, 1, CAST(n_chars - floor(n_chars / 4) AS INT))")
    met = met.select("doc_id", "n_chars", "sketch", "next_sketch", F.concat(kept, F.col("given")).alias("edited"))
    met = with_sketch(met, "edited", "edited_sketch")
    return met.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"), as_text("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"), likeness("sketch", "next_sketch").alias("near_next"),
    )
