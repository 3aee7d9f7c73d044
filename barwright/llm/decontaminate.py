"""Benchmark decontamination by spaced seeds.

Seeds of all windows of the training texts are joined with those of the benchmark.  A hit only
names an alignment of a document and an item; there the tokens are compared one by one, and
every stretch with enough equal tokens is an overlap.  Two masks find every stretch that the
default rule allows: four tokens in a row, and five with one ignored between (tests try all
places of the unequal tokens).

Tokens are lower-cased runs of letters and digits, so line breaks and punctuation play no part.
Everything is built from DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import staged

MASKS = ("1111", "111011")
SPAN = 4  # of the shortest mask; a longer one has windows past the end, where fewer tokens count
MIN_ITEM = 8  # tokens of the shortest item that is found by seeds; shorter ones are compared whole
REACH = 23  # a stretch by the rule holds one of at most so many tokens, or is one
BLOCK_SEEDS = 200_000  # seeds sent to all tasks at once; a larger benchmark is joined in blocks


def tokens(text: str) -> Column:
    found = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(found, lambda t: t != "")


def _seeds(hashes: str) -> Column:
    """Seeds of all windows, mask after mask."""
    windows = F.when(F.size(hashes) >= SPAN, F.sequence(F.lit(0), F.size(hashes) - SPAN)).otherwise(F.array().cast("array<int>"))

    def seed(mask: str):
        taken = [j for j, c in enumerate(mask) if c == "1"]
        return lambda i: F.xxhash64(F.lit(mask), *[F.get(F.col(hashes), i + j) for j in taken])

    return F.concat(*[F.transform(windows, seed(m)) for m in MASKS])


def _with_seeds(df: DataFrame, *keep: str) -> DataFrame:
    """One row per window and mask: seed, and the window's place.  The outer form of the
    explode keeps Spark from adding a filter on the arrays, which would compute them anew for
    each element; a text without windows gives one null seed, which joins nothing."""
    df = df.withColumn("hashes", F.transform(tokens("text"), lambda t: F.xxhash64(t)))
    df = df.withColumn("windows", F.size("hashes") - SPAN + 1).withColumn("seeds", _seeds("hashes"))
    return df.select(*keep, "windows", F.posexplode_outer("seeds").alias("i", "seed")).select(*keep, "seed", (F.col("i") % F.col("windows")).alias("place"))


def overlaps(docs: DataFrame, benchmark: DataFrame, min_tokens: int = 12, min_share: float = 0.8) -> DataFrame:
    """Overlaps of documents and benchmark items: doc_id, mark (hash of the document's text),
    item_id, start (token of the document), length, matched, share, item_tokens.

    A stretch of an alignment counts if it has at least ``min_tokens`` tokens, or the whole item
    where that is shorter, and at least ``min_share`` of them are equal in place.  Reported are
    the stretches that lie in no longer one that counts.  Seeds find all of them at the default
    rule and at stricter ones; a looser rule may miss some.  An item with fewer than
    eight tokens overlaps where all of them are found in a row, unchanged; its first place is
    reported.  Null or empty texts, and texts without a token, overlap with nothing.  Rows without doc_id or item_id are compared like others.  A
    repeated document row (same id and text) yields the overlaps once, as does a repeated
    item.  Other columns are not read."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    items = benchmark.select("item_id", "text").distinct()
    items = items.withColumn("item", tokens("text"))
    items = items.withColumn("item_mark", F.xxhash64("text")).withColumn("item_tokens", F.size("item"))
    items = staged(items.where("item_tokens > 0"), "items")
    brief = _whole_items(docs, items.where(F.col("item_tokens") < MIN_ITEM))
    items = items.where(F.col("item_tokens") >= MIN_ITEM)
    seeds = _with_seeds(items.select("item_id", "item_mark", "item_tokens", "text"), "item_id", "item_mark", "item_tokens")
    seeds = staged(seeds.where("seed IS NOT NULL").distinct(), "seeds")
    blocks = max(1, -(-seeds.count() // BLOCK_SEEDS))
    windows = _with_seeds(docs, "doc_id", "mark").withColumnRenamed("place", "doc_place")
    hits = None
    for b in range(blocks):
        # Bounded: about BLOCK_SEEDS rows by construction.
        part = F.broadcast(seeds.where(F.pmod("seed", F.lit(blocks)) == b))
        found = windows.join(part, "seed")
        hits = found if hits is None else hits.unionByName(found)
    region = hits.groupBy("doc_id", "mark", "item_id", "item_mark", "item_tokens", (F.col("doc_place") - F.col("place")).alias("shift"))
    # Written first, so Spark knows its size when it chooses how to fetch the texts.
    regions = staged(region.agg(F.collect_set("place").alias("places")), "regions")
    wanted = regions.select("doc_id", "mark").distinct()
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["mark"] == wanted["mark"]), "left_semi")
    texts = texts.dropDuplicates(["doc_id", "mark"]).select("doc_id", "mark", tokens("text").alias("words"))
    r, t, i = regions.alias("r"), texts.alias("t"), items.select("item_id", "item_mark", "item").alias("i")
    both = r.join(t, F.col("r.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("r.mark") == F.col("t.mark")))
    both = both.join(i, F.col("r.item_id").eqNullSafe(F.col("i.item_id")) & (F.col("r.item_mark") == F.col("i.item_mark")))
    both = both.select("r.doc_id", "r.mark", "r.item_id", "item_tokens", "shift", "places", "item", "words")
    least = F.least(F.lit(min_tokens), F.col("item_tokens"))
    both = both.withColumn("low", F.greatest(F.lit(0), -F.col("shift"))).withColumn("least", least)
    both = both.withColumn("high", F.least(F.col("item_tokens"), F.size("words") - F.col("shift")))
    both = both.where(F.col("high") - F.col("low") >= F.col("least"))
    # Cheap and without loss: by the hit there are as many equal tokens as the shortest stretch needs.
    by_hit = lambda p: F.sequence(F.greatest("low", p - REACH), F.least(F.col("high") - 1, p + REACH))
    both = both.where(F.exists("places", lambda p: F.size(F.filter(by_hit(p), _equal)) >= F.ceil(min_share * F.col("least") - 1e-9)))
    both = both.withColumn("cuts", F.filter(F.sequence("low", F.col("high") - 1), lambda p: ~_equal(p)))
    both = both.withColumn("cuts", F.concat(F.array(F.col("low") - 1), "cuts", F.array("high")))
    found = both.withColumn("found", F.explode(_stretches("cuts", min_share)))
    found = found.select(
        "doc_id", "mark", "item_id", (F.col("found.first") + F.col("shift")).alias("start"), F.col("found.length").alias("length"),
        F.col("found.matched").alias("matched"), (F.col("found.matched") / F.col("found.length")).alias("share"), "item_tokens",
    )
    found = found.distinct()
    return found if brief is None else found.unionByName(brief)


def _whole_items(docs: DataFrame, items: DataFrame) -> DataFrame | None:
    """Documents that hold all tokens of a short item in a row; None if there is no such item.  The
    windows of the lengths that occur are joined by hash, and the tokens are compared."""
    lengths = sorted(r[0] for r in items.select("item_tokens").distinct().collect())  # at most seven
    if not lengths:
        return None
    blocks = max(1, -(-items.count() // BLOCK_SEEDS))

    def whole(words: str, n: int):
        return lambda i: F.struct(i.alias("start"), F.lit(n).alias("n"), F.xxhash64(*[F.get(F.col(words), i + j) for j in range(n)]).alias("whole"))

    def windows(n: int) -> Column:
        none = F.array().cast("array<struct<start:int,n:int,whole:bigint>>")
        return F.when(F.size("words") >= n, F.transform(F.sequence(F.lit(0), F.size("words") - n), whole("words", n))).otherwise(none)

    cut = docs.withColumn("words", tokens("text")).select("doc_id", "mark", "words", F.explode_outer(F.concat(*[windows(n) for n in lengths])).alias("w"))
    cut = cut.select("doc_id", "mark", "w.*", F.slice("words", F.col("w.start") + 1, F.col("w.n")).alias("here"))
    hashed = F.coalesce(*[F.when(F.col("item_tokens") == n, F.xxhash64(*[F.get("item", F.lit(j)) for j in range(n)])) for n in lengths])
    names = items.select("item_id", "item_mark", "item", "item_tokens", hashed.alias("whole"))
    found = None
    for b in range(blocks):
        # Bounded: about BLOCK_SEEDS items by construction.
        part = F.broadcast(names.where(F.pmod("whole", F.lit(blocks)) == b))
        hits = cut.join(part, "whole").where(F.col("here") == F.col("item"))
        found = hits if found is None else found.unionByName(hits)
    # One row per text and item however often a phrase occurs, formed before the exchange.
    first = found.groupBy("doc_id", "mark", "item_id", "item_mark", "item_tokens").agg(F.min("start").alias("start"))
    length = F.col("item_tokens").cast("int")
    return first.select("doc_id", "mark", "item_id", "start", length.alias("length"), length.alias("matched"), F.lit(1.0).alias("share"), "item_tokens")


def _equal(p: Column) -> Column:
    return F.coalesce(F.get("item", p) == F.get("words", p + F.col("shift")), F.lit(False))


def _stretches(cuts: str, min_share: float) -> Column:
    """Stretches (first, length, matched) between two of the cuts, which are the unequal tokens
    and both ends.  For each cut, in order, the furthest one that still makes a stretch; if it
    is no further than that of an earlier cut, the stretch lies in a longer one."""
    at = lambda k: F.get(cuts, k)
    last = F.size(cuts) - 1

    def further(state: Column, a: Column) -> Column:
        length = lambda b: at(b) - at(a) - 1
        matched = lambda b: length(b) - (b - a - 1)
        enough = lambda b: (length(b) >= F.col("least")) & (matched(b) / length(b) >= min_share)
        after = F.greatest(state["end"], a) + 1
        ends = F.when(after <= last, F.sequence(after, last)).otherwise(F.array().cast("array<int>"))
        b = F.array_max(F.filter(ends, enough))
        one = F.transform(F.filter(F.array(b), lambda x: x.isNotNull()), lambda x: F.struct(
            (at(a) + 1).cast("int").alias("first"), length(x).cast("int").alias("length"), matched(x).cast("int").alias("matched")
        ))
        return F.struct(F.coalesce(b, state["end"]).alias("end"), F.concat(state["out"], one).alias("out"))

    none = F.array().cast("array<struct<first:int,length:int,matched:int>>")
    start = F.struct(F.lit(-1).alias("end"), none.alias("out"))
    return F.aggregate(F.sequence(F.lit(0), last), start, further, lambda state: state["out"])


def contaminated(docs: DataFrame, benchmark: DataFrame, **rule) -> DataFrame:
    """Pairs (doc_id, item_id) with their longest overlap: overlap_tokens, matched_tokens,
    share, item_tokens."""
    best = F.max(F.struct("matched", "length", "share")).alias("b")
    pairs = overlaps(docs, benchmark, **rule).groupBy("doc_id", "item_id", "item_tokens").agg(best)
    return pairs.select(
        "doc_id", "item_id", F.col("b.length").alias("overlap_tokens"), F.col("b.matched").alias("matched_tokens"), F.col("b.share").alias("share"), "item_tokens"
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **rule) -> DataFrame:
    """The rows without any overlap.  A row goes for its own text only: other rows of its
    doc_id, or other rows without doc_id, are judged by theirs.  Null and empty texts stay, repeated
    rows have one fate, and an empty benchmark removes nothing."""
    found = overlaps(docs, benchmark, **rule).select(F.col("doc_id").alias("bad_id"), F.col("mark").alias("bad_mark"))
    bad = staged(found.distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_mark"])
    return docs.join(bad, same, "left_anti")
