"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``SLOTS`` places.  Every shard owns ``vnodes`` of them, chosen by hash; a key
belongs to the first virtual node at or after its place.  A shard takes no more than its
capacity; what comes after that goes on clockwise to the next virtual node whose shard still
has room.

Keys of one place are interchangeable for the walk, so it runs over the number of keys of each
place (``SLOTS`` numbers, whatever the table holds).  It yields runs: the keys of a place from
one rank to another go to a shard and take a run of its slots.  Each row then finds its run by
its rank in its place.

Rows move once.  One pass counts rows by place and by a hash of the row.  A place with more rows than
a task should get is cut into salts, ranges of that hash, whose first ranks follow from the counts;
tasks are runs of salts in the order of the shards, so a task's rows mostly belong to one shard and
can be written from where they are ranked.  Everything on rows is built-in Spark expressions."""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwright.llm.common import staged

SLOTS = 1 << 13
MARKS = 1 << 10  # finest cut of a place
TASK_BYTES = 64_000_000


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes, clockwise; a place has one owner."""
    owner: dict[int, int] = {}
    for v in range(vnodes):
        for s in range(shards):
            place = int.from_bytes(hashlib.sha256(f"shard {s} node {v}".encode()).digest()[:8], "big") % SLOTS
            owner.setdefault(place, s)
    for s in range(shards):  # a shard that lost all its places still gets one
        if s not in owner.values():
            owner[next(p for p in range(SLOTS) if p not in owner)] = s
    return sorted(owner.items())


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Bounded loads: at most (1 + slack) times the mean.  Without slack the capacities sum
    to the total, so counts differ by one at most."""
    if slack:
        return [math.ceil((1 + slack) * total / shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def walk(counts: dict[int, int], shards: int, vnodes: int, slack: float) -> list[tuple[int, int, int, int, int]]:
    """Runs (place, from rank, to rank, shard, first slot).  Places are served clockwise from
    0; inside a place, keys by rank."""
    nodes = ring(shards, vnodes)
    places = [p for p, _ in nodes]
    room = capacities(sum(counts.values()), shards, slack)
    used = [0] * shards
    runs = []
    for place in sorted(counts):
        left, rank, at = counts[place], 0, bisect_left(places, place)
        while left:
            shard = nodes[at % len(nodes)][1]
            n = min(left, room[shard] - used[shard])
            if n:
                runs.append((place, rank, rank + n, shard, used[shard]))
                used[shard] += n
                rank, left = rank + n, left - n
            at += 1
    return runs


def shard_rows(
    df: DataFrame, key: str, shards: int = 16, vnodes: int = 64, slack: float = 0.0, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 in each shard) to all rows.

    Rows are keys: equal keys share a place on the ring and are ranked in it by a hash of the
    whole row, so ties are rows that are equal (they may take each other's slot and stay in one
    task).  A null key has a place of its own hash; null and empty texts are rows like others, and
    no column is cut however long.  An empty table stays empty.  The table has to be readable
    again with the same rows.  Only ``key`` decides the place; columns of ``df`` that are named
    shard or slot are replaced."""
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    plain = [f for f in df.schema.fields if f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    rows = df.withColumns({
        "__place": F.pmod(F.xxhash64(F.col(key)), F.lit(SLOTS)).cast("int"), "__mark": F.xxhash64(*[f.name for f in plain]),
    })
    fine = F.pmod("__mark", F.lit(MARKS)).cast("int")
    size = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) for f in plain if f.dataType.typeName() == "string"), F.lit(8 * len(df.columns)))
    # At most SLOTS * MARKS rows, whatever the table holds.
    counted = staged(
        rows.select("__place", fine.alias("__fine"), size.alias("b")).groupBy("__place", "__fine").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")),
        "counts",
    )
    places = counted.groupBy("__place").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).collect()  # SLOTS rows at most
    counts = {r["__place"]: r["n"] for r in places}
    total, volume = sum(counts.values()), sum(r["b"] for r in places)
    per_task = max(1, int(total * task_bytes / max(1, volume)))
    runs = walk(counts, shards, vnodes, slack)
    home: dict[int, int] = {}
    for place, _, _, shard, _ in runs:
        home.setdefault(place, shard)
    before, cuts = 0, []
    for place in sorted(counts, key=lambda p: (home[p], p)):  # tasks follow the shards
        cuts.append((place, min(MARKS, -(-counts[place] // per_task)), before))
        before += counts[place]
    cut = _values(spark, "__place int, __salts int, __before long", cuts)
    run = _values(spark, "__place int, __from long, __to long, shard int, __first long", runs)
    salt = F.floor(F.col("__fine") * F.col("__salts") / MARKS).cast("int")
    earlier = Window.partitionBy("__place").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    salts = (
        counted.join(F.broadcast(cut), "__place").withColumn("__salt", salt)
        .groupBy("__place", "__salt", "__before").agg(F.sum("n").alias("n"))
        .withColumn("__base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .select("__place", "__salt", "__base", F.floor((F.col("__before") + F.col("__base")) / per_task).cast("int").alias("__task"))
    )
    # SLOTS rows and one for each task's worth of rows, at most SLOTS * MARKS; two numbers each.
    dealt = rows.join(F.broadcast(cut.drop("__before")), "__place").withColumn("__fine", fine).withColumn("__salt", salt)
    dealt = dealt.join(F.broadcast(salts), ["__place", "__salt"]).repartition(max(1, -(-total // per_task)), "__task")
    order = Window.partitionBy("__task", "__place", "__salt").orderBy("__mark")
    ranked = dealt.withColumn("__rank", F.col("__base") + F.row_number().over(order) - 1)
    inside = (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to"))
    # SLOTS + shards * vnodes runs at most.
    found = ranked.join(F.broadcast(run), (ranked["__place"] == run["__place"]) & inside)
    return found.select(*df.columns, "shard", (F.col("__first") + F.col("__rank") - F.col("__from")).alias("slot"))


def _values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table made by the driver."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    text = ", ".join("(" + ", ".join(f"{v}L" if k == "long" else str(v) for v, k in zip(r, kinds, strict=True)) + ")" for r in rows)
    text = text or "(" + ", ".join("null" for _ in names) + ")"
    cast = ", ".join(f"cast({n} as {k}) as {n}" for n, k in zip(names, kinds, strict=True))
    return spark.sql(f"SELECT {cast} FROM VALUES {text} AS t({', '.join(names)})")


def moved(counts: dict[int, int], shards: int, vnodes: int, slack: float) -> float:
    """Share of keys that one more shard moves, by the same walk."""

    def share(n: int) -> dict[tuple[int, int], int]:
        return {(p, r): s for p, a, b, s, _ in walk(counts, n, vnodes, slack) for r in range(a, b)}

    old, new = share(shards), share(shards + 1)
    return sum(old[k] != new[k] for k in old) / max(1, len(old))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows of a file by slot.  Rows are written by the tasks that ranked
    them, each some ``task_bytes`` large."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
