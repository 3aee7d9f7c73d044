"""Repair of conversation structure as a lightest derivation.

Rows of a conversation are axioms ``Row(i)``.  An item ``State(i, p)`` says that i rows are
consumed and the last row put out has the initial p (empty: none yet).  Edits are deductions:

    State(i, p), Row(i)  ->  State(i + 1, q)     keep, rerole or delete the row
    State(i, p)          ->  State(i, q)         insert an empty row
    State(n, p)          ->  Goal                p empty or "a"

The weight of an item is (cost, audit), the audit being the initials of the edits so far.  Each
deduction adds to the cost and appends to the audit.  That is monotone and never makes a weight
smaller, so popping the lightest item of an agenda finalises it, and the search ends with the goal.
(Appending keeps the order of two audits unless one begins with the other; audits of one item
that cost the same hold an edit for each of the same rows, and so never do.)

Rows come sorted by conversation and turn and stream through a task.  A conversation longer
than CHUNK rows (or CHUNK_BYTES of text) is deduced chunk by chunk: the final items at the end
of a chunk are the axioms of the next, each with the running hash of what it has put out.  So
memory does not grow with a conversation, but for its audit of one byte a row."""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barwright.llm.common import ship

CHUNK, CHUNK_BYTES = 256, 8_000_000
ROLE_OF = {"u": "user", "a": "assistant"}
AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}  # initials that may follow
LEGAL = ("su", "ua", "au")
BLANKS = " \t\n\x0b\x0c\r"


# --- damage and faults ----------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage, with ``copy`` (1 for a repeat) and ``gone`` (dropped rows stay
    marked, so that no conversation is lost).  Nulls of role and text become one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind, role, text = F.col("__kind"), F.coalesce("role", space), F.coalesce("text", space)
    return (
        conversations.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("__kind"))
        .select(
            "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            (kind == 0).alias("gone"),
            F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """``fault``: blank, duplicate, truncated or empty, the first that holds.  Rows of one
    turn are ordered by role, text and copy."""
    solid = F.rtrim("text", F.lit(BLANKS))
    same = Window.partitionBy("conv_id", "role", "__mark", "gone").orderBy(*in_order())
    dealt = rows.withColumn("__mark", F.sha2("text", 256)).repartition("conv_id")
    return dealt.withColumn("__seen", F.row_number().over(same) > 1).withColumn("__solid", solid).select(
        "conv_id", "turn", "role", "text", "copy", "gone",
        F.when(F.col("gone"), "").when(F.length("__solid") == 0, "blank").when(F.col("__seen"), "duplicate")
        .when(~F.substring("__solid", -1, 1).isin(".", "!", "?"), "truncated").otherwise("").alias("fault"),
    )


def in_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]


# --- derivation ------------------------------------------------------------------------


@dataclass(frozen=True)
class Row:
    role: str
    text: str
    fault: str


@dataclass
class Axiom:
    """A final item at the border of two chunks: its weight is (cost, rank, lead), where the
    rank orders the audits up to the last consumed row and the lead holds the inserts after
    it; ``digest`` is the hash of what was put out and ``audit`` the linked pieces."""

    cost: int = 0
    rank: int = 0
    lead: str = ""
    digest: object = field(default_factory=hashlib.sha256)
    any_out: bool = False
    audit: tuple | None = None

    def put(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.any_out else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.any_out = True


def deductions(i: int, p: str, rows: list[Row]):
    """What follows from State(i, p): (cost, letter, i, p) of each conclusion."""
    if i < len(rows):
        row = rows[i]
        cut = int(row.fault == "truncated")
        yield 3, "D", i + 1, p
        if row.fault not in ("blank", "duplicate"):
            if row.role[:1] and row.role[:1] in AFTER[p]:
                yield cut, "K", i + 1, row.role[:1]
            for q in AFTER[p]:
                if q in ROLE_OF:
                    yield 2 + cut, "R", i + 1, q
    for q in AFTER[p]:
        if q in ROLE_OF:
            yield 2, "I", i, q


def lightest(rows: list[Row], axioms: dict[str, Axiom], last: bool) -> dict[str, tuple[int, int, str, str]]:
    """Final weights (cost, rank, audit) and first states of the items after all rows; for the
    last chunk only that which reaches the goal."""
    agenda = [(a.cost, a.rank, a.lead, 0, p, p) for p, a in axioms.items()]
    heapq.heapify(agenda)
    final, ends = set(), {}
    while agenda:
        cost, rank, audit, i, p, source = heapq.heappop(agenda)
        if (i, p) in final:
            continue
        final.add((i, p))
        if i == len(rows):
            ends[p] = (cost, rank, audit, source)
            if last and p in ("", "a"):  # the goal weighs what its premise weighs
                return {p: ends[p]}
        for more, letter, j, q in deductions(i, p, rows):
            if (j, q) not in final:
                heapq.heappush(agenda, (cost + more, rank, audit + letter, j, q, source))
    return ends


def concluded(rows: list[Row], axioms: dict[str, Axiom], last: bool) -> dict[str, Axiom]:
    """The items after a chunk as axioms of the next one."""
    ends = lightest(rows, axioms, last)
    bases = sorted({(rank, audit.rstrip("I")) for _, rank, audit, _ in ends.values()})
    out = {}
    for p, (cost, rank, audit, source) in ends.items():
        begin, base = axioms[source], audit.rstrip("I")
        a = Axiom(cost, bases.index((rank, base)), audit[len(base) :], begin.digest.copy(), begin.any_out, (begin.audit, base))
        i, state = 0, source
        for letter in audit[len(begin.lead) :]:
            if letter in "KR":
                state = rows[i].role[:1] if letter == "K" else next(q for q in AFTER[state] if q in ROLE_OF)
                a.put(rows[i].role if letter == "K" else ROLE_OF[state], rows[i].text)
            elif letter == "I":
                state = next(q for q in AFTER[state] if q in ROLE_OF)
                a.put(ROLE_OF[state], "")
            i += letter != "I"
        out[p] = a
    return out


class Conversation:
    """Counts and repair of one conversation whose rows arrive in order."""

    def __init__(self, conv_id):
        self.conv_id, self.pending, self.bytes = conv_id, [], 0
        self.axioms = {"": Axiom()}
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.first = self.latest = None
        self.turns, self.before = 0, None

    def add(self, turn, row: Row) -> None:
        if len(self.pending) >= CHUNK or self.bytes >= CHUNK_BYTES:
            self.axioms = concluded(self.pending, self.axioms, last=False)
            self.pending, self.bytes = [], 0
        self.pending.append(row)
        self.bytes += len(row.text)
        if row.fault:
            self.counts[row.fault] += 1
        if self.before is not None and self.before + row.role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.before = row.role[:1]
        if turn is not None and turn != self.latest:
            self.first = turn if self.first is None else self.first
            self.latest = turn
            self.turns += 1

    def result(self) -> tuple:
        (end,) = concluded(self.pending, self.axioms, last=True).values()
        pieces, link = [end.lead], end.audit
        while link is not None:
            pieces.append(link[1])
            link = link[0]
        gaps = 0 if self.first is None else self.latest - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.counts.values(), end.cost, "".join(reversed(pieces)), end.digest.hexdigest())


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    Rows without conv_id form one conversation; rows of one turn, null turns first, are ordered
    by role and text; repeated rows are rows of their own (and so duplicates).  A conversation
    without rows after the damage has zeros and the hash of nothing.  Texts of any length are
    taken whole.  Other columns are not read; an empty table gives no row.

    A conversation's rows pass through one task in their order, as its hash runs over its whole
    repaired text; the task keeps one chunk of them at a time."""
    ship(conversations.sparkSession)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    rows = with_faults(damaged(conversations)).withColumn("turn", F.col("turn").cast("long"))
    rows = rows.sortWithinPartitions("conv_id", *in_order())

    def repaired(batches):
        now = None
        for batch in batches:
            done = []
            for conv, turn, role, text, gone, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "fault")), strict=True):
                if now is None or conv != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(conv)
                if not gone:
                    now.add(turn, Row(role, text, fault))
            if done:
                yield as_batch(done)
        if now is not None:
            yield as_batch([now.result()])

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    names, types = arrow.names, arrow.types
    return rows.select("conv_id", "turn", "role", "text", "gone", "fault").mapInArrow(repaired, schema)
