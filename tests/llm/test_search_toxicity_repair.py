"""Ball-tree search and conversation repair against brute force, toxicity on held-out rows, and
all three on nulls, empty texts, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwright.llm import ball_tree, queries, repair, toxicity

EXTRA = "score long, rank int, item int, terms int, n int, counts int, label int, part int, fault string, copy int, gone int, __mark int"
NONE = [None] * 12


# --- search ---------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(docs, items, k=10):
    counts = [(d, collections.Counter(terms_of(t))) for d, t in docs]
    n_docs, total = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, c in counts:
            score = 0
            for t in terms_of(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (25 + (75 * sum(c.values()) * n_docs) // total)))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def ranked(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, *NONE) for r in docs], f"doc_id long, text string, {EXTRA}")
    q = spark.createDataFrame([(*r, *NONE) for r in items], f"item_id long, text string, {EXTRA}")
    got = ball_tree.rank(d, q, **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    dice = np.random.default_rng(1)
    words = ["the", "of", *[f"w{i}" for i in range(60)], "Été", "日本語", "A1"]
    share = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(dice.choice(words, n, p=share / share.sum()))
    docs = [(i, text(int(dice.integers(1, 60)))) for i in range(300)]
    docs += [(i + 300, docs[5][1]) for i in range(30)] + [(None, docs[5][1]), (7, docs[7][1]), (900, None), (901, ""), (902, "... !?"), (903, text(20_000))]
    items = [(i, text(12)) for i in range(25)] + [(3, "w1 w2"), (3, "w1 w2"), (None, "été w5"), (50, None), (51, ""), (52, "nobody says this"), (53, docs[5][1])]
    want = sorted(plain_ranks(docs, items), key=str)
    assert ranked(spark, docs, items) == want
    assert ranked(spark, docs, items, block_bytes=200) == want  # several blocks
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == []


def test_trees_prune_and_lose_nothing():
    dice = np.random.default_rng(2)
    groups = [dice.choice(400, 12, replace=False) for _ in range(40)]
    rows = [np.sort(dice.choice(groups[i % 40], 8, replace=False)) for i in range(2000)]
    first = np.arange(len(rows) + 1) * 8
    values = dice.integers(1, 1_000_000, 16_000)
    tree = ball_tree.Tree(list(range(2000)), first, np.concatenate(rows), values)
    scored = 0
    for g in groups[:10]:
        best = ball_tree.Best(10)
        terms, counts = np.sort(g), np.arange(1, 13)
        scored += tree.search(terms, counts, best)
        weight = np.zeros(400, np.int64)
        weight[terms] = counts
        every = [(-int(weight[r] @ values[8 * i : 8 * i + 8]), False, i) for i, r in enumerate(rows)]
        assert best.rows == sorted(x for x in every if x[0] < 0)[:10]
    assert scored < 0.5 * 10 * 2000


def test_vocabulary_confirms_bytes():
    v = ball_tree.Vocabulary([b"abc", b"abd", b"x"])
    data = np.frombuffer(b"abc x abd abcd", np.uint8)
    which, number = v.find(data, np.array([0, 4, 6, 10]), np.array([3, 5, 9, 14]))
    assert which.tolist() == [0, 1, 2] and number.tolist() == [0, 2, 1]
    v.data = np.frombuffer(b"abcabex", np.uint8)  # a hash that fits and bytes that do not
    assert v.find(data, np.array([0, 6]), np.array([3, 9]))[0].tolist() == [0]


# --- toxicity --------------------------------------------------------------------------


def test_risk_never_goes_below_zero():
    for loss in (toxicity.LOGISTIC, toxicity.BOUNDED):
        toxic, other = np.array([2.0, -1.0]), np.array([0.5, -3.0, 1.0])

        def risk(t, u, loss=loss):
            clean = loss.clean(u).mean() - 0.3 * loss.clean(t).mean()
            return clean if clean < 0 else 0.3 * loss.clean(-t).mean() + clean

        for other_scores in (other, other - 9):
            up = risk(toxic, other_scores) >= 0 and loss.clean(other_scores).mean() - 0.3 * loss.clean(toxic).mean() >= 0
            got = toxicity.risk_gradient(toxic, other_scores, 0.3, loss)
            for side in (0, 1):
                for i in range((2, 3)[side]):
                    step = np.zeros((2, 3)[side])
                    step[i] = 1e-6
                    a = risk(toxic + step * (side == 0) if side == 0 else toxic, other_scores + step if side else other_scores)
                    b = risk(toxic - step * (side == 0) if side == 0 else toxic, other_scores - step if side else other_scores)
                    slope = (a - b) / 2e-6
                    assert got[side][i] == pytest.approx(slope if up else -slope, abs=1e-6)


def test_toxicity(spark):
    dice = np.random.default_rng(3)
    words = [f"{a}{b}" for a in ("ran", "hou", "tree", "wat", "gold") for b in ("ing", "se", "er", "ton", "lo", "mi")]
    bad = ["idiot", "scumbag", "scumlike", "moron"]
    docs, labels = [], []
    for i in range(1500):
        text = list(dice.choice(words, int(dice.integers(10, 200))))
        toxic = i % 7 == 0
        if toxic:
            text[:4] = dice.choice(bad, 4)
        docs.append((i, " ".join(dice.permutation(text)), *NONE))
        if i % 3:
            labels.append((i, int(toxic), 1))
    docs += [(None, "idiot", *NONE), (5000, None, *NONE), (5001, "", *NONE), (5002, "12 !!", *NONE), (0, docs[0][1], *NONE)]
    d = spark.createDataFrame(docs, f"doc_id long, text string, {EXTRA}")
    known = spark.createDataFrame(labels + [(None, 1, 1), (3, None, 0), (4, 0, 0)], "doc_id long, toxic int, quality int")
    model = toxicity.train(d, known)
    scored = toxicity.score(d, model)
    assert scored.columns == [*[c for c in d.columns if c != "score"], "score"]
    got = [(r.doc_id, r.score) for r in scored.collect()]
    assert len(got) == len(docs) and all(0 <= s <= 1 for _, s in got)
    fresh = [(i, s) for i, s in got if i is not None and i < 1500 and zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= 0.5) == (i % 7 == 0) for i, s in fresh]) > 0.97
    by_id = collections.defaultdict(list)
    for i, s in got:
        by_id[i].append(s)
    assert by_id[0][0] == by_id[0][1] and by_id[5000] == by_id[5001] == by_id[5002] and by_id[5001][0] < 0.5 < by_id[None][0]
    # the labels of clean documents and of the held-out fold are not learned from
    turned = known.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert [r.score for r in toxicity.score(d, toxicity.train(d, turned)).collect()] == [s for _, s in got]
    assert toxicity.score(d.limit(0), model).count() == 0
    assert toxicity.train(d.limit(0), known) is None and toxicity.train(d, known.limit(0)) is None
    assert {r.score for r in toxicity.score(d, None).collect()} == {0.0}
    long = spark.createDataFrame([(1, " ".join(words * 4000)), (2, " ".join(words * 4000 + bad * 2000))], "doc_id long, text string")
    one, two = (r.score for r in toxicity.score(long, model).orderBy("doc_id").collect())
    assert one < 0.5 < two


def test_held_out_toxicity_of_the_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in queries.table(spark, sf, "labels").collect()}
    rows = [r for r in queries.op12_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.93


# --- repair -----------------------------------------------------------------------------


def cheapest(rows):
    """Lightest (cost, audit, output) over all edit sequences with at most three inserts at a place."""
    best = None

    def step(i, cost, audit, out, inserts):
        nonlocal best
        if cost > (best[0] if best else 3 * len(rows)):  # deleting all rows costs no more
            return
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] if r[:1] in ("s", "u", "a") else "x" for r, _ in out)):
                best = min(best or (cost, audit, out), (cost, audit, out))
        else:
            role, text, fault = rows[i]
            cut = int(fault == "truncated")
            step(i + 1, cost + 3, audit + "D", out, 0)
            if fault not in ("blank", "duplicate"):
                step(i + 1, cost + cut, audit + "K", [*out, (role, text)], 0)
                for new in ("user", "assistant"):
                    step(i + 1, cost + 2 + cut, audit + "R", [*out, (new, text)], 0)
        if inserts < 2:
            for new in ("user", "assistant"):
                step(i, cost + 2, audit + "I", [*out, (new, "")], inserts + 1)

    step(0, 0, "", [], 0)
    return best


def plain_repair(table):
    """(conv_id, ...) results row by row, with the derivation by enumeration."""
    out = []
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in rows if t is not None}
        seen, faults = set(), []
        for _, role, text in rows:
            solid = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, put = cheapest([(r, t, f) for (_, r, t), f in zip(rows, faults, strict=True)])
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in put).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n):
    dice = np.random.default_rng(seed)
    roles, texts = ["user", "assistant", "system", "user", "assistant", None, "tool", ""], ["Hi.", "Yes!", "no end", None, "", " \t", "Ça va?\n", "a."]
    table = []
    for conv in range(n):
        for turn in range(int(dice.integers(0, 5))):
            table.append((conv, None if dice.random() < 0.1 else int(turn + dice.integers(0, 2)), roles[dice.integers(8)], texts[dice.integers(8)]))
    return table


def repaired(spark, table):
    df = spark.createDataFrame([(*r, *NONE) for r in table], f"conv_id long, turn long, role string, text string, {EXTRA}")
    return sorted(map(tuple, repair.repair(df).collect()), key=str)


def test_repair_equals_enumeration(spark):
    table = conversations(1, 100) + [(None, 0, "user", "who?"), (None, 1, "assistant", "me."), (None, None, None, None)]
    assert repaired(spark, table) == plain_repair(table)
    table = table[:20] + table[:20]  # repeated rows
    assert repaired(spark, table[:10] + table[20:25]) == plain_repair(table[:10] + table[20:25])
    assert repaired(spark, []) == []


@pytest.mark.parametrize("chunk", [1, 2, 3])
def test_chunks_do_not_change_a_repair(monkeypatch, chunk):
    dice = np.random.default_rng(chunk)
    kinds = [(r, t, f) for r in ("user", "assistant", "system", "tool", "") for t, f in (("x.", ""), ("y", "truncated"), ("", "blank"), ("x.", "duplicate"))]
    for _ in range(400):
        rows = [repair.Row(*kinds[dice.integers(len(kinds))]) for _ in range(int(dice.integers(0, 14)))]
        results = []
        for size in (1000, chunk):
            monkeypatch.setattr(repair, "CHUNK", size)
            c = repair.Conversation(1)
            for i, row in enumerate(rows):
                c.add(i, row)
            results.append(c.result())
        assert results[0] == results[1], rows


def test_conversations_across_batches(spark):
    table = [(7, t, ("user", "assistant")[t % 2], f"row {t}.") for t in range(3000)] + [(8, 0, "user", "x" * 300_000 + "."), (8, 1, "assistant", "y.")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        (long, short) = sorted(repaired(spark, table))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert long[0] == 7 and len(long[7].replace("I", "")) == sum(
        (0, 1, 1, 2)[(0, 3).index(k) * 3 if k in (0, 3) else 1] for k in (zlib.crc32(f"7:{t}".encode()) % 20 for t in range(3000))
    )
    assert short[0] == 8
