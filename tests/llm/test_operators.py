"""Text operators against plain versions, and on nulls, empty texts, repeated rows, empty
tables and extra columns whose names clash with results."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from barwright.llm import (
    components, decontaminate, hyperminhash, language, licences, packing, quality, queries, ring, syncmers, token_blocks, tokens, warc,
)
from barwright.llm.common import chosen_by_hash, shingle_sets, text_bytes
from barwright.session import new_workspace

# Names that operators use for results or inside.
EXTRA = "shard int, slot int, score double, lang_pred string, component_id int, n int, key string, sequence_id int, mark int, hashes int, seed int"


def rows_of(spark, texts, first_id=0):
    """Documents with clashing extra columns; a text may come with its own id."""
    pairs = [t if isinstance(t, tuple) else (i + first_id, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(*p, *[None] * 11) for p in pairs], f"doc_id long, text string, {EXTRA}")


WORDS = "the and of alpha beta gamma delta house river mountain small large green paper window".split()


def prose(seed, n):
    dice = np.random.default_rng(seed)
    return " ".join(dice.choice(WORDS, n)) + f" {seed}."


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, ties, repeated rows, a long text, other scripts."""
    long = " ".join(prose(i, 40) for i in range(150))
    texts = [prose(1, 50), None, "", "  \n\t", prose(1, 50), long, "x", "Ça va? L'été, d'accord!", "日本語 テキスト", "don't 's 12   x"]
    texts += [(None, "no id"), (3, "  \n\t"), (20, "same row"), (20, "same row"), (21, "the"), (22, "a | b | c")]
    return rows_of(spark, texts).cache()


@pytest.fixture(scope="module")
def none(spark):
    return rows_of(spark, [])


def test_ids_are_those_of_the_whole_text():
    pieces = ["don't it's 'll", "a　 b", "  x  y\n\n z \t", "×.÷,é. é, É!", "", "日本語 ok", "a<|endoftext|>b", "a\n\n\nb \r\n d", "l'été 12.5,x"]
    encoder = tokens.Encoder(queries.VOCABULARY)
    import pyarrow as pa

    ids, count = encoder.encode(*text_bytes(pa.array(pieces)))
    library = Tokenizer.from_file(queries.VOCABULARY)
    pieces += ["<|endoftext|>", " <|endoftext|> x", "<|endoftext|><|endoftext|>.", "don't<|endoftext|>'s", "<|endof", "text|>", "é<|endoftext|>É  <|endoftext|>\n\n"]
    ids, count = encoder.encode(*text_bytes(pa.array(pieces)))
    want = [library.encode(p, add_special_tokens=False).ids for p in pieces]
    assert library.token_to_id("<|endoftext|>") in sum(want, [])
    assert count.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("top", [1, 300, 50_000, 2**32 - 1])
def test_blocks_round_trip(size, top):
    dice = np.random.default_rng(size)
    ids = dice.integers(0, top, size, dtype=np.uint64).astype(np.uint32)
    ids[dice.random(size) < 0.02] = top - 1
    parts = token_blocks.encode_blocks(ids, 0.9)
    assert np.array_equal(token_blocks.decode_blocks(*parts)[:size], ids)
    if size > 300:
        assert np.array_equal(token_blocks.ids_between(parts, 250, 300), ids[250:300])


def test_token_files(spark, odd, none):
    tk = Tokenizer.from_file(queries.VOCABULARY)
    for docs in (odd, none):
        place = f"{new_workspace(spark)}/ids"
        token_blocks.write_token_files(docs, place, queries.VOCABULARY)
        got = token_blocks.with_global_start(token_blocks.read_token_files(spark, place)).orderBy("start").collect()
        want = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        start = 0
        assert len(got) == len(want)
        for g, (doc_id, text) in zip(got, want):
            ids = tk.encode(text, add_special_tokens=False).ids + [0]
            assert (g.doc_id, g.start, g.n_tokens, g.ids) == (doc_id, start, len(ids), ids)
            assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            start += len(ids)


def test_files_are_ordered_by_their_numbers(spark):
    rows = spark.range(99_990, 100_011).selectExpr("concat('part-', lpad(id, if(id < 100000, 5, 6), '0'), '-x.txt') as file", "id as doc_id", "5L as n_tokens", "0L as file_start")
    got = token_blocks.with_global_start(rows).orderBy("doc_id").collect()
    assert [r.start for r in got] == [5 * i for i in range(21)]


def test_packing(spark, odd, none):
    assert packing.packed_documents(none, queries.VOCABULARY).count() == 0
    tk = Tokenizer.from_file(queries.VOCABULARY)
    got = packing.packed_documents(odd, queries.VOCABULARY, capacity=64).collect()
    by_doc = collections.defaultdict(list)
    by_sequence = collections.defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) <= 64 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for r in odd.where("doc_id NOT IN (3, 20) AND doc_id IS NOT NULL").collect():
        ids = tk.encode(r.text or "", add_special_tokens=False).ids + [2]
        own = sorted(by_doc[r.doc_id], key=lambda p: p.piece)
        assert sum((p.ids for p in own), []) == ids and [p.piece for p in own] == list(range(-(-len(ids) // 64)))
        assert all(p.length == 64 for p in own[1:])
    assert len(by_doc[20]) == 2
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64


def test_sequences_hold_the_pieces(spark, odd, none):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    packed = packing.packed_documents(odd, queries.VOCABULARY, capacity=64).cache()
    built = packing.sequences(packed)
    got = packing.pieces_of(built)
    assert sorted(map(repr, got.select(names).collect())) == sorted(map(repr, packed.select(names).collect()))
    assert all(len(r.ids) <= 64 and len(r.doc_ids) == len(r.pieces) for r in built.collect())
    assert packing.pieces_of(packing.sequences(packing.packed_documents(none, queries.VOCABULARY))).count() == 0


def test_blocks_and_the_second_round_lose_nothing(spark, monkeypatch):
    docs = rows_of(spark, [prose(i, int(n)) for i, n in enumerate(np.random.default_rng(5).integers(1, 120, 300))] + [(None, None), (3, prose(3, 9))])
    library = Tokenizer.from_file(queries.VOCABULARY)
    want = collections.Counter()
    for r in docs.collect():
        want[r.doc_id] += len(library.encode(r.text or "", add_special_tokens=False).ids) + 1
    sizes = []
    for block in (200, 3000, 10**7):
        monkeypatch.setattr(packing, "BLOCK_IDS", block)
        built = packing.packed_sequences(docs, queries.VOCABULARY, capacity=128).cache()
        got = packing.pieces_of(built).collect()
        held = collections.Counter()
        for r in got:
            held[r.doc_id] += r.length
        assert held == want and built.select("sequence_id").distinct().count() == built.count()
        for r in built.collect():
            at = 0
            for p in r.pieces:
                assert p.offset == at
                at += p.length
            assert at == len(r.ids) <= 128
        sizes.append(built.count())
    assert max(sizes) <= 1.03 * -(-sum(want.values()) // 128)


def test_queries_run_their_whole_job(spark, sf_dir, monkeypatch):
    seen = []
    build, write = packing.sequences, ring.write_shards
    monkeypatch.setattr(packing, "sequences", lambda p: seen.append(p.columns) or build(p))
    monkeypatch.setattr(ring, "write_shards", lambda p, place: seen.append(p.columns) or write(p, place))
    docs = queries.table(spark, sf_dir, "documents").where("doc_id IS NOT NULL").limit(20)
    queries.op4_packing(spark, sf_dir)
    got = queries.op6_ring(spark, sf_dir)
    last = corpus_pipeline.best_fit_packing(spark, docs, sf_dir)
    assert "ids" in seen[0] and "text" in seen[1] and "ids" in last.columns
    want = {(r.doc_id, zlib.crc32((r.text or "").encode())) for r in docs.collect()}
    assert want <= {(r.doc_id, r.text_crc32) for r in got.collect()}


def test_plan_is_near_the_bound():
    dice = np.random.default_rng(3)
    counts = collections.Counter(dice.integers(1, 1025, 20_000).tolist())
    plan = packing.Plan(dict(counts), 1024)
    assert sum(r[2] for r in plan.runs) == 20_000
    assert plan.sequences <= 1.02 * sum(s * n for s, n in counts.items()) / 1024 + 1
    assert packing.Plan({342: 2, 340: 1}, 1024).sequences == 1


def brute_groups(texts, k, percent):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    name = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]:
                old, new = max(name[a], name[b]), min(name[a], name[b])
                name = {i: new if n == old else n for i, n in name.items()}
    return {i: (len(s), name[i], name[i] == i) for i, s in sets.items()}


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, odd, none, k, percent):
    dice = np.random.default_rng(5)
    texts = {r.doc_id: r.text for r in odd.where("doc_id IS NOT NULL").collect()}
    base = [f"w{i}" for i in dice.integers(0, 3000, 200)]
    for i in range(100, 190):  # a large group of edits, many of them near the threshold
        edited = list(base)
        for j in dice.choice(200, int(dice.integers(1, 14)), replace=False):
            edited[j] = f"x{dice.integers(0, 100_000)}"
        texts[i] = " ".join(edited)
    for i in range(190, 230):  # edits of edits
        edited = texts[100 + i % 40].split()
        edited[int(dice.integers(0, 200))] = f"y{i}"
        texts[i] = " ".join(edited)
    for i in range(230, 270):  # one long passage in otherwise different texts
        texts[i] = " ".join(base[:150] + [f"z{x}" for x in dice.integers(0, 100_000, 60)])
    texts |= {i: texts[100] for i in range(270, 280)}
    docs = rows_of(spark, [*texts.items(), (20, "same row")])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in hyperminhash.near_duplicates(docs, k, percent).collect()}
    assert got == brute_groups(texts, k, percent)
    lost = hyperminhash.near_duplicates(docs.where("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long")), k, percent).collect()
    assert [(r.component_id, r.kept) for r in lost] == [(None, True)]
    assert hyperminhash.near_duplicates(none, k, percent).count() == 0


def near(text, mark):
    return " ".join([*text.split()[:-1], mark])


def test_several_texts_of_one_document(spark):
    a, b, c, d = ([f"{x}{i}" for i in range(120)] for x in "abcd")
    a, b, c, d = (" ".join(x) for x in (a, b, c, d))
    texts = [(7, a), (7, b), (9, near(a, "x")), (11, near(b, "y")), (12, c), (12, d), (3, d), (20, a + " " + c)]
    got = {(r.doc_id, r.component_id, r.kept) for r in hyperminhash.near_duplicates(rows_of(spark, texts), 3, 85).collect()}
    assert got == {(7, 7, True), (9, 7, False), (11, 7, False), (12, 3, False), (3, 3, True), (20, 20, True)}


def test_stage_judges_each_text(spark, sf_dir):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(120)) for x in "abcd")
    texts = [(7, a), (7, b), (7, b), (9, near(a, "x")), (9, c), (3, near(b, "y")), (12, d), (None, d)]
    docs = spark.createDataFrame([(*t, "en", "s", 1) for t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()
    assert collections.Counter((r.doc_id, r.text) for r in kept) == collections.Counter([(7, a), (9, c), (3, near(b, "y")), (12, d), (None, d)])


def test_estimate_follows_jaccard():
    dice = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.9):
        pool = dice.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2)
        n = int(4000 * share)
        cut = n + (4000 - n) // 2
        a, b = np.unique(pool[:cut]), np.unique(np.concatenate([pool[:n], pool[cut:]]))
        j, _ = hyperminhash.estimate(hyperminhash.registers(a)[None], hyperminhash.registers(b)[None])
        assert abs(j[0] - share) < 0.12


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 51)} | {100 + i: 100 for i in range(1, 40)} | {201: 200}


def test_shingles_of_short_rows():
    import pyarrow as pa

    data = text_bytes(pa.array(["a b", "A\tB ", "a", "", None, "a b c d", " b c d"]))
    sets = [s.tolist() for s in shingle_sets(*data, 3)]
    assert sets[0] == sets[1] != sets[2] and sets[3] == sets[4] == [] and len(sets[5]) == 2 and set(sets[6]) <= set(sets[5])


def test_fingerprints_match_by_place(spark):
    """A text with its passages in another order, one moved as a whole, and a plain count of the matches."""
    import random

    pick = random.Random(5)
    words = lambda n: " ".join(f"w{pick.randrange(10**6)}" for _ in range(n))
    passages = [words(20) for _ in range(4)]
    rows = [(0, " ".join(passages), " ".join(reversed(passages))), (1, " ".join(passages), words(9) + " " + " ".join(passages)),
            (2, passages[0], passages[0]), (3, passages[0], words(20)), (4, "", "")]
    df = spark.createDataFrame(rows, "doc_id long, a string, b string")
    for side in "ab":
        df = syncmers.anchors(syncmers.with_sketch(df, side, f"s{side}"), side, f"places_{side}")
    got = {r.doc_id: r for r in df.withColumn("near", syncmers.likeness("sa", "sb")).collect()}
    for r in list(got.values())[:4]:
        sides = []
        for anchors in (r.places_a, r.places_b):
            first = {}
            for x in anchors:
                first.setdefault(x.hash >> syncmers.PLACE_BITS, x.position)
            sides.append(first)
        mine, theirs = sides
        small = sorted({*mine, *theirs})[: syncmers.SKETCH]
        apart = [mine[h] - theirs[h] for h in small if h in mine and h in theirs]
        shared = max((apart.count(d) for d in apart), default=0)
        assert abs(r.near - 2 * shared / (shared + len(small))) < 1e-12, r.doc_id
    assert got[0].near < 0.5 < 0.75 < got[1].near < 1 and got[2].near == got[4].near == 1.0 and got[3].near < 0.2


def test_common_hashes_are_worked_out_once(spark):
    """Not for each entry: what a lambda refers to is evaluated with every call of it."""
    df = spark.createDataFrame([([1 << 24], [1 << 24])], "sa array<long>, sb array<long>").select(syncmers.likeness("sa", "sb").alias("near"))
    for call in df._jdf.queryExecution().optimizedPlan().toString().split("array_contains(")[1:]:
        assert not call.startswith("array_intersect")


def test_fingerprints(spark, odd, none):
    docs = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in syncmers.fingerprints(docs).collect()}
    order = sorted((r.doc_id, r.text or "") for r in docs.collect())
    for i, (doc_id, text) in enumerate(order):
        after, n = order[(i + 1) % len(order)][1], len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        assert got[doc_id].n_chars == len(text) and got[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[doc_id].near_edited <= 1 and 0 <= got[doc_id].near_next <= 1
    assert got[0].fingerprint == got[4].fingerprint != got[5].fingerprint and got[1].fingerprint == got[2].fingerprint
    assert got[0].near_edited > 0.5 > got[0].near_next and got[1].near_next == 1.0
    assert syncmers.fingerprints(odd).count() == odd.count() and syncmers.fingerprints(none).count() == 0


def test_anchors_survive_edits_elsewhere(spark):
    text = prose(9, 120)
    docs = rows_of(spark, [text, "new words in front " + text])
    a, b = (({h["hash"]: h["position"] for h in r.anchors}) for r in syncmers.anchors(docs.select("doc_id", "text")).orderBy("doc_id").collect())
    common = set(a) & set(b)
    assert len(common) > 0.9 * len(a)
    shifts = collections.Counter(b[h] - a[h] for h in common)
    assert shifts.most_common(1)[0][0] == 4


def test_no_python_on_native_paths(spark, odd):
    bench = spark.createDataFrame([(1, prose(1, 50))], "item_id long, text string")
    frames = [syncmers.fingerprints(odd), decontaminate.overlaps(odd, bench), ring.shard_rows(odd.select("doc_id", "text"), "doc_id")]
    frames.append(licences.scan(odd, licences.train(odd)))
    for df in frames:
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_decontamination(spark, odd, none):
    item = prose(500, 30)
    changed = item.split()
    changed[6], changed[15], changed[24] = "one", "two", "three"
    texts = [f"{prose(7, 20)}\n{item} {prose(8, 10)}", f"{prose(9, 20)} {' '.join(changed)}", prose(10, 80), item.upper(), f"x {item}", f"x {item}"]
    docs = rows_of(spark, texts).unionByName(odd.withColumn("doc_id", F.col("doc_id") + 100))
    bench = spark.createDataFrame(
        [(1, item, 0), (2, prose(600, 25), 0), (3, None, 0), (4, "the and", 0), (1, item, 0), (None, item, 0)], "item_id long, text string, doc_id int"
    )
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    short = {r.doc_id for r in docs.collect() if " the and " in f" {' '.join(re.findall(r'[^\W_]+', (r.text or '').lower()))} "}
    assert set(got) == {(d, i) for d in (0, 1, 3, 4, 5) for i in (1, None)} | {(d, 4) for d in short}
    assert all(got[d, 4].overlap_tokens == 2 for d in short)
    got = {k: r for k, r in got.items() if k[1] != 4}
    assert got[0, 1].matched_tokens == got[0, 1].item_tokens and got[1, 1].share < 1
    kept = {r.doc_id for r in decontaminate.without_contaminated(docs, bench).collect()}
    assert not kept & {0, 1, 3, 4, 5} and 2 in kept and not kept & short and None in kept
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.without_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_rows_go_for_their_own_text(spark):
    item = prose(500, 30)
    texts = [(None, f"x {item}"), (None, prose(10, 80)), (None, None), (7, f"y {item}"), (7, prose(11, 80)), (8, prose(12, 80))]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontaminate.without_contaminated(rows_of(spark, texts), bench).collect()
    assert collections.Counter((r.doc_id, r.text) for r in kept) == collections.Counter([texts[1], texts[2], texts[4], texts[5]])


def test_masks_cover_the_rule():
    for n in range(decontaminate.MIN_ITEM, decontaminate.REACH + 1):
        for gone in itertools.combinations(range(n), n - -(-4 * n // 5)):
            row = "".join("0" if p in gone else "1" for p in range(n))
            assert any(re.search(m.replace("0", "."), row) for m in decontaminate.MASKS), row


def brute_stretches(words, item, least, share):
    out = set()
    for shift in range(-len(item), len(words)):
        same = [0 <= p + shift < len(words) and item[p] == words[p + shift] for p in range(len(item))]
        low, high = max(0, -shift), min(len(item), len(words) - shift)
        spans = [(a, b) for a in range(low, high) for b in range(a + least, high + 1) if sum(same[a:b]) / (b - a) >= share]
        whole = [(a, b) for a, b in spans if not any(c <= a and b <= d and (a, b) != (c, d) for c, d in spans)]
        out |= {(a + shift, b - a, sum(same[a:b])) for a, b in whole}
    return out


def test_overlaps_against_brute_force(spark):
    dice = np.random.default_rng(11)
    items = {i: [f"i{i}w{j}" for j in range(n)] for i, n in enumerate([8, 9, 10, 11, 12, 15, 20, 40, 100, 7])}
    items[9] += items[0][:3]  # two items with a few tokens in common
    texts = {0: items[8][:30] + [f"o{j}" for j in range(40)] + items[8][70:]}
    for d in range(1, 200):
        item = items[int(dice.integers(0, 10))]
        a = int(dice.integers(0, max(1, len(item) - 11)))
        part = item[a : a + int(dice.integers(8, 30))]
        for j in dice.choice(len(part), int(dice.integers(0, 1 + len(part) // 4)), replace=False):
            part[j] = f"x{j}"
        texts[d] = [f"f{j}" for j in range(d % 4)] + part + [f"g{j}" for j in range(d % 3)]
    docs = rows_of(spark, [(d, " ".join(w)) for d, w in texts.items()])
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.start, r.length, r.matched) for r in decontaminate.overlaps(docs, bench).collect()}
    want = {
        (d, i, *s) for d, w in texts.items() for i, t in items.items() if len(t) >= decontaminate.MIN_ITEM
        for s in brute_stretches(w, t, min(12, len(t)), 0.8)
    }
    assert got == want and len({w[:2] for w in want}) > 80
    assert sorted(s[2:] for s in want if s[:2] == (0, 8))[0][1] >= 30


def test_blocks_of_a_large_benchmark(spark, odd, monkeypatch):
    bench = spark.createDataFrame([(i, prose(i, 30)) for i in range(20)], "item_id long, text string")
    docs = rows_of(spark, [f"{prose(90 + i, 10)} {prose(i, 30)}" for i in range(20)])
    whole = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 300)
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == whole and len(whole) == 20


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_ring(spark, odd, none, slack):
    docs = odd.unionByName(rows_of(spark, [prose(i, 3) for i in range(500)], 1000))
    got = ring.shard_rows(docs, "doc_id", 16, 64, slack).collect()
    counts = collections.Counter(r.shard for r in got)
    assert len(got) == docs.count()
    if slack:
        assert max(counts.values()) <= -(-1.25 * len(got) // 16)
    else:
        assert max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    assert ring.shard_rows(none, "doc_id").count() == 0


def test_ring_equals_a_walk_row_by_row(spark):
    docs = spark.createDataFrame(
        [(None if i % 3 == 0 else i % 150, prose(i % 400, 3)) for i in range(900)] + [(7, "same")] * 40, "doc_id long, text string"
    )
    placed = docs.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(ring.SLOTS)).cast("int"))
    nodes, room = ring.ring(5, 16), ring.capacities(940, 5, 0.0)
    want = collections.Counter()
    for place in sorted(r.place for r in placed.collect()):  # key by key, clockwise from its place
        at = next((i for i, (p, _) in enumerate(nodes) if p >= place), len(nodes))
        while not room[nodes[at % len(nodes)][1]]:
            at += 1
        room[nodes[at % len(nodes)][1]] -= 1
        want[place, nodes[at % len(nodes)][1]] += 1
    for task_bytes in (10**9, 900, 1):  # one task, a hot place in several tasks, as fine as it gets
        sharded = ring.shard_rows(placed, "doc_id", 5, 16, 0.0, task_bytes)
        got = sharded.collect()
        assert collections.Counter((r.place, r.shard) for r in got) == want
        assert all(sorted(r.slot for r in got if r.shard == s) == list(range(188)) for s in range(5))
        assert sorted(map(repr, (r.text for r in got))) == sorted(map(repr, (r.text for r in docs.collect())))
    place = f"{new_workspace(spark)}/shards"
    ring.write_shards(sharded, place)
    assert sorted(map(repr, spark.read.parquet(place).select(*sharded.columns).collect())) == sorted(map(repr, got))


def test_ring_moves_little_with_room():
    counts = {p: 3 for p in range(0, ring.SLOTS, 5)}
    assert ring.moved(counts, 16, 64, 0.25) < 0.2


def test_quality(spark, odd, none):
    good = [". ".join(prose(i * 7 + j, 8).capitalize() for j in range(4)) for i in range(60)]
    bad = [" ".join(f"{w}$$$" for w in prose(i, 30).split()) for i in range(60)]
    docs = rows_of(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)] + [(None, 1, 0), (5, None, 0), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).where(language.held_out(F.col("doc_id"))).collect()}
    assert got and all((s >= 0.7) == (i < 60) for i, s in got.items())
    ends = {r.doc_id: r.score for r in quality.score(odd.where("doc_id IN (1, 2, 3)"), model).collect()}
    assert set(ends.values()) == {0.0}
    assert quality.score(odd, model).count() == odd.count() and quality.score(none, model).count() == 0
    assert quality.train(docs, labels.limit(0)) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}


def test_marginals_against_enumeration():
    dice = np.random.default_rng(1)
    first = np.array([0, 1, 1, 5, 8])
    score, change = dice.normal(size=8), dice.normal(size=(2, 2))
    good, pairs = quality.marginals(score, first, change)
    want, want_pairs = np.zeros(8), np.zeros((2, 2))
    for a, b in zip(first, first[1:]):
        total, mass = 0.0, []
        for code in range(2 ** (b - a)):
            y = [(code >> i) & 1 for i in range(b - a)]
            weight = np.exp(sum(score[a + i] * y[i] for i in range(b - a)) + sum(change[p, q] for p, q in zip(y, y[1:])))
            total += weight
            mass.append((weight, y))
        for weight, y in mass if b > a else []:
            want[a:b] += weight / total * np.array(y)
            for p, q in zip(y, y[1:]):
                want_pairs[p, q] += weight / total
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs)


def test_language(spark, odd, none):
    vocabulary = {"aa": ["kiru", "tomi", "sela", "pana"], "bb": ["grund", "stark", "wolf", "haus"], "cc": ["oiseau", "belle", "jour", "nuit"]}
    dice = np.random.default_rng(4)
    table = [(i, " ".join(dice.choice(vocabulary[c], 30)), c) for i, c in enumerate(list(vocabulary) * 20)]
    docs = spark.createDataFrame(table + [(900, None, "aa"), (901, "pana", None), (None, "sela", "aa")], "doc_id long, text string, lang string")
    model = language.train(docs)
    got = {r.doc_id: (r.lang_pred, r.lang) for r in language.identify(docs, model).collect() if r.doc_id is not None}
    assert all(p == lang for i, (p, lang) in got.items() if i < 900) and got[900][0] == "und" and got[901][0] == "aa"
    # words never seen: their n-grams decide
    assert language.scored(model, ["Starkhaus wolfgrund", "oiseaux belles"])[0] == ["bb", "cc"]
    assert language.scored(model, [None, "", "12 ?!", "日本"])[0][:3] == ["und"] * 3
    assert language.identify(odd, model).count() == odd.count() and language.identify(none, model).count() == 0
    empty = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, empty).collect()} == {"und"}


def test_chosen_by_hash(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).alias("g"))
    got = chosen_by_hash(df, "g", 40).collect()
    assert collections.Counter(r.g for r in got) == {True: 40, False: 40}
    assert chosen_by_hash(df, "g", 2000).count() == 1000


def test_warc(spark):
    big, other = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 80, "y" * 1200
    table = [(1, "http://a\r\nX: y", big), (5, None, big), (3, "u3", big), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", other),
             (None, "u", other), (8, "u", other), (8, "u", other)]
    pages = spark.createDataFrame([(*r, "z", "z") for r in table], "page_id long, url string, html string, refers_to string, original string")
    resolved = warc.resolve_revisits(pages.withColumn("record_type", F.lit(1)))
    assert resolved.count() == len(table) and {r.original for r in resolved.collect()} == {"z"}
    place = f"{new_workspace(spark)}/warc"
    warc.write_archives(pages, place, "2020-01-01T00:00:00Z")
    rows = warc.with_originals(warc.read_archives(spark, place), ("content_bytes", "html"))
    got = sorted(((r.page_id, r.html, r.payload_digest, r.record_type, r.refers_to, r.content_bytes) for r in rows.collect()), key=str)
    want = []
    for page, _, html in table:
        html = html or ""
        top = {big: 5, other: 8}.get(html)
        kind = "revisit" if top is not None and top != page else "response"
        want.append((page, html, hashlib.sha1(html.encode()).hexdigest(), kind, top if kind == "revisit" else None, len(html.encode())))
    assert got == sorted(want, key=str)
    empty = f"{new_workspace(spark)}/warc"
    warc.write_archives(pages.limit(0), empty, "2020-01-01T00:00:00Z")
    assert warc.read_archives(spark, empty).count() == 0


def test_licences(spark, odd, none):
    model = licences.train(odd)
    lines = {
        "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under CC BY-SA 4.0.": "cc-by-sa",
        "This work is licensed under the GNU General Public License, version 3.": "gpl", "© 2020 River Works. All rights reserved.": "proprietary",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Mit der Zeit wird alles gut.": None,
        "You need a driving license to rent a car.": None, "The public library is general and free.": None,
    }
    docs = rows_of(spark, [f"{prose(i, 12)}\n{line}\n{prose(i + 50, 12)}" for i, line in enumerate(lines)] * 2)
    got = {(r.doc_id, r.paragraph): r for r in licences.scan(docs, model).collect()}
    want = {(i + 9 * c, 1): f for c in (0, 1) for i, f in enumerate(lines.values()) if f}
    assert {k: r.family for k, r in got.items()} == want and all(r.confirmed for r in got.values())
    assert licences.scan(odd, model).count() == 0 and licences.scan(none, model).count() == 0
    assert licences.scan(docs.unionByName(docs), model).count() == len(want)


WRAPPED = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at""",
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
}


def test_wrapped_licences(spark):
    model = licences.train(spark.createDataFrame([(1, prose(1, 30))], "doc_id long, text string"))
    texts = []
    for text in WRAPPED.values():
        texts += [f"{prose(3, 12)}\n\n{text}\n\n{prose(4, 12)}", " ".join(text.split())]
    got = collections.defaultdict(list)
    for r in licences.scan(rows_of(spark, texts), model).collect():
        got[r.doc_id].append(r)
    for i, family in enumerate(WRAPPED):
        (wrapped,), (flat,) = got[2 * i], got[2 * i + 1]
        assert flat.family.startswith(family) and wrapped.family == flat.family
        assert wrapped.confirmed == flat.confirmed and wrapped.template_share == flat.template_share
        assert (wrapped.paragraph, flat.paragraph, flat.lines) == (2, 0, 1) and wrapped.lines > 1


def test_short_items_are_found_whole(spark):
    dice = np.random.default_rng(8)
    texts = [" ".join(dice.choice(WORDS, int(n))) for n in dice.integers(0, 30, 60)] + ["", None, "The,  of", "what is\nthe Capital city of France?"]
    items = [(n, " ".join(dice.choice(WORDS, n))) for n in range(1, 8)] + [(20, "what is the capital city of france"), (21, "of"), (22, "..."), (23, None)]
    docs, bench = rows_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    word = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = set()
    for i, t in enumerate(texts):
        for item, b in items:
            have, asked = word(t), word(b)
            if asked and any(have[k : k + len(asked)] == asked for k in range(len(have))):
                want.add((i, item, len(asked)))
    got = [(r.doc_id, r.item_id, r.overlap_tokens) for r in decontaminate.contaminated(docs, bench).collect()]
    assert len(got) == len(set(got)) and set(got) == want and (len(texts) - 1, 20, 7) in want


def plain_language(docs, min_count=2):
    """The word-first model from plain counts, as a function of a text."""
    import math

    words_in = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang in docs:
        counts[lang].update(words_in(text))
    langs = sorted(counts)

    def logs(tables):
        keys = {k for c in tables.values() for k in c}
        raw = {k: [math.log(tables[x][k] + 0.5) - math.log(sum(tables[x].values()) + 0.5 * len(keys)) for x in langs] for k in keys}
        return {k: [v - sum(r) / len(r) for v in r] for k, r in raw.items()}

    often = {w for c in counts.values() for w in c if sum(counts[x][w] for x in langs) >= min_count}
    known = logs({x: collections.Counter({w: n for w, n in counts[x].items() if w in often}) for x in langs})
    grams = {}
    for n in (4, 3, 2, 1):
        tables = {x: collections.Counter() for x in langs}
        for x in langs:
            for w, many in counts[x].items():
                for i in range(len(w) - n + 1):
                    tables[x][w[i : i + n]] += many
        grams[n] = logs(tables)

    def score(text):
        total = [0.0] * len(langs)
        for w in words_in(text):
            value = known.get(w)
            if value is None:
                per_char = [next((grams[n][w[i : i + n]] for n in (4, 3, 2, 1) if i + n <= len(w) and w[i : i + n] in grams[n]), [0.0] * len(langs)) for i in range(len(w))]
                value = [sum(c) / len(w) for c in zip(*per_char, strict=True)]
            total = [a + b for a, b in zip(total, value, strict=True)]
        top = max(total)
        chance = [math.exp(v - top) for v in total]
        best = chance.index(max(chance))
        return (langs[best], chance[best] / sum(chance)) if words_in(text) else ("und", 0.0)

    return score


def test_language_equals_plain_scoring(spark):
    dice = np.random.default_rng(6)
    letters = {"aa": "kirutomsela", "bb": "grundstwolfha", "cc": "oiseaublnt"}
    make = lambda c, n: " ".join("".join(dice.choice(list(letters[c]), int(k))) for k in dice.integers(1, 6, n))
    rows = [(i, make(c, 25), c) for i, c in enumerate(list(letters) * 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    plain = plain_language(learned)
    asked = [make(c, 4) for c in list(letters) * 10] + ["zzz q", "Kiru GRUND", "", "12 34", "日本 oiseau"]
    found, score = language.scored(model, asked)
    for text, lang, s in zip(asked, found, score, strict=True):
        want, chance = plain(text)
        assert s == pytest.approx(chance, abs=1e-3) and (lang == want or chance < 0.5)


def test_licences_equal_plain_scoring(spark):
    from barwright.llm.licence_texts import TEMPLATES

    model = licences.train(spark.createDataFrame([(1, prose(1, 30))], "doc_id long, text string"))
    dice = np.random.default_rng(9)
    every = [t for texts in TEMPLATES.values() for t in texts]
    lines = [" ".join(w for w in t.split() if dice.random() > 0.25) for t in every for _ in range(2)] + [prose(5, 20), "", "software license"]
    want = []
    for i, line in enumerate(lines):
        found = licences.words(line)
        if not set(found) & set(model.markers):
            continue
        hits = [model.weights[g] for g in licences.grams(found) if g in model.weights]
        if not hits:
            continue
        score = [(sum(round(h[c], 6) for h in hits) + b) / model.temperature for c, b in enumerate(model.bias)]
        chance = np.exp(np.array(score) - max(score))
        chance /= chance.sum()
        family = model.classes[int(chance.argmax())]
        if family == licences.UNKNOWN or chance.max() < 0.8:
            continue
        pairs = {" ".join(found[k : k + 2]) for k in range(max(1, len(found) - 1))}
        shares = []
        for t in TEMPLATES[family]:
            w = licences.words(t)
            own = {" ".join(w[k : k + 2]) for k in range(max(1, len(w) - 1))}
            shares.append(len(own & pairs) / len(own))
        want.append((i, family, pytest.approx(float(chance.max()), abs=1e-5), pytest.approx(max(shares))))
    got = sorted((r.doc_id, r.family, r.probability, r.template_share) for r in licences.scan(rows_of(spark, lines), model).collect())
    assert len(want) > 20 and len(got) == len(want) and all(g == w for g, w in zip(got, want, strict=True))


def test_blocks_leave_in_batches_of_few_ids():
    """The rows do not depend on it: ids, pieces and places of a block in any batches."""
    lengths = np.array([1024] * 300 + [700, 300, 24] * 150 + [9] * 40)
    block = {
        "doc_id": np.arange(len(lengths)), "known": np.arange(len(lengths)) % 7 > 0, "piece": np.zeros(len(lengths), np.int32),
        "start": np.zeros(len(lengths), np.int64), "length": lengths, "ids": np.arange(lengths.sum(), dtype=np.uint32),
    }
    batches, n = packing.block_sequences(block, 1024)
    batches = list(batches)
    sizes = [len(b.column("ids").flatten()) for b in batches]
    assert len(batches) > 1 and max(sizes) <= packing.BATCH_IDS + 1024 and sum(sizes) == lengths.sum()
    begin = np.append(0, np.cumsum(lengths))
    names, docs = [], []
    for r in (r for b in batches for r in b.to_pylist()):
        names += [r["sequence_id"]] if r["done"] else []
        for p in r["pieces"]:
            found = r["ids"][p["offset"]: p["offset"] + p["length"]]
            docs.append(found[0])
            at = int(np.searchsorted(begin, found[0]))
            assert found == list(range(begin[at], begin[at + 1])) and p["doc_id"] == (at if at % 7 else None)
    assert sorted(docs) == begin[:-1].tolist() and len(set(names)) == len(names) and max(names) < n


def test_classes_with_edits_of_their_own_form_no_pairs(spark):
    """300 classes just off their pivot, each with other changes, and two that link: without the bound by
    places nearly all pairs meet at a part that many of them lack."""
    import random

    from barwright.llm.hyperminhash import _candidates

    rng, pivot = random.Random(5), range(100)
    sets = []
    for i in range(300):
        gone = set(rng.sample(pivot, 13))
        sets.append(set(pivot) - gone | {1000 * (i + 1) + j for j in range(13)})
    sets.append(set(sets[7]) - {7000, 8000} | {5})
    made = [(0, i + 1, len(x), 100, i + 1, True, sorted(x ^ set(pivot))) for i, x in enumerate(sets)]
    apart = spark.createDataFrame(made, "pivot long, node long, n long, pivot_n long, component long, outside boolean, parts array<long>")
    found = {(r["a"], r["b"]) for r in _candidates(apart, 80).collect()}
    links = {(i + 1, j + 1) for i, x in enumerate(sets) for j, y in enumerate(sets) if i < j and 100 * len(x & y) >= 80 * len(x | y)}
    assert links and links <= found and len(found) < 300
