"""Every registered text query on the small tables; SQL twins where they exist."""

import os

import duckdb
import pytest

import corpus_pipeline
from barwright.llm import queries

COLUMNS = {
    "op1_token_blocks": "doc_id start n_tokens ids_crc32",
    "op2_syncmers": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3_hyperminhash": "doc_id n_shingles component_id kept",
    "op4_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op5_spaced_seeds": "doc_id item_id",
    "op6_ring": "doc_id size text_crc32 law shard slot grown_shard",
    "op7_quality": "doc_id held_out score predicted",
    "op8_language": "doc_id held_out lang_pred score",
    "op9_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op10_licences": "doc_id paragraph lines family probability confirmed",
    "op11_ball_tree": "item_id rank doc_id score",
    "op12_toxicity": "doc_id held_out score predicted",
    "op13_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    assert rows and set(COLUMNS[name].split()) <= set(df.columns)
    if name in queries.ORACLE:
        db = duckdb.connect()
        for f in os.listdir(sf_dir):
            db.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
        twin = db.sql(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE[name]})").fetchall()
        assert sorted(map(repr, twin)) == sorted(map(repr, rows))


def test_pipeline(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    bench = {r.item_id: r.text for r in queries.table(spark, sf_dir, "benchmark").collect()}
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf_dir, "labels").collect()}
    last = corpus_pipeline.run(spark, sf_dir)
    kept = {r.doc_id for r in last.select("doc_id").distinct().collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert 0 < len(kept) < len(texts)
    assert len({texts[i] for i in kept}) == len(kept)
    assert not any(b in texts[i] for i in kept for b in bench.values())
    assert sum(labels.get(i) == 0 for i in kept) <= 1
    assert sum(q == 1 and i not in kept for i, q in labels.items()) < 0.25 * len(labels)


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf_dir).columns == docs.columns, name
