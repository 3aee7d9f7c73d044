"""Registered queries of the text operators: each applies one operator with production
parameters to its whole table and derives the digest columns of its contract.

``ORACLE`` holds DuckDB texts where SQL can express the result over whole tables; the other
queries are held against brute-force versions in ``tests/llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.llm import (
    ball_tree, decontaminate, hyperminhash, language, licences, packing, quality, repair, ring, syncmers, token_blocks, toxicity, warc,
)
from barwright.llm.common import drop_staged, staged
from barwright.session import new_workspace

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back as digests."""
    place = f"{new_workspace(spark)}/token_files"
    token_blocks.write_token_files(table(spark, sf_dir, "documents"), place, VOCABULARY, end_id=0)
    rows = staged(token_blocks.read_token_files(spark, place, digest_only=True), "digests")
    drop_staged(spark.read.format("binaryFile").load(place))
    return token_blocks.with_global_start(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: three-word shingles, 85 of 100 in common."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids; digests are of the ids found in
    the built sequences."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), VOCABULARY, 2, 1024, with_ids=False)


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark: pairs with their longest overlap."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on sixteen shards of a ring with 64 virtual nodes each, loads bounded so
    tightly that counts differ by one at most; written as shards and read back."""
    place = f"{new_workspace(spark)}/shards"
    ring.write_shards(ring.shard_rows(table(spark, sf_dir, "documents"), "doc_id", shards=16, vnodes=64, slack=0.0), place)
    text = F.coalesce("text", F.lit(""))
    return spark.read.parquet(place).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from three of four labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three of four of them."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back; sizes of revisits come from the originals."""
    place = f"{new_workspace(spark)}/archives"
    warc.write_archives(table(spark, sf_dir, "pages"), place, date="2020-01-01T00:00:00Z")
    rows = staged(warc.read_archives(spark, place, with_html=False), "records")
    drop_staged(spark.read.format("binaryFile").load(place))
    return warc.with_originals(rows).select(
        "page_id", F.col("content_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of all documents."""
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train(docs))


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return ball_tree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from confirmed toxic texts and unlabelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return repair.repair(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_token_blocks": op1_token_blocks,
    "op2_syncmers": op2_syncmers,
    "op3_hyperminhash": op3_hyperminhash,
    "op4_packing": op4_packing,
    "op5_spaced_seeds": op5_spaced_seeds,
    "op6_ring": op6_ring,
    "op7_quality": op7_quality,
    "op8_language": op8_language,
    "op9_warc": op9_warc,
    "op10_licences": op10_licences,
    "op11_ball_tree": op11_ball_tree,
    "op12_toxicity": op12_toxicity,
    "op13_repair": op13_repair,
}

ORACLE: dict[str, str] = {
    "op9_warc": """
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                 sha1(coalesce(html, '')) AS payload_digest
          FROM pages),
        o AS (SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN original IS NOT NULL AND original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original <> page_id THEN original END AS refers_to
        FROM p LEFT JOIN o USING (payload_digest)""",
    "op11_ball_tree": r"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL),
        n AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d),
        total AS (SELECT count(*) FILTER (n > 0) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, total),
        item AS (
          SELECT item_id, term, count(*) AS times FROM (
            SELECT item_id, unnest(regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
          GROUP BY ALL),
        scored AS (
          SELECT item_id, doc_id,
                 CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total.terms)))) AS BIGINT) AS score
          FROM item JOIN tf USING (term) JOIN w USING (term) JOIN n USING (r), total GROUP BY item_id, r, doc_id),
        ranked AS (
          SELECT item_id, doc_id, score,
                 CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
          FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_repair": r"""
        WITH RECURSIVE crc_table AS (
          SELECT list_transform(range(256), lambda x: list_reduce(
            list_concat([x], range(8)), lambda c, step: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
        plain AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
          FROM conversations),
        kinds AS (
          SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
            list_concat([4294967295], list_transform(range(1, len(key) + 1), lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) % 20 AS kind
          FROM plain, crc_table),
        damaged AS (
          SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
          FROM kinds WHERE kind <> 0),
        numbered AS (
          SELECT *, left(role, 1) AS ini, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                 rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid,
                 row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
          FROM damaged),
        rows AS (
          SELECT *, solid = '' AS blank, solid <> '' AND again AS duplicate,
                 solid <> '' AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') AS truncated,
                 coalesce(lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS illegal
          FROM numbered),
        inserts(p, q, cost, audit, put) AS (VALUES
          ('', '', 0, '', ''), ('', 'u', 2, 'I', chr(10) || 'user:'), ('', 'a', 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
          ('s', 's', 0, '', ''), ('s', 'u', 2, 'I', chr(10) || 'user:'), ('s', 'a', 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
          ('u', 'u', 0, '', ''), ('u', 'a', 2, 'I', chr(10) || 'assistant:'), ('a', 'a', 0, '', ''), ('a', 'u', 2, 'I', chr(10) || 'user:')),
        follows(p, q) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
        edits AS (
          SELECT conv_id, i, p, q, 'K' AS letter, CAST(truncated AS INTEGER) AS cost, chr(10) || role || ':' || text AS put
          FROM rows JOIN follows ON ini = q WHERE NOT blank AND NOT duplicate
          UNION ALL
          SELECT conv_id, i, p, q, 'R', 2 + CAST(truncated AS INTEGER),
                 chr(10) || CASE q WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text
          FROM rows, follows WHERE q <> 's' AND NOT blank AND NOT duplicate
          UNION ALL
          SELECT conv_id, i, p, p, 'D', 3, '' FROM rows, (VALUES (''), ('s'), ('u'), ('a')) AS states(p)),
        best AS (
          SELECT conv_id, CAST(0 AS BIGINT) AS i, '' AS p, {'cost': 0, 'audit': '', 'put': ''} AS w
          FROM (SELECT DISTINCT conv_id FROM conversations)
          UNION ALL
          SELECT best.conv_id, edits.i, edits.q,
                 min({'cost': best.w.cost + inserts.cost + edits.cost, 'audit': best.w.audit || inserts.audit || edits.letter,
                      'put': best.w.put || inserts.put || edits.put})
          FROM best JOIN inserts ON inserts.p = best.p
          JOIN edits ON edits.conv_id IS NOT DISTINCT FROM best.conv_id AND edits.i = best.i + 1 AND edits.p = inserts.q
          GROUP BY best.conv_id, edits.i, edits.q),
        size AS (
          SELECT c.conv_id, count(r.i) AS n, coalesce(max(r.turn) - min(r.turn) + 1 - count(DISTINCT r.turn), 0) AS gaps,
                 count(*) FILTER (r.blank) AS blank, count(*) FILTER (r.duplicate) AS duplicate,
                 count(*) FILTER (r.truncated) AS truncated, count(*) FILTER (r.illegal) AS illegal
          FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
          GROUP BY c.conv_id),
        ends AS (
          SELECT size.conv_id, min({'cost': best.w.cost + inserts.cost, 'audit': best.w.audit || inserts.audit, 'put': best.w.put || inserts.put}) AS w
          FROM size JOIN best ON best.conv_id IS NOT DISTINCT FROM size.conv_id AND best.i = size.n
          JOIN inserts ON inserts.p = best.p AND inserts.q IN ('', 'a') GROUP BY size.conv_id)
        SELECT size.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(w.cost AS BIGINT) AS cost, w.audit AS audit,
               sha256(substr(w.put, 2)) AS repaired_sha256
        FROM size JOIN ends ON ends.conv_id IS NOT DISTINCT FROM size.conv_id""",
}
