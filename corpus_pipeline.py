"""The corpus pipeline: documents in, packed training sequences out.

Each stage gets the rows that its predecessor kept, written as Parquet and read again.  All
but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.llm import decontaminate, hyperminhash, language, packing, quality
from barwright.llm.common import staged
from barwright.llm.queries import VOCABULARY, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_LANGUAGE_SCORE = 0.5
MIN_QUALITY = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language that the labelled ones have; null texts, texts
    without a letter and undecided ones go.  A table without any language keeps none."""
    docs = docs.select(*COLUMNS)
    found = language.identify(docs, language.train(docs))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field takes for good more than for bad.  Without labels of both
    kinds nothing can be judged and all stay but blank texts."""
    docs = docs.select(*COLUMNS)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where(F.col("score") >= MIN_QUALITY).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, 0.8): that with the smallest
    doc_id, once.  Different texts of one doc_id are judged each by itself.  Documents without
    words, or without doc_id, are in no group."""
    docs = docs.select(*COLUMNS)
    named = docs.where("doc_id IS NOT NULL").withColumn("mark", F.xxhash64("text"))
    texts = named.select("doc_id", "mark").distinct()
    if texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        numbered = named.withColumn("row", F.col("doc_id"))
    else:  # numbers in the order of doc_id
        texts = staged(texts.orderBy("doc_id", "mark").withColumn("row", F.monotonically_increasing_id()), "rows")
        numbered = named.join(texts, ["doc_id", "mark"])
    groups = hyperminhash.near_duplicates(numbered.select(F.col("row").alias("doc_id"), "text"), k=5, percent=80)
    kept = groups.where("kept").select(F.col("doc_id").alias("row")).distinct()
    named = numbered.join(kept, "row", "left_semi").dropDuplicates(["row"])
    return named.select(*COLUMNS).unionByName(docs.where("doc_id IS NULL"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with a benchmark item."""
    return decontaminate.without_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents in sequences of at most 1024 ids: the pieces of the built
    sequences, with their ids and places.  Null and empty texts give the end id alone, repeated rows
    are packed each."""
    return packing.packed_documents(docs, VOCABULARY, 2, 1024)


STAGES = [
    ("language_id", language_id),
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Language, quality and token ids come from trained models and a tokenizer; tests hold the
# stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
