"""Training-data pipeline over the documents table.

``STAGES`` are applied in order; each reads what its predecessor kept, written
as Parquet. All but the last return the columns of documents. What a stage wrote
for itself is deleted once its result is written; the last one's tables are read
by the result, so the caller drops them (``drop_staged``).

Rows are told apart by a hash of (doc_id, text), so different texts under one id,
and texts without an id, are judged each for itself.

Cases: null and empty texts have no language unless one is declared, link with
nothing, hold no benchmark item, take no words of the mix; repeated rows (same id
and text) become one in ``near_dedup``; of a group the row with the smallest id
stays, rows without an id last, ties by the hash; texts of any length are read
whole; empty tables give no rows; extra columns pass through all stages but the
last. Token files are written in ascending doc_id order, as their format asks:
of the training order only the number of times a document is taken reaches them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rulemill.llm import op03_templates, op04_dac, op07_language, op08_minhash, op09_mixing
from rulemill.staging import drop_staged, stage, staged_mark

SHINGLE_WORDS = 5
SIMILARITY = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told."""
    rejected = stage(op07_language.document_languages(docs).filter(F.col("lang") == op07_language.UNKNOWN).select(F.col("id").alias("_id")), "rejected")
    return docs.join(rejected, F.xxhash64("doc_id", "text") == F.col("_id"), "left_anti").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates and one row of each (doc_id, text)."""
    row = F.xxhash64("doc_id", "text")
    ids = stage(docs.groupBy(row.alias("_id")).agg(F.min("doc_id").alias("_doc"), F.count(F.lit(1)).alias("_n")), "row-ids")
    found = op08_minhash.near_duplicates(docs.select(row.alias("doc_id"), "text"), SHINGLE_WORDS, SIMILARITY)
    linked = stage(found.select(F.col("doc_id").alias("_id"), "component_id").distinct().join(ids, "_id"), "linked")
    first = F.min(F.struct(F.col("_doc").isNull(), "_doc", "_id"))
    groups = stage(linked.groupBy("component_id").agg(first.getField("_id").alias("_first"), F.count(F.lit(1)).alias("_size")).filter("_size > 1"), "groups")
    gone = stage(linked.join(groups, "component_id").filter("_id <> _first").select("_id"), "near-duplicates")
    again = stage(ids.filter("_n > 1").select("_id"), "repeated-rows")
    mine = F.xxhash64(docs["doc_id"], docs["text"])
    kept = docs.join(gone, mine == gone["_id"], "left_anti")
    whole = F.struct(*docs.columns)
    once = (
        kept.join(again, mine == again["_id"], "left_semi")
        .groupBy(row.alias("_id")).agg(F.min_by(whole, F.to_json(whole)).alias("_whole")).select("_whole.*")
    )
    return kept.join(again, mine == again["_id"], "left_anti").select(*docs.columns).unionByName(once)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, re-parameterised or not."""
    return op03_templates.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, range-sorted by training position."""
    return op09_mixing.training_order(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; returns each document's place in them."""
    return op04_dac.token_files(spark, docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: Language models, minhashes and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        mark = staged_mark(spark)
        docs = stage(apply(spark, docs, sf_dir), name)
        drop_staged(spark, mark, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
