"""Corpus pipeline: stages applied to the documents one after another.

1. toxicity: rejected documents go; labels of the labels table are learnt from where they are not held out.
2. near_dedup: of every group of near copies the document with the smallest id stays (five-word shingles,
   similarity 0.8 or more); rows that repeat an id are told apart by their texts, of equal rows one stays.
3. decontamination: documents that hold a benchmark passage go.
4. secrets: found secrets are masked in the text; every document stays.
5. tokens: the text is encoded, and the result has the ids in place of the text.

Each stage reads all that the stage before it kept. Documents that no stage objects to keep their text.

Defined cases: null and empty texts are never rejected and are no copies of one another; documents without
an id cannot be linked or counted as repeated and stay; further columns of the documents ride along to the
last stage, an empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import bpe, common, decontam, neardup, secret_ledger, toxicity

#: Documents from this score on are rejected.
TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = common.table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, ~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs.withColumnRenamed("score", "_score") if "score" in docs.columns else docs, model)
    kept = scored.filter(F.col("score") < TOXIC_FROM).drop("score")
    return kept.withColumnRenamed("_score", "score") if "_score" in kept.columns else kept


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = common.stored(neardup.near_duplicates(docs.select("doc_id", "text")), "near-rows")
    rows = rows.filter("doc_id is not null and class is not null").select("class", "doc_id", "text_hash")
    first = rows.groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    copies = rows.join(first, "class").filter(F.struct("doc_id", "text_hash") != F.col("first"))
    copies = copies.select(F.col("doc_id").alias("copy_id"), F.col("text_hash").alias("copy_hash")).distinct()
    mark = F.xxhash64("text")
    kept = docs.join(copies, (F.col("doc_id") == F.col("copy_id")) & (mark == F.col("copy_hash")), "left_anti")
    if not neardup.repeated(docs):
        return kept
    without_id = kept.filter("doc_id is null")
    mark = F.when(F.length("text") > 0, F.md5("text"))  # null and empty texts are no copies of one another
    each = kept.filter("doc_id is not null").withColumns({"_mark": mark, "_row": F.when(mark.isNull(), F.monotonically_increasing_id())})
    return each.dropDuplicates(["doc_id", "_mark", "_row"]).select(*docs.columns).unionByName(without_id)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = decontam.contamination(docs, common.table(spark, sf_dir, "benchmark"))
    found = rows.filter(F.size("spans") > 0).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.xxhash64("text") == F.col("bad_hash"))
    return docs.join(found, same, "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    fields = F.struct(*docs.columns)  # clear of the names that the scan adds
    versions = docs.select(F.col("text").alias("content"), fields.alias("fields"))
    rows = secret_ledger.scan(versions, secret_ledger.new_ledger(spark), text="content")
    text = secret_ledger.masked(F.col("fields.text"), F.col("found"))
    return rows.select(*[text.alias(c) if c == "text" else F.col("fields")[c].alias(c) for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return rows.withColumn("n_tokens", F.floor(F.octet_length("tokens") / 4))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("tokens", encode_tokens),
]

#: A trained classifier decides in the first stage, so SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
