"""Registered queries of the text operators and the SQL they are checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import bpe, centroids, chat, checks, convrepair, decontam, fingerprints, licenses, neardup, runindex, secret_ledger, tokencount, topk, toxicity
from geoloom.llm.common import table

#: Documents from this score on are taken as toxic.
TOXIC_FROM = 0.7


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = secret_ledger.scan(documents, secret_ledger.new_ledger(spark))
    found = F.col("found")
    counts = [
        F.size(secret_ledger.of_kind(found, r.name)).cast("bigint").alias(f"n_{r.name}") for r in secret_ledger.BASE
    ]
    base = secret_ledger.of_kind(found, *[r.name for r in secret_ledger.BASE])
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(secret_ledger.digest(base), 256).alias("base_sha256"),
        secret_ledger.digest(found).alias("spans"),
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = neardup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.encode(documents, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return rows.select(
        "doc_id",
        F.floor(F.octet_length("tokens") / 4).alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), ~held_out)
    rows = toxicity.score(documents, model)
    predicted = (F.col("score") >= TOXIC_FROM).cast("int")
    return rows.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.notices(table(spark, sf_dir, "documents").select("doc_id", "text"))
    confirmed = F.filter("notices", lambda n: n["confirmed"])
    return rows.select(
        "doc_id",
        F.size("notices").cast("bigint").alias("n_named"),
        F.size(confirmed).cast("bigint").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda n: n["family"]))), ",").alias("licenses"),
        F.array_join(F.transform(confirmed, lambda n: n["paragraph"].cast("string")), ",").alias("paragraphs"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.count_tokens(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runindex.deduplicate(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontam.hit_words(F.col("spans")).cast("bigint")
    return rows.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return convrepair.audits(conversations, convrepair.damaged(conversations))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.edited(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        *[F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
        "near_edited",
        "near_next",
    )


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_toxicity": op4_toxicity,
    "op5_license_scans": op5_license_scans,
    "op6_token_counts": op6_token_counts,
    "op7_top_k": op7_top_k,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_chat_perspectives": op9_chat_perspectives,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_document_fingerprints": op13_document_fingerprints,
}

CHECKS = {
    "op1_secret_scans": checks.SECRET_SCANS,
    "op2_minhash_near_dedup": checks.NEAR_DUPLICATES,
    "op7_top_k": checks.TOP_K,
    "op9_chat_perspectives": checks.PERSPECTIVES,
    "op10_decontamination": checks.DECONTAMINATION,
    "op11_conversation_repair": checks.CONVERSATION_REPAIR,
    "op12_centroid_clusters": checks.CENTROIDS,
}
