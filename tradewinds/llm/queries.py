"""The registered queries of the training-data operators and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewinds.llm import (
    ann, bpe, chosen_path, comparison, conversation_repair, exact_dedup, jaccard_join, lang_id, lm_score, merkle, packing, repeats, sharding, toxicity)
from tradewinds.llm.common import crc_mod
from tradewinds.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_query
def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.nearest(rows, rows.where("vec_id % 20 = 0"), 20)


@_query
def op2_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fold = crc_mod("doc_id", 3)
    trees = lang_id.train(docs.where(f"{fold} <> 1"))
    return lang_id.identify(docs, trees).selectExpr("id as doc_id", crc_mod("id", 3) + " = 1 as held_out", "lang_pred", "score", "bits")


@_query
def op3_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score.score(documents(spark, sf_dir), crc_mod("doc_id", 7) + " <> 2")
    return found.selectExpr("id as doc_id", crc_mod("id", 7) + " = 2 as held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@_query
def op4_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir), k=3, percent=90).withColumnRenamed("id", "doc_id")


@_query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op5_exact_dedup"] = r"""
    with n as (select doc_id, length(coalesce(text, '')) chars,
                      sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) text_sha256 from documents)
    select doc_id, first_value(doc_id) over best keep_id, count(*) over (partition by text_sha256) group_size,
           doc_id = first_value(doc_id) over best as kept, text_sha256
    from n window best as (partition by text_sha256 order by chars desc, doc_id)"""


@_query
def op8_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.extendible_shards(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_bytes", "shard", F.col("depth").cast("long").alias("depth"), "shard_bytes", "shard_rows")


ORACLES["op8_extendible_sharding"] = sharding.shards_sql()


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> dict:
    """Learned from the labels of documents outside the held-out fold."""
    learned = docs.where(crc_mod("doc_id", 3) + " <> 1")
    return toxicity.train(learned, spark.read.parquet(f"{sf_dir}/labels.parquet"), docs)


@_query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity_model(spark, docs, sf_dir)).selectExpr(
        "id as doc_id", crc_mod("id", 3) + " = 1 as held_out", "score", "predicted", "evidence")


@_query
def op7_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of all documents with their places; token ids are summed up by their CRC."""
    found = packing.cut(docs, public_tokenizers.path("word_bpe_49k.json"))
    rows = cut_lineage(found.select("id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))
    return packing.pack(rows).withColumnRenamed("id", "doc_id")


@_query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), path)
    return bpe.decode(ids, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@_query
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op11_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates; ``kept`` marks the least id of each (a null id is kept)."""
    found = chosen_path.near_duplicates(documents(spark, sf_dir), k=5, percent=85)
    return found.selectExpr("id as doc_id", "n_shingles", "component_id", "id <=> component_id as kept")


ORACLES["op11_chosen_path"] = comparison.near_duplicates_sql(5, 85, kept=True)
ORACLES["op4_parity_sketch_join"] = comparison.near_duplicates_sql(3, 90, kept=False)


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    rows = conversation_repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_repair.reports(rows).withColumnRenamed("conv", "conv_id")


ORACLES["op12_conversation_repair"] = comparison.conversations_sql()


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and its check for every document; a seventh of them is checked with one character more than it has."""
    more = F.expr("n_chars + if(crc32(cast(cast(doc_id as string) as binary)) % 7 = 0, 1, 0)")
    return merkle.manifest(documents(spark, sf_dir), changed={"n_chars": more}).withColumnRenamed("id", "doc_id")


ORACLES["op13_merkle_manifest"] = comparison.manifest_sql()
