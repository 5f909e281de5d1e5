"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import (
    attribution,
    bitslice,
    chat,
    collocations,
    licenses,
    merkle,
    minhash,
    mixing,
    oracle,
    packing,
    pii,
    scoring,
    simhash,
    toxicity,
)
from gaugeworks.llm.common import table


def op1_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.marked(table(spark, sf_dir, "documents"))


def op2_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.attributed(table(spark, sf_dir, "documents"))


def op3_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), bitslice.quantised(F.col("embedding")).alias("whole")
    )
    return bitslice.top(vectors, vectors.where("id % 50 = 0"), k=5)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex(F.col("print")[0]), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.with_edits(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, merkle.tampered_leaf(docs))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


def op13_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.examples(chat.with_planted(table(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_skip_chain_pii": op1_skip_chain_pii,
    "op2_token_attribution": op2_token_attribution,
    "op3_bit_sliced_top_k": op3_bit_sliced_top_k,
    "op4_source_mix": op4_source_mix,
    "op5_gru_scores": op5_gru_scores,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_license_scan": op9_license_scan,
    "op10_minhash_fingerprints": op10_minhash_fingerprints,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_chat_examples": op13_chat_examples,
}

#: The other queries train models, permute, or depend on a hash that DuckDB lacks; tests
#: hold them against plain versions.
ORACLES = {
    "op3_bit_sliced_top_k": oracle.TOP_K,
    "op11_merkle_manifest": oracle.merkle_sql(),
    "op12_phrase_collocations": oracle.PHRASES,
    "op13_chat_examples": oracle.chat_sql(),
}
