"""The registered queries of this subpackage, one per operator and one for the pipeline."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetpulse.llm import (
    conversation_repair,
    embedding_dedup,
    line_dedup,
    merkle_manifest,
    minhash_dedup,
    mixing,
    packing,
    quality_rules,
    sentence_pieces,
    substring_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
)


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_vocabulary() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(column: str):
    return F.sha2(F.col(column), 256).alias("kept_sha256")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return deduped.select("doc.doc_id", "n_lines", "n_dropped", sha256("kept_text"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return deduped.select("doc.doc_id", "n_sentences", "n_removed", "n_spans", sha256("kept_text"))


def op2_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"), cut=substring_dedup.pieces)
    return deduped.select("doc.doc_id", F.col("n_sentences").alias("n_pieces"), "n_removed", "n_spans", sha256("kept_text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = toxicity.train(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), max_labelled=1600))
    scored = toxicity.score_toxicity(docs, network, ["doc_id"])
    return scored.select("doc.doc_id", toxicity.held_out("doc.doc_id").alias("held_out"), "score", "predicted")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(table(spark, sf_dir, "documents"), vocabulary())


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"), ["doc_id"])
    return deduped.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", sha256("kept"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary(), ["doc_id"])
    return counted.select("doc.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quality_rules.text_counts(table(spark, sf_dir, "documents")).drop("doc")
    judged = quality_rules.judge(counts, table(spark, sf_dir, "labels"))
    return judged.select(F.col("id").alias("doc_id"), *quality_rules.COUNTS, "base_failed", "kept")


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentence_pieces.encode_documents(table(spark, sf_dir, "documents"), piece_vocabulary(), ["doc_id"])
    digests = [F.sha2(F.col(c), 256).alias(f"{c}_sha256") for c in ("ids", "decoded")]
    return encoded.select("doc.doc_id", "n_tokens", *digests)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verified(table(spark, sf_dir, "documents"), tampered=merkle_manifest.crc_tampered())


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_conversations(conversation_repair.damaged(conversations), conversations)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op2_passage_dedup": op2_passage_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_mixing": op8_mixing,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_sentence_pieces": op11_sentence_pieces,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_conversation_repair": op13_conversation_repair,
}
