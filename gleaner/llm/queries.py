"""The registered queries of this subpackage: ``opN_<name>``, one per operator.

Each applies its operator to the whole of its table and derives the columns of
its contract from the operator's own output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import (chat, chunkdedup, chosenpath, decontam, licenses, negatives, oracles, packing, parsing, phrases,
                         quality, simhash, suffixes, tokencount)
from gleaner.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunkdedup.drop_repeated_chunks(docs, keep_text=False).select(
        "doc_id", "n_bytes", "n_chunks", "n_removed_chunks", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/<doc_id mod 50>/<doc_id>.txt``."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")),
                                      F.pmod("doc_id", F.lit(50)), F.concat("doc_id", F.lit(".txt"))).alias("path"))
    return licenses.scan(docs)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=3, k=3).select(
        "doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.edit_study(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs, keep_text=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, weights).select(
        "doc_id", (quality.checksum_part() == 0).alias("held_out"), "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                              "conv_id long, turn long, role string, text string"))
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return chat.read_back(chat.format_conversations(conversations, tokenizer), tokenizer)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh vector changes its label first; every hundredth is an anchor."""
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chosenpath.near_duplicates(docs, shingle=5, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_token_counts": op7_token_counts,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_decontamination": op9_decontamination,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

#: DuckDB SQL of the queries that SQL can express over whole tables.
ORACLES: dict[str, str] = {
    "op3_license_scan": oracles.license_scan(),
    "op5_suffix_array_dedup": oracles.suffix_array_dedup(),
    "op9_decontamination": oracles.decontamination(),
    "op10_chat_formatting": oracles.chat_formatting(),
    "op11_hard_negatives": oracles.hard_negatives(),
    "op12_phrase_collocations": oracles.phrase_collocations(),
    "op13_minhash_near_dedup": oracles.minhash_near_dedup(),
}
