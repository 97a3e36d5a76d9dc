"""The training-corpus pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir), works on every document its predecessor
kept and returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and reads it back.  All stages but the last return the columns of
``documents``.

The operators see the columns that they read and nothing else: every other column of
``docs``, whatever its name, travels under a name of the pipeline's own and comes back
as it was, so a column called ``score`` or ``kept`` is neither read nor replaced.  The
last stage returns the placed pieces of each document: ``doc_id`` and the columns of
``op8_best_fit_packing``.

Defined cases, in every stage: an empty table gives an empty table with the same columns.
A null text is an empty one; such documents score the classifier's bias, are one
SimHash group (fingerprint zero, of which one stays), have nothing to cut and no
words to be found in a benchmark, and become the end id alone.  A null id counts as
larger than all others.  Rows that repeat, whole or by id, are rows of their own until
SimHash near-dedup keeps one of them.  Very long texts are worked on whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import decontam, packing, quality, simhash, suffixes
from gleaner.llm.common import table, written


def _apart(docs: DataFrame, *read: str) -> DataFrame:
    """``docs`` with the columns that a stage does not read under names of their own."""
    return docs.withColumnsRenamed({c: f"_doc_{i}" for i, c in enumerate(docs.columns) if c not in read})


def _back(out: DataFrame, docs: DataFrame, *read: str) -> DataFrame:
    """The columns of ``docs`` again, under their names and in their order."""
    return out.select(*[F.col(c if c in read else f"_doc_{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least THRESHOLD stay."""
    read, weights = ("doc_id", "text"), quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(_apart(docs, *read), weights, keep_text=True)
    return _back(scored.where(F.col("score") >= quality.THRESHOLD), docs, *read)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group within 3 bits of 3-word-shingle fingerprints stays."""
    read = ("doc_id", "text")
    return _back(simhash.one_of_each(_apart(docs, *read), shingle=3, k=3), docs, *read)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in 50-byte strings of a document with a smaller id go (characters as a whole);
    ``n_chars``, if there is one, is that of what is left."""
    read = ("doc_id", "text")
    out = _back(suffixes.remove_repeats(_apart(docs, *read), whole_chars=True), docs, *read)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 10 consecutive words of a benchmark item go."""
    read = ("doc_id", "text")
    found = decontam.contamination(_apart(docs, *read), table(spark, sf_dir, "benchmark"), keep_text=True)
    return _back(found.where(~F.col("contaminated")), docs, *read)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, one row per piece."""
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
