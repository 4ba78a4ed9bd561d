"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination,
secrets, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; all but the last return the columns of ``docs``.  ``run`` writes every
stage to the shared checkpoint folder, so a lost executor or a restart repeats
one stage at most.

NULL and empty texts fail the first stage's base rules; in the others a NULL text
has no words, holds no benchmark item, no secret and no tokens.  Of repeated rows
one stays in the second stage.  Columns may have any names and keep their values
and types through the first four stages; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import bpe, decontaminate, quality, secrets, simhash
from orderlens.llm.common import stage_table, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: rejected documents go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each group stays, that of smallest doc_id."""
    return simhash.one_of_each(docs, simhash.SHINGLE_WORDS, simhash.MAX_BITS)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that hold a benchmark item go."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: live secrets are replaced in the texts."""
    return secrets.redact_live(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: ids of the public byte-level BPE, decoded again."""
    return bpe.encode_documents(docs, bpe.tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_free),
    ("secret_scans", secret_scan),
    ("byte_level_bpe", tokens),
]

#: No stage but the fourth can be said in SQL (learned trees, 64-bit shingle
#: hashes, tiling, merges by rank); the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name, "snappy")
    return STAGES[-1][1](spark, docs, sf_dir)
