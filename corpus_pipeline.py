"""From raw documents to token ids, in stages: each takes what the one before has kept.

A stage is called with (spark, docs, sf_dir); its result is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import bpe, decontaminate, quality_rules, simhash, suffix_dedup
from terrace.session import cut_lineage


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality_rules.kept_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    return simhash.first_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has, or the same one earlier, are cut out of the texts."""
    return suffix_dedup.without_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from others, the few words of test items are cut."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): token ids, and the digest of what they decode to."""
    back, ids, text = bpe.round_trip(docs.select("doc_id", "text"))
    return back.select("doc_id", F.size(ids).cast("long").alias("n_tokens"), ids,
                       F.sha2(F.col(text), 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", rules),
    ("simhash_near_dedup", near_copies),
    ("suffix_array_dedup", repeats),
    ("benchmark_decontamination", benchmark_passages),
    ("bpe_encoding_and_decoding", tokens),
]

#: Fingerprints and byte-pair encoding have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
