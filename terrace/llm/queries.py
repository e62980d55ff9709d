"""The registered queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from terrace.llm import (
    bpe, chat_format, decontaminate, hard_negatives, html_extract, lm_scoring, quality_classifier, quality_rules, repair,
    sharding, simhash, suffix_dedup, url_filters)
from terrace.llm.oracle import ORACLE  # noqa: F401
from terrace.session import cut_lineage

SHARDS = 16
FIRST_DAY = "2024-01-01"
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Workers that start from here on find this package, wherever they are started.
    root = str(Path(__file__).resolve().parents[2])
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, have)))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    trial = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    found = chat_format.read(chat_format.formatted(rows.unionByName(trial)))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return found.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = suffix_dedup.deduplicated(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])
    return done.select(
        "row.doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    found = quality_classifier.classified(docs, trusted)
    return found.select("row.*", "n_grams", "perplexity", "threshold", "kept")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged, name = quality_rules.ledger(docs)
    failed = F.col(f"{name}.failed")
    return judged.select(
        "doc_id", *(f"{name}.{m}" for m in quality_rules.MEASURES),
        (~quality_rules.passes(failed, "base")).alias("base_failed"),
        quality_rules.passes(failed).alias("kept"), failed.alias("failed_rules"))


def quality_rules_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy does, over the ledger of all documents."""
    judged, name = quality_rules.ledger(table(spark, sf_dir, "documents").select("text"))
    failed = cut_lineage(judged.select(f"{name}.failed"))
    return reduce(DataFrame.unionByName, (
        quality_rules.ablation(failed, policy).select(F.lit(policy).alias("policy"), "*")
        for policy in quality_rules.POLICIES))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
                        "component_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.sharded(table(spark, sf_dir, "documents"), SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def _digits(column: Column, first: int) -> Column:
    """A number from 0 to 255 that hangs on the value alone: two hexadecimal digits of its digest."""
    digit = lambda k: F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(column), k, 1)) - 1
    return digit(first) * 16 + digit(first + 1)


def dated_entries(pages: DataFrame) -> DataFrame:
    """Lists over time for the hosts, domains and path prefixes that the pages have.

    About a quarter of the patterns are added on some day, half of those are taken off later, and half
    of these put on again; the pattern's digest decides.
    """
    name = url_filters.host(F.col("url"))
    parts = url_filters.segments(F.col("url"))
    kinds = {"host": F.array(name), "domain": url_filters.domains(name), "prefix": url_filters.prefixes(name, parts)}
    of_kind = lambda kind: lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern"))
    patterns = pages.select(F.explode(F.concat(*(
        F.transform(found, of_kind(kind)) for kind, found in kinds.items()))).alias("e")).select(
        "e.*").filter("pattern <> ''").distinct()
    said = F.concat_ws(" ", "kind", "pattern")
    drawn = patterns.filter(_digits(said, 1) < 64).select(
        F.when(_digits(said, 3) < 128, "malware").otherwise("spam").alias("list"), "kind", "pattern",
        _digits(said, 5).alias("on"), (_digits(said, 7) % 100 + 1).alias("for"), _digits(said, 9).alias("fate"))
    day = lambda n: F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))
    event = lambda added, n: F.struct(F.lit(added).alias("added"), day(n).alias("at"))
    on, off = F.col("on"), F.col("on") + F.col("for")
    events = F.array(event(True, on), F.when(F.col("fate") < 128, event(False, off)),
                     F.when(F.col("fate") < 64, event(True, off + 30)))
    return drawn.select("list", "kind", "pattern", F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e")).select(
        "list", "kind", "pattern", "e.*")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    visited = F.concat_ws(" ", F.col("page_id").cast("string"), "url")
    captures = pages.withColumn("fetched", F.date_add(
        F.lit(FIRST_DAY).cast("date"), (_digits(visited, 1) + _digits(visited, 3)).cast("int")))
    found = url_filters.judged(captures, dated_entries(pages))
    return found.select(
        "row.page_id", "host", F.col("row.fetched").cast("string").alias("fetched"),
        (F.size("matches") > 0).alias("blocked"), F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.list")), ",").alias("lists"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(
            " ", m["list"], m["kind"], m["pattern"], m["since"].cast("string"))), "\n").alias("matched"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    hits = F.col(name)
    return found.select(
        "doc_id", hits["n_words"].alias("n_words"), hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(hits).alias("contaminated"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back, ids, text = bpe.round_trip(docs)
    return back.select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col(text), 256).alias("decoded_sha256"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(rows, F.col("id") % 100 == 0, label=label)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults that hang on their ids and turns alone, and how often each row stands there."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    found = repair.repaired(rows, copies=F.col("copies"))
    return found.select(F.col("conv").alias("conv_id"), *repair.COUNTS, "audit", "repaired_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "documents")
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_chat_formatting, op2_suffix_array_dedup, op3_lm_scoring, op4_quality_classifier,
        op5_quality_rules, quality_rules_ablation, op6_simhash_near_dedup, op7_sharding, op8_url_filters,
        op9_benchmark_decontamination, op10_bpe, op11_html_extraction, op12_hard_negatives,
        op13_conversation_repair, pipeline)}
