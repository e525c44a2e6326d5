"""The registered queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _io, chat, decontaminate, html_text, infill, mixing, ngram_join, quality, repair, shards, substrings, tokens, urls, warc

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
TOKEN_LIMIT = 1024


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_io.table(spark, sf_dir, "documents"), _io.table(spark, sf_dir, "benchmark"))
    at = F.sequence(F.lit(0), F.size("spans") - 1, F.lit(2))
    n_hit = F.when(F.size("spans") > 0, F.aggregate(at, F.lit(0).cast("long"), lambda n, i: n + F.get("spans", i + 1) - F.get("spans", i))).otherwise(F.lit(0).cast("long"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), (F.size("items") + F.col("unnamed").cast("int")).cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _io.table(spark, sf_dir, "documents")
    return quality.judge_documents(docs, quality.train(docs, _io.table(spark, sf_dir, "labels")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = tokens.count_tokens(_io.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.duplicate_classes(_io.table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_io.table(spark, sf_dir, "pages"), RULES)


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard_documents(_io.table(spark, sf_dir, "documents"))
    return placed.select("doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "h")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_io.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_io.table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_io.table(spark, sf_dir, "pages"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(said).alias("text"))
    rows = _io.keyed(_io.table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest_formatted(chat.format_conversations(rows))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_io.table(spark, sf_dir, "pages"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest_forms(infill.transform(_io.table(spark, sf_dir, "documents")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(repair.damage(_io.table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_decontaminate, op2_quality, op3_token_counts, op4_ngram_join, op5_url_filter, op6_shards, op7_mixing, op8_substrings, op9_warc, op10_chat, op11_html_text, op12_fill_in_middle, op13_conversation_repair)}
