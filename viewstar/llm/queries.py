"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
import public_tokenizers
from viewstar.llm import (
    decontamination, grammar_ids, language_mixture, main_text, mixing, near_duplicates, oracles,
    prefix_trie, quality_rules, sharding, subword_quality, token_alignment, viterbi_counts, warc)
from viewstar.staging import Staging

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_grammar_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Staging(spark).path("ids")
    grammar_ids.write_ids(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return grammar_ids.read_documents(grammar_ids.open_blocks(spark, path))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates.near_duplicates(docs, Staging(spark)).select(
        "doc_id", "class_id", "copy_id", "n_copies", "n_links")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(table(spark, sf_dir, "pages"), main_text.trained())


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    path = staging.path("warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path, staging)
    records = warc.read_warc(spark, path, "record_type IN ('response', 'revisit')",
                             payload=False, verify=True)
    return records.select(
        warc.page_id("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.replace("payload_digest", F.lit("sha1:"), F.lit("")).alias("payload_digest"),
        "record_type", warc.page_id("refers_to").alias("refers_to"))


def op5_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = subword_quality.train(
        *subword_quality.sample(docs, table(spark, sf_dir, "labels")))
    return subword_quality.scored(docs, model).select(
        "doc_id", subword_quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi_counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judged(docs, "quality").select("doc_id", *[
        f"quality.{c}" for c in (*quality_rules.MEASURES, "base_failed", "kept")])


def op8_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = staging.table(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32")), "rows")
    links = sharding.equal_text_links(docs, sharding.SHARDS, staging)
    return sharding.sharded(rows, links, staging).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.training_order(mixing.mixed(docs, "mix"), "mix").select("doc_id", *[
        f"mix.{c}" for c in ("size", "source_size", "target", "taken", "position")])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.agreement(
        table(spark, sf_dir, "documents"), TOKENIZER, PIECES, Staging(spark))


def op12_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_mixture.train(language_mixture.sample(docs))
    return language_mixture.predicted(docs.select(
        "doc_id", "text"), model).withColumn(
        "held_out", language_mixture.held_out("doc_id")).select(
        "doc_id", "held_out", "lang_pred", "score", "shares")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    found = staging.table(
        prefix_trie.sequences(table(spark, sf_dir, "conversations")), "sequences")
    return prefix_trie.trie(prefix_trie.rebuilt(found), staging)


def queries() -> dict[str, Query]:
    found = {name: query for name, query in globals().items() if name.startswith("op")}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op7_quality_rules": oracles.QUALITY_RULES, "op9_source_mix": oracles.SOURCE_MIX,
            "op13_prefix_trie": oracles.PREFIX_TRIE}
