"""The corpus pipeline: each stage takes documents and gives documents; the last one writes ids.

Defined cases, in all stages: a null text is empty and fails the quality rules; a null source is a
source of its own; a null doc_id is the least id; of rows with one id and one text one stays; ties
are broken by id and text; an empty table passes through; a stage keeps all columns, whatever their
names, in their order, and looks at doc_id, text and source alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from viewstar.llm import decontamination, grammar_ids, mixing, near_duplicates, quality_rules
from viewstar.staging import Staging

#: SQL can express neither the near-duplicate classes nor the tokenizer.
ORACLE_SQL = None

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_duplicates.keep_one(docs, Staging(spark))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in the amounts and the order of the curriculum."""
    return mixing.copies(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as ids in grammar-compressed files; one row per document read back.

    The files keep the order of the curriculum, in which the stage before wrote its rows.
    """
    path = Staging(spark).path("ids")
    grammar_ids.write_ids(docs, path, TOKENIZER, in_file_order=True)
    return grammar_ids.read_documents(grammar_ids.open_blocks(spark, path))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("source_mix", mix),
    ("grammar_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
