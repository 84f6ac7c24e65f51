"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's docs. The last stage
gives the packed pieces of the documents that are left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sigflow.llm import exact_dedup, jaccard_join, packing, quality, toxicity
from sigflow.llm.common import read_table, staged, workers_find_package
from sigflow.llm.queries import END_ID, SEQUENCE_TOKENS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    workers_find_package(spark)
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id."""
    workers_find_package(spark)
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarity links the one with the smallest id."""
    workers_find_package(spark)
    return jaccard_join.keep_representatives(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    workers_find_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_TOKENS, END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("best-fit packing", pack_sequences),
]

#: A trained model and a tokenizer: SQL can't express them; tests/llm hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
    return docs
