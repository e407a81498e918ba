"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import mixing, ngram_join, packing, passages, quality
from rollcall.llm.common import delete_folder, scratch_dir, stashes_removed, table
from rollcall.llm.queries import GOOD, TARGETS, byte_bpe, language_labels


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out())
    return quality.keep_good(docs, quality.learn_quality(docs, labels), GOOD)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs, ngram_join.decide(docs, n=5, threshold=0.8))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that occur earlier are cut out."""
    return passages.cut_repeats(docs, width=20)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of languages below their target share are repeated; none goes."""
    return mixing.mix_documents(docs, language_labels(spark, sf_dir), TARGETS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens."""
    return packing.pack_documents(docs, byte_bpe(added=True), size=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("substring dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]

#: SQL cannot express the learnt and iterative stages; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, with a Parquet table between each two.

    A stage's own tables go once its result is written, and that goes once the next stage has read it.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_dir(spark)}/rollcall-pipeline/{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        with stashes_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            delete_folder(spark, f"{folder}/{k - 1}")
    return docs
