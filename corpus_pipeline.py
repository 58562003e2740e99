"""A corpus in five stages: reject poor documents, remove repeated lines, keep one of similar
documents, remove what holds benchmark items, pack the rest into sequences of tokens.

Every stage takes what the one before has kept, as a stored table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tableflow.llm import decontamination, line_dedup, ngram_join, packing, quality_classifier
from tableflow.llm.queries import table
from tableflow.session import materialise


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more; it learns from the labels of ``docs``."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.of_quality(docs, model)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand before; those of which no line with a word is left go."""
    return line_dedup.without_repetitions(docs)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by a Jaccard similarity of 0.8 on five words."""
    return ngram_join.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is covered by 80 %."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", reject_poor),
    ("line dedup", remove_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("benchmark decontamination", remove_benchmark),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the tokens; tests compare with a plain computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
