"""The corpus pipeline: toxicity, n-gram Jaccard join, substring dedup, mixing and packing of ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and rereads as the
next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphmill.llm.common import stored
from graphmill.llm.jaccard import keep_one
from graphmill.llm.mixing import mixed_documents
from graphmill.llm.packing import pack
from graphmill.llm.substring import without_repeats
from graphmill.llm.toxicity import reject_toxic
from graphmill.session import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores as toxic go."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that shingle sets of five words link at 0.8 or more, directly or through others, the least id stays."""
    return keep_one(spark, docs, k=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go from the texts, wherever in a sentence they begin; every document stays."""
    return without_repeats(spark, docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions: documents whole, in parts or twice."""
    return mixed_documents(spark, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids: a row per piece of a document, with its ids."""
    return pack(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", jaccard_join),
    ("substring dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The first stage is a trained model, which SQL cannot express; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
