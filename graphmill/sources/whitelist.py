"""White-list scan (S5): a request's file of source names, one per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_white_list(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty, trimmed lines as ``source_name`` (distinct)."""
    lines = spark.read.text(path).select(F.trim("value").alias("source_name"))
    return lines.where(F.length("source_name") > 0).distinct()


def select_sources(sources: DataFrame, white_list: DataFrame, name_col: str = "source_name") -> DataFrame:
    """Sources named in the white list (left-semi join: each source at most once)."""
    return sources.join(white_list.withColumnRenamed("source_name", name_col), name_col, "left_semi")
