"""Source providers.

A provider returns ``(source_name, DataFrame, graph_model)`` triples; the DataFrames stay lazy.
Generators take a DataFrame of integer ids (``i``) rather than a count, so their size follows the data
they are derived from and they run partitioned like any other scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Iterable, Protocol, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.model import FROM_UID, TO_UID, EDGE_TYPE, UID


@dataclass(frozen=True)
class Source:
    """A named source, its data and the graph model (mapping specs) that translates it."""

    name: str
    data: DataFrame
    graph_model: Any


class DataAndModelProvider(Protocol):
    """Anything that turns source descriptions into ``Source`` triples."""

    def get_data_and_model_for(self, source_descriptions: Iterable[str]) -> list[Source]: ...


class TableProvider:
    """Sources are parquet (or any format) tables under a folder; the model per name is given."""

    def __init__(self, spark: SparkSession, root: str, models: dict[str, Any], fmt: str = "parquet"):
        self.spark, self.root, self.models, self.fmt = spark, root.rstrip("/"), models, fmt

    def get_data_and_model_for(self, source_descriptions: Iterable[str]) -> list[Source]:
        out = []
        for name in source_descriptions:
            df = self.spark.read.format(self.fmt).load(f"{self.root}/{name}.{self.fmt}")
            out.append(Source(name, df, self.models.get(name)))
        return out


def mock_sources(ids: DataFrame, names: Sequence[str] = ("source-1", "source-2")) -> list[Source]:
    """Per source, rows ``_uid='{s}-{i}'``, ``name='{i}-{s}'``, ``age=i``, ``likes=['{i}-Oranges',
    '{i}-Apples']``, ``email='{i}-{s}@gmail.com'`` for every ``i`` of ``ids``."""
    i = F.col("i")
    out = []
    for s in names:
        df = ids.select(
            F.format_string("%s-%d", F.lit(s), i).alias(UID),
            F.format_string("%d-%s", i, F.lit(s)).alias("name"),
            i.cast("long").alias("age"),
            F.array(F.format_string("%d-Oranges", i), F.format_string("%d-Apples", i)).alias("likes"),
            F.format_string("%d-%s@gmail.com", i, F.lit(s)).alias("email"),
        )
        out.append(Source(s, df, f"A mock model for source {s}."))
    return out


def fixture_nodes(ids: DataFrame, label: str = "Person") -> DataFrame:
    """``_uid=i, name='{label}{i}', age=i, email='{label}{i}@gmail.com'``."""
    i = F.col("i").cast("long")
    return ids.select(
        i.alias(UID),
        F.format_string("%s%d", F.lit(label), i).alias("name"),
        i.alias("age"),
        F.format_string("%s%d@gmail.com", F.lit(label), i).alias("email"),
    )


def fixture_edges(ids: DataFrame, edge_type: str = "EDGE_TYPE") -> DataFrame:
    """``_fromUid=i, _toUid=2*i, _edgeType=edge_type``."""
    i = F.col("i").cast("long")
    return ids.select(i.alias(FROM_UID), (i * 2).alias(TO_UID), F.lit(edge_type).alias(EDGE_TYPE))


def index_documents(ids: DataFrame) -> DataFrame:
    """``pid=i, name='Name_{i}', age=i, org_name='Org_{i}', org_location='location_{i}'``."""
    i = F.col("i").cast("long")
    return ids.select(
        i.alias("pid"),
        F.format_string("Name_%d", i).alias("name"),
        i.alias("age"),
        F.format_string("Org_%d", i).alias("org_name"),
        F.format_string("location_%d", i).alias("org_location"),
    )
