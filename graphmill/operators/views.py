"""Graph-wide counts (A2, A3), the undirected view (U4) and SQL views."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.functions.rows import to_entries
from graphmill.model import FROM_UID, TO_UID, UID, Graph


def count_nodes_by_label(graph: Graph) -> DataFrame:
    """A2: ``MATCH (n:L) RETURN count(n)`` for every label, as (label, n)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("label"), "n") for label, df in sorted(graph.nodes.items())]
    return reduce(DataFrame.unionByName, parts)


def count_edges_by_type(graph: Graph) -> DataFrame:
    """A3: ``MATCH ()-[:T]->() RETURN count(*)`` per type (summed over end labels), as (edge_type, n)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(key[0]).alias("edge_type"), "n") for key, df in sorted(graph.edges.items())]
    return reduce(DataFrame.unionByName, parts).groupBy("edge_type").agg(F.sum("n").cast("long").alias("n"))


def undirected_graph(node_frames: Sequence[DataFrame], edge_frames: Sequence[tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """U4: (vertices, edges) of the undirected graph over staged nodes and edges.

    Vertices: every node uid plus every edge end, ``has_node`` telling whether a node row exists.  Edges:
    one per unordered pair (parallel and reversed edges collapse), ``type`` = the key's arguments (the
    greatest one when several keys hold the pair, so the result is repeatable).  Raises when there are
    no node frames.
    """
    if not node_frames:
        raise ValueError("an undirected graph needs node frames")
    node_ids = reduce(DataFrame.unionByName, [f.select(F.col(UID).cast("string").alias("id")) for f in node_frames])
    edges = reduce(
        DataFrame.unionByName,
        [e.select(F.col(FROM_UID).cast("string").alias("a"), F.col(TO_UID).cast("string").alias("b"), F.lit(t).alias("type")) for t, e in edge_frames],
    ).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    und = edges.groupBy(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).agg(F.max("type").alias("type"))
    ends = und.select(F.col("u").alias("id")).unionByName(und.select(F.col("v").alias("id")))
    vertices = (
        node_ids.withColumn("_node", F.lit(1))
        .unionByName(ends.withColumn("_node", F.lit(0)))
        .groupBy("id")
        .agg((F.max("_node") == 1).alias("has_node"))
    )
    return vertices, und


def undirected_attributes(node_frames: Sequence[DataFrame]) -> DataFrame:
    """U4: the vertices' node attributes in long form, (id, attribute, value as text).  A node that several
    rows describe has every attribute once, the greatest value."""
    if not node_frames:
        raise ValueError("an undirected graph needs node frames")
    long = [to_entries(f.select(F.col(UID).cast("string").alias("id"), *[c for c in f.columns if c != UID]), [c for c in f.columns if c != UID]) for f in node_frames]
    return reduce(DataFrame.unionByName, long).where(F.col("value").isNotNull()).groupBy("id", "attribute").agg(F.max("value").alias("value"))


def register_views(spark: SparkSession, graph: Graph, prefix: str = "") -> list[str]:
    """``nodes_<Label>`` and ``edges_<TYPE>_<From>_<To>`` temp views for plain Spark SQL reads."""
    names = []
    for label, df in graph.nodes.items():
        name = f"{prefix}nodes_{label}"
        df.createOrReplaceTempView(name)
        names.append(name)
    for (t, a, b), df in graph.edges.items():
        name = f"{prefix}edges_{t}_{a}_{b}"
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def graph_sql(spark: SparkSession, graph: Graph, query: str, prefix: str = "") -> DataFrame:
    """Run ``query`` against the graph's views (the reference's free-text query, as Spark SQL)."""
    register_views(spark, graph, prefix)
    return spark.sql(query)
