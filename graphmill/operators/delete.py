"""Detach delete (J4) with its predicate (F6) and index guard."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphmill.model import DELETE_BATCH_SIZE, FROM_UID, INDEXED_PROPERTIES, TO_UID, UID, Graph
from graphmill.operators.skew import HOT_KEY_MIN_ROWS, hot_keys_by_column, split_join


class PropertyNotIndexedError(ValueError):
    pass


def _same_kind(value: object, data_type: T.DataType) -> bool:
    if isinstance(value, bool):
        return isinstance(data_type, T.BooleanType)
    if isinstance(value, str):
        return isinstance(data_type, (T.StringType, T.VarcharType, T.CharType))
    if isinstance(value, (int, float)):
        return isinstance(data_type, T.NumericType)
    return True


def property_predicate(conditions: Sequence[tuple[str, object]], schema: T.StructType | None = None) -> Column:
    """conjunction of ``property = value`` with typed comparison.

    With the table's schema, a value of another kind than the column never matches (a quoted ``'5'``
    does not match the number 5), instead of Spark's implicit cast, and a property that the table lacks
    matches nothing.
    """
    if not conditions:
        raise ValueError("at least one (property, value) condition is required")
    parts = []
    for name, value in conditions:
        if schema is not None and (name not in schema.fieldNames() or not _same_kind(value, schema[name].dataType)):
            parts.append(F.lit(False))
        else:
            parts.append(F.col(name) == F.lit(value))
    return reduce(lambda a, b: a & b, parts)


def check_indexed(label: str, properties: Iterable[str], indexed: Mapping[str, Sequence[str]] = INDEXED_PROPERTIES) -> None:
    """delete only by declared key properties (``'*'`` applies to every label)."""
    allowed = set(indexed.get("*", [])) | set(indexed.get(label, []))
    for p in properties:
        if p not in allowed:
            raise PropertyNotIndexedError(f"{label} nodes cannot be deleted by {p!r}: it is not a declared key property")


@dataclass
class DeleteResult:
    graph: Graph
    deleted: DataFrame  # uids removed from the label
    summary: DataFrame  # label, total, batches, edges_deleted


TOUCHED = "_touched"


def edges_touching(edges: DataFrame, key: tuple[str, str, str], label: str, deleted: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame | None:
    """``edges`` with a flag for those that end at a node of ``deleted`` (nodes of ``label``); None when the
    table's ends have other labels."""
    sides = [c for c, l in ((FROM_UID, key[1]), (TO_UID, key[2])) if l == label]
    if not sides:
        return None
    hot = hot_keys_by_column(edges, sides, hot_min_rows) if hot_min_rows is not None else {c: [] for c in sides}
    out, hits = edges, []
    for i, c in enumerate(sides):
        gone = deleted.select(F.col(UID).alias("_gone"), F.lit(True).alias(f"_hit{i}"))
        out = split_join(out, gone, c, "_gone", "left", min_rows=hot_min_rows, hot=hot[c]).drop("_gone")
        hits.append(F.coalesce(F.col(f"_hit{i}"), F.lit(False)))
    return out.withColumn(TOUCHED, reduce(lambda a, b: a | b, hits)).drop(*[f"_hit{i}" for i in range(len(sides))])


def detach_delete(
    graph: Graph,
    label: str,
    conditions: Sequence[tuple[str, object]],
    indexed: Mapping[str, Sequence[str]] | None = INDEXED_PROPERTIES,
    batch_size: int = DELETE_BATCH_SIZE,
    hot_min_rows: int | None = HOT_KEY_MIN_ROWS,
) -> DeleteResult:
    """Remove nodes of ``label`` matching all ``conditions`` and every edge touching one of them.

    Only declared properties may be named (F7; ``indexed=None`` turns the guard off).  A null property never
    matches, and a label without nodes gives zero.  Edge tables whose ends do not have the label are passed
    through untouched; in the others each end is joined once with the deleted uids (a supernode's edges are
    salted by ``split_join``), which tells kept rows and counts together.
    """
    if indexed is not None:
        check_indexed(label, [c for c, _ in conditions], indexed)
    if label not in graph.nodes:
        spark = next((df.sparkSession for df in [*graph.nodes.values(), *graph.edges.values()]), None) or SparkSession.active()
        none = spark.createDataFrame([], f"{UID} string")
        zero = spark.range(1).select(F.lit(label).alias("label"), *[F.lit(0).cast("long").alias(c) for c in ("total", "batches", "edges_deleted")])
        return DeleteResult(graph, none, zero)
    nodes = graph.nodes[label]
    hit = F.coalesce(property_predicate(conditions, nodes.schema), F.lit(False))
    kept = nodes.where(~hit)
    deleted = nodes.where(hit).select(UID)

    new_edges: dict = {}
    removed_counts: list[DataFrame] = []
    for key, edges in graph.edges.items():
        tagged = edges_touching(edges, key, label, deleted, hot_min_rows)
        new_edges[key] = edges if tagged is None else tagged.where(~F.col(TOUCHED)).drop(TOUCHED)
        if tagged is not None:
            removed_counts.append(tagged.agg(F.count(F.when(F.col(TOUCHED), 1)).alias("n")))

    total = deleted.agg(F.count(F.lit(1)).alias("total"))
    if removed_counts:
        edges_deleted = reduce(DataFrame.unionByName, removed_counts).agg(F.sum("n").cast("long").alias("edges_deleted"))
    else:
        edges_deleted = nodes.sparkSession.range(1).select(F.lit(0).cast("long").alias("edges_deleted"))
    summary = (
        total.select(F.lit(label).alias("label"), F.col("total"), F.lit(0).cast("long").alias("edges_deleted"))
        .unionByName(edges_deleted.select(F.lit(label).alias("label"), F.lit(0).cast("long").alias("total"), F.col("edges_deleted")))
        .groupBy("label")
        .agg(F.sum("total").cast("long").alias("total"), F.sum("edges_deleted").cast("long").alias("edges_deleted"))
        .select(
            "label",
            "total",
            F.ceil(F.col("total") / F.lit(batch_size)).cast("long").alias("batches"),
            "edges_deleted",
        )
    )
    new_nodes = dict(graph.nodes)
    new_nodes[label] = kept
    return DeleteResult(Graph(new_nodes, new_edges), deleted, summary)
