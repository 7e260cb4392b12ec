"""graphmill: property-graph ingestion on Spark.

Mapping specs turn source DataFrames into nodes and edges; upserts, detach deletes, staged sets, progress
from events and Structured Streaming forms are DataFrame operations over parquet.  Start with
``plans.ingest.ingest`` and ``plans.store.GraphStore``; the operators live in ``operators``.
"""

from graphmill.model import EdgeMapping, Graph, NodeMapping
from graphmill.operators.delete import detach_delete
from graphmill.operators.merge import dangling_edges, merge_edges, merge_nodes, merge_typed_edges
from graphmill.operators.progress import request_state
from graphmill.operators.views import graph_sql, register_views
from graphmill.plans.ingest import ingest, load_staged
from graphmill.plans.store import GraphStore
from graphmill.sources.providers import Source

__all__ = [
    "EdgeMapping",
    "Graph",
    "GraphStore",
    "NodeMapping",
    "Source",
    "dangling_edges",
    "detach_delete",
    "graph_sql",
    "ingest",
    "load_staged",
    "merge_edges",
    "merge_nodes",
    "merge_typed_edges",
    "register_views",
    "request_state",
]
__version__ = "0.1.0"
