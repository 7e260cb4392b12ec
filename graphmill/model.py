"""Data model: fixed names, mapping specs and the in-memory graph handle."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values.  These must equal the reference's for results to line up; they are stated here
# plainly and in one place.
# ---------------------------------------------------------------------------------------------
UID = "_uid"
FROM_UID = "_fromUid"
TO_UID = "_toUid"
EDGE_TYPE = "_edgeType"
CREATED = "_created"
LAST_UPDATED = "_last_updated"
NODES_INGEST = "nodes_ingest"
EDGES_INGEST = "edges_ingest"
SUPPORTED_OPERATIONS = (NODES_INGEST, EDGES_INGEST)
KEY_SEPARATOR = ":"
ARGUMENT_SEPARATOR = ","
DELETE_BATCH_SIZE = 1000
INDEXED_PROPERTIES = {"*": ["_uid", "_created", "_last_updated", "_table"]}
EVENT_TYPES = (
    "RECEIVED_REQUEST",
    "STARTED_PROCESSING_REQUEST",
    "FETCHING_DATA_AND_MODELS",
    "FINISHED_FETCHING_DATA_AND_MODELS",
    "WRITING_GRAPH_ELEMENTS_INTO_REDIS",
    "REDIS_IS_READY_FOR_CONSUMPTION",
    "WRITING_FROM_REDIS_TO_NEO",
    "PUSHED_GRAPH_ELEMENTS_INTO_NEO",
    "DELETING_REDIS_KEYS",
    "DONE_PROCESSING_REQUEST",
    "ERROR",
    "GENERAL_ERROR",
)
# Event types whose handler sets the request's status (the others only carry data).
STATUS_EVENTS = (
    "STARTED_PROCESSING_REQUEST",
    "FETCHING_DATA_AND_MODELS",
    "FINISHED_FETCHING_DATA_AND_MODELS",
    "WRITING_GRAPH_ELEMENTS_INTO_REDIS",
    "REDIS_IS_READY_FOR_CONSUMPTION",
    "DELETING_REDIS_KEYS",
    "DONE_PROCESSING_REQUEST",
    "ERROR",
)
# Messages of the staging-key checks (format strings, arguments in order).
MSG_KEY_PARTS = "Expected 3 parts in %s but got %d"
MSG_EMPTY_JOB = "Job name must not be empty ! [%s]"
MSG_UNSUPPORTED_OPERATION = "Operation %s is not supported."
# Option of the search-index connector.
INDEX_ARRAY_FIELDS_OPTION = "es.read.field.as.array.include"
REQUEST_MANDATORY_FIELDS = ("request_type", "request_id")
REQUIRED_REQUEST_FIELDS = {"white_list": {"file_path": "str"}}
# ---------------------------------------------------------------------------------------------

# Short aliases of the event types the operators test for.
STARTED = "STARTED_PROCESSING_REQUEST"
DONE = "DONE_PROCESSING_REQUEST"
ERROR = "ERROR"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("request_id", T.StringType(), True),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("message", T.StringType(), True),
        T.StructField("arguments", T.MapType(T.StringType(), T.StringType()), True),
    ]
)

ADMIN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), True),
        T.StructField("job_name", T.StringType(), True),
        T.StructField("job_id", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("int_value", T.LongType(), True),
        T.StructField("string_value", T.StringType(), True),
    ]
)


def _as_col(expr: str | Column) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr


@dataclass(frozen=True)
class NodeMapping:
    """Rows of a source become nodes of ``label``: one ``_uid`` expression plus named properties."""

    label: str
    uid: str | Column
    properties: Mapping[str, str | Column] = field(default_factory=dict)
    where: str | Column | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        if self.where is not None:
            df = df.where(self.where)
        cols = [_as_col(self.uid).alias(UID)] + [_as_col(e).alias(n) for n, e in self.properties.items()]
        return df.select(*cols)

    @property
    def arguments(self) -> str:
        return self.label


@dataclass(frozen=True)
class EdgeMapping:
    """Rows of a source become ``edge_type`` edges from ``from_label`` to ``to_label``."""

    edge_type: str
    from_label: str
    from_uid: str | Column
    to_label: str
    to_uid: str | Column
    where: str | Column | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        if self.where is not None:
            df = df.where(self.where)
        return df.select(
            _as_col(self.from_uid).alias(FROM_UID),
            _as_col(self.to_uid).alias(TO_UID),
            F.lit(self.edge_type).alias(EDGE_TYPE),
        )

    @property
    def arguments(self) -> str:
        return ARGUMENT_SEPARATOR.join([self.edge_type, self.from_label, self.to_label])

    @property
    def key(self) -> tuple[str, str, str]:
        return (self.edge_type, self.from_label, self.to_label)


@dataclass
class Graph:
    """A property graph as DataFrames: one node table per label, one edge table per (type, from, to).

    Node tables hold ``_uid``, properties, ``_created`` and ``_last_updated``; edge tables hold
    ``_fromUid`` and ``_toUid`` (the reference stores no edge properties).
    """

    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[tuple[str, str, str], DataFrame] = field(default_factory=dict)

    def labels(self) -> Sequence[str]:
        return sorted(self.nodes)

    def edge_keys(self) -> Sequence[tuple[str, str, str]]:
        return sorted(self.edges)
