"""Whole requests: ingest sources into the graph (E1) and load staged content (E2), with events.

The driver only loops over *keys* (one per label and per edge type of the model, a handful); every key
is one set of DataFrame jobs.  Node keys run before edge keys (W1) because an edge merge reads the node
tables its ends live in.  Each step appends a row to the request's event table, from which
``operators.progress`` derives status, counters and completeness.
"""

from __future__ import annotations

import datetime as _dt
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Iterable, Sequence

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.model import EDGES_INGEST, EVENT_SCHEMA, MSG_UNSUPPORTED_OPERATION, NODES_INGEST, UID
from graphmill.operators import staging
from graphmill.operators.merge import CREATED_ACTION, ROWS, UPDATED_ACTION, element_properties
from graphmill.operators.skew import HOT_KEY_MIN_ROWS, orderable
from graphmill.plans.store import GraphStore
from graphmill.plans.translate import MappingTranslator, StagingKey
from graphmill.sources.providers import Source


#: Column of ``_last_values``: the incoming rows of a uid.
_TIMES = "_times"


@dataclass
class EventLog:
    """Events of one run, kept on the driver (a few per key) and written as one small table."""

    request_id: str
    as_of: _dt.datetime
    rows: list = field(default_factory=list)

    def emit(self, event_type: str, message: str, **arguments) -> dict[str, str]:
        """Appends an event; its arguments may be completed later, until the log is written."""
        args = {k: (v if isinstance(v, str) else json.dumps(v, default=str)) for k, v in arguments.items()}
        self.rows.append((self.as_of, len(self.rows), self.request_id, event_type, message, args))
        return args

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, EVENT_SCHEMA)


def _order_keys(keys: Sequence[StagingKey]) -> list[StagingKey]:
    """Nodes first, then by key case-insensitively."""
    return sorted(keys, key=lambda k: (k[1] != NODES_INGEST, ":".join(k).lower()))


def _target(key: StagingKey) -> tuple[str, str]:
    """The table a key writes: a label for nodes, (type, from, to) for edges."""
    _, op, args = key
    return (op, args.split(",")[0] if op == NODES_INGEST else args)


def _check_keys(keys: Iterable[StagingKey]) -> None:
    """Labels and types may not hold the separator of a key's arguments: parts of it would be taken for the whole."""
    for _, op, args in keys:
        if len(args.split(",")) != (1 if op == NODES_INGEST else 3):
            raise ValueError(f"key arguments {args!r} of {op}: a label or type holds a comma, or parts are missing")


class RequestCancelled(RuntimeError):
    """The request was called off before its next step."""


def _go_on(cancelled: Callable[[], bool] | None) -> None:
    if cancelled is not None and cancelled():
        raise RequestCancelled("cancelled")


def _run_keys(store: GraphStore, work: list[tuple[StagingKey, Sequence[DataFrame]]], as_of, order_by, hot_min_rows, parallel: int, cancelled=None) -> list[dict]:
    """Merge every key; all node keys first, then the edge keys.  Within a phase, keys that write different
    tables run as concurrent Spark jobs (driver threads only submit them); keys of one table run in order."""
    results: list[dict | None] = [None] * len(work)

    def run_group(positions: list[int]) -> None:
        for pos in positions:
            _go_on(cancelled)
            key, frames = work[pos]
            results[pos] = _merge_key(store, key, frames, as_of, order_by, hot_min_rows)

    for phase in (NODES_INGEST, EDGES_INGEST):
        groups: dict[tuple[str, str], list[int]] = {}
        for pos, (key, _) in enumerate(work):
            if key[1] == phase:
                groups.setdefault(_target(key), []).append(pos)
        if parallel > 1 and len(groups) > 1:
            with ThreadPoolExecutor(max_workers=min(parallel, len(groups))) as pool:
                # the threads' jobs keep the request's tags and scheduler pool
                for f in [pool.submit(inheritable_thread_target(store.spark)(run_group), positions) for positions in groups.values()]:
                    f.result()
        else:
            for positions in groups.values():
                run_group(positions)
    return results  # type: ignore[return-value]


def _merge_key(store: GraphStore, key: StagingKey, frames: Sequence[DataFrame], as_of, order_by, hot_min_rows) -> dict:
    _, op, args = key
    parts = args.split(",")
    if op == NODES_INGEST:
        # Frames of one shape are one merge; with several shapes a column that one frame lacks is "absent" for
        # its rows (kept), never "null" (overwritten).
        label = parts[0]
        shapes: dict[str, list[DataFrame]] = {}
        for f in frames:
            shapes.setdefault(f.schema.simpleString(), []).append(f)
        by_shape = [staging.union_frames(shapes[s]) for s in sorted(shapes)]
        if order_by and len(by_shape) > 1:
            keyed, batches = _last_values(by_shape, order_by)
        else:
            keyed, batches = None, by_shape
        counters = {"nodes_created": 0, "labels_added": 0, "nodes_matched": 0, "how_many": 0}
        try:
            for batch in batches:
                if keyed is None:
                    counts = store.merge_nodes(label, batch, as_of, order_by)
                else:
                    counts = store.merge_nodes(label, batch, as_of, unique_uids=True, rows_column=_TIMES)
                counters["nodes_created"] += counts[CREATED_ACTION]
                counters["labels_added"] += counts[CREATED_ACTION]
                counters["nodes_matched"] += counts[UPDATED_ACTION]
                counters["how_many"] += counts[ROWS]
        finally:
            if keyed is not None:
                keyed.unpersist()
        return {"key": ":".join(key), "element_type": "NODES", "element_properties": label, **counters}
    incoming = staging.union_frames(frames)
    edge_type, from_label, to_label = parts

    def empty_keys(end: str) -> DataFrame:  # a label with no nodes yet: every edge into it dangles
        return store.spark.createDataFrame([], incoming.select(F.col(end).alias("_uid")).schema)

    from_nodes = store.nodes(from_label)
    to_nodes = store.nodes(to_label)
    counts = store.merge_edges(
        (edge_type, from_label, to_label),
        incoming,
        from_nodes if from_nodes is not None else empty_keys("_fromUid"),
        to_nodes if to_nodes is not None else empty_keys("_toUid"),
        hot_min_rows,
    )
    props = element_properties(edge_type, from_label, to_label)
    counters = {"relationships_created": counts[CREATED_ACTION], "how_many": counts[ROWS]}
    return {"key": ":".join(key), "element_type": "EDGES", "element_properties": props, **counters}


def _last_values(shapes: Sequence[DataFrame], order_by: Sequence[str]) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of several shapes, applied in ``order_by`` over all of them, as disjoint keyed batches; before them the persisted
    frame that they read.

    A property's value is that of the last row whose shape has it.  Uids whose rows together have the same
    properties form one batch with just these columns, and ``_TIMES`` counts a uid's rows; there are at most as
    many batches as sets of shapes that meet in a uid.
    """
    props = sorted({c for s in shapes for c in s.columns if c != UID})
    rows = staging.union_frames([s.withColumns({f"_has_{c}": F.lit(c in s.columns) for c in props}) for s in shapes])
    rows = rows.where(F.col(UID).isNotNull())
    order = F.struct(*[F.col(c) for c in order_by], *[F.col(f"_has_{c}") for c in props], *[F.col(c) for c in props if orderable(rows.schema[c].dataType)])
    last = [F.max_by(F.struct(F.col(c)), F.when(F.col(f"_has_{c}"), order)).getField(c).alias(c) for c in props]
    has = F.array_compact(F.array(*[F.when(F.bool_or(f"_has_{c}"), F.lit(c)) for c in props])).alias("_props")
    keyed = rows.groupBy(UID).agg(*last, has, F.count(F.lit(1)).alias(_TIMES))
    keyed = keyed.persist()  # read once for the sets of properties and once per set
    sets = [r[0] for r in keyed.select("_props").distinct().collect()]
    return keyed, [keyed.where(F.col("_props") == F.array(*map(F.lit, s))).select(UID, *s, _TIMES) for s in sorted(sets)]


class IngestError(RuntimeError):
    """A key failed to load.  Staged keys are kept (a re-run converges); ``events`` holds the request's
    events up to and including the ERROR event, so its state reads ERROR."""

    def __init__(self, message: str, events: DataFrame):
        super().__init__(message)
        self.events = events


@dataclass
class IngestResult:
    request_id: str
    loaded: list[dict]
    events: DataFrame


def ingest(
    spark: SparkSession,
    sources: Sequence[Source],
    store: GraphStore,
    request_id: str,
    as_of: _dt.datetime,
    staging_path: str | None = None,
    translator=None,
    order_by: Sequence[str] | None = None,
    hot_min_rows: int | None = HOT_KEY_MIN_ROWS,
    parallel: int = 4,
    cancelled: Callable[[], bool] | None = None,
) -> IngestResult:
    """Translate every source, (optionally) stage it, merge nodes then edges, drop the staged keys.

    ``cancelled`` is asked before every source and key; once it says so, the request ends with an ERROR event.

    Without ``staging_path`` the translated frames go straight into the merges (the staging round trip is
    not needed on Spark); with it, every key is written as a staged set first (K1) and read back (E2).
    """
    translator = translator or MappingTranslator()
    stamped = f"{request_id}_{as_of.year}_{as_of.month}_{as_of.day}_{as_of.hour}_{as_of.minute}_{as_of.second}"
    log = EventLog(stamped, as_of)
    log.emit("STARTED_PROCESSING_REQUEST", f"Request {stamped} begins")
    log.emit("FETCHING_DATA_AND_MODELS", f"Request {stamped} asks for its sources")
    log.emit("FINISHED_FETCHING_DATA_AND_MODELS", f"Request {stamped} has its sources", sources=[s.name for s in sources])
    try:
        per_source: list[tuple[Source, dict[StagingKey, list[DataFrame]]]] = []
        for src in sources:
            _go_on(cancelled)
            log.emit("WRITING_GRAPH_ELEMENTS_INTO_REDIS", f"Translating [{src.name}]", source_name=src.name)
            translated = translator.translate(src.data, src.graph_model, f"{stamped}_{src.name}")
            _check_keys(translated)
            if staging_path:
                for (job, op, args), frames in translated.items():
                    for f in frames:
                        staging.write_set_add(spark, staging.stage(f, job, op, args), staging_path)
            per_source.append((src, translated))
        # Node keys of every source before any edge key: an edge of source A may end at a node of source B.
        work = [(i, src, key, frames) for i, (src, tr) in enumerate(per_source) for key, frames in tr.items()]
        work.sort(key=lambda w: (w[2][1] != NODES_INGEST, w[0], ":".join(w[2]).lower()))
        if staging_path:
            work = [(i, src, key, _read_staged(spark, staging_path, key)) for i, src, key, _ in work]
        ready = log.emit("REDIS_IS_READY_FOR_CONSUMPTION", f"Request {stamped} is ready to load")
        results = _run_keys(store, [(key, frames) for _, _, key, frames in work], as_of, order_by, hot_min_rows, parallel, cancelled)
        # the sizes are what the merges saw while writing: no source is read a second time to count it
        ready["cardinality"] = json.dumps({":".join(w[2]): r["how_many"] for w, r in zip(work, results, strict=True)})

        loaded = []
        first, last = {}, {}
        for pos, w in enumerate(work):
            first.setdefault(w[0], pos)
            last[w[0]] = pos
        for pos, (i, src, key, _) in enumerate(work):
            if first[i] == pos:
                log.emit("WRITING_FROM_REDIS_TO_NEO", f"Loading source {src.name}", source_name=src.name, processed_keys=[":".join(k) for k in per_source[i][1]])
            r = results[pos]
            log.emit("PUSHED_GRAPH_ELEMENTS_INTO_NEO", _pushed(r), **r)
            loaded.append({"source_name": src.name, **r})
            if last[i] == pos:
                keys = list(per_source[i][1])
                log.emit("DELETING_REDIS_KEYS", f"Keys of {src.name} are loaded", keys=[":".join(k) for k in keys])
                if staging_path:
                    staging.drop_keys(spark, staging_path, keys)
    except Exception as exc:  # noqa: BLE001 - reported as an ERROR event, then raised with the events
        log.emit("ERROR", str(exc), exception=type(exc).__name__)
        raise IngestError(f"request {stamped} failed: {exc}", log.frame(spark)) from exc
    log.emit("DONE_PROCESSING_REQUEST", f"Request {stamped} is loaded")
    return IngestResult(stamped, loaded, log.frame(spark))


def _read_staged(spark: SparkSession, staging_path: str, key: StagingKey) -> list[DataFrame]:
    job, op, args = key
    members = staging.read_staging(spark, staging_path).where(
        (F.col("job_name") == job) & (F.col("operation") == op) & (F.col("arguments") == args)
    )
    shapes = [r[0] for r in members.select(staging.SCHEMA).distinct().collect()]
    return [staging.decode(members.where(F.col(staging.SCHEMA) == s), s) for s in sorted(shapes)]


def load_staged(
    spark: SparkSession,
    staging_path: str,
    store: GraphStore,
    translation_id: str,
    request_id: str,
    as_of: _dt.datetime,
    order_by: Sequence[str] | None = None,
    hot_min_rows: int | None = HOT_KEY_MIN_ROWS,
    delete_after: bool = True,
) -> IngestResult:
    """Merge every staged key of ``translation_id`` (nodes first), then drop those keys.

    Members of one key with several shapes keep presence (absent column vs null value) exact per row; with
    ``order_by`` the last row wins per property over all shapes.  A set has no order by itself: without
    ``order_by`` the shapes apply in the order of their schema text, which makes reruns repeatable.  A failure
    is logged as an ERROR event and raised as ``IngestError`` with the events; the staged keys stay.
    """
    log = EventLog(request_id, as_of)
    log.emit("STARTED_PROCESSING_REQUEST", f"Loading staged keys of {translation_id}")
    loaded = []
    try:
        staged = staging.read_staging(spark, staging_path)
        keys = [tuple(r) for r in staging.keys_of_translation(staged, translation_id).collect()]
        sizes = {(r["job_name"], r["operation"], r["arguments"]): r["cardinality"] for r in staging.cardinality(staged.where(F.col("job_name") == translation_id)).collect()}
        log.emit("REDIS_IS_READY_FOR_CONSUMPTION", f"Staged keys of {translation_id}", cardinality={":".join(k): sizes[k] for k in keys})
        for key in _order_keys(keys):
            if key[1] not in (NODES_INGEST, EDGES_INGEST):
                raise ValueError(MSG_UNSUPPORTED_OPERATION % key[1])
        for key in _order_keys(keys):
            frames = _read_staged(spark, staging_path, key)
            for batch in [frames] if order_by or len(frames) == 1 else [[f] for f in frames]:
                r = _merge_key(store, key, batch, as_of, order_by, hot_min_rows)
                log.emit("PUSHED_GRAPH_ELEMENTS_INTO_NEO", _pushed(r), **r)
                loaded.append(r)
        if delete_after:
            log.emit("DELETING_REDIS_KEYS", "All keys are loaded", keys=[":".join(k) for k in keys])
            staging.drop_keys(spark, staging_path, keys)
    except Exception as exc:  # noqa: BLE001 - reported as an ERROR event, then raised with the events
        log.emit("ERROR", str(exc), exception=type(exc).__name__)
        raise IngestError(f"request {request_id} failed: {exc}", log.frame(spark)) from exc
    log.emit("DONE_PROCESSING_REQUEST", f"Done loading {translation_id}")
    return IngestResult(request_id, loaded, log.frame(spark))


def _pushed(r: dict) -> str:
    return f"Pushed {r['element_type'].lower()}: {r['element_properties']}"
