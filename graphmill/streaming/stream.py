"""Structured Streaming forms.

* T1 ``read_stream``: a file stream read from its beginning in bounded micro-batches; the checkpoint is the
  bookmark (the reference kept its position in memory only).
* T2 ``merge_stream_into_store``: every micro-batch upserted into the graph store with ``foreachBatch``.
  The streaming query's id and the batch's number are committed with the version it wrote, so a replay is
  recognised and changes nothing; streams that write one label at the same time take turns by the store's commit.
* T3 ``live_state``: request state as a streaming aggregation (complete mode), written per batch.
* T4 ``closed_sessions``: requests idle for ``gap`` are emitted once (session window + watermark, append
  mode) and leave the state store.

All state lives in the checkpoint folder (a shared file system), so a lost executor or driver restart
resumes from the last committed batch.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphmill.model import DONE, ERROR, STATUS_EVENTS, UID



def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the files of ``path``; at most ``max_files_per_trigger`` files per micro-batch."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def run_to_end(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process everything available now with ``foreachBatch(sink)`` and stop (``availableNow``)."""
    q = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def copy_to_sink(path: str, mode: str = "append") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink writing each batch to parquet; append is idempotent per batch id through the
    batch folder (a replayed batch overwrites its own folder only)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(path)
        else:
            batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return sink


def fan_out_batches(sinks: Sequence[tuple[str, Callable[[DataFrame, int], None]]], outcomes_path: str) -> Callable[[DataFrame, int], None]:
    """X4 for streams: one ``foreachBatch`` that hands each (persisted) micro-batch to several sinks; a failing
    sink does not stop the others, and every outcome is appended as a row (batch_id, sink, ok, error)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        rows = []
        try:
            for name, fn in sinks:
                try:
                    fn(batch, batch_id)
                    rows.append((batch_id, name, True, None))
                except Exception as exc:  # noqa: BLE001 - reported as a row, never fatal to the others
                    rows.append((batch_id, name, False, str(exc)))
        finally:
            batch.unpersist()
        out = batch.sparkSession.createDataFrame(rows, "batch_id long, sink string, ok boolean, error string")
        out.write.mode("overwrite").parquet(f"{outcomes_path}/batch={batch_id}")

    return sink


def run_listeners(
    stream: DataFrame | Callable[[str], DataFrame],
    listeners: Sequence[tuple[str, Callable[[DataFrame, int], None]]],
    checkpoint_root: str,
    attempts: int = 3,
    mode: str = "append",
) -> list[tuple[str, bool, int, str | None]]:
    """Every listener is a streaming query of its own, with its own checkpoint ``<checkpoint_root>/<name>``, over all there is now.

    A listener that fails stops alone and is started again, up to ``attempts`` times, from the batch that failed; the others go on.  One
    that fails to the end keeps its checkpoint, so a later call delivers what it missed.  Returns (name, ok, attempts, error) per listener.
    ``stream`` may be a function of the checkpoint folder, for sources that need it.
    """

    def start(name: str, sink: Callable[[DataFrame, int], None]):
        folder = f"{checkpoint_root.rstrip('/')}/{name}"
        rows = stream(folder) if callable(stream) else stream
        return rows.writeStream.outputMode(mode).option("checkpointLocation", folder).foreachBatch(sink).trigger(availableNow=True).start()

    sinks = dict(listeners)
    running = {name: (1, start(name, sink)) for name, sink in listeners}
    out: dict[str, tuple[bool, int, str | None]] = {}
    while running:
        for name, (n, query) in list(running.items()):
            try:
                if not query.awaitTermination(0.1 if len(running) > 1 else None):
                    if query.isActive:
                        continue
                out[name] = (True, n, None)
                del running[name]
            except StreamingQueryException as exc:
                if n < attempts:
                    running[name] = (n + 1, start(name, sinks[name]))
                else:
                    out[name] = (False, n, str(exc))
                    del running[name]
    return [(name, *out[name]) for name, _ in listeners]


def batch_of(batch: DataFrame, batch_id: int) -> tuple[str, int] | None:
    """A micro-batch as (streaming query, number), the same after a restart from the same checkpoint; None outside a query."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return (query, batch_id) if query else None


def upsert_sink(store, label: str, key: str, as_of) -> Callable[[DataFrame, int], None]:
    """T3 at scale: an update-mode aggregate emits, per micro-batch, only the keys whose state changed,
    each with its full current state; upserting them by key into ``store`` (nodes of ``label``, ``key``
    as ``_uid``) keeps one current row per key."""
    return merge_sink(store, label, as_of, key=key)


def merge_sink(store, label: str, as_of, order_by: Sequence[str] | None = None, key: str = UID) -> Callable[[DataFrame, int], None]:
    """Upserts every micro-batch into ``store`` under ``label``, rewriting only the buckets its keys fall in (of a bucketed store)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumnRenamed(key, UID).persist()  # read for the buckets, and again for the merge
        try:
            store.merge_nodes(label, rows, as_of, order_by, batch=batch_of(batch, batch_id), small=True)
        finally:
            rows.unpersist()

    return sink


def merge_stream_into_store(stream: DataFrame, store, label: str, as_of, checkpoint: str, order_by: Sequence[str] | None = None) -> None:
    """Upsert every micro-batch of nodes into ``store`` under ``label``."""
    run_to_end(stream, merge_sink(store, label, as_of, order_by), checkpoint)


def live_state(events: DataFrame) -> DataFrame:
    """Per request, status (last status event), start, end and counts, as a streaming aggregate.

    Request ids are unique per run (stamped to the second), so the stream does not replay restarts; the
    batch form ``progress.request_state`` does.
    """
    order = F.struct("timestamp", "seq")
    is_status = F.col("event_type").isin(*STATUS_EVENTS)
    return events.groupBy("request_id").agg(
        F.max_by(F.when(is_status, F.col("event_type")), F.when(is_status, order)).alias("status"),
        F.min("timestamp").alias("first_at"),
        F.max(F.when(F.col("event_type") == DONE, F.col("timestamp"))).alias("end_at"),
        F.count(F.lit(1)).alias("n_events"),
        F.count(F.when(F.col("event_type") == ERROR, 1)).alias("n_errors"),
    )


def closed_sessions(events: DataFrame, gap: str, delay: str) -> DataFrame:
    """T4: one row per (request, activity session) once the watermark has passed the session's end."""
    ev = events.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)
    g = ev.groupBy("request_id", F.session_window("timestamp", gap).alias("session")).agg(
        F.count(F.lit(1)).alias("n_events"),
    )
    return g.select(
        "request_id",
        F.col("session.start").alias("session_start"),
        F.col("session.end").alias("session_end"),
        "n_events",
    )


def dump_closed_sessions(events: DataFrame, path: str, gap: str, delay: str, checkpoint: str) -> None:
    """T4 feeding K9: every session the watermark closes goes once to the JSON-lines state log
    (``dumped_at`` = the session's end), then leaves the state store.  Each micro-batch has a folder of its
    own, which a replay writes again."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("dumped_at", F.col("session_end").cast("timestamp_ntz"))
        out.write.mode("overwrite").json(f"{path}/{'-'.join(map(str, batch_of(batch, batch_id) or ('batch', batch_id)))}")

    run_to_end(closed_sessions(events, gap, delay), sink, checkpoint)
