"""Progress from the event table.

Events have the columns of ``model.EVENT_SCHEMA``: ``timestamp, seq, request_id, event_type, message,
arguments``.  ``(timestamp, seq)`` orders the events of a request.  Every aggregate here is algebraic
(count, sum, max, max_by), so Spark combines map-side and one busy request does not land in one task; the
per-request lists of the reference (errors, maps) are returned in long form instead of one array per
request.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.functions.rows import percent_done, ts_text, unix_seconds
from graphmill.model import ADMIN_LOG_SCHEMA, DONE, ERROR, STARTED, STATUS_EVENTS  # noqa: F401 (re-exported)
from graphmill.operators.skew import HOT_KEY_MIN_ROWS, latest_per_key, number_within, split_join

def _order() -> Column:
    return F.struct(F.col("timestamp"), F.col("seq"))


def since_last_start(events: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    """Events from the last STARTED of their request on (a new STARTED replaces the whole state).

    Requests that never started have no state and drop out.  The last start per request is a partial
    aggregate; joining it back salts busy requests (``split_join``).
    """
    starts = (
        events.where(F.col("event_type") == STARTED)
        .groupBy("request_id")
        .agg(F.max(_order()).alias("_start"))
        .withColumnRenamed("request_id", "_rid")
    )
    j = split_join(events, starts, "request_id", "_rid", "inner", min_rows=hot_min_rows)
    return j.where(_order() >= F.col("_start")).drop("_rid")


def request_state(events: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    """A10: one row per request: status, start / end (text and unix seconds), event and error counts."""
    ev = since_last_start(events, hot_min_rows)
    is_status = F.col("event_type").isin(*STATUS_EVENTS)
    g = ev.groupBy("request_id").agg(
        F.max_by(F.when(is_status, F.col("event_type")), F.when(is_status, _order())).alias("status"),
        F.max("_start").alias("_start"),
        F.max(F.when(F.col("event_type") == DONE, F.col("timestamp"))).alias("_end"),
        F.count(F.lit(1)).alias("n_events"),
        F.count(F.when(F.col("event_type") == ERROR, 1)).alias("n_errors"),
    )
    return g.select(
        "request_id",
        "status",
        ts_text(F.col("_start.timestamp")).alias("start_time"),
        ts_text(F.col("_end")).alias("end_time"),
        unix_seconds(F.col("_start.timestamp")).alias("start_time_unix"),
        unix_seconds(F.col("_end")).alias("end_time_unix"),
        "n_events",
        "n_errors",
    )


def status_times(events: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    """Per request and status, the time of its latest occurrence (long form of the status map)."""
    ev = since_last_start(events, hot_min_rows).where(F.col("event_type").isin(*STATUS_EVENTS))
    g = ev.groupBy("request_id", "event_type").agg(F.max("timestamp").alias("_t"))
    return g.select("request_id", F.col("event_type").alias("status"), ts_text("_t").alias("at"))


def request_errors(events: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    """The errors of each request in order, numbered from 1 (long form)."""
    ev = since_last_start(events, hot_min_rows).where(F.col("event_type") == ERROR)
    ev = ev.select("request_id", "timestamp", "seq", "message")
    return number_within(ev, ["request_id"], ["timestamp", "seq"], out="error_no")


def sequence_check(events: DataFrame, expected: Sequence[str], spark: SparkSession | None = None) -> DataFrame:
    """T5: does each request's ordered event sequence equal ``expected``?

    Events are numbered per request (skew-safe, ``number_within``) and joined to the expected
    (position, type) list, which is a fixed, small table and so broadcast.  No list per request is built.
    Returns request_id, n_events, n_matching, first_mismatch (position, or null) and ``matches``.
    """
    spark = spark or events.sparkSession
    exp = F.broadcast(spark.createDataFrame([(i + 1, t) for i, t in enumerate(expected)], "pos long, expected string"))
    n = number_within(events.select("request_id", "timestamp", "seq", "event_type"), ["request_id"], ["timestamp", "seq"], out="pos")
    j = n.join(exp, "pos", "left")
    hit = F.col("event_type").eqNullSafe(F.col("expected"))
    g = j.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count(F.when(hit, 1)).alias("n_matching"),
        F.min(F.when(~hit, F.col("pos"))).alias("first_mismatch"),
    )
    k = len(expected)
    return g.withColumn("matches", (F.col("n_events") == k) & (F.col("n_matching") == k))


COUNTER_ARGUMENTS = ("nodes_created", "labels_added", "nodes_matched", "relationships_created")


def request_report(events: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    """A10 + A11 + A5 as one document per request, like the reference's request object: the state, the
    status -> latest time map, and the counters per ``element_type_element_properties`` summed over the
    pushed batches.

    The maps are built after partial aggregation, so their inputs are bounded by the model, not by the
    data: at most one entry per status type, one per (key, counter).
    """
    ev = since_last_start(events, hot_min_rows)
    pushed = F.when(F.col("event_type") == "PUSHED_GRAPH_ELEMENTS_INTO_NEO", F.map_filter("arguments", lambda k, v: k.isin(*COUNTER_ARGUMENTS)))
    name = F.concat_ws("_", F.col("arguments")["element_type"], F.col("arguments")["element_properties"])
    # a row per event, and one per counter that it carries: all that follows is one aggregate over both
    entry = "struct<key:string,counter:string,value:bigint>"
    itself = F.array(F.struct(F.lit(None).alias("key"), F.lit(None).alias("counter"), F.lit(None).alias("value")).cast(entry))
    carried = F.transform(F.map_entries(pushed), lambda e: F.struct(name.alias("key"), e["key"].alias("counter"), e["value"].cast("long").alias("value")).cast(entry))
    rows = ev.select("request_id", "event_type", "timestamp", "seq", "_start", F.inline(F.concat(itself, F.coalesce(carried, F.array().cast(f"array<{entry}>")))))
    kinds = rows.groupBy("request_id", "event_type", "key", "counter").agg(
        F.max(_order()).alias("last"), F.max("_start").alias("_start"), F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")
    )
    # at most a row per event type, and per counter of a key: bounded by the model
    event, status = F.col("counter").isNull(), F.col("counter").isNull() & F.col("event_type").isin(*STATUS_EVENTS)
    g = kinds.groupBy("request_id").agg(
        F.max_by(F.when(status, F.col("event_type")), F.when(status, F.col("last"))).alias("status"),
        F.max("_start").alias("_start"),
        F.max(F.when(event & (F.col("event_type") == DONE), F.col("last.timestamp"))).alias("_end"),
        F.sum(F.when(event, F.col("n")).otherwise(0)).alias("n_events"),
        F.sum(F.when(event & (F.col("event_type") == ERROR), F.col("n")).otherwise(0)).alias("n_errors"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(status, F.struct(F.col("event_type").alias("status"), ts_text(F.col("last.timestamp")).alias("at")))))).alias("map_status_to_timestamp"),
        F.array_sort(F.collect_list(F.when(~event, F.struct("key", "counter", "value")))).alias("_counters"),
    )
    own = lambda k: F.transform(F.filter("_counters", lambda c: c["key"] == k), lambda c: F.struct(c["counter"].alias("counter"), c["value"].alias("value")))
    counters = F.map_from_entries(F.transform(F.array_distinct(F.col("_counters.key")), lambda k: F.struct(k.alias("key"), F.map_from_entries(own(k)).alias("counters"))))
    return g.select(
        "request_id",
        "status",
        ts_text(F.col("_start.timestamp")).alias("start_time"),
        ts_text(F.col("_end")).alias("end_time"),
        unix_seconds(F.col("_start.timestamp")).alias("start_time_unix"),
        unix_seconds(F.col("_end")).alias("end_time_unix"),
        F.col("n_events").cast("long").alias("n_events"),
        F.col("n_errors").cast("long").alias("n_errors"),
        "map_status_to_timestamp",
        F.when(F.size("_counters") > 0, counters).alias("counters"),
    )


def counter_rollup(counters: DataFrame) -> DataFrame:
    """A5: sum each counter per (request, ``element_type_element_properties``) over all batches."""
    key = F.concat_ws("_", "element_type", "element_properties")
    return counters.groupBy("request_id", key.alias("key"), "counter").agg(F.sum("value").cast("long").alias("value"))


def progress(cardinality: DataFrame, processed: DataFrame) -> DataFrame:
    """A6 + P16: processed amount per (request, key), summed over batches, with its percent.

    ``cardinality``: request_id, key, cardinality.  ``processed``: request_id, key, how_many (one row per
    batch pushed).  Keys with nothing processed report 0.
    """
    done = processed.groupBy("request_id", "key").agg(F.sum("how_many").cast("long").alias("processed"))
    j = cardinality.join(done, ["request_id", "key"], "left").fillna(0, ["processed"])
    return j.select("request_id", "key", "cardinality", "processed", percent_done("processed", "cardinality").alias("percent"))


def of_ingest(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cardinality, processed) for ``progress`` and ``completeness`` from the events of ``ingest`` or
    ``load_staged``: the sizes of the keys a request has to load, and what each push wrote."""
    sizes = F.from_json(F.col("arguments")["cardinality"], "map<string,bigint>")
    ready = events.where(F.col("arguments")["cardinality"].isNotNull()).select("request_id", F.explode(sizes).alias("key", "cardinality"))
    pushed = events.where(F.col("arguments")["how_many"].isNotNull())
    return ready, pushed.select("request_id", F.col("arguments")["key"].alias("key"), F.col("arguments")["how_many"].cast("long").alias("how_many"))


def missing_keys(expected: DataFrame, finished: DataFrame) -> DataFrame:
    """Expected (request_id, key) pairs with no finished row."""
    return expected.select("request_id", "key").distinct().join(finished.select("request_id", "key"), ["request_id", "key"], "left_anti")


def completeness(expected: DataFrame, finished: DataFrame) -> DataFrame:
    """Per request, expected and missing key counts and whether all keys were written."""
    exp = expected.select("request_id", "key").distinct()
    miss = missing_keys(exp, finished).withColumn("_m", F.lit(1))
    j = exp.join(miss, ["request_id", "key"], "left")
    g = j.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_expected"), F.count("_m").alias("n_missing"))
    return g.withColumn("complete", F.col("n_missing") == 0)


def outcome_summary(outcomes: DataFrame, group: Sequence[str] = ("request_id",)) -> DataFrame:
    """A7 + A8: total, succeeded, failed, all_ok and a verdict per group (``ok`` boolean column)."""
    g = outcomes.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("ok"), 1)).alias("succeeded"),
        F.count(F.when(~F.col("ok"), 1)).alias("failed"),
        F.bool_and("ok").alias("all_ok"),
    )
    verdict = (
        F.when(F.col("failed") > 0, F.lit("FAILED_WRITERS"))
        .when(F.col("succeeded") == 0, F.lit("NOTHING_WRITTEN"))
        .otherwise(F.lit("ALL_OK"))
    )
    return g.withColumn("verdict", verdict)


def source_models(pairs: DataFrame) -> DataFrame:
    """A12 long form: distinct (request_id, source_name, graph_model)."""
    return pairs.select("request_id", "source_name", "graph_model").distinct()


def source_keys(written: DataFrame) -> DataFrame:
    """A13 long form: distinct (source_name, key) processed."""
    return written.select("source_name", "key").distinct()


# --------------------------------------------------------------------------- registry, log, lookup


class DuplicateJobError(ValueError):
    pass


def is_small(df: DataFrame, max_rows: int = 100_000) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (counts at most ``max_rows + 1``)."""
    return df.limit(max_rows + 1).count() <= max_rows


def check_registry(registry: DataFrame) -> None:
    """A job id may be registered once."""
    dup = registry.groupBy("job_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if dup:
        raise DuplicateJobError(f"Job-id {dup[0]['job_id']} is registered {dup[0]['n']} times")


class UnknownJobError(LookupError):
    pass


def name_entries(entries: DataFrame, registry: DataFrame, max_broadcast_rows: int = 100_000, strict: bool = False) -> DataFrame:
    """Fill ``job_name`` of admin-log entries from the id -> name registry.  Unknown ids stay null,
    or with ``strict`` fail (one bounded probe for an entry whose id is not registered)."""
    check_registry(registry)
    if strict:
        unknown = entries.select("job_id").join(registry.select("job_id"), "job_id", "left_anti").limit(1).collect()
        if unknown:
            raise UnknownJobError(f"job id {unknown[0]['job_id']} is not registered")
    reg = registry.select(F.col("job_id").alias("_jid"), F.col("job_name").alias("_name"))
    if is_small(reg, max_broadcast_rows):
        j = entries.join(F.broadcast(reg), entries["job_id"] == reg["_jid"], "left")
    else:  # a large registry: shuffle join, busy job ids salted
        j = split_join(entries, reg, "job_id", "_jid", "left")
    name = F.coalesce(F.col("_name"), F.col("job_name")) if "job_name" in entries.columns else F.col("_name")
    cols = [name.alias("job_name") if c == "job_name" else F.col(c) for c in entries.columns]
    if "job_name" not in entries.columns:
        cols.append(name.alias("job_name"))
    return j.select(*cols)


def create_admin_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """K8: the admin log table (``model.ADMIN_LOG_SCHEMA``), if absent; ``job_id`` is a string since ids
    such as ``Unique-123`` exist."""
    if spark.catalog.tableExists(table):
        return
    spark.catalog.createTable(table, path=location, source="parquet", schema=ADMIN_LOG_SCHEMA)


@dataclass
class Outcome:
    """What a writer of a fan-out came to: its result, or the exception that it raised."""

    name: str
    result: object = None
    error: Exception | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


def fan_out_outcomes(df: DataFrame, writers: Iterable[tuple[str, Callable[[DataFrame], object]]]) -> list[Outcome]:
    """Hand one (persisted) frame to several writers; a failing writer does not stop the others.  Results and
    exceptions come back per writer."""
    df = df.persist()
    out = []
    try:
        for name, write in writers:
            try:
                out.append(Outcome(name, write(df)))
            except Exception as exc:  # noqa: BLE001 - every writer failure is reported, none is fatal
                out.append(Outcome(name, error=exc))
    finally:
        df.unpersist()
    return out


def outcomes_frame(spark: SparkSession, outcomes: Iterable[Outcome], request_id: str | None = None) -> DataFrame:
    """A7 in long form, a row per writer: request_id, writer, ok, result (as text), error_type and error; ``outcome_summary`` reads it."""
    rows = [(request_id, o.name, o.ok, None if o.result is None else str(o.result), type(o.error).__name__ if o.error else None, str(o.error) if o.error else None) for o in outcomes]
    return spark.createDataFrame(rows, "request_id string, writer string, ok boolean, result string, error_type string, error string")


def fan_out(df: DataFrame, writers: Iterable[tuple[str, Callable[[DataFrame], object]]]) -> list[tuple[str, bool, str | None]]:
    """``fan_out_outcomes`` as (writer, ok, error) per writer."""
    return [(o.name, o.ok, None if o.ok else str(o.error)) for o in fan_out_outcomes(df, writers)]


def jdbc_writer(url: str, table: str, properties: dict | None = None) -> Callable[[DataFrame], None]:
    """K7: a ``fan_out`` writer appending to a relational table (driver jar on the classpath); the same
    DataFrame can go to parquet, a catalog table and a database in one fan-out."""

    def write(df: DataFrame) -> None:
        df.write.mode("append").jdbc(url, table, properties=properties or {})

    return write


def dump_states(states: DataFrame, path: str, as_of) -> None:
    """K9: append one JSON document per request (JSON lines), stamped ``dumped_at``.

    Append-only: no folder per request (millions of small folders at scale), nothing overwritten, so a
    failed dump leaves the earlier ones intact; ``read_dumped`` keeps the latest document per request.
    """
    from graphmill.operators.merge import as_of_literal

    states.withColumn("dumped_at", as_of_literal(as_of)).write.mode("append").json(path)


def read_dumped(spark: SparkSession, path: str, schema) -> DataFrame:
    """The latest dumped state per request (partial aggregate: a request dumped often stays cheap)."""
    from pyspark.sql import types as T

    full = T.StructType(list(schema.fields) + [T.StructField("dumped_at", T.TimestampNTZType())])
    dumps = spark.read.schema(full).option("recursiveFileLookup", "true").json(path)
    return latest_per_key(dumps, ["request_id"], ["dumped_at"]).drop("dumped_at")


def progress_lookup(live: DataFrame, dumped: DataFrame | None) -> DataFrame:
    """Live state first, then the dumped one for requests no longer live; ``source`` says which."""
    l = live.withColumn("source", F.lit("memory"))
    if dumped is None:
        return l
    d = dumped.select(*live.columns).join(live.select("request_id"), "request_id", "left_anti").withColumn("source", F.lit("dump"))
    return l.unionByName(d)
