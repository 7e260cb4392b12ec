"""Requests in batch: the reference's front desk and coordinator, re-aimed at a table of requests.

``handle_requests`` validates every request (F4), and for each accepted ``white_list`` request reads its
file of source names (S5), fetches those sources from a provider (S1) and ingests them (E1).  Several run at
once, each in a driver thread that only submits Spark jobs, in a scheduler pool and under a job tag of its own, so that a request can be
called off without touching the others, and one that fails fails alone.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections import deque
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.operators.validate import validate_requests
from graphmill.plans.ingest import EventLog, IngestError, IngestResult, ingest
from graphmill.plans.store import GraphStore
from graphmill.sources.whitelist import read_white_list


class RequestControl:
    """Calls off requests, running or not yet begun, from any thread."""

    def __init__(self, spark: SparkSession):
        self._sc = spark.sparkContext
        self._gone: set[str] = set()

    @staticmethod
    def tag(request_id: str) -> str:
        return "request-" + hashlib.sha1(request_id.encode()).hexdigest()[:16]

    def cancel(self, request_id: str) -> None:
        """The request's jobs are cancelled, and it takes no further step."""
        self._gone.add(request_id)
        self._sc.cancelJobsWithTag(self.tag(request_id))

    def cancelled(self, request_id: str) -> bool:
        return request_id in self._gone


@dataclass
class RequestsResult:
    checked: DataFrame  # every request with ``problems`` and ``valid``
    ingested: list[IngestResult]
    events: DataFrame  # RECEIVED_REQUEST / GENERAL_ERROR per request, then each ingest's events
    failed: dict[str, str]  # request id -> why, of accepted requests that did not end well


def received_events(checked: DataFrame, column: str, as_of: _dt.datetime) -> DataFrame:
    """The front desk's events, one or two per request, computed over the requests table: RECEIVED_REQUEST
    (request id as given, ``UNASSIGNED`` without one) and GENERAL_ERROR for a request that is not JSON."""
    v = F.expr(f"try_parse_json(`{column}`)")
    rid = F.coalesce(F.expr(f"variant_get(try_parse_json(`{column}`), '$.request_id', 'string')"), F.lit("UNASSIGNED"))
    ts = F.lit(as_of).cast("timestamp_ntz")
    got = checked.select(
        ts.alias("timestamp"),
        F.lit(-2).cast("long").alias("seq"),
        rid.alias("request_id"),
        F.lit("RECEIVED_REQUEST").alias("event_type"),
        F.concat(F.lit("Received a request: "), F.col(column)).alias("message"),
        F.create_map(F.lit("request_content"), F.col(column)).alias("arguments"),
    )
    bad = checked.where(v.isNull()).select(
        ts.alias("timestamp"),
        F.lit(-1).cast("long").alias("seq"),
        F.lit(None).cast("string").alias("request_id"),
        F.lit("GENERAL_ERROR").alias("event_type"),
        F.lit("Failed parsing the request as a JSON string.").alias("message"),
        F.create_map(F.lit("request_data"), F.col(column)).alias("arguments"),
    )
    return got.unionByName(bad)


def handle_requests(
    spark: SparkSession,
    requests: DataFrame,
    provider,
    store: GraphStore,
    as_of: _dt.datetime,
    column: str = "request",
    translator=None,
    staging_path: str | None = None,
    parallel: int = 4,
    control: RequestControl | None = None,
) -> RequestsResult:
    """Handles every request of the table, at most ``parallel`` at once; results and events come in the table's order.

    A request that fails, or that ``control`` calls off, leaves its ERROR event and an entry in ``failed``."""
    checked = validate_requests(requests, column)
    fields = F.expr(f"try_parse_json(`{column}`)")
    accepted = checked.where("valid").withColumn("v", fields).select(
        F.expr("variant_get(v, '$.request_id', 'string')").alias("request_id"),
        F.expr("variant_get(v, '$.file_path', 'string')").alias("file_path"),
    )
    control = control or RequestControl(spark)
    sc = spark.sparkContext

    def run(request_id: str, file_path: str) -> IngestResult | Exception:
        tag = control.tag(request_id)
        sc.addJobTag(tag)
        sc.setLocalProperty("spark.scheduler.pool", tag)  # a fair share each, where the scheduler's mode is FAIR
        try:
            names = [x[0] for x in read_white_list(spark, file_path).orderBy("source_name").toLocalIterator()]
            sources = provider.get_data_and_model_for(names)
            return ingest(spark, sources, store, request_id, as_of, staging_path=staging_path, translator=translator, cancelled=lambda: control.cancelled(request_id))
        except Exception as exc:  # noqa: BLE001 - reported per request
            return exc
        finally:
            sc.removeJobTag(tag)
            sc.setLocalProperty("spark.scheduler.pool", None)

    outcomes: list[tuple[str, IngestResult | Exception]] = []
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        waiting: deque = deque()
        for r in accepted.toLocalIterator():  # a page of requests at a time
            waiting.append((r["request_id"], pool.submit(inheritable_thread_target(spark)(run), r["request_id"], r["file_path"])))
            if len(waiting) > 2 * parallel:
                name, future = waiting.popleft()
                outcomes.append((name, future.result()))
        outcomes += [(name, future.result()) for name, future in waiting]

    logs, failed = [], {}
    for name, outcome in outcomes:
        if isinstance(outcome, IngestResult):
            logs.append(outcome.events)
            continue
        failed[name] = str(outcome)
        if isinstance(outcome, IngestError):
            logs.append(outcome.events)
        else:  # before its ingest began
            log = EventLog(name, as_of)
            log.emit("ERROR", str(outcome), exception=type(outcome).__name__)
            logs.append(log.frame(spark))
    events = reduce(DataFrame.unionByName, [received_events(checked, column, as_of), *logs])
    return RequestsResult(checked, [x for _, x in outcomes if isinstance(x, IngestResult)], events, failed)
