"""Node and edge upserts (J1, J2), dangling edges (J3) and merge counters (A4).

Semantics pinned by the tests:

* A node is matched on ``_uid`` within its label.  Created: all incoming properties plus ``_created``.
  Matched: every column of the incoming *schema* overwrites, null included; columns absent from the
  incoming schema keep their value; ``_last_updated`` is set.  Presence comes from the schema, never from
  null tests.
* Several incoming rows with one ``_uid`` are applied one after another: one node, the last row wins, and
  ``_last_updated`` is set even on a new node.  "Last" is the greatest ``order_by`` tuple (default: all
  columns), so the result is repeatable.
* Timestamps come from the ``as_of`` parameter; nothing reads the clock inside an operator.
* An edge needs both ends under their labels, else it is dropped (and reported by ``dangling_edges``).
  One edge per (from, type, to); edges carry no properties.  Null ids match nothing.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphmill.model import CREATED, FROM_UID, LAST_UPDATED, TO_UID, UID
from graphmill.operators.skew import HOT_KEY_MIN_ROWS, hot_keys_by_column, latest_per_key, orderable, quoted, split_join

ACTION = "_action"
CREATED_ACTION, UPDATED_ACTION, KEPT_ACTION = "created", "updated", "kept"
ACTIONS = (CREATED_ACTION, UPDATED_ACTION, KEPT_ACTION)
#: An incoming edge without one of its ends; it is not merged.
DANGLING_ACTION = "dangling"
#: Incoming rows that a flagged row stands for (0: none).
ROWS = "_rows"
SYSTEM_COLUMNS = (CREATED, LAST_UPDATED)


def as_of_literal(as_of: str | _dt.datetime | Column) -> Column:
    """A fixed ``TIMESTAMP_NTZ`` literal for ``_created`` / ``_last_updated``."""
    if isinstance(as_of, Column):
        return as_of.cast(T.TimestampNTZType())
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(as_of).cast(T.TimestampNTZType())


def _props(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (UID, ACTION, ROWS) and c not in SYSTEM_COLUMNS]


def dedupe_incoming(incoming: DataFrame, order_by: Sequence[str] | None = None, unique_uids: bool = False, rows_column: str = ROWS) -> DataFrame:
    """One row per ``_uid`` (the last to apply), plus ``rows_column`` = rows of that uid in the batch.

    ``unique_uids``: the caller guarantees one row per uid (a keyed source, another merge's output), so
    the sort-based dedupe aggregate is skipped; the join still shuffles the batch once.
    """
    inc = incoming.where(F.col(UID).isNotNull())
    if unique_uids:
        return inc if rows_column in inc.columns else inc.withColumn(rows_column, F.lit(1).cast("long"))
    order = list(order_by) if order_by else [c for c in inc.columns if c != UID and orderable(inc.schema[c].dataType)]
    return latest_per_key(inc, [UID], order, count_as=rows_column)


def _check_merge(existing: DataFrame | None, incoming: DataFrame) -> None:
    """Names and key types that no merge can honour are errors before any job runs."""
    taken = [c for c in (ACTION, ROWS) if c in incoming.columns]
    if taken:
        raise ValueError(f"property names {taken} are reserved for merges; rename them")
    if existing is not None:
        old, new = existing.schema[UID].dataType, incoming.schema[UID].dataType
        if old != new and not (isinstance(old, T.IntegralType) and isinstance(new, T.IntegralType)):
            raise ValueError(f"the label's {UID} is {old.simpleString()}, the incoming one {new.simpleString()}; cast one of them")


def merge_nodes_tagged(
    existing: DataFrame | None,
    incoming: DataFrame,
    as_of,
    order_by: Sequence[str] | None = None,
    unique_uids: bool = False,
    rows_column: str | None = None,
) -> DataFrame:
    """The node table after the upsert, with ``_action`` (created / updated / kept) and ``_rows``, the incoming rows applied.

    ``rows_column`` names a column of ``incoming`` that is no property: how many rows each of its (unique) rows stands for."""
    props_of = incoming if rows_column is None else incoming.drop(rows_column)
    _check_merge(existing, props_of)
    ts = as_of_literal(as_of)
    count = rows_column or ROWS
    inc = dedupe_incoming(incoming, order_by, unique_uids, count)
    in_props = _props(props_of)
    # user names may hold dots or look like inner ones: inside the join all columns are numbered
    i_of = {c: f"i{n}" for n, c in enumerate([UID, *in_props, *[c for c in SYSTEM_COLUMNS if c in props_of.columns]])}
    i = inc.select(*[F.col(quoted(c)).alias(a) for c, a in i_of.items()], F.col(quoted(count)).alias("n"))
    last = F.when(F.col("n") > 1, ts)
    if LAST_UPDATED in i_of:
        last = last.otherwise(F.col(i_of[LAST_UPDATED]))

    if existing is None:
        return i.select(
            F.col(i_of[UID]).alias(UID),
            *[F.col(i_of[c]).alias(c) for c in in_props],
            ts.alias(CREATED),
            last.cast(T.TimestampNTZType()).alias(LAST_UPDATED),
            F.lit(CREATED_ACTION).alias(ACTION),
            F.col("n").alias(ROWS),
        )

    ex_props = _props(existing)
    for c in SYSTEM_COLUMNS:  # a table written without a merge has no timestamps yet
        if c not in existing.columns:
            existing = existing.withColumn(c, F.lit(None).cast(T.TimestampNTZType()))
    e_of = {c: f"e{n}" for n, c in enumerate([UID, *ex_props, *SYSTEM_COLUMNS])}
    e = existing.select(*[F.col(quoted(c)).alias(a) for c, a in e_of.items()], F.lit(True).alias("old"))
    j = e.join(i, F.col(e_of[UID]) == F.col(i_of[UID]), "full_outer")
    new, old = F.col("n").isNotNull(), F.col("old").isNotNull()

    cols = [F.coalesce(i_of[UID], e_of[UID]).alias(UID)]
    for c in ex_props:
        own = F.col(e_of[c])
        cols.append((F.when(new, F.col(i_of[c])).otherwise(own) if c in in_props else own).alias(c))
    cols += [F.col(i_of[c]).alias(c) for c in in_props if c not in ex_props]

    created = F.when(old & new, F.col(i_of.get(CREATED, e_of[CREATED]))).when(old, F.col(e_of[CREATED])).otherwise(ts)
    updated = F.when(old & new, ts).when(new, last).otherwise(F.col(e_of[LAST_UPDATED]))
    action = F.when(old & new, UPDATED_ACTION).when(new, CREATED_ACTION).otherwise(KEPT_ACTION)
    cols += [
        created.cast(T.TimestampNTZType()).alias(CREATED),
        updated.cast(T.TimestampNTZType()).alias(LAST_UPDATED),
        action.alias(ACTION),
        F.coalesce("n", F.lit(0)).cast("long").alias(ROWS),
    ]
    return j.select(*cols)


def merge_nodes_flagged(existing: DataFrame | None, incoming: DataFrame, as_of, order_by: Sequence[str] | None = None, unique_uids: bool = False) -> DataFrame:
    """The node table after the upsert, with an ``_action`` column (created / updated / kept)."""
    return merge_nodes_tagged(existing, incoming, as_of, order_by, unique_uids).drop(ROWS)


def merge_nodes(
    existing: DataFrame | None, incoming: DataFrame, as_of, order_by: Sequence[str] | None = None, unique_uids: bool = False
) -> DataFrame:
    """Upsert ``incoming`` into the node table ``existing`` (``None`` = empty label)."""
    return merge_nodes_flagged(existing, incoming, as_of, order_by, unique_uids).drop(ACTION)


def node_counters(flagged: DataFrame, incoming: DataFrame, label: str) -> DataFrame:
    """A4 for a node merge, long form ``(element_type, element_properties, counter, value)``.

    nodes_created = labels_added = new uids; properties_set = per applied incoming row, its non-null
    properties plus the timestamp it sets.
    """
    made = flagged.where(F.col(ACTION) == CREATED_ACTION).agg(F.count(F.lit(1)).alias("n"))
    props = _props(incoming)
    non_null = sum((F.col(quoted(c)).isNotNull().cast("long") for c in props), F.lit(0).cast("long"))
    set_ = incoming.where(F.col(UID).isNotNull()).agg(F.coalesce(F.sum(non_null + 1), F.lit(0)).cast("long").alias("n"))
    head = [F.lit("NODES").alias("element_type"), F.lit(label).alias("element_properties")]
    both = F.inline(F.array(*[F.struct(F.lit(c).alias("counter"), F.col("n").alias("value")) for c in ("nodes_created", "labels_added")]))
    return made.select(*head, both).unionByName(set_.select(*head, F.lit("properties_set").alias("counter"), F.col("n").alias("value")))


def valid_edges(
    incoming: DataFrame,
    from_nodes: DataFrame,
    to_nodes: DataFrame,
    hot_min_rows: int | None = HOT_KEY_MIN_ROWS,
) -> DataFrame:
    """Distinct (from, to) pairs of ``incoming`` whose ends both exist.

    Repeats collapse first (partial aggregate), then each end is checked with a semi-join against the node
    keys only; a supernode's edges are salted by ``split_join``.  Hot ends are counted once,
    on the raw input, for both ends in one pass.
    """
    hot = _hot_ends(incoming, hot_min_rows)
    pairs = (
        incoming.select(FROM_UID, TO_UID)
        .where(F.col(FROM_UID).isNotNull() & F.col(TO_UID).isNotNull())
        .distinct()
    )
    fk = from_nodes.select(F.col(UID).alias("_fk"))
    tk = to_nodes.select(F.col(UID).alias("_tk"))
    pairs = split_join(pairs, fk, FROM_UID, "_fk", "left_semi", min_rows=hot_min_rows, hot=hot[FROM_UID])
    pairs = split_join(pairs, tk, TO_UID, "_tk", "left_semi", min_rows=hot_min_rows, hot=hot[TO_UID])
    return pairs


def _hot_ends(edges: DataFrame, hot_min_rows: int | None) -> dict[str, list]:
    if hot_min_rows is None:
        return {FROM_UID: [], TO_UID: []}
    return hot_keys_by_column(edges, [FROM_UID, TO_UID], hot_min_rows)


def _checked_pairs(incoming: DataFrame, from_nodes: DataFrame, to_nodes: DataFrame, hot_min_rows: int | None) -> DataFrame:
    """The distinct pairs of ``incoming`` with their ``_rows`` and whether each end exists (``_f``, ``_t``)."""
    hot = _hot_ends(incoming, hot_min_rows)
    pairs = incoming.groupBy(FROM_UID, TO_UID).agg(F.count(F.lit(1)).alias(ROWS))
    for end, nodes, found in ((FROM_UID, from_nodes, "_f"), (TO_UID, to_nodes, "_t")):
        keys = nodes.select(F.col(UID).alias("_k"), F.lit(True).alias(found))
        pairs = split_join(pairs, keys, end, "_k", "left", min_rows=hot_min_rows, hot=hot[end]).drop("_k")
    return pairs


def merge_edges_tagged(
    existing: DataFrame | None,
    incoming: DataFrame,
    from_nodes: DataFrame,
    to_nodes: DataFrame,
    hot_min_rows: int | None = HOT_KEY_MIN_ROWS,
) -> DataFrame:
    """The edges after the upsert with ``_action`` (created / kept / dangling: not an edge) and ``_rows``, the incoming rows
    of the pair; ``applied_edges`` leaves the table."""
    pairs = _checked_pairs(incoming, from_nodes, to_nodes, hot_min_rows)
    valid = F.col("_f").isNotNull() & F.col("_t").isNotNull()
    if existing is None:
        return pairs.select(FROM_UID, TO_UID, F.when(valid, CREATED_ACTION).otherwise(DANGLING_ACTION).alias(ACTION), ROWS)
    # 1:1 full outer join on the pair (both sides are unique on it): the output stays partitioned like a
    # bucketed existing table, so the next version is written bucket by bucket without another shuffle.
    old = existing.select(FROM_UID, TO_UID, F.lit(True).alias("_old"))
    j = old.join(pairs, [FROM_UID, TO_UID], "full_outer")
    action = F.when(F.col("_old").isNotNull(), KEPT_ACTION).when(valid, CREATED_ACTION).otherwise(DANGLING_ACTION)
    return j.select(FROM_UID, TO_UID, action.alias(ACTION), F.coalesce(ROWS, F.lit(0)).cast("long").alias(ROWS))


def applied_edges(tagged: DataFrame) -> DataFrame:
    """The edge table of a tagged merge."""
    return tagged.where(F.col(ACTION) != DANGLING_ACTION).select(FROM_UID, TO_UID)


def merge_edges_flagged(existing: DataFrame | None, incoming: DataFrame, from_nodes: DataFrame, to_nodes: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    """The edge table after the upsert, with ``_action`` (created / kept)."""
    return merge_edges_tagged(existing, incoming, from_nodes, to_nodes, hot_min_rows).where(F.col(ACTION) != DANGLING_ACTION).drop(ROWS)


def merge_edges(existing, incoming, from_nodes, to_nodes, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    return applied_edges(merge_edges_tagged(existing, incoming, from_nodes, to_nodes, hot_min_rows))


def edge_counters(flagged: DataFrame, edge_type: str, from_label: str, to_label: str) -> DataFrame:
    made = flagged.where(F.col(ACTION) == CREATED_ACTION).agg(F.count(F.lit(1)).alias("value"))
    return made.select(
        F.lit("EDGES").alias("element_type"),
        F.lit(element_properties(edge_type, from_label, to_label)).alias("element_properties"),
        F.lit("relationships_created").alias("counter"),
        F.col("value"),
    )


def element_properties(edge_type: str, from_label: str, to_label: str) -> str:
    """P14 for edges: ``type_from_to``."""
    return f"{edge_type}_{from_label}_{to_label}"


def dangling_edges(
    incoming: DataFrame,
    from_nodes: DataFrame,
    to_nodes: DataFrame,
    hot_min_rows: int | None = HOT_KEY_MIN_ROWS,
) -> DataFrame:
    """Incoming edges a merge would drop, with ``missing_from`` / ``missing_to`` flags."""
    hot = _hot_ends(incoming, hot_min_rows)
    # a pair that repeats is one row until the end
    e = incoming.groupBy(FROM_UID, TO_UID).agg(F.count(F.lit(1)).alias("_times"))
    fk = from_nodes.select(F.col(UID).alias("_fk"), F.lit(True).alias("_fhit"))
    tk = to_nodes.select(F.col(UID).alias("_tk"), F.lit(True).alias("_thit"))
    e = split_join(e, fk, FROM_UID, "_fk", "left", min_rows=hot_min_rows, hot=hot[FROM_UID])
    e = split_join(e, tk, TO_UID, "_tk", "left", min_rows=hot_min_rows, hot=hot[TO_UID])
    out = e.select(
        FROM_UID,
        TO_UID,
        "_times",
        F.col("_fhit").isNull().alias("missing_from"),
        F.col("_thit").isNull().alias("missing_to"),
    )
    out = out.where(F.col("missing_from") | F.col("missing_to"))
    return out.withColumn("_times", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).drop("_times")


#: Folder value of an empty edge type (an empty partition value reads back as null).
_EMPTY_TYPE = "\\e"


def _written_types(spark, path: str) -> list[str]:
    """The edge types in a folder partitioned by type, from its listing."""
    from urllib.parse import unquote

    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(unquote(n.split("=", 1)[1]) for n in names if n.startswith("_type="))


def merge_typed_edges(
    graph,
    incoming: DataFrame,
    from_label: str,
    to_label: str,
    edge_type: str | None = None,
    hot_min_rows: int | None = HOT_KEY_MIN_ROWS,
    path: str | None = None,
):
    """J2 with P15: each incoming edge's type is ``edge_type`` when given, else its own ``_edgeType``; null types and ids are no edges.

    One merge for all types, keyed by (type, from, to): the source is read once, edges that the graph knows go first (one shuffle of
    the triples), the rest is written to scratch, and only its ends are checked (a shuffle for each end; hot ends are sampled
    from scratch).  New edges are written once, partitioned by type, under ``path`` (default: the scratch folder).  Returns a new
    ``Graph`` whose tables ``(type, from_label, to_label)`` are the known edges and those.
    """
    from graphmill.model import EDGE_TYPE, Graph
    from graphmill.session import scratch_path

    spark = incoming.sparkSession
    path = path or scratch_path(spark, "typed-edges")
    kind = F.coalesce(F.lit(edge_type).cast("string"), F.col(EDGE_TYPE).cast("string"))
    ends = [F.col(c).isNotNull() for c in (FROM_UID, TO_UID)]
    fresh = incoming.select(F.when(kind == "", _EMPTY_TYPE).otherwise(kind).alias("_type"), FROM_UID, TO_UID).where(F.col("_type").isNotNull() & ends[0] & ends[1]).distinct()
    known = {k: e for k, e in graph.edges.items() if k[1:] == (from_label, to_label)}
    if known:
        held = [e.select(F.lit(k[0] or _EMPTY_TYPE).alias("_type"), FROM_UID, TO_UID) for k, e in known.items()]
        fresh = fresh.join(reduce(DataFrame.unionByName, held), ["_type", FROM_UID, TO_UID], "left_anti")
    fresh.write.parquet(f"{path}/fresh")
    fresh = spark.read.schema(fresh.schema).parquet(f"{path}/fresh")
    hot = _hot_ends(fresh, hot_min_rows)
    for end, nodes in ((FROM_UID, graph.nodes[from_label]), (TO_UID, graph.nodes[to_label])):
        fresh = split_join(fresh, nodes.select(F.col(UID).alias("_k")), end, "_k", "left_semi", min_rows=hot_min_rows, hot=hot[end])
    fresh.write.partitionBy("_type").parquet(f"{path}/edges")
    new = spark.read.schema(T.StructType([*fresh.schema.fields])).parquet(f"{path}/edges")
    edges = dict(graph.edges)
    for t in _written_types(spark, f"{path}/edges"):
        key = ("" if t == _EMPTY_TYPE else t, from_label, to_label)
        own = new.where(F.col("_type") == t).select(FROM_UID, TO_UID)  # that type's folder only
        edges[key] = edges[key].select(FROM_UID, TO_UID).unionByName(own) if key in edges else own
    return Graph(dict(graph.nodes), edges)
