"""Staging-key functions (P5-P8, P13-P15, F1, F3, F7).  All are Column expressions: they run in the JVM
inside whole-stage codegen, no Python per row."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphmill.model import (
    ARGUMENT_SEPARATOR,
    KEY_SEPARATOR,
    MSG_EMPTY_JOB,
    MSG_KEY_PARTS,
    MSG_UNSUPPORTED_OPERATION,
    NODES_INGEST,
    SUPPORTED_OPERATIONS,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def build_key(job_name, operation, arguments) -> Column:
    """``job:operation:arguments``; ``arguments`` may be an array (joined with ``,``)."""
    args = _c(arguments)
    return F.concat_ws(KEY_SEPARATOR, _c(job_name), _c(operation), args)


def is_supported_operation(operation) -> Column:
    """F3."""
    return _c(operation).isin(*SUPPORTED_OPERATIONS)


def job_name_ok(job_name) -> Column:
    """The job name must not hold the key separator."""
    return ~_c(job_name).contains(KEY_SEPARATOR)


def parse_key(key) -> Column:
    """P5: struct(job_name, operation, arguments array<string>, error string).

    ``error`` is null for a valid key: exactly three parts, a non-empty job name, a supported operation.
    """
    k = _c(key)
    parts = F.split(k, KEY_SEPARATOR, -1)
    n = F.size(parts)
    job = F.when(n == 3, F.element_at(parts, 1))
    op = F.when(n == 3, F.element_at(parts, 2))
    args = F.when(n == 3, F.split(F.element_at(parts, 3), ARGUMENT_SEPARATOR, -1))
    error = (
        F.when(n != 3, F.format_string(MSG_KEY_PARTS, k, n))
        .when(F.length(job) == 0, F.format_string(MSG_EMPTY_JOB, k))
        .when(~is_supported_operation(op), F.format_string(MSG_UNSUPPORTED_OPERATION, op))
    )
    return F.struct(job.alias("job_name"), op.alias("operation"), args.alias("arguments"), error.alias("error"))


def element_kind(operation) -> Column:
    """P13 on the parsed operation (a job name containing 'nodes' does not make an edge key a node key)."""
    return F.when(_c(operation) == NODES_INGEST, F.lit("Nodes")).otherwise(F.lit("Edges"))


def element_label(operation, arguments) -> Column:
    """Nodes -> label; edges -> ``type_from_to`` from the key's arguments array."""
    args = _c(arguments)
    return F.when(_c(operation) == NODES_INGEST, F.element_at(args, 1)).otherwise(F.array_join(args, "_"))


def edge_type_or_default(edge_type: str | None, column="_edgeType") -> Column:
    """The given type, else the row's own ``_edgeType``."""
    return F.coalesce(F.lit(edge_type).cast("string"), _c(column))


def translation_id(request_id, ts, source_name) -> Column:
    """``{request_id}_{y}_{m}_{d}_{h}_{m}_{s}_{source}`` with unpadded date parts."""
    stamp = F.date_format(_c(ts), "y_M_d_H_m_s")
    return F.concat_ws("_", _c(request_id), stamp, _c(source_name))


def stamped_request_id(request_id, ts) -> Column:
    return F.concat_ws("_", _c(request_id), F.date_format(_c(ts), "y_M_d_H_m_s"))


def glob_to_regex(pattern: str) -> str:
    """a key glob (``*``, ``?``, ``[...]``, ``\\`` escapes) as an anchored Java regex."""
    out, i = ["^"], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "\\" and i + 1 < len(pattern):
            i += 1
            out.append(re.escape(pattern[i]))
        elif ch == "[":
            negated = pattern[i + 1 : i + 2] in ("^", "!")
            j, inner = i + 1 + negated, []
            while j < len(pattern) and pattern[j] != "]":
                escaped = pattern[j] == "\\" and j + 1 < len(pattern)
                j += escaped
                # inside a class only a range's dash keeps a meaning
                inner.append(re.escape(pattern[j]) if escaped or pattern[j] in "[]\\&^" else pattern[j])
                j += 1
            if j < len(pattern) and inner:
                out.append(f"[{'^' if negated else ''}{''.join(inner)}]")
                i = j
            else:
                out.append(re.escape(ch))
        else:
            out.append(re.escape(ch))
        i += 1
    out.append("$")
    return "".join(out)


def matches_glob(key, pattern: str) -> Column:
    """Plain prefixes (``abc*``) use ``startswith`` so parquet can skip row groups; others ``rlike``."""
    body = pattern[:-1]
    if pattern.endswith("*") and not any(ch in body for ch in "*?[\\"):
        return _c(key).startswith(body)
    return _c(key).rlike(glob_to_regex(pattern))
