"""Validation."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphmill.model import REQUEST_MANDATORY_FIELDS, REQUIRED_REQUEST_FIELDS, UID

# JSON value kinds as the request rules name them.
_KIND_OF_RULE = {"str": "string", "int": "number", "float": "number", "bool": "boolean", "dict": "object", "list": "array"}


def validate_requests(
    requests: DataFrame,
    column: str = "request",
    mandatory: Sequence[str] = REQUEST_MANDATORY_FIELDS,
    rules: Mapping[str, Mapping[str, str]] = REQUIRED_REQUEST_FIELDS,
) -> DataFrame:
    """add ``problems`` (array of messages, empty when valid) and ``valid`` to a table of JSON requests.

    Checks, as the reference's front desk does: the mandatory fields exist (if not, nothing else is
    checked); the request type is supported; its required fields exist and have the declared JSON kind.
    All problems of a request are reported together.
    """
    v = F.expr(f"try_parse_json(`{column}`)")
    tmp = requests.withColumn("_v", v)

    def get(path: str) -> Column:
        return F.expr(f"variant_get(_v, '$.{path}')")

    def kind(path: str) -> Column:
        s = F.lower(F.expr(f"schema_of_variant(variant_get(_v, '$.{path}'))"))
        return (
            F.when(s == "string", "string")
            .when(s.isin("bigint", "int", "smallint", "tinyint", "double", "float") | s.startswith("decimal"), "number")
            .when(s == "boolean", "boolean")
            .when(s.startswith("object"), "object")
            .when(s.startswith("array"), "array")
            .otherwise("null")
        )

    supported = list(rules)
    missing_mandatory = [F.when(get(f).isNull(), F.lit(f"Field {f} is mandatory.")) for f in mandatory]
    rtype = F.expr("variant_get(_v, '$.request_type', 'string')")
    type_problem = F.when(~rtype.isin(*supported), F.concat(F.lit("Unsupported request type: "), rtype, F.lit(".")))
    field_problems = []
    for rt, fields in rules.items():
        for name, rule in fields.items():
            want = _KIND_OF_RULE.get(rule, rule)
            field_problems.append(F.when((rtype == rt) & get(name).isNull(), F.lit(f"Field {name} is missing.")))
            field_problems.append(
                F.when((rtype == rt) & get(name).isNotNull() & (kind(name) != want), F.lit(f"Field {name} must be of type {rule}."))
            )
    not_json = F.when(F.col("_v").isNull(), F.array(F.lit("Failed parsing the request as a JSON string.")))
    first_stage = F.filter(F.array(*missing_mandatory), lambda x: x.isNotNull())
    later = F.filter(F.array(type_problem, *field_problems), lambda x: x.isNotNull())
    problems = F.coalesce(not_json, F.when(F.size(first_stage) > 0, first_stage).otherwise(later))
    out = tmp.withColumn("problems", problems).drop("_v")
    return out.withColumn("valid", F.size("problems") == 0)


def events_of_request(events: DataFrame, request_id: str) -> DataFrame:
    """events whose request id contains ``request_id`` (stamped ids carry a time suffix); null ids drop out."""
    return events.where(F.col("request_id").contains(request_id))


def uid_nulls(df: DataFrame, label: str, uid: str = UID) -> DataFrame:
    """F8: rows without a uid (a merge cannot place them)."""
    return df.agg(F.count(F.when(F.col(uid).isNull(), 1)).alias("n_null"), F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(label).alias("label"), "n_null", "n_rows"
    )


def uid_duplicates(df: DataFrame, uid: str = UID) -> DataFrame:
    """uids held by more than one row, with their row count (partial aggregate)."""
    return df.where(F.col(uid).isNotNull()).groupBy(uid).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


class MissingUidError(ValueError):
    pass


def require_uids(df: DataFrame, how: str = "raise", uid: str = UID) -> tuple[DataFrame, DataFrame | None]:
    """F8: rows without a uid cannot be merged.  ``how='raise'`` fails when there is one (one bounded
    probe); ``how='quarantine'`` returns (rows with a uid, rows without) for the caller to keep."""
    missing = F.col(uid).isNull()
    if how == "raise":
        if df.where(missing).limit(1).count():
            raise MissingUidError(f"rows without {uid}")
        return df, None
    if how == "quarantine":
        return df.where(~missing), df.where(missing)
    raise ValueError(f"unknown mode {how!r}")
