"""Row-shape functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Times in JSON payloads keep their microseconds; written and read with the same patterns.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
JSON_WRITE = {"ignoreNullFields": "false", **JSON_TIMES}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def payload_struct(df: DataFrame, columns=None) -> Column:
    """All (or the given) columns as one struct; decimals become doubles (the intent of the reference)."""
    cols = []
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return F.struct(*cols)


def row_to_json(df: DataFrame, column_name: str = "graph_node", keep: list[str] | None = None) -> DataFrame:
    """Each row as a JSON object with every column, nulls kept (``ignoreNullFields=false``)."""
    js = F.to_json(payload_struct(df), JSON_WRITE).alias(column_name)
    return df.select(*([F.col(k) for k in keep] if keep else []), js)


def json_to_row(column, schema: T.StructType | str) -> Column:
    """Decode a payload back into a struct of the given schema."""
    return F.from_json(_c(column), schema, JSON_TIMES)


def json_to_map(column) -> Column:
    """P4 for payloads of differing shapes: ``map<string,string>``; a null-valued key stays present."""
    return F.from_json(_c(column), T.MapType(T.StringType(), T.StringType()))


def ts_text(column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``."""
    return F.date_format(_c(column), "yyyy-MM-dd HH:mm:ss")


def unix_seconds(column) -> Column:
    """Whole seconds since the epoch of a wall-clock (``TIMESTAMP_NTZ``) value, read as UTC.

    A difference of two NTZ values, so the result does not depend on the session time zone.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
    return F.timestamp_diff("SECOND", epoch, _c(column).cast(T.TimestampNTZType()))


def to_json_without(df: DataFrame, ignored: list[str], column_name: str = "json") -> Column:
    """P10: the row as JSON without the ignored fields."""
    keep = [c for c in df.columns if c not in set(ignored)]
    return F.to_json(payload_struct(df, keep), JSON_WRITE).alias(column_name)


def to_entries(df: DataFrame, columns: list[str], key_col: str = "attribute", value_col: str = "value") -> DataFrame:
    """P11 long form: one (attribute, value-as-string) row per public column (names not starting with _)."""
    public = [c for c in columns if not c.startswith("_")]
    pairs = F.array(*[F.struct(F.lit(c).alias(key_col), F.col(c).cast("string").alias(value_col)) for c in public])
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(pairs))


def to_attribute_map(columns: list[str]) -> Column:
    """P11 as one map column."""
    public = [c for c in columns if not c.startswith("_")]
    return F.create_map(*[x for c in public for x in (F.lit(c), F.col(c).cast("string"))])


def flatten_all(column, data_type: T.DataType) -> Column:
    """Flatten nested arrays of any depth (depth read from the type)."""
    c = _c(column)
    t = data_type
    while isinstance(t, T.ArrayType) and isinstance(t.elementType, T.ArrayType):
        c = F.flatten(c)
        t = t.elementType
    return c


def percent_done(processed, cardinality) -> Column:
    """``round(100 * processed / cardinality)`` half to even; null when the cardinality is 0."""
    return F.bround(F.lit(100.0) * _c(processed) / F.nullif(_c(cardinality), F.lit(0)), 0)
