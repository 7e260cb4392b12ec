"""Search-index scan (S3) and its array-field hint.

The connector format is a parameter: an Elasticsearch index is ``fmt='org.elasticsearch.spark.sql'`` with
its options (jar on the classpath); tests and exports use ``json``.  Filters and projections on the result
are pushed to the connector by Catalyst when it supports them.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphmill.model import INDEX_ARRAY_FIELDS_OPTION


def as_string_array(column: str | Column) -> Column:
    """A field that holds either one string or a JSON array of strings, as ``array<string>``.

    A text that starts with ``[`` without being a JSON array is one string."""
    c = F.col(column) if isinstance(column, str) else column
    trimmed = F.ltrim(c)
    return (
        F.when(c.isNull(), F.lit(None).cast("array<string>"))
        .when(trimmed.startswith("["), F.coalesce(F.from_json(c, T.ArrayType(T.StringType())), F.array(c)))
        .otherwise(F.array(c))
    )


def read_index(
    spark: SparkSession,
    index: str,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
    array_fields: Sequence[str] = (),
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """S3 (+ S4): load an index / export as a DataFrame; ``array_fields`` are always ``array<string>``."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt in ("org.elasticsearch.spark.sql", "es") and array_fields:
        reader = reader.option(INDEX_ARRAY_FIELDS_OPTION, ",".join(array_fields))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(index)
    for f in array_fields:
        if f in df.columns and not isinstance(df.schema[f].dataType, T.ArrayType):
            df = df.withColumn(f, as_string_array(F.col(f).cast("string")))
    return df
