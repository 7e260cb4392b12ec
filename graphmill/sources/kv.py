"""Keyed lookups (S7, S8) and the keyed overwrite sink (K3).

``multi_get`` and ``multi_get_hash`` join any two frames.  A store kept by ``write_store`` is laid out for lookups: a folder per bucket
of the key's hash, rows sorted by key, a Parquet Bloom filter on the key.  ``get_stored`` reads only the folders that hold a wanted
key, and in them, for a short list of keys, only the row groups that may have one.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphmill.model import UID
from graphmill.operators.skew import HOT_KEY_MIN_ROWS, latest_per_key, split_join


def multi_get(requested: DataFrame, store: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    """``requested(pos, key)`` against ``store(key, value)``: one row per request, value null when the
    key is missing; ``pos`` keeps the caller's order (the store must be unique on key).  A key asked for
    by a large share of the requests is salted by ``split_join``."""
    st = store.select(F.col("key").alias("_k"), "value")
    j = split_join(requested.select("pos", "key"), st, "key", "_k", "left", min_rows=hot_min_rows)
    return j.select("pos", "key", "value")


def multi_get_hash(requested: DataFrame, store: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    """``requested(pos, key)`` against the long form ``store(key, field, value)``: one row per
    (request, field); a missing key gives one row with null field (an empty map).  The fields of one key
    are bounded by the hash's width, so the salted copies of a hot key stay bounded too."""
    st = store.select(F.col("key").alias("_k"), "field", "value")
    j = split_join(requested.select("pos", "key"), st, "key", "_k", "left", min_rows=hot_min_rows)
    return j.select("pos", "key", "field", "value")


def hash_maps(store: DataFrame) -> DataFrame:
    """S8 map form for keys whose field count is bounded (``map_from_entries`` per key)."""
    return store.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("fields"))


def keyed_rows(df: DataFrame, order: Sequence[str], key: str = UID) -> DataFrame:
    """K3: one row per key (the greatest ``order``), ready for ``write.mode('overwrite')``."""
    return latest_per_key(df, [key], order)


def write_keyed(df: DataFrame, path: str, order: Sequence[str], key: str = UID) -> None:
    """K3: overwrite ``path`` with one row per key, hash-partitioned on the key."""
    out = keyed_rows(df, order, key)
    out.repartition(key).write.mode("overwrite").parquet(path)


#: Keys that a lookup hands to the Parquet reader itself, at most; more are looked up by the join alone.
PUSHED_KEYS = 1000


def _bucket(of: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(of)).cast("int")


def write_store(store: DataFrame, path: str, buckets: int = 64, rows_per_file: int = 4_000_000) -> None:
    """Overwrites ``path`` with ``store`` (key, and value or field and value) in ``buckets`` folders by the key's hash.

    A bucket is best some hundred MB; its files hold at most ``rows_per_file`` rows, in the order of their keys.  Null keys are not kept; a row
    without a key stands in bucket 0 and keeps the columns of an empty store."""
    blank = store.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in store.schema.fields], F.lit(0).alias("_bucket"))
    rows = store.where("key is not null").withColumn("_bucket", _bucket(buckets)).unionByName(blank).withColumn("_of", F.lit(buckets))
    rows = rows.repartition(buckets, "_bucket").sortWithinPartitions("_bucket", "key")
    out = rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("parquet.bloom.filter.enabled#key", "true")
    # the whole store is replaced, whatever the session's overwrite mode
    out.option("partitionOverwriteMode", "static").partitionBy("_of", "_bucket").parquet(path)


def stored_rows(requested: DataFrame, path: str) -> DataFrame:
    """The rows of the store at ``path`` in buckets of the keys that ``requested`` asks for, and of a few keys only those."""
    store = requested.sparkSession.read.parquet(path)
    of = store.select("_of").first()[0]  # a folder's name
    wanted = requested.where("key is not null").select("key").distinct()
    buckets = [r[0] for r in wanted.select(_bucket(of).alias("b")).distinct().collect()]  # at most one row a bucket
    rows = store.where(F.col("_bucket").isin(buckets) & F.col("key").isNotNull())
    few = [r[0] for r in wanted.limit(PUSHED_KEYS + 1).collect()]
    if len(few) <= PUSHED_KEYS:
        rows = rows.where(F.col("key").isin(few))
    return rows.drop("_of", "_bucket")


def get_stored(requested: DataFrame, path: str, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    """S7 / S8 from a store that ``write_store`` wrote: as ``multi_get``, or ``multi_get_hash`` if it has fields."""
    rows = stored_rows(requested, path)
    return (multi_get_hash if "field" in rows.columns else multi_get)(requested, rows, hot_min_rows)
