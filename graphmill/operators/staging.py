"""Staged sets.

A staged set is rows of ``(job_name, operation, arguments, payload)``: the key split into three columns and
the element as a JSON payload.  Stored as parquet partitioned by the three key columns, so reading one key
is partition pruning and dropping one key is dropping its folder.  Set semantics = distinct rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from graphmill.functions.keys import build_key, is_supported_operation, job_name_ok, matches_glob, parse_key
from graphmill.functions.rows import JSON_TIMES, JSON_WRITE, payload_struct
from graphmill.model import MSG_UNSUPPORTED_OPERATION, NODES_INGEST, SUPPORTED_OPERATIONS
from graphmill.operators.skew import HOT_KEY_MIN_ROWS, number_within, split_join, top_n_within

KEY_COLS = ["job_name", "operation", "arguments"]
PAYLOAD = "payload"
SCHEMA = "schema"  # JSON of the payload's struct type; one dictionary entry per key in parquet
STAGING_DDL = "job_name string, operation string, arguments string, schema string, payload string"


class MissingKeyError(LookupError):
    pass


def key_column() -> Column:
    return build_key("job_name", "operation", "arguments").alias("key")


def stage(df: DataFrame, job_name: str, operation: str, arguments: str | Column) -> DataFrame:
    """Rows of ``df`` as members of the set ``job_name:operation:arguments`` (payload = JSON with nulls,
    plus the payload's schema so a reader can decode it without inference).  ``arguments`` may be a
    column, spreading the rows over one key per value."""
    if operation not in SUPPORTED_OPERATIONS:
        raise ValueError(MSG_UNSUPPORTED_OPERATION % operation)
    if ":" in job_name or not job_name:
        raise ValueError(f"Job name {job_name!r} must be non-empty and free of ':'")
    args = arguments if isinstance(arguments, Column) else F.lit(arguments)
    st = payload_struct(df)
    payload = F.to_json(st, JSON_WRITE)
    shape = df.select(st.alias("s")).schema["s"].dataType.json()
    return df.select(
        F.lit(job_name).alias("job_name"),
        F.lit(operation).alias("operation"),
        args.cast("string").alias("arguments"),
        F.lit(shape).alias(SCHEMA),
        payload.alias(PAYLOAD),
    )


def stage_columns(df: DataFrame, job_name: str, operation: str, arguments: Column, payload_columns: list[str]) -> DataFrame:
    """``stage`` where the key's arguments come from a column of ``df`` that is not part of the payload."""
    if operation not in SUPPORTED_OPERATIONS:
        raise ValueError(MSG_UNSUPPORTED_OPERATION % operation)
    st = payload_struct(df, payload_columns)
    shape = df.select(st.alias("s")).schema["s"].dataType.json()
    return df.select(
        F.lit(job_name).alias("job_name"),
        F.lit(operation).alias("operation"),
        arguments.cast("string").alias("arguments"),
        F.lit(shape).alias(SCHEMA),
        F.to_json(st, JSON_WRITE).alias(PAYLOAD),
    )


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Several DataFrames under one key; columns missing in one become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def set_add(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """``existing`` and ``new`` as one set: distinct over the whole row (hash aggregate, map-side)."""
    return (new if existing is None else existing.unionByName(new)).distinct()


def new_members(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Members of ``new`` not yet in ``existing`` (what a set add writes)."""
    fresh = new.distinct()
    if existing is None:
        return fresh
    return fresh.join(existing.select(*KEY_COLS, PAYLOAD), KEY_COLS + [PAYLOAD], "left_anti")


def publish_check(existing: DataFrame | None, items: DataFrame) -> DataFrame:
    """K2 as a report: per key ``n_items``, ``n_distinct``, ``n_new`` and ``ok``.

    ``ok`` holds when all items are new and distinct, or none is new (the reference asserts this after
    its write; we report before writing).
    """
    per_key_items = items.groupBy(*KEY_COLS).agg(F.count(F.lit(1)).alias("n_items"))
    distinct_items = items.distinct()
    per_key_distinct = distinct_items.groupBy(*KEY_COLS).agg(F.count(F.lit(1)).alias("n_distinct"))
    fresh = new_members(existing, items)
    per_key_new = fresh.groupBy(*KEY_COLS).agg(F.count(F.lit(1)).alias("n_new"))
    out = per_key_items.join(per_key_distinct, KEY_COLS, "left").join(per_key_new, KEY_COLS, "left")
    out = out.withColumn("n_new", F.coalesce("n_new", F.lit(0)))
    ok = (F.col("n_new") == F.col("n_items")) | (F.col("n_new") == 0)
    return out.select(*KEY_COLS, "n_items", "n_distinct", "n_new", ok.alias("ok"))


class PublishError(ValueError):
    """Keys whose items overlap the stored set in part; ``report`` has a row for each of them."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


def publish(spark: SparkSession, items: DataFrame, path: str) -> None:
    """K2: add ``items`` to the stored sets only if, per key, all of them are new and distinct or none is
    new; otherwise fail with the counts and write nothing (the reference checks after its write)."""
    existing = read_staging(spark, path, must_exist=False)
    bad = publish_check(existing, items).where(~F.col("ok"))
    n = bad.count()
    if n:
        raise PublishError(f"{n} keys overlap the stored set in part", bad)
    _append(new_members(existing, items), path)


def write_set_add(spark: SparkSession, staged: DataFrame, path: str) -> None:
    """K1: add members to the stored sets; only members not yet stored are appended, so no file the
    plan reads is overwritten."""
    existing = read_staging(spark, path, must_exist=False)
    _append(new_members(existing, staged), path)


# ---- sets with stored fingerprints
MEMBER = "member"


def fingerprint() -> Column:
    """A member's 128-bit hash, over its key and payload."""
    return F.unhex(F.md5(F.to_json(F.struct(*KEY_COLS, PAYLOAD), JSON_WRITE))).alias(MEMBER)


def _set_table(spark: SparkSession, path: str, buckets: int) -> str:
    """The catalog table over a staging folder whose files are bucketed by fingerprint, in step with the key folders there are."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    full = fs.makeQualified(p).toString()
    name = f"gm_set_{hashlib.sha1(full.encode()).hexdigest()[:16]}_{buckets}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA} string, {PAYLOAD} string, {MEMBER} binary, {', '.join(f'{c} string' for c in KEY_COLS)}) "
        f"USING parquet PARTITIONED BY ({', '.join(KEY_COLS)}) CLUSTERED BY ({MEMBER}) INTO {buckets} BUCKETS LOCATION '{full}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")  # lists key folders: some may have been dropped, or come from another session
    return name


def fresh_members(staged: DataFrame, stored: DataFrame) -> DataFrame:
    """Members of ``staged``, each once with its fingerprint, whose fingerprint ``stored`` (column ``member``) lacks."""
    once = staged.withColumn(MEMBER, fingerprint()).groupBy(MEMBER).agg(*[F.min(c).alias(c) for c in (*KEY_COLS, SCHEMA, PAYLOAD)])
    return once.join(stored.select(MEMBER), MEMBER, "left_anti")


def write_indexed_add(spark: SparkSession, staged: DataFrame, path: str, buckets: int) -> int:
    """K1 / U1 with stored fingerprints: adds the members that the sets under ``path`` lack; returns how many those were.

    The files are bucketed by fingerprint, so only the batch is shuffled, into the buckets, and of the sets only the fingerprints are
    read.  Members and fingerprints are one row, so a write that fails leaves neither.  ``buckets`` stays the same for a folder's
    life, and such a folder is added to by this function alone; it is read, and its keys dropped, like any other.  Adds to one
    folder run one after another."""
    name = _set_table(spark, path, buckets)
    fresh = fresh_members(staged, spark.table(name))
    for c in KEY_COLS:
        fresh = fresh.withColumn(c, _folder_part(F.col(c)))
    seen = Observation()
    rows = fresh.select(SCHEMA, PAYLOAD, MEMBER, *KEY_COLS).observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.format("parquet").mode("append").partitionBy(*KEY_COLS).bucketBy(buckets, MEMBER).saveAsTable(name)
    return int(seen.get["n"])


# An empty key part would be read back as null (the default folder of a partition without a value).
_EMPTY = "\\e"


def _stored_part(value: str) -> str:
    """A key part as its folder has it: empty as a marker, a leading backslash doubled."""
    return _EMPTY if value == "" else f"\\{value}" if value.startswith("\\") else value


def _folder_part(part: Column) -> Column:
    """``_stored_part`` of a column."""
    return F.when(part == "", F.lit(_EMPTY)).when(part.startswith("\\"), F.concat(F.lit("\\"), part)).otherwise(part)


def _append(members: DataFrame, path: str) -> None:
    for c in KEY_COLS:
        members = members.withColumn(c, _folder_part(F.col(c)))
    members.write.mode("append").partitionBy(*KEY_COLS).parquet(path)


def read_staging(spark: SparkSession, path: str, must_exist: bool = True) -> DataFrame | None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        if must_exist:
            raise MissingKeyError(f"no staging at {path}")
        return None
    if not any(st.getPath().getName().startswith("job_name=") for st in fs.listStatus(p)):
        return spark.createDataFrame([], STAGING_DDL)  # every key dropped
    # the schema is given, so key parts that look like numbers stay text
    out = spark.read.schema(STAGING_DDL).option("basePath", path).parquet(path).select(*KEY_COLS, SCHEMA, PAYLOAD)
    for c in KEY_COLS:
        part = F.col(c)
        out = out.withColumn(c, F.when(part == _EMPTY, F.lit("")).when(part.startswith("\\\\"), part.substr(F.lit(2), F.length(part))).otherwise(part))
    return out


def drop_keys(spark: SparkSession, path: str, keys: Iterable[tuple[str, str, str]]) -> int:
    """K4 on storage: remove the folders of the given keys; returns how many existed."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    n = 0
    for job, op, args in keys:
        job, op, args = (_escape(_stored_part(str(x))) for x in (job, op, args))
        part = f"{path}/job_name={job}/operation={op}/arguments={args}"
        p = jvm.org.apache.hadoop.fs.Path(part)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
        for parent in (p.getParent(), p.getParent().getParent()):  # empty operation / job folders go too
            if fs.exists(parent) and len(fs.listStatus(parent)) == 0:
                fs.delete(parent, False)
    return n


def _escape(v: str) -> str:
    # Hive-style partition value escaping, as Spark writes it.
    out = []
    for ch in v:
        if ch in '"#%\'*/:=?\\\x7f{[]^' or ord(ch) < 0x20:
            out.append("%{:02X}".format(ord(ch)))
        else:
            out.append(ch)
    return "".join(out)


def delete_keys(staged: DataFrame, keys: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> DataFrame:
    """K4 as a DataFrame: staged rows whose key is not in ``keys`` (columns job_name, operation, arguments).

    A key that holds most staged rows is salted (``split_join``); Spark broadcasts a short key list."""
    gone = keys.select(*KEY_COLS).distinct().select(F.struct(*KEY_COLS).alias("_gone")).select(F.to_json("_gone", JSON_WRITE).alias("_gone"))
    held = staged.withColumn("_key", F.to_json(F.struct(*KEY_COLS), JSON_WRITE))
    return split_join(held, gone, "_key", "_gone", "left_anti", min_rows=hot_min_rows).drop("_key")


def delete_prefix(staged: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
    """K5: (remaining rows, one-row summary ``keys_deleted``, ``rows_remaining``).

    The summary is one aggregation pass over the staged rows (distinct keys are few; ``count_distinct`` on
    the key columns combines map-side).
    """
    key = build_key("job_name", "operation", "arguments")
    hit = key.startswith(prefix)
    summary = staged.agg(
        F.count_distinct(F.when(hit, F.col("job_name")), F.col("operation"), F.col("arguments")).alias("keys_deleted"),
        F.count(F.when(~hit, 1)).alias("rows_remaining"),
    )
    return staged.where(~hit), summary


def purge(df: DataFrame) -> DataFrame:
    """K6: an empty frame of the same schema."""
    return df.limit(0)


def purge_storage(spark: SparkSession, path: str) -> int:
    """K6 on storage: drop every staged key folder; returns how many keys there were.

    Lists folders only, one job at a time; no row is read."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return 0
    n = 0
    for job in fs.listStatus(top):
        if job.isDirectory() and job.getPath().getName().startswith("job_name="):
            n += sum(len(fs.listStatus(op.getPath())) for op in fs.listStatus(job.getPath()))
            fs.delete(job.getPath(), True)
    return n


def cardinality(staged: DataFrame) -> DataFrame:
    """A1: members per key (distinct payloads)."""
    return staged.select(*KEY_COLS, PAYLOAD).distinct().groupBy(*KEY_COLS).agg(F.count(F.lit(1)).alias("cardinality"))


def decode(members: DataFrame, schema_json: str) -> DataFrame:
    """Staged members of one shape back into typed columns."""
    import json

    from pyspark.sql import types as T

    st = T.StructType.fromJson(json.loads(schema_json))
    return members.select(F.from_json(PAYLOAD, st, JSON_TIMES).alias("_r")).select("_r.*")


def keys_of(staged: DataFrame) -> DataFrame:
    return staged.select(*KEY_COLS).distinct()


def keys_by_pattern(keys: DataFrame, pattern: str) -> DataFrame:
    """keys (job_name, operation, arguments) whose ``job:op:args`` matches the glob."""
    return keys.where(matches_glob(build_key("job_name", "operation", "arguments"), pattern))


def keys_of_translation(staged: DataFrame, translation_id: str) -> DataFrame:
    """the keys ``{translation_id}:*``; error when there is none."""
    keys = keys_of(staged.where(F.col("job_name") == translation_id))
    if keys.isEmpty():
        raise MissingKeyError(f"nothing is staged under {translation_id!r}")
    return keys


def scan_key(staged: DataFrame, pattern: str) -> DataFrame:
    """Members of the one key matching ``pattern``; ``MissingKeyError`` unless exactly one matches.

    The key check reads at most two distinct keys to the driver.
    """
    hit = keys_by_pattern(keys_of(staged), pattern)
    found = hit.limit(2).collect()
    if len(found) != 1:
        raise MissingKeyError(f"pattern {pattern!r} names {'no' if not found else 'more than one'} staged key")
    job, op, args = found[0]
    return staged.where((F.col("job_name") == job) & (F.col("operation") == op) & (F.col("arguments") == args))


def order_jobs(keys: DataFrame, out: str = "job_order") -> DataFrame:
    """Nodes keys before edges keys, then by key case-insensitively; ``job_order`` numbers them 1..n
    (distributed numbering, no single-partition window)."""
    k = keys.withColumn("key", build_key("job_name", "operation", "arguments"))
    k = k.withColumn("_edges_first", (F.col("operation") != NODES_INGEST).cast("int")).withColumn("_lkey", F.lower("key"))
    numbered = number_within(k, [], ["_edges_first", "_lkey", "key"], out=out)
    return numbered.drop("_edges_first", "_lkey")


def batch_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], batch_size: int, out: str = "batch_no") -> DataFrame:
    """Fixed-size batches per key, numbered from 0; the last one may be short."""
    n = number_within(df, keys, order, out="_rn")
    return n.withColumn(out, F.floor((F.col("_rn") - 1) / F.lit(batch_size)).cast("long")).drop("_rn")


def key_sample(staged: DataFrame, n: int) -> DataFrame:
    """Per key, type (Nodes / Edges), size, and the first ``n`` members by payload."""
    sizes = cardinality(staged)
    sample = top_n_within(staged.select(*KEY_COLS, PAYLOAD).distinct(), KEY_COLS, [PAYLOAD], n, out="sample_no")
    kind = F.when(F.col("operation") == NODES_INGEST, "Nodes").otherwise("Edges")
    return sample.join(sizes, KEY_COLS, "inner").select(
        key_column(), kind.alias("type"), F.col("cardinality").alias("size"), "sample_no", PAYLOAD
    )


def parse_keys(keys: DataFrame, key: str = "key", strict: bool = False) -> DataFrame:
    """P5 over a column of key strings; ``strict`` makes the first invalid key fail the job
    (``raise_error``) instead of filling the ``error`` column."""
    p = parse_key(key)
    if strict:
        keys = keys.where(F.when(p["error"].isNotNull(), F.raise_error(p["error"])).otherwise(F.lit(True)))
    return keys.select(
        F.col(key),
        p["job_name"].alias("job_name"),
        p["operation"].alias("operation"),
        p["arguments"].alias("arguments"),
        p["error"].alias("error"),
    )


__all__ = [
    "KEY_COLS",
    "PAYLOAD",
    "MissingKeyError",
    "stage",
    "set_add",
    "new_members",
    "publish_check",
    "write_set_add",
    "write_indexed_add",
    "fresh_members",
    "fingerprint",
    "read_staging",
    "drop_keys",
    "delete_keys",
    "delete_prefix",
    "purge",
    "purge_storage",
    "publish",
    "PublishError",
    "cardinality",
    "decode",
    "SCHEMA",
    "keys_of",
    "keys_by_pattern",
    "keys_of_translation",
    "scan_key",
    "order_jobs",
    "batch_numbers",
    "key_sample",
    "parse_keys",
    "union_frames",
    "is_supported_operation",
    "job_name_ok",
]
