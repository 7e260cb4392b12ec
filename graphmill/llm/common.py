"""Shared pieces of the training-data operators: text hashing with numpy, scratch tables, link components,
distributed prefix sums.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, after lower-casing A-Z.  A word's hash is a
64-bit polynomial over a random byte table, finished with a 64-bit mixer; equal hashes stand for equal words.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphmill.session import scratch_path

#: Bytes of text that one numpy pass works on (about 60 times as much memory, which a worker keeps from task to task).
CHUNK_BYTES = 1 << 18

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NONSPACE = np.ones(256, dtype=bool)
_NONSPACE[[9, 10, 11, 12, 13, 32]] = False


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(256)


class Words:
    """The words of several texts: ``hash`` and ``doc`` (index of the text) per word, in text order."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, solid_bytes: np.ndarray = _NONSPACE):
        self.n_docs = len(offsets) - 1
        o = offsets - offsets[0]
        b = _LOWER[data[offsets[0] : offsets[-1]]]
        solid = solid_bytes[b]
        first, last = solid.copy(), solid.copy()
        if len(b):
            first[1:] &= ~solid[:-1]
            last[:-1] &= ~solid[1:]
            full = o[1:] > o[:-1]  # a text's border also ends a word
            first[o[:-1][full]] = solid[o[:-1][full]]
            last[o[1:][full] - 1] = solid[o[1:][full] - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bytes, self.offsets = b, o
        self.doc = np.searchsorted(o, self.start, "right") - 1
        n = self.end - self.start
        at = np.cumsum(n) - n
        c = b[solid]
        pos = np.arange(len(c)) - np.repeat(at, n)
        power = _POW if not len(n) or n.max() <= len(_POW) else _powers(int(n.max()))
        terms = _TABLE[c] * power[pos]
        self.hash = mix64(np.add.reduceat(terms, at)) if len(n) else np.zeros(0, np.uint64)
        self._at, self._n, self._pos, self._terms = at, n, pos, terms
        self.count = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.cumsum(self.count) - self.count

    def prefixes(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(doc, hash) of the first ``k`` bytes of every word longer than ``k`` bytes."""
        if not len(self.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        sums = np.add.reduceat(np.where(self._pos < k, self._terms, np.uint64(0)), self._at)
        keep = self._n > k
        return self.doc[keep], mix64(sums + _POW[k])[keep]

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(doc, hash) of every run of ``k`` words; a shorter text is one run of all its words."""
        n = len(self.hash)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        mult = mix64(np.arange(1, k + 1, dtype=np.uint64))
        padded = np.concatenate([self.hash, np.zeros(k, np.uint64)])
        total = np.zeros(n, np.uint64)
        left = self.count[self.doc] - (np.arange(n) - self.first[self.doc])  # words from here to the text's end
        for i in range(k):
            total += np.where(left > i, padded[i : i + n] * mult[i], np.uint64(0))
        keep = (left >= k) | ((left == self.count[self.doc]) & (left < k))
        short = np.minimum(left, k).astype(np.uint64)
        return self.doc[keep], mix64(total + short)[keep]


def text_chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts of about ``chunk_bytes``; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(off, off[i] + chunk_bytes, "right")) - 1)
        yield i, j, data, off[i : j + 1]
        i = j


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def stored(spark: SparkSession, df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts lineage, survives lost executors.

    ``rows_per_file`` keeps files of very large rows short (0: any number)."""
    path = scratch_path(spark, f"llm-{name}")
    schema = df.schema
    df.write.option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished steps now instead of at the driver's next collection.

    Twice, as the JVM hears of Python's dropped references a little later."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges``.

    Alternates large-star and small-star steps (each an aggregation and a join over the edges) until every node
    has one edge, to a node without a smaller neighbour.  Aggregations combine before the shuffle, and a node
    with many edges is split by the adaptive skew join.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = stored(spark, e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")
        e = stored(spark, small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        ends = e.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty():
            break
    stars = e.groupBy("u").agg(F.min("v").alias("component"))
    return stars.select(F.col("u").alias("node"), "component").unionByName(
        stars.select(F.col("component").alias("node"), "component").distinct()
    )


def running_total(
    spark: SparkSession, df: DataFrame, order: list[str], value: str, out: str, group: list[str] | None = None,
    partitions: int | None = None, name: str = "ordered",
) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over all rows before, in ``order``, within ``group``.

    One range partitioning by (group, order), running sums inside each partition, and an offset per
    (partition, group) from the partitions' totals, so a group of any size spreads over many tasks.  The ranges are
    stored before they are summed, so the offsets and the rows see the same partitions.  The order must be total.
    """
    group = group or []
    n = partitions or parts(spark)
    ranged = df.repartitionByRange(n, *[F.col(c).asc_nulls_last() for c in [*group, *order]])
    ranged = stored(spark, ranged.withColumn("_part", F.spark_partition_id()), name)
    inner = Window.partitionBy("_part", *group).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part", *group).agg(F.sum(value).alias("_sum"))
    by = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_part", *group, F.coalesce(F.sum("_sum").over(by), F.lit(0)).alias("_before"))
    rows = ranged.withColumn("_inner", F.coalesce(F.sum(value).over(before), F.lit(0)))
    same = rows["_part"] == totals["_part"]
    for c in group:
        same &= rows[c].eqNullSafe(totals[c])
    keep = [rows[c] for c in df.columns]
    return rows.join(totals, same).select(*keep, (F.col("_inner") + F.col("_before")).cast("long").alias(out))


def whole_groups(batches, key: list[str]) -> Iterator:
    """Whole groups of consecutive rows with equal ``key`` as pandas frames, from sorted pandas batches."""
    import pandas as pd

    held = None
    for pdf in batches:
        if not len(pdf):
            continue
        held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        k = held[key].to_numpy()
        last = (k != k[-1]).any(axis=1)
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        if cut:
            done, held = held.iloc[:cut], held.iloc[cut:].reset_index(drop=True)
            k = k[:cut]
            edge = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            for i, j in zip([0, *edge], [*edge, cut], strict=True):
                yield done.iloc[i:j]
    if held is not None and len(held):
        yield held
