"""Operator 4: mixture-controlled packing by deficit round-robin over source queues.

Documents, as ids with an end id, queue by source in ascending id, cut into packets of at most ``PACKET`` ids.  In
every round a source earns its target share of one window (its quantum) and sends packets while its deficit covers them; what is
left of the deficit stays for the next round.  While a queue holds packets, the round in which one goes out is its last
id's place in the queue over the quantum, rounded up.  So the whole schedule is a sort by (round, source, place): the deficit is
carried exactly over all windows and partitions, and no task sees more than its range of rounds.  The packets in that
order, end to end, are cut into windows of ``WINDOW`` ids, of which only the last can be short.

By default a source's share is that of its ids in the corpus, so every window has the corpus' mixture and all queues end
together.  Given ``weights`` (source -> weight; others weigh 1), windows have that mixture while all queues last.

Defined results: a null or empty text is its end id alone; null sources are one source, null ids come after all others,
equal ids and equal rows are packed each on their own; no rows give no pieces; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphmill.llm.common import release, running_total, stored
from graphmill.llm.tokens import default_path, encoder, text_lists
from graphmill.session import table

WINDOW = 2048
PACKET = 512
END = 1


def encoded(docs: DataFrame, path: str, end: int) -> DataFrame:
    """(doc_id, source, n_ids, ids) of every row; ids: little-endian, 2 bytes each if the vocabulary allows, else 4."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        last = np.array([end], e.dtype).tobytes()
        for batch in batches:
            for i, texts in text_lists(batch.column("text")):
                ids = [x + last for x in e.encode(texts)]
                n = pa.array([len(x) // e.dtype.itemsize for x in ids], pa.int64())
                part = batch.slice(i, len(texts))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), n, pa.array(ids, pa.binary())], ["doc_id", "source", "n_ids", "ids"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(rows, "doc_id long, source string, n_ids long, ids binary")


def _schedule(spark: SparkSession, docs: DataFrame, weights: dict[str, float] | None, window: int, packet: int) -> DataFrame:
    """(row, start, length, at): packets of ``docs`` (row, doc_id, source, n_ids) and their places in the output."""
    queued = running_total(spark, docs, ["doc_id", "row"], "n_ids", "place", ["source"], name="queues")
    totals = docs.groupBy("source").agg(F.sum("n_ids").alias("total"))
    if weights is None:
        share = F.col("total") / F.sum("total").over(Window.partitionBy())
    else:
        weight = F.lit(1.0)
        for k, v in weights.items():
            weight = F.when(F.col("source") == k, F.lit(float(v))).otherwise(weight)
        share = weight / F.sum(weight).over(Window.partitionBy())
    # one row per source
    sources = totals.select(F.col("source").alias("_source"), (share * window).alias("quantum"), F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("sno"))
    packets = queued.join(sources, F.col("source").eqNullSafe(F.col("_source")))
    packets = packets.select("row", "n_ids", "place", "quantum", "sno", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_ids") - 1) / packet))).alias("k"))
    start = F.col("k") * packet
    length = F.least(F.lit(packet).cast("long"), F.col("n_ids") - start)
    packets = packets.select("row", "sno", start.alias("start"), length.alias("length"), (F.col("place") + start).alias("place"), F.ceil((F.col("place") + start + length) / F.col("quantum")).alias("round"))
    return running_total(spark, packets, ["round", "sno", "place"], "length", "at", name="rounds").select("row", "start", "length", "at")


def pack(spark: SparkSession, docs: DataFrame, path: str | None = None, weights: dict[str, float] | None = None,
         window: int = WINDOW, packet: int = PACKET, end: int = END) -> DataFrame:
    """Per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (binary)."""
    path = path or default_path()
    width = encoder(path).dtype.itemsize
    ids = stored(spark, encoded(docs, path, end).withColumn("row", F.monotonically_increasing_id()), "ids")
    places = _schedule(spark, ids.select("row", "doc_id", "source", "n_ids"), weights, window, packet)
    at = F.col("at")
    cuts = places.withColumn("sequence_id", F.explode(F.sequence(F.floor(at / window), F.floor((at + F.col("length") - 1) / window))))
    lo = F.greatest(at, F.col("sequence_id") * window)
    hi = F.least(at + F.col("length"), (F.col("sequence_id") + 1) * window)
    cuts = cuts.select("row", (F.col("start") + lo - at).alias("start"), (hi - lo).alias("length"), "sequence_id", (lo - F.col("sequence_id") * window).alias("offset"))
    # a document's pieces are bounded by its own ids
    pieces = cuts.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    pieces = stored(spark, pieces, "pieces")
    release(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            doc = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
            start, length, sequence, offset = (x.to_numpy() for x in lists.flatten().flatten())
            n = batch.column("n_ids").to_numpy()
            own_ids: list[bytes] = []
            crc = np.empty(len(doc), np.int64)
            held, raw = -1, b""
            for i in range(len(doc)):
                if doc[i] != held:
                    held, raw = int(doc[i]), batch.column("ids")[int(doc[i])].as_py()
                own = raw[start[i] * width : (start[i] + length[i]) * width]
                own_ids.append(own)
                crc[i] = zlib.crc32(own if width == 4 else np.frombuffer(own, "<u2").astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), *map(pa.array, (start, length, crc, n[doc], sequence, offset)), pa.array(own_ids, pa.binary())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    joined = ids.select("row", "doc_id", "n_ids", "ids").join(pieces, "row").select("doc_id", "n_ids", "ids", "pieces")
    return joined.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents")).drop("ids")
