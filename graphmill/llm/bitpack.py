"""Operator 9: token ids in a fixed-width bit-packed file format.

Ids take the fewest bits that hold the vocabulary.  ``BLOCK`` ids make a block, which begins at a whole byte; a
table of block offsets stands before the blocks, so numpy unpacks a block, or any run of ids, without reading what
comes before.  A record holds the ids of consecutive documents::

    magic "PKID", version, bits, 2 zero bytes | ids, ids per block, blocks (u64) | block offsets (u64 each) | blocks

Documents are range-partitioned by ascending id; a task writes its records in order, each with the documents' ids and lengths
as columns beside it, as Parquet, so that Spark commits the files and a lost executor's are written anew.  Readers take
the lengths without the payload for the documents' places.

Defined results: a null or empty text is its end id alone; null ids come after all others; equal ids keep one row each,
in the order of their texts' hash; no rows give an empty table; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphmill.llm.common import parts, release
from graphmill.llm.tokens import default_path, encoder, text_lists
from graphmill.session import scratch_path, table

BLOCK = 1024
END = 0
#: Ids in a record, about.
RECORD_IDS = 1 << 18

_HEAD = struct.Struct("<4sBBHQQQ")


def pack_ids(ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    """A record of ``ids``, each below 2 ** bits (at most 32)."""
    n_blocks = -(-len(ids) // block)
    padded = np.zeros(n_blocks * block, np.uint32)
    padded[: len(ids)] = ids
    if bits in (8, 16, 32):
        body = padded.astype(f"<u{bits // 8}").view(np.uint8).reshape(n_blocks, block * bits // 8)
    else:
        # bit k of an id is bit k of its place in the block
        planes = (padded[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
        body = np.packbits(planes.astype(np.uint8).reshape(n_blocks, block * bits), axis=1, bitorder="little")
    sizes = np.full(n_blocks, body.shape[1] if n_blocks else 0, np.uint64)
    raw = body.tobytes()
    if n_blocks and len(ids) % block:
        sizes[-1] = -(-(len(ids) % block) * bits // 8)
        raw = raw[: int(sizes.sum())]
    offsets = np.cumsum(sizes) - sizes + _HEAD.size + 8 * n_blocks
    return _HEAD.pack(b"PKID", 1, bits, 0, len(ids), block, n_blocks) + offsets.astype("<u8").tobytes() + raw


def unpack_ids(record: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids start..stop of a record, by way of the blocks that hold them only."""
    magic, version, bits, _, n, block, n_blocks = _HEAD.unpack_from(record)
    if magic != b"PKID" or version != 1:
        raise ValueError("not a packed record")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    first, last = start // block, (stop - 1) // block
    offsets = np.frombuffer(record, "<u8", n_blocks, _HEAD.size)
    end = int(offsets[last + 1]) if last + 1 < n_blocks else len(record)
    raw = np.frombuffer(record, np.uint8, end - int(offsets[first]), int(offsets[first]))
    count = min(n, (last + 1) * block) - first * block
    if bits in (8, 16, 32):
        ids = raw.view(f"<u{bits // 8}")[:count].astype(np.uint32)
    else:
        # blocks are whole bytes; a block of other than a multiple of 8 ids could end in spare bits
        per = -(-block * bits // 8)
        ids = np.empty(0, np.uint32)
        held = []
        for at in range(0, len(raw), per):
            planes = np.unpackbits(raw[at : at + per], bitorder="little")
            m = min(block, len(planes) // bits)
            held.append(planes[: m * bits].reshape(m, bits).astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32)))
        ids = np.concatenate([ids, *held])[:count]
    return ids[start - first * block : stop - first * block]


def write_packed(spark: SparkSession, docs: DataFrame, out: str, path: str | None = None, end: int = END, record_ids: int = RECORD_IDS) -> None:
    """Writes the ids of ``docs`` in ascending doc_id order: (part, record, doc_ids, lengths, n_ids, payload)."""
    path = path or default_path()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        bits = max(1, int(max(e.vocabulary - 1, end)).bit_length())
        last = np.array([end], e.dtype).tobytes()
        record, size = 0, 0
        ids: list[bytes] = []
        names: list[int | None] = []

        def done() -> pa.RecordBatch:
            lengths = [len(x) // e.dtype.itemsize for x in ids]
            payload = pack_ids(np.frombuffer(b"".join(ids), e.dtype), bits)
            columns = [pa.array([record], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())), pa.array([sum(lengths)], pa.int64()), pa.array([payload], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["record", "doc_ids", "lengths", "n_ids", "payload"])

        for batch in batches:
            for i, texts in text_lists(batch.column("text")):
                ids += [x + last for x in e.encode(texts)]
                names += batch.column("doc_id")[i : i + len(texts)].to_pylist()
                size += sum(map(len, ids[-len(texts) :])) // e.dtype.itemsize
                if size >= record_ids:
                    yield done()
                    record, size, ids, names = record + 1, 0, [], []
        if ids:
            yield done()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.repartitionByRange(parts(spark), F.col("doc_id").asc_nulls_last()).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    packed = own.mapInArrow(rows, "record long, doc_ids array<long>, lengths array<long>, n_ids long, payload binary")
    packed.withColumn("part", F.spark_partition_id()).write.option("compression", "none").option("maxRecordsPerFile", 256).parquet(out)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document of a folder that ``write_packed`` wrote."""
    stored = spark.read.parquet(path)
    index = stored.select("part", "record", "n_ids")
    per = index.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # a row per partition, then running sums of a partition's records
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("part").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    index = index.withColumn("inner", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(per, "part").select("part", "record", (F.col("base") + F.col("inner")).alias("start"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                ids = unpack_ids(batch.column("payload")[r].as_py()).astype("<u4")
                names, lengths = batch.column("doc_ids").slice(r, 1).flatten(), batch.column("lengths").slice(r, 1).flatten().to_numpy()
                inner = np.cumsum(lengths) - lengths
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(inner.tolist(), lengths.tolist(), strict=True)]
                same = [pa.array(np.full(len(names), batch.column(c)[r].as_py(), np.int64)) for c in ("part", "record")]
                yield pa.RecordBatch.from_arrays([*same, names, pa.array(inner), pa.array(lengths), pa.array(crc, pa.int64())], ["part", "record", "doc_id", "inner", "n_tokens", "ids_crc32"])

    read = stored.select(F.col("part").cast("long").alias("part"), "record", "doc_ids", "lengths", "payload")
    read = read.mapInArrow(rows, "part long, record long, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return read.join(index, ["part", "record"]).select("doc_id", (F.col("start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def op9_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "llm-packed-ids")
    write_packed(spark, table(spark, sf_dir, "documents"), out)
    release(spark)
    return read_packed(spark, out)
