"""Operator 8: mixing sources to target weights.

The words of a source, its documents in ascending id, are cut into blocks of ``BLOCK_WORDS`` words.  A source's
target is its weight's share of ``share`` times all words, at most ``most`` times its own words; what is over goes to the
others by weight.  The target in blocks is the source's number of slots.  Each source's slots are dealt to the output
shards by a multinomial draw, and slot j stands for block ``permute(j mod n)`` in its pass ``j div n`` over the source's n blocks:
a keyed pseudorandom permutation per source and pass, so no shuffle of an index list is needed.  Slots and blocks are
joined by (source, block).  A pass takes every block once, so no document is taken more than ``most`` times.

The draws are keyed by the seed and the source alone, so reruns agree.  The only table handled as one is that with a
row per source.

Defined results: null and empty texts have size 0 and are never taken; null sources are one source, the last; null ids come
after all others; equal ids and equal rows each count on their own; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphmill.llm.common import Words, mix64, parts, release, running_total, stored, text_chunks
from graphmill.operators.skew import quoted
from graphmill.session import table

BLOCK_WORDS = 64
SLOTS_PER_SHARD = 4096
#: Weights by the sources' order, repeating; all targets together, and a source's target at most, as multiples of their words.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2


def permute(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """Where a keyed permutation of 0..n-1 takes each ``i``: a four-round Feistel network, walked until below n."""
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix64(np.arange(4, dtype=np.uint64) + np.uint64(key % 2**63))
    out = i.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            left, right = right, left ^ (mix64(right + k) & low)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def _row_hash(docs: DataFrame) -> Column:
    """A hash of id, source and text, and of other columns that ``documents`` does not have."""
    more = [f.name for f in docs.schema.fields if f.name not in ("doc_id", "text", "lang", "source", "n_chars")]
    return F.xxhash64("doc_id", "source", "text", *([F.to_json(F.struct(*[F.col(quoted(c)) for c in more]))] if more else []))


def with_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, rid, size): words per row, and a hash of the row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [Words(data, off).count for _, _, data, off in text_chunks(batch.column("text"))]
            n = np.concatenate(n).astype(np.int64) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "source", "rid")), pa.array(n)], ["doc_id", "source", "rid", "size"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _row_hash(docs).alias("rid"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(rows, "doc_id long, source string, rid long, size long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK_WORDS) -> DataFrame:
    """(source, sno, source_size, target, blocks, slots), a row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sno", F.row_number().over(order) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("sno") % len(weights) + 1))
    # sources in the order in which a common rate per weight reaches their limits; those before the first that
    # the rate of the rest doesn't fill are at their limits
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "sno")
    per = per.withColumn("rest_words", F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum(F.col("source_size") * most).over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    per = per.withColumn("rate", F.col("rest_words") / F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
    per = per.withColumn("open", F.col("rate") * F.col("weight") <= F.col("source_size") * most)
    per = per.withColumn("rate", F.first(F.when(F.col("open"), F.col("rate")), ignorenulls=True).over(Window.orderBy(F.col("source_size") / F.col("weight"), "sno").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    limit = (F.col("source_size") * most).cast("double")
    per = per.withColumn("target", F.coalesce(F.least(limit, F.col("rate") * F.col("weight")), limit))
    per = per.withColumn("blocks", F.ceil(F.col("source_size") / block))
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0).cast("long")
    return per.select("source", "sno", "source_size", "target", "blocks", slots.alias("slots"))


def _slots(sources: DataFrame, seed: int, per_shard: int, tasks: int) -> DataFrame:
    """(shard, sno, block): the block of every slot of every output shard."""
    shards = F.greatest(F.lit(1), F.ceil(F.sum("slots").over(Window.partitionBy()) / per_shard))
    dealt = sources.where("slots > 0").withColumn("shards", shards.cast("long")).select("sno", "blocks", "slots", "shards")

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                rng = np.random.default_rng([seed, int(r.sno)])
                n = rng.multinomial(int(r.slots), np.full(int(r.shards), 1 / int(r.shards)))
                first = np.cumsum(n) - n
                yield pd.DataFrame({"sno": r.sno, "blocks": r.blocks, "shard": np.arange(int(r.shards)), "first": first, "n": n})[n > 0]

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                j = np.arange(int(r.first), int(r.first) + int(r.n))
                turn, at = j // int(r.blocks), j % int(r.blocks)
                out = np.empty(len(j), np.int64)
                for t in np.unique(turn):
                    out[turn == t] = permute(at[turn == t], int(r.blocks), int(mix64(np.array([seed * 1_000_003 + int(r.sno) * 64 + int(t)], np.uint64))[0]))
                yield pd.DataFrame({"shard": r.shard, "sno": r.sno, "block": out})

    # a task's input is a few numbers and its output long, so the number of tasks is given
    drawn = dealt.repartition(tasks, "sno").mapInPandas(draw, "sno int, blocks long, shard long, first long, n long")
    return drawn.repartition(tasks, "sno", "shard").mapInPandas(expand, "shard long, sno int, block long")


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
        block: int = BLOCK_WORDS, per_shard: int = SLOTS_PER_SHARD, seed: int = 8) -> tuple[DataFrame, DataFrame]:
    """(rows, pieces).  rows: every row of ``docs`` with size, source_size, target, sno and its first word's place in
    its source (start).  pieces: (shard, sno, start, at, words) per part of a document in a slot, where at is
    the part's first word in the document."""
    # stored first: the range partitioning reads its input twice
    sizes = running_total(spark, stored(spark, with_sizes(docs), "words"), ["doc_id", "rid"], "size", "start", ["source"], name="sizes")
    sizes = stored(spark, sizes, "places")
    sources = stored(spark, targets(sizes, weights, share, most, block), "sources")
    own = sources.withColumnRenamed("source", "_source")
    rows = sizes.join(own, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    release(spark)
    slots = _slots(sources, seed, per_shard, parts(spark)).hint("merge")  # both sides grow with the words
    full = rows.where("size > 0")
    spans = full.select("sno", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    lo = F.greatest(F.col("start"), F.col("block") * block)
    hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    spans = spans.select("sno", "start", "block", (lo - F.col("start")).alias("at"), (hi - lo).alias("words"))
    return rows, slots.join(spans, ["sno", "block"]).select("shard", "sno", "start", "at", "words")


def mixed_words(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``."""
    rows, pieces = mix(spark, docs, **options)
    taken = pieces.groupBy("sno", "start").agg(F.sum("words").alias("taken")).withColumn("some", F.lit(True))
    out = rows.withColumn("some", F.col("size") > 0).join(taken, ["sno", "start", "some"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of ``docs``: the k-th copy of a document has, in order, the parts taken at least k times.

    n_chars, if there, is that of the copy; a document without words stays as it is, once.
    """
    rows, pieces = mix(spark, docs, **options)
    times = pieces.groupBy("sno", "start", "at", "words").agg(F.count("*").cast("int").alias("times"))
    lists = times.groupBy("sno", "start").agg(F.sort_array(F.collect_list(F.struct("at", "words", "times"))).alias("parts"))
    lists = rows.where("size > 0").select("sno", "start", "rid").join(lists, ["sno", "start"])
    # rows that are equal have one text and as many lists
    lists = stored(spark, lists.groupBy("rid").agg(F.collect_list("parts").alias("lists")), "parts")
    blank = rows.where("size = 0").groupBy("rid").agg(F.count("*").cast("int").alias("blank"))
    blank = stored(spark, blank, "blank")
    release(spark)
    # other columns may be named like inner ones: they are numbered on the way
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])
    text_at, chars_at = (docs.columns.index(c) if c in docs.columns else None for c in ("text", "n_chars"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column(text_at)):
                w = Words(data, off)
                take, texts = [], []
                for r, (lists, blank) in enumerate(zip(batch.column("lists")[i:j].to_pylist(), batch.column("blank")[i:j].to_pylist(), strict=True)):
                    old = batch.column(text_at)[i + r].as_py()
                    if not lists:
                        take += [i + r] * (blank or 0)
                        texts += [old] * (blank or 0)
                        continue
                    raw, first, base = old.encode(), int(w.first[r]), int(w.offsets[r])
                    size = int(w.count[r])
                    for parts in lists:
                        for k in range(1, max(p["times"] for p in parts) + 1):
                            out: list[bytes] = []
                            last = None
                            for p in parts:
                                if p["times"] < k:
                                    continue
                                a, z = p["at"], p["at"] + p["words"]
                                begin = 0 if a == 0 else int(w.start[first + a]) - base
                                end = len(raw) if z == size else int(w.start[first + z]) - base
                                if last is not None and last != a and not out[-1][-1:].isspace():
                                    out.append(b" ")
                                out.append(raw[begin:end])
                                last = z
                            take.append(i + r)
                            texts.append(b"".join(out).decode())
                part = batch.select(schema.names).take(pa.array(take, pa.int64()))
                columns = [part.column(c) for c in range(part.num_columns)]
                columns[text_at] = pa.array(texts, pa.string())
                if chars_at is not None:
                    columns[chars_at] = pa.array([None if t is None else len(t) for t in texts], columns[chars_at].type)
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    own = docs.select(*[F.col(quoted(c)).alias(k) for c, k in zip(docs.columns, schema.names, strict=True)], _row_hash(docs).alias("rid")).dropDuplicates(["rid"])
    mixed = own.join(lists, "rid", "left").join(blank, "rid", "left").select(*schema.names, "lists", "blank").mapInArrow(cut, schema)
    return mixed.toDF(*docs.columns)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_words(spark, table(spark, sf_dir, "documents"))
