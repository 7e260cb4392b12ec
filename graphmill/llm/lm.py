"""Operator 3: language-model scores by deleted interpolation.

The model is P(w | h) = l2[b] c(h w) / c(h) + l1[b] c(w) / N + l0[b] / (V + 1), with one set of weights for each bucket b of
the context's count.  One tenth of the training documents (remainder ``DELETED``) is deleted from the counts to learn the
weights: expectation-maximisation on the deleted documents' pairs, with the ratios of the rest.  The final model counts
both.

1. Tasks turn runs of documents into batches: distinct words, and each token's place among them.  Batches are stored.
2. For each batch, every distinct word and pair of words goes with its counts to the bucket of its hash, once per batch, so that
   a frequent pair makes one entry a batch, not one an occurrence.  Buckets add up the counts and answer every batch.
3. Batches of deleted documents give a histogram of (bucket, c(h w) / c(h), c(w) / N), of bounded size, on
   which the driver runs EM.
4. Batches and answers meet again, and the documents are scored.

Words are known by 64-bit hashes.  Every text ends with one end token, which is also the context of the first word.

Defined results: null and empty texts are an end token; a null id counts as the empty text's remainder; equal ids and equal
rows are counted and scored each on their own; without training rows N and V are 0 and every token has
probability 1; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.llm.common import Words, crc_mod, mix64, parts, release, stored, text_chunks, whole_groups
from graphmill.session import table

FOLDS = 10
HELD_OUT = 0
DELETED = 1
ADD = 0.1
#: Buckets of the context's count, by powers of two.
BUCKETS = 24
BATCH_BYTES = 1 << 22

_END = np.uint64(0x5EED0E0DE0DE0DE1)
_LEFT = np.uint64(0xD6E8FEB86659FD93)
_STEP = 4  # cells of the histogram per power of two
_CELLS = 120


def _planes(x: np.ndarray) -> bytes:
    """An array's lowest bytes, then the next, ...: bytes that are all zero then lie together and compress away."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _of_planes(raw: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)


def _sorted_keys(x: np.ndarray) -> bytes:
    """Rising keys as the steps between them."""
    return _planes(np.diff(x, prepend=np.uint64(0)))


def _of_sorted_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_of_planes(raw, np.uint64), dtype=np.uint64)


def _batches(docs: DataFrame) -> DataFrame:
    """(deleted, doc_ids, folds, sizes, words, places): see step 1."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fold = batch.column("doc_id"), batch.column("fold").to_numpy()
            for i, j, data, off in text_chunks(batch.column("text"), BATCH_BYTES):
                w = Words(data, off)
                for deleted in (False, True):
                    own = (fold[i:j] == DELETED) == deleted
                    if not own.any():
                        continue
                    size = w.count[own] + 1
                    end = np.zeros(int(size.sum()), bool)
                    end[np.cumsum(size) - 1] = True
                    tokens = np.full(len(end), _END)
                    tokens[~end] = w.hash[own[w.doc]]
                    words, places = np.unique(tokens, return_inverse=True)
                    at = np.flatnonzero(own) + i
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([deleted]), pa.array([ids.take(pa.array(at)).to_pylist()], pa.list_(pa.int64())), pa.array([fold[at].tolist()], pa.list_(pa.int32())),
                         pa.array([size.tolist()], pa.list_(pa.int32())), pa.array([_sorted_keys(words)], pa.binary()), pa.array([_planes(places.astype(np.uint32))], pa.binary())],
                        ["deleted", "doc_ids", "folds", "sizes", "words", "places"],
                    )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), crc_mod(F.col("doc_id"), FOLDS).cast("int").alias("fold"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(rows, "deleted boolean, doc_ids array<long>, folds array<int>, sizes array<int>, words binary, places binary")


class Batch:
    """A stored batch's tokens: distinct words and pairs, and each token's place among them."""

    def __init__(self, words: bytes, places: bytes, sizes: np.ndarray):
        self.words = _of_sorted_keys(words)
        self.word = _of_planes(places, np.uint32)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        end = np.searchsorted(self.words, _END)
        self.context = np.concatenate([[end], self.word[:-1]]).astype(np.uint32)  # every text ends with the end token
        self.pairs, self.pair = np.unique(mix64(self.words[self.context] * _LEFT + self.words[self.word]), return_inverse=True)


def _small(x: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as a byte each, those from 255 on also in full."""
    return np.minimum(x, 255).astype(np.uint8).tobytes(), x[x >= 255].astype("<u8").tobytes()


def _large(small: bytes, rest: bytes) -> np.ndarray:
    x = np.frombuffer(small, np.uint8).astype(np.int64)
    x[x == 255] = np.frombuffer(rest, "<u8").astype(np.int64)
    return x


_COUNTS = "kept binary, kept_rest binary, gone binary, gone_rest binary"


def _requests(batches: DataFrame, buckets: int) -> DataFrame:
    """(kind, bucket, batch, deleted, keys, counts): kind 1 words, 2 pairs; kept: in training but not deleted, gone: deleted."""

    def rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for r in frame.to_pylist():
                b = Batch(r["words"], r["places"], np.array(r["sizes"]))
                fold = np.array(r["folds"])[b.doc]
                kept, gone = (fold != HELD_OUT) & (fold != DELETED), fold == DELETED
                out: list[tuple] = []
                for kind, keys, place in ((1, b.words, b.word), (2, b.pairs, b.pair)):
                    n = [np.bincount(place, weights=m, minlength=len(keys)).astype(np.int64) for m in (kept, gone)]
                    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                    cut = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
                    for k in np.flatnonzero(np.diff(cut)):
                        a, z = cut[k], cut[k + 1]
                        out.append((kind, int(k), r["batch"], r["deleted"], _sorted_keys(keys[a:z]), *_small(n[0][a:z]), *_small(n[1][a:z])))
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)), schema=schema)

    names = ["kind", "bucket", "batch", "deleted", "keys", "kept", "kept_rest", "gone", "gone_rest"]
    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("batch", pa.int64()), ("deleted", pa.bool_()), *((c, pa.binary()) for c in names[4:])])
    return batches.select("batch", "deleted", "folds", "sizes", "words", "places").mapInArrow(rows, f"kind int, bucket int, batch long, deleted boolean, keys binary, {_COUNTS}")


def _answers(requests: DataFrame, tasks: int) -> DataFrame:
    """(kind, bucket, batch, deleted, counts): the corpus counts of every request's keys; batch -1 has a bucket's sums."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_groups(frames, ["kind", "bucket"]):
            keys = [_of_sorted_keys(k) for k in g["keys"]]
            cut = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            seen, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = []
            for c in ("kept", "gone"):
                n = np.concatenate([_large(a, b) for a, b in zip(g[c], g[f"{c}_rest"], strict=True)])
                total.append(np.bincount(at, weights=n, minlength=len(seen)).astype(np.int64))
            out = [(b, d, *_small(total[0][at[i:j]]), *_small(total[1][at[i:j]])) for b, d, i, j in zip(g["batch"], g["deleted"], cut[:-1], cut[1:], strict=True)]
            sums = np.array([total[0].sum(), total[1].sum(), (total[0] > 0).sum(), (total[0] + total[1] > 0).sum()])
            out.append((-1, False, sums.astype("<u8").tobytes(), b"", b"", b""))
            done = pd.DataFrame(out, columns=["batch", "deleted", "kept", "kept_rest", "gone", "gone_rest"])
            yield done.assign(kind=int(g["kind"].iloc[0]), bucket=int(g["bucket"].iloc[0]))[["kind", "bucket", *done.columns]]

    own = requests.repartition(tasks, "kind", "bucket").sortWithinPartitions("kind", "bucket")
    return own.mapInPandas(rows, f"kind int, bucket int, batch long, deleted boolean, {_COUNTS}")


def _answered(batches: DataFrame, answers: DataFrame) -> DataFrame:
    """Every batch with its answers, in the order of its keys."""
    lists = answers.where("batch >= 0").groupBy("batch").agg(F.collect_list(F.struct("kind", "bucket", "kept", "kept_rest", "gone", "gone_rest")).alias("answers"))
    return batches.join(lists, "batch")


def _counts_of(r: dict) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    got = sorted(r["answers"], key=lambda a: (a["kind"], a["bucket"]))
    return {k: tuple(np.concatenate([_large(a[c], a[f"{c}_rest"]) for a in got if a["kind"] == k]) for c in ("kept", "gone")) for k in (1, 2)}


def _context_bucket(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(n + 1.0).astype(np.int64), BUCKETS - 1)


def _histogram(batches: DataFrame, n_kept: int) -> DataFrame:
    """(bucket, p2, p1, n): deleted tokens by bucket and by ranges of the two ratios, with their mean ratios."""

    def cell(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, np.minimum(1 - _STEP * np.log2(np.maximum(p, 1e-300)), _CELLS - 1), 0).astype(np.int64)

    def rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for r in frame.to_pylist():
                b, counts = Batch(r["words"], r["places"], np.array(r["sizes"])), _counts_of(r)
                word, pair = counts[1][0], counts[2][0]
                h = word[b.context]
                p2 = pair[b.pair] / np.maximum(h, 1)
                p1 = word[b.word] / max(n_kept, 1)
                key = (_context_bucket(h) * _CELLS + cell(p2)) * _CELLS + cell(p1)
                keys, at = np.unique(key, return_inverse=True)
                sums = [np.bincount(at, weights=x, minlength=len(keys)) for x in (p2, p1, np.ones(len(at)))]
                yield pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, sums)], ["cell", "p2", "p1", "n"])

    cells = batches.mapInArrow(rows, "cell long, p2 double, p1 double, n double").groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("p2", "p1", "n")))
    return cells.select("cell", (F.col("p2") / F.col("n")).alias("p2"), (F.col("p1") / F.col("n")).alias("p1"), "n")


def learn_weights(cells: pd.DataFrame, v_kept: int, rounds: int = 100) -> np.ndarray:
    """(bucket, 3): weights of the pair's, the word's and the uniform estimate, by expectation-maximisation."""
    weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    cells = cells.sort_values("cell")
    bucket = cells["cell"].to_numpy(np.int64) // (_CELLS * _CELLS)
    p = np.stack([cells["p2"].to_numpy(float), cells["p1"].to_numpy(float), np.full(len(cells), 1 / (v_kept + 1))], axis=1)
    n = cells["n"].to_numpy(float)
    for _ in range(rounds):
        part = weights[bucket] * p
        part *= (n / part.sum(axis=1))[:, None]
        # a thousandth of a token for each estimate keeps every weight above 0
        total = np.stack([np.bincount(bucket, weights=part[:, k], minlength=BUCKETS) for k in range(3)], axis=1) + 1e-3
        weights = total / total.sum(axis=1, keepdims=True)
    seen = np.flatnonzero(np.bincount(bucket, weights=n, minlength=BUCKETS) > 0)
    for b in range(BUCKETS):  # a bucket without deleted tokens takes the nearest one's weights
        if b and len(seen) and b not in seen:
            weights[b] = weights[seen[np.argmin(np.abs(seen - b))]]
    # a context that was never seen has no pairs
    weights[0] = [0, *(weights[0, 1:] / weights[0, 1:].sum())]
    return weights


def interpolated_scores(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    batches = stored(spark, _batches(docs).withColumn("batch", F.monotonically_increasing_id()), "batches", 16)
    answers = stored(spark, _answers(_requests(batches, 4 * parts(spark)), parts(spark)), "answers")
    release(spark)
    sums = np.zeros(4, np.int64)
    for r in answers.where("batch = -1 and kind = 1").select("kept").toLocalIterator():  # a row per bucket
        sums += np.frombuffer(r.kept, "<u8").astype(np.int64)
    n_kept, n_all, v_kept, v = int(sums[0]), int(sums[0] + sums[1]), int(sums[2]), int(sums[3])
    cells = _histogram(_answered(batches.where("deleted"), answers.where("deleted")), n_kept).toPandas()  # at most BUCKETS * _CELLS ** 2 rows
    weights = learn_weights(cells, v_kept)

    def rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for r in frame.to_pylist():
                sizes = np.array(r["sizes"])
                b, counts = Batch(r["words"], r["places"], sizes), _counts_of(r)
                word, pair = counts[1][0] + counts[1][1], counts[2][0] + counts[2][1]
                c, h = word[b.word], word[b.context]
                w = weights[_context_bucket(h)]
                p = w[:, 0] * pair[b.pair] / np.maximum(h, 1) + w[:, 1] * c / max(n_all, 1) + w[:, 2] / (v + 1)
                if not n_all:
                    p = np.ones(len(c))
                base = np.log10((c + ADD) / (n_all + ADD * (v + 1)))
                by = [np.bincount(b.doc, weights=x, minlength=len(sizes)) for x in (c > 0, base, np.log10(p))]
                columns = [pa.array(r["doc_ids"], pa.int64()), pa.array(np.array(r["folds"]) == HELD_OUT), pa.array(sizes.astype(np.int64)), pa.array(by[0].astype(np.int64)), pa.array(np.full(len(sizes), n_all)), pa.array(by[1]), pa.array(by[2])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return _answered(batches, answers).mapInArrow(rows, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_scores(spark, table(spark, sf_dir, "documents"))
