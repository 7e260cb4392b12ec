"""Operator 11: periodic runs of words, by internal pattern matching.

A run is a stretch of words with smallest period q and at least max(``least``, 3 q) words that no neighbouring word extends.
Texts are numbered words, several to a batch, each closed by a symbol of its own, so that no match crosses its border.

* Prefix doubling ranks the stretches of 1, 2, 4, ... words and gives the suffix array, kept where a stretch of 8 words repeats.
* A wavelet tree over it answers range successors: the next places, from a given word on, of one stretch.
* Every dyadic block (2**k words from a multiple of 2**k, k >= 3) asks for its own occurrences 2**k to 2**(k+1) - 1 words on (for
  k = 3 also 1 to 7).  A run of period q holds a block of the k with 2**k <= q < 2**(k+1) that occurs again q words on.
* Up to two occurrences are candidate periods.  Three or more form a progression; there a period shifts the periodic stretch about
  the block onto that about the occurrences, so the distances of their ends are the candidates.
* Ranks give the longest match of two places to either side, which turns a candidate into its maximal stretch, or drops it.

Ranks and tree hold about 8 * log2(words) bytes a word of one batch: of ``BATCH_WORDS``, or of one longer text.

Defined results: a null or empty text has no words and no run; a null id counts as the empty id where the query repeats words;
equal rows are answered one by one; no rows give an empty table; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.session import table

LEAST = 24
BATCH_WORDS = 1 << 18
#: Blocks have 2 ** FIRST words at least: with 24 words or more, each run of a period up to 8 holds one twice.
FIRST = 3


class Ranks:
    """Ranks of the stretches of 2**k symbols from every place, for k up to the longest repeat, and the suffix array where
    stretches of 2 ** FIRST symbols repeat.  Every text in ``x`` ends with a symbol that occurs once."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        counts = np.bincount(x)
        rank = (np.cumsum(counts) - counts)[x]
        open_ = np.flatnonzero(counts[x] > 1)  # places whose stretch occurs elsewhere too
        self.levels = [rank.astype(np.int32)]
        self.repeated: list[np.ndarray] = [open_]
        width = 1
        while len(open_):
            key = rank[open_] * (n + 1) + rank[open_ + width]
            order = np.argsort(key)
            at, key = open_[order], key[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            old = rank[at]
            first = np.concatenate([[True], old[1:] != old[:-1]])
            i = np.arange(len(at))
            rank[at] = old + np.maximum.accumulate(np.where(new, i, 0)) - np.maximum.accumulate(np.where(first, i, 0))
            alone = new & np.concatenate([new[1:], [True]])
            open_ = np.sort(at[~alone])
            self.levels.append(rank.astype(np.int32))
            self.repeated.append(open_)
            width *= 2
        kept = self.repeated[FIRST] if len(self.repeated) > FIRST else open_
        order = np.argsort(rank[kept])
        self.suffixes, self.suffix_ranks = kept[order], rank[kept][order]

    def ranges(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array's stretch that begins with the 2**k symbols at each of ``at``, all of them repeated."""
        start = self.levels[k][at].astype(np.int64)
        known = np.sort(self.levels[k][self.repeated[k]])
        size = np.searchsorted(known, start, "right") - np.searchsorted(known, start)
        return np.searchsorted(self.suffix_ranks, start), np.searchsorted(self.suffix_ranks, start + size)

    def match_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` on equal those from ``b`` on."""
        got = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            got += (level[a + got] == level[b + got]).astype(np.int64) << k
        return got

    def match_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before ``a`` equal those before ``b``."""
        got = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            i, j = a - got - (1 << k), b - got - (1 << k)
            inside = (i >= 0) & (j >= 0)
            got += (inside & (level[np.maximum(i, 0)] == level[np.maximum(j, 0)])).astype(np.int64) << k
        return got


class WaveletTree:
    """Counts and order statistics of the values in any stretch of ``values`` (from 0 to their number less 1)."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(self.n).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            values = np.concatenate([values[~one], values[one]])

    def below(self, left: np.ndarray, right: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values in left..right are less than ``value`` (at most their number)."""
        got = np.zeros(len(left), np.int64)
        for bit, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            l, r, ones = zeros[left], zeros[right], (value >> bit) & 1 == 1
            got += np.where(ones, r - l, 0)
            left, right = np.where(ones, left - l + zeros[-1], l), np.where(ones, right - r + zeros[-1], r)
        return got

    def smallest(self, left: np.ndarray, right: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The ``nth`` smallest value (from 0) in left..right; with ``nth`` = below(value), the successor of ``value``."""
        got = np.zeros(len(left), np.int64)
        for bit, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            l, r = zeros[left], zeros[right]
            ones = nth >= r - l
            nth = np.where(ones, nth - (r - l), nth)
            got |= ones.astype(np.int64) << bit
            left, right = np.where(ones, left - l + zeros[-1], l), np.where(ones, right - r + zeros[-1], r)
        return got


def _candidates(ranks: Ranks, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance): distances at which a dyadic block, or the periodic stretch about it, occurs again nearby."""
    places = np.sort(ranks.suffixes)
    tree = WaveletTree(np.searchsorted(places, ranks.suffixes))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(FIRST, len(ranks.levels)):
        width = 1 << k
        blocks = ranks.repeated[k]
        blocks = blocks[blocks % width == 0]
        if not len(blocks):
            continue
        left, right = ranks.ranges(k, blocks)
        for near, far in ([(1, width), (width, 2 * width)] if k == FIRST else [(width, 2 * width)]):
            lo = tree.below(left, right, np.searchsorted(places, blocks + near))
            hits = tree.below(left, right, np.searchsorted(places, blocks + far)) - lo
            some = np.flatnonzero(hits)
            at = blocks[some]
            first = places[tree.smallest(left[some], right[some], lo[some])]
            found.append((at, first - at))
            some2 = np.flatnonzero(hits > 1)
            if not len(some2):
                continue
            at, first = blocks[some2], first[hits[some] > 1]
            second = places[tree.smallest(left[some2], right[some2], lo[some2] + 1)]
            found.append((at, second - at))
            many = hits[some2] > 2
            at, first, step = at[many], first[many], (second - first)[many]
            ends = ranks.match_after(first, first + step) + first - ranks.match_after(at, at + step) - at
            starts = first - ranks.match_before(first, first + step) - at + ranks.match_before(at, at + step)
            for distance in (ends, starts):
                fits = (distance >= near) & (distance < far) & (at + distance < n)
                found.append((at[fits], distance[fits]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([d for _, d in found])


def runs_of(texts: list[list], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Per text, a list of words (any hashable values): its runs (start, length, period) by start, then period."""
    if least < 24:
        raise ValueError("runs of fewer than 24 words need shorter blocks")
    ids = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], np.int64)
    border = np.cumsum(sizes + 1)  # after each text's closing symbol
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(texts) or sizes.max() < least:
        return out
    x = np.zeros(int(border[-1]), np.int64)
    for end, t in zip(border.tolist(), texts, strict=True):
        x[end - 1 - len(t) : end - 1] = np.fromiter(map(ids.__getitem__, t), np.int64, len(t))
    x[border - 1] = len(ids) + np.arange(len(texts))
    ranks = Ranks(x)
    if not len(ranks.suffixes):
        return out
    at, period = _candidates(ranks, len(x))
    start = at - ranks.match_before(at, at + period)
    end = at + period + ranks.match_after(at, at + period)
    long = end - start >= np.maximum(least, 3 * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])  # the smallest period of each stretch
    start, end, period = start[new], end[new], period[new]
    doc = np.searchsorted(border, start, "right")
    start_in = start - (border - sizes - 1)[doc]
    order = np.lexsort((period, start_in, doc))
    for d, s, n, p in zip(doc[order].tolist(), start_in[order].tolist(), (end - start)[order].tolist(), period[order].tolist(), strict=True):
        out[d].append((s, n, p))
    return out


def without_repeats(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` less those that a run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), dtype=bool)
    for s, n, p in runs:
        kept[s + p : s + n] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def echoed(doc_id: int | None, words: list) -> list:
    """The words that the query searches: in a tenth of the documents, by the id's crc32, an end that repeats itself."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    again = words[a : a + p]
    return words[:a] + (again * (-(-(n - a) // p)))[: n - a]


def periodic_runs(docs: DataFrame, least: int = LEAST, change: Callable[[int | None, list], list] | None = None, batch_words: int = BATCH_WORDS) -> DataFrame:
    """(doc_id, runs, collapsed): every document's runs, and its words without repeats, joined by one space.

    ``change`` maps (doc_id, words) to the words to search; None: the text's own."""

    def answer(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of(texts, least)
        kept = [b" ".join(without_repeats(t, r)) for t, r in zip(texts, runs, strict=True)]
        flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
        cut = np.cumsum([0, *map(len, runs)]).astype(np.int32)
        fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
        columns = [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(cut), fields), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = (text.as_py() or "").encode().split()  # of bytes: at 0x20 and 0x09-0x0D only
                words = change(i, words) if change else words
                if size and size + len(words) > batch_words:
                    yield answer(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(words)
                size += len(words) + 1
        if ids:
            yield answer(ids, texts)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(rows, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its number of runs, the one of greatest exponent, and digests of all runs and of the text without repeats."""
    found = periodic_runs(table(spark, sf_dir, "documents"), change=echoed)
    runs = F.col("runs")
    # runs come by start, then period: of equal exponents the first stays
    best = F.reduce(runs, F.get(runs, 0), lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
