"""Operator 2: substring dedup by sliding sentence spans.

A sentence ends at a word that ends in ``.``, ``!`` or ``?`` (closing quotes and brackets may follow), or at a line's
end; a sentence of more than ``MAX_WORDS`` words counts as several.  Every run of ``SPAN`` consecutive sentences, however
short, is hashed (words only, lower-cased A-Z) and all runs are joined globally.  The first
occurrence of a run is the one with the smallest doc_id, and within a document the earliest; sentences covered by any other
occurrence are marked.

With ``anywhere``, runs also begin and end inside sentences, at places that depend on the words alone: of every ``ANCHOR_GAP``
consecutive words of a sentence the one with the least hash, and each sentence's first.  From each such place a run goes to the
first one at least ``ANCHOR_WORDS`` words on.  Places next to a passage's ends may differ by what stands around it, so
of equal words the first and last ``ANCHOR_GAP - 1`` may be cut differently; every passage of ``2 * (ANCHOR_GAP - 1) + 2 * ANCHOR_GAP
+ ANCHOR_WORDS`` = 50 words holds a run that is cut alike wherever it stands.

Every marked stretch is removed with the white space after it (``min_words`` keeps shorter ones).

Defined results: null stays null, empty texts and texts of fewer than ``SPAN`` sentences stay as they are; a null id
comes after all others; rows that share an id don't remove each other's runs, and equal rows get equal results; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphmill.llm.common import Words, mix64, release, stored, text_chunks
from graphmill.operators.skew import quoted
from graphmill.session import table

SPAN = 3
MAX_WORDS = 12
MIN_SPAN_WORDS = 1  # every run
MIN_WORDS = 1  # every stretch
ANCHOR_GAP = 7
ANCHOR_WORDS = 24

_LAST = 1 << 62
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True
_CLOSE = np.zeros(256, dtype=bool)
_CLOSE[list(b"\"')]}")] = True
_BASE = 0x9E3779B97F4A7C15
_UNIT_MULT = mix64(np.arange(101, 101 + 64, dtype=np.uint64))


class Sentences:
    """Sentences of some texts: first word, number of words and text of each; words, text and hash of their runs."""

    def __init__(self, words: Words, anywhere: bool = False):
        n = len(words.hash)
        self.words, self.n_docs = words, words.n_docs
        if not n:
            self.first = self.size = self.doc = np.zeros(0, np.int64)
            self.run = self.run_end = self.run_doc = np.zeros(0, np.int64)
            self.run_hash = np.zeros(0, np.uint64)
            return
        b, start, end, doc = words.bytes, words.start, words.end, words.doc
        tail = end - 1
        for _ in range(2):
            tail = np.where(_CLOSE[b[tail]] & (tail > start), tail - 1, tail)
        lines = np.concatenate([[0], np.cumsum(b == 10)])
        new = np.ones(n, dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | _STOP[b[tail[:-1]]] | (lines[start[1:]] > lines[end[:-1]])
        first = np.flatnonzero(new)
        at = np.arange(n) - first[np.cumsum(new) - 1]
        self.first = np.flatnonzero(at % MAX_WORDS == 0)
        self.size = np.diff(self.first, append=n)
        self.doc = doc[self.first]
        in_unit = np.arange(n) - np.repeat(self.first, self.size)
        unit = mix64(np.add.reduceat(words.hash * _UNIT_MULT[in_unit], self.first) + self.size.astype(np.uint64))
        m = max(0, len(unit) - SPAN + 1)
        total = np.zeros(m, np.uint64)
        for i in range(SPAN):
            total += unit[i : i + m] * _UNIT_MULT[i]
        run = np.flatnonzero(self.doc[:m] == self.doc[SPAN - 1 :])
        # first word of each run, and the word after its last
        self.run, self.run_end, self.run_hash = self.first[run], (self.first + self.size)[run + SPAN - 1], mix64(total[run])
        if anywhere:
            begin, end, key = self._anchored(new)
            order = np.argsort(np.concatenate([doc[self.run], doc[begin]]), kind="stable")  # a text's runs stay together
            self.run, self.run_end, self.run_hash = (np.concatenate(x)[order] for x in ((self.run, begin), (self.run_end, end), (self.run_hash, key)))
        self.run_doc = doc[self.run]

    def _anchored(self, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, word after the last, and hash of the runs between places that the words alone decide."""
        h, n = self.words.hash, len(new)
        place = new.copy()
        if n >= ANCHOR_GAP:
            sentence = np.cumsum(new)
            m = n - ANCHOR_GAP + 1
            least, at = h[:m].copy(), np.arange(m)
            for i in range(1, ANCHOR_GAP):  # of equal words the last
                other = h[i : m + i]
                low = other <= least
                least[low] = other[low]
                at[low] = np.flatnonzero(low) + i
            place[at[sentence[:m] == sentence[ANCHOR_GAP - 1 :]]] = True
        begin = np.flatnonzero(place)
        ends = np.append(begin, n)
        end = ends[np.minimum(np.searchsorted(ends, begin + ANCHOR_WORDS), len(ends) - 1)]
        ok = (end - begin >= ANCHOR_WORDS) & (self.words.doc[begin] == self.words.doc[end - 1])
        begin, end = begin[ok], end[ok]
        power = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, _BASE, np.uint64)))
        back = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)))
        sums = np.append(np.uint64(0), np.cumsum(h * power[:n]))
        return begin, end, mix64((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))

    def first_runs(self) -> np.ndarray:
        """For each run, whether it is its text's first with its hash."""
        doc = self.run_doc
        order = np.lexsort((self.run, self.run_hash, doc))
        out = np.ones(len(order), dtype=bool)
        out[order[1:]] = (doc[order[1:]] != doc[order[:-1]]) | (self.run_hash[order[1:]] != self.run_hash[order[:-1]])
        return out


def _runs(docs: DataFrame, anywhere: bool) -> DataFrame:
    """(rid, ord, run, at): hash and number of every run, once per text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column("text")):
                s = Sentences(Words(data, off), anywhere)
                if not len(s.run):
                    continue
                own = s.first_runs()
                doc = s.run_doc[own]
                at = np.flatnonzero(own) - np.searchsorted(s.run_doc, doc)
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([batch.column("rid")[i:j].take(take), batch.column("ord")[i:j].take(take), pa.array(s.run_hash[own].view(np.int64)), pa.array(at.astype(np.int32))], ["rid", "ord", "run", "at"])

    return docs.select("rid", "ord", "text").mapInArrow(rows, "rid long, ord long, run long, at int")


def _clean(text: bytes, s: Sentences, lo: int, hi: int, base: int, marked: np.ndarray, min_words: int) -> tuple[bytes, np.ndarray]:
    """The text, whose words are ``lo`` to ``hi``, without marked stretches that are long enough; which words were removed."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    out, at, gone = [], 0, np.zeros(hi - lo, dtype=bool)
    for a, z in zip(edge[::2], edge[1::2], strict=True):
        if z - a < min_words:
            continue
        begin = int(s.words.start[lo + a]) - base
        end = int(s.words.start[lo + z]) - base if lo + z < hi else len(text)
        out.append(text[at:begin])
        at, gone[a:z] = end, True
    out.append(text[at:])
    return b"".join(out), gone


_COUNTS = ("n_sentences", "n_removed", "words_removed")


def dedup_substrings(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS, anywhere: bool = False) -> DataFrame:
    """Every row of ``docs`` with all its columns, its ``text`` cleaned, and n_sentences, n_removed, words_removed (long), which
    replace columns of these names.

    n_removed counts sentences that went as a whole.  Marked stretches of fewer than ``min_words`` words stay.  With ``anywhere``,
    repeats that begin or end inside a sentence go too."""
    names = [c for c in docs.columns if c not in ("text", *_COUNTS)]
    # other columns may be named like inner ones: they are numbered on the way
    keep = [f"c{i}" for i in range(len(names))]
    types = {k: docs.schema[c].dataType for k, c in zip(keep, names, strict=True)}
    own = docs.select(*[F.col(quoted(c)).alias(k) for c, k in zip(names, keep, strict=True)], "doc_id", F.col("text").cast("string").alias("text"))
    own = own.withColumn("ord", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))).withColumn("rid", F.xxhash64("doc_id", "text"))
    runs = _runs(own, anywhere)
    seen = runs.groupBy("run").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first < last")
    again = runs.join(seen, "run").where("ord > first").groupBy("rid").agg(F.collect_set("at").alias("at"))
    again = stored(spark, again, "repeats")
    release(spark)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column("text")):
                s = Sentences(Words(data, off), anywhere)
                cut = np.searchsorted(s.doc, np.arange(j - i + 1))
                word = np.searchsorted(s.words.doc, np.arange(j - i + 1))
                found = batch.column("at")[i:j]
                doc = np.repeat(np.arange(j - i), found.value_lengths().fill_null(0).to_numpy())
                again = np.concatenate([np.flatnonzero(~s.first_runs()), np.searchsorted(s.run_doc, doc) + found.flatten().to_numpy()])
                step = np.bincount(s.run[again], minlength=word[-1] + 1) - np.bincount(s.run_end[again], minlength=word[-1] + 1)
                marked = np.cumsum(step[:-1]) > 0
                texts, gone, gone_words = [], [], []
                for r, old in enumerate(batch.column("text")[i:j].to_pylist()):
                    m = marked[word[r] : word[r + 1]]
                    n = w = 0
                    if m.any():
                        raw, went = _clean(old.encode(), s, word[r], word[r + 1], int(off[r] - off[0]), m, min_words)
                        old = raw.decode()
                        n, w = int(np.logical_and.reduceat(went, s.first[cut[r] : cut[r + 1]] - word[r]).sum()), int(went.sum())
                    texts.append(old)
                    gone.append(n)
                    gone_words.append(w)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(texts, pa.string()), pa.array(np.diff(cut).astype(np.int64)), pa.array(gone, pa.int64()), pa.array(gone_words, pa.int64())],
                    [*keep, "text", *_COUNTS],
                )

    schema = T.StructType([T.StructField(k, t) for k, t in types.items()]).add("text", "string")
    for c in _COUNTS:
        schema = schema.add(c, "long")
    return own.join(again, "rid", "left").select(*keep, "text", "at").mapInArrow(rows, schema).toDF(*names, "text", *_COUNTS)


def without_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned texts, repeats inside sentences included, and its own columns only; n_chars, if there, is that of the
    text where it changed."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    inner = [c if c in ("doc_id", "text") else k for c, k in zip(docs.columns, own, strict=True)]
    cleaned = dedup_substrings(spark, docs.toDF(*inner), anywhere=True)
    if "n_chars" in docs.columns:
        at = inner[docs.columns.index("n_chars")]
        cleaned = cleaned.withColumn(at, F.when(F.col("words_removed") > 0, F.length("text")).otherwise(F.col(at)).cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*inner).toDF(*docs.columns)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, its cleaned text, its sentences, and how many sentences and words were removed."""
    return dedup_substrings(spark, table(spark, sf_dir, "documents"), anywhere=True).select("doc_id", "text", *_COUNTS)
