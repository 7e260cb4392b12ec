"""Operator 12: alignment of two tokenizers' ids over the same texts.

A is a byte-level BPE of the tokenizers library, which reads a space and the text; B is a sentencepiece model, which adds that
space itself.  Both are cut at the byte offsets where a token of each ends, and every pair of tokens whose bytes overlap is a link.

* Coarse cuts are A's character offsets and B's proto spans (the installed sentencepiece has ``return_type="proto"`` in place of the
  immutable one; its spans are in bytes).  Tokens that share a character, and byte-fallback tokens, whose spans are empty but for a
  character's last one, are refined with their decoded bytes.
* Both libraries split before a single space or newline between two other characters, and between a letter and the punctuation
  that ends a word (checked for the given vocabularies; else a text stays whole), so a text is a row of units.  Units repeat: a
  worker aligns each once and keeps its groups and links, of too many those that it has met more than once.
* A task joins documents to a chunk, writes their distinct links beside the chunk's table of (pair, documents that hold it), and
  only these tables are summed across the corpus.  Sums and the best pair of each A id return to the chunks by a join on the pair (a
  pair occurs once a chunk, so no key is hot), and each chunk meets its own sums in one group of bounded size.

Defined results: null and empty texts, and texts whose joined token bytes differ from the text, have no tokens: zeros and an empty
``groups``; repeated rows count as documents of their own; null ids stay; no rows give an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.llm.common import release, stored
from graphmill.llm.tokens import MARKS, _byte_letters, default_path, places, text_lists, unit_offsets
from graphmill.session import table

#: Units that a worker remembers at most; then it starts anew.
CACHE_UNITS = 400_000
#: Characters of text in a chunk, about; a longer text is a chunk of its own.
CHUNK_CHARS = 4 << 20
#: Pairs in a row of a chunk's table.
TABLE_ROW = 1 << 14

_SPAN = attrgetter("id", "begin", "end")
_WORD_END = re.compile(f"[A-Za-z][{MARKS}]")


def _numbers(parts: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(parts), np.int64)


def _ends(coarse: np.ndarray, sure: np.ndarray, sizes: np.ndarray, first: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: ``coarse`` where ``sure``; else the last sure end (or the unit's ``base``) and the decoded bytes since.

    ``first`` is the number of the first token of each token's unit."""
    i = np.arange(len(coarse))
    upto = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(sure, i, -1))
    inside = last >= first
    anchor = np.where(inside, coarse[last], base)
    spent = np.where(inside, upto[last], upto[first] - sizes[first])
    return np.where(sure, coarse, anchor + upto - spent)


class Aligned:
    """The alignment of some units, each contiguous in both tokenizers: ``ends_*`` over all their bytes, and per unit the counts,
    the groups' text, and its links as (A id << 32 | B id) from ``cut[u]`` to ``cut[u + 1]``."""

    def __init__(self, ids_a, ids_b, ends_a, ends_b, unit_ends, strings_a, strings_b):
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        starts_a, starts_b = (np.concatenate([[0], e[:-1]]) for e in (ends_a, ends_b))
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        first = np.searchsorted(ends_b, starts_a, "right")
        n = np.searchsorted(starts_b, ends_a) - first
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        self.links = (np.repeat(ids_a, n) << 32) | ids_b[place]
        upto = np.concatenate([[0], np.cumsum(n)])
        at_a, at_b, at_g = (np.concatenate([[0], np.searchsorted(x, unit_ends, "right")]) for x in (ends_a, ends_b, common))
        self.cut = upto[at_a]
        self.counts = np.stack([np.diff(at_a), np.diff(at_b), np.diff(at_g), np.diff(self.cut)])
        last_a = np.concatenate([group_a[1:] != group_a[:-1], [True]])
        last_b = np.concatenate([group_b[1:] != group_b[:-1], [True]])
        said = np.concatenate([strings_a[last_a.astype(np.int64), ids_a], strings_b[last_b.astype(np.int64), ids_b]])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        said = said[order].tolist()
        at = (at_a + at_b).tolist()
        self.groups = ["".join(said[i:j]) for i, j in pairwise(at)]


class Aligner:
    """Aligns texts unit by unit and remembers units; ``text`` is what both tokenizers read but for the leading space."""

    def __init__(self, path_a: str, path_b: str, cache_units: int = CACHE_UNITS):
        import sentencepiece
        from tokenizers import Tokenizer, processors

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # special tokens' strings in a text are ordinary text
        self.a.post_processor = processors.ByteLevel(trim_offsets=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = {c: b for b, c in _byte_letters().items()}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(map(letters.__getitem__, piece)) if all(c in letters for c in piece) else piece.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.byte_b = np.array([self.b.is_byte(i) for i in range(len(pieces))])
        self.bytes_b = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in zip(pieces, self.byte_b, strict=True)]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.strings_a, self.strings_b = (
            np.array([[f"{i}{mark}" for i in range(len(t))] for mark in (",", end)], dtype=object) for t, end in ((self.bytes_a, "|"), (self.bytes_b, ";"))
        )
        rules = json.loads(self.a.to_str())
        own = [p for p, byte in zip(pieces, self.byte_b, strict=True) if not byte]
        self.cuts = (
            rules["normalizer"] is None
            and rules["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
            and not any("\n" in p or "▁" in p.lstrip("▁") or _WORD_END.search(p) for p in own)
        )
        self.cache_units = cache_units
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.pair_ids: dict[int, int] = {}
        self.good, self.met = np.zeros(0, bool), np.zeros(0, np.int64)
        self.counts, self.first, self.links = np.zeros((4, 0), np.int64), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _trim(self) -> None:
        """Keeps units met more than once, at most half of what the cache holds; pairs keep their numbers."""
        kept = np.flatnonzero(self.met > 1)
        kept = kept[np.argsort(-self.met[kept], kind="stable")[: self.cache_units // 2]]
        names = {at: u for u, at in self.known.items()}
        kept = np.array([i for i in np.sort(kept).tolist() if i in names], np.int64)
        if not len(kept) or len(self.pair_ids) > 4 * self.cache_units:
            self._forget()
            return
        self.known = {names[i]: at for at, i in enumerate(kept.tolist())}
        self.groups = [self.groups[i] for i in kept.tolist()]
        at, upto = places(self.first, kept)
        self.good, self.met, self.counts, self.links, self.first = self.good[kept], np.zeros(len(kept), np.int64), self.counts[:, kept], self.links[at], upto

    # ------------------------------------------------------------------ units
    def encode(self, units: list[str]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        """(A's encodings, B's (id, begin, end) of all pieces, pieces and what to add to B's places per unit) of units that begin with their space, with
        their newline, or in the middle of a line.  B puts a space before each and never merges it, or a newline, with what follows."""
        a = self.a.encode_batch(units, add_special_tokens=False)
        own = [u[1:] if u[0] == " " else u if u[0] == "\n" else "\n" + u for u in units]
        protos = self.b.encode(own, return_type="proto", num_threads=1)
        n = np.fromiter((len(p.pieces) for p in protos), np.int64, len(units))
        spans = _numbers(chain.from_iterable(map(_SPAN, p.pieces) for p in protos)).reshape(-1, 3)
        drop = np.array([0 if u[0] == " " else 1 if u[0] == "\n" else 2 for u in units], np.int64)
        place = np.arange(len(spans)) - np.repeat(np.cumsum(n) - n, n)
        return a, spans[place >= np.repeat(drop, n)], n - drop, 1 - drop

    def align(self, units: list[str]) -> tuple[Aligned | None, list[bool]]:
        """The alignment of those units whose joined token bytes are their own, and which these are."""
        enc_a, spans_b, n_b, shift = self.encode(units)
        lists = [e.ids for e in enc_a]
        n_a = np.array(list(map(len, lists)), np.int64)
        ids_a, ids_b = _numbers(lists), spans_b[:, 0]
        want = [u.encode() for u in units]
        joined = b"".join(want)
        good = [True] * len(units)
        for pieces, ids, n in ((self.bytes_a, ids_a, n_a), (self.bytes_b, ids_b, n_b)):
            said = list(map(pieces.__getitem__, ids.tolist()))
            if b"".join(said) != joined or not n.all():
                cut = [0, *np.cumsum(n).tolist()]
                good = [g and b"".join(said[i:j]) == w for g, (i, j), w in zip(good, pairwise(cut), want, strict=True)]
        if not any(good):
            return None, good
        if not all(good):
            return self.align([u for u, g in zip(units, good, strict=True) if g])[0], good
        sizes = np.array(list(map(len, want)), np.int64)
        unit_ends = np.cumsum(sizes)
        data = np.frombuffer(joined, np.uint8)
        char_at = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))
        chars = np.array(list(map(len, units)), np.int64)
        ends = []
        for own, n, sizes_of in ((ids_a, n_a, self.sizes_a), (ids_b, n_b, self.sizes_b)):
            unit = np.repeat(np.arange(len(n)), n)
            first = np.repeat(np.cumsum(n) - n, n)
            base = (unit_ends - sizes)[unit]
            if own is ids_a:
                span = _numbers(chain.from_iterable(e.offsets for e in enc_a)).reshape(-1, 2)
                last = np.concatenate([unit[1:] != unit[:-1], [True]])
                sure = last | (np.append(span[1:, 0], 0) >= span[:, 1])  # no character shared with the next token
                coarse = char_at[span[:, 1] + (np.cumsum(chars) - chars)[unit]]
            else:
                sure = ~self.byte_b[own] | (spans_b[:, 2] > spans_b[:, 1])
                coarse = base + spans_b[:, 2] + shift[unit]
            ends.append((own, _ends(coarse, sure, sizes_of[own], first, base)))
        (own_a, ends_a), (own_b, ends_b) = ends
        return Aligned(own_a, own_b, ends_a, ends_b, unit_ends, self.strings_a, self.strings_b), good

    def _add(self, units: list[str]) -> int:
        """Aligns units and stores them; the number of the first."""
        at = len(self.groups)
        found, good = self.align(units)
        place = np.flatnonzero(good)
        counts, sizes = np.zeros((4, len(units)), np.int64), np.zeros(len(units), np.int64)
        said = [""] * len(units)
        if found:
            counts[:, place], sizes[place] = found.counts, np.diff(found.cut)
            for i, g in zip(place.tolist(), found.groups, strict=True):
                said[i] = g
            pairs, back = np.unique(found.links, return_inverse=True)
            numbers = np.array([self.pair_ids.setdefault(p, len(self.pair_ids)) for p in pairs.tolist()], np.int32)
            self.links = np.concatenate([self.links, numbers[back]])
        self.counts = np.concatenate([self.counts, counts], axis=1)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        self.good, self.met = np.concatenate([self.good, good]), np.concatenate([self.met, np.zeros(len(units), np.int64)])
        self.groups += said
        return at

    def split(self, texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
        """(units, number of the first unit of each text and after the last) of a space and each text; an empty text has none."""
        raw = [(" " + t).encode() if t else b"" for t in texts]
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        if self.cuts:
            units, _ = unit_offsets(data, offsets)
        else:
            units = np.unique(offsets)
        strings = pa.LargeStringArray.from_buffers(len(units) - 1, pa.py_buffer(units.astype(np.int64)), pa.py_buffer(joined))
        return strings, np.searchsorted(units, offsets)

    def units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(units' numbers, first of each text and after the last); a text whose tokens' bytes are not its own has none."""
        if len(self.groups) > (self.cache_units if self.cuts else 0):
            self._trim()
        strings, cut = self.split(texts)
        coded = strings.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = list(map(self.known.get, names))
        if None in numbers:
            new = [u for u, p in zip(names, numbers, strict=True) if p is None]
            at = self._add(new)
            self.known.update(zip(new, range(at, at + len(new)), strict=True))
            numbers = list(map(self.known.__getitem__, names))
        unit = np.array(numbers, np.int64)[coded.indices.to_numpy()]
        self.met += np.bincount(unit, minlength=len(self.met))
        bad = np.flatnonzero(~self.good[unit])
        if len(bad):
            # there the tokens of the whole text decide
            own = [unit[i:j] for i, j in pairwise(cut.tolist())]
            for i in np.unique(np.searchsorted(cut, bad, "right") - 1).tolist():
                at = self._add([" " + texts[i]])
                own[i] = np.array([at] if self.good[at] else [], np.int64)
            unit, cut = np.concatenate(own), np.concatenate([[0], np.cumsum([len(u) for u in own])])
        return unit, cut

    def pairs(self) -> np.ndarray:
        """All pairs met, by their numbers."""
        return np.fromiter(self.pair_ids, np.int64, len(self.pair_ids))


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner for two vocabulary files; kept from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Aligner(path_a, path_b)


def default_piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_STATS = ("n_a", "n_b", "n_groups", "n_links")
_ALIGNED = "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pair array<int>, times array<int>, base int, pairs array<long>, docs array<long>"


def aligned_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, digest: bool = False, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Rows of two kinds.  A document: its counts, ``groups`` (with ``digest`` their sha256) and distinct links as numbers in its
    ``chunk``'s table with the times they occur.  A piece of that table (``pairs`` is not null): from number ``base`` on, pairs as
    (A id << 32 | B id) and the chunk's documents that hold them."""
    path_a, path_b = path_a or default_path(), path_b or default_piece_path()

    def answer(al: Aligner, chunk: int, ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        groups: list[str] = []
        counts: list[np.ndarray] = []
        doc_keys: list[np.ndarray] = []
        pairs_seen: list[np.ndarray] = []
        for i, some in text_lists(texts, 1 << 21):
            unit, cut = al.units(some)
            pairs = al.pairs()
            sums = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(al.counts[:, unit], axis=1)], axis=1)
            counts.append(np.diff(sums[:, cut], axis=1))
            said = list(map(al.groups.__getitem__, unit.tolist()))
            own = ["".join(said[j:k])[:-1] for j, k in pairwise(cut.tolist())]
            groups += [s and hashlib.sha256(s.encode()).hexdigest() for s in own] if digest else own
            at, upto = places(al.first, unit)
            doc = np.repeat(np.arange(len(some)), np.diff(upto[cut]))
            key, times = np.unique(doc * max(1, len(pairs)) + al.links[at], return_counts=True)
            doc, pair = np.divmod(key, max(1, len(pairs)))
            doc_keys.append(np.stack([doc + i, times]))
            pairs_seen.append(pairs[pair])
        per_doc = np.concatenate(doc_keys, axis=1)
        pairs, number = np.unique(np.concatenate(pairs_seen), return_inverse=True)
        cut = np.searchsorted(per_doc[0], np.arange(len(ids) + 1)).astype(np.int32)
        holders = np.bincount(number, minlength=len(pairs))
        lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x.astype(np.int32))) for x in (number, per_doc[1])]
        same = pa.array(np.full(len(ids), chunk, np.int64))
        none = [pa.nulls(len(ids), t) for t in (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))]
        names = [f.split(" ")[0] for f in _ALIGNED.split(", ")]
        stats = [pa.array(x) for x in np.concatenate(counts, axis=1)]
        whole = pa.RecordBatch.from_arrays([same, pa.array(ids, pa.int64()), *stats, pa.array(groups, pa.string()), *lists, *none], names)
        for i in range(0, len(whole), 256):
            yield whole.slice(i, 256)
        for base in range(0, len(pairs), TABLE_ROW):
            some, held = pairs[base : base + TABLE_ROW], holders[base : base + TABLE_ROW]
            row = {"chunk": chunk, "base": base, "pairs": some, "docs": held}
            yield pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], f.type) for f in whole.schema], names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        chunk = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                n = len(t.as_py() or "")
                if size and size + n > chunk_chars:
                    yield from answer(al, chunk, ids, texts)
                    chunk, ids, texts, size = chunk + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += n
        if ids:
            yield from answer(al, chunk, ids, texts)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(rows, _ALIGNED)


def pair_counts(tables: DataFrame) -> DataFrame:
    """(a, b, count, best): how many documents hold a pair linked, and whether no pair of that A id has more."""
    counts = tables.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(best, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokens(spark: SparkSession, docs: DataFrame, path_a: str | None = None, path_b: str | None = None, digest: bool = False) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups`` (or their sha256)."""
    found = stored(spark, aligned_documents(docs, path_a, path_b, digest), "aligned")
    release(spark)
    tables = found.where("pairs is not null").select("chunk", "base", F.posexplode(F.arrays_zip("pairs", "docs")).alias("i", "x"))
    pair = F.col("x.pairs")
    tables = tables.select(
        "chunk", (F.col("base") + F.col("i")).alias("pair"), F.shiftright(pair, 32).cast("int").alias("a"),
        pair.bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), F.col("x.docs").alias("docs"),
    )
    sums = tables.drop("docs").join(pair_counts(tables.select("a", "b", "docs")), ["a", "b"]).select(F.col("chunk").alias("of"), "pair", "count", "best")
    own = found.where("pairs is null").select("chunk", "doc_id", *_STATS, "groups", F.col("pair").alias("own"), "times")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        n = right.num_rows
        number = right["pair"].to_numpy()
        count, best = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        count[number], best[number] = right["count"].to_numpy(), right["best"].to_numpy().astype(np.int64)
        lists, times = left["own"].combine_chunks(), left["times"].combine_chunks()
        if isinstance(lists, pa.ChunkedArray):  # no documents' rows
            lists, times = (pa.array([], pa.list_(pa.int32())) for _ in range(2))
        cut = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
        at, times = lists.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        totals = [np.diff(np.concatenate([[0], np.cumsum(x[at] * times)])[cut]) for x in (best, count)]
        columns = [left[c] for c in ("doc_id", *_STATS)]
        return pa.table([*columns, *map(pa.array, totals), left["groups"]], ["doc_id", *_STATS, "n_best", "count_sum", "groups"])

    return own.groupBy("chunk").cogroup(sums.groupBy("of")).applyInArrow(
        answer, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    )


def op12_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its tokens, groups and links by both tokenizers, how many of its links are their A id's most common, and the sum of their counts."""
    return align_tokens(spark, table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")
