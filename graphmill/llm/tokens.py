"""Token ids of whole texts with the tokenizers library, a unit of text at a time.

A byte-level BPE splits text before every single space or newline that stands between two characters that are no white space, and
between a letter and the punctuation that ends a word, so the ids of a text are those of its units (a word with the space or
newline before it, or the punctuation after it) in a row.  Units repeat: Arrow finds the distinct
ones of a run of texts, each task keeps the ids of those it has met, and numpy lines them up again.  A text that holds one of
the vocabulary's added tokens is encoded whole, so that the ids are always the library's own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units that a worker remembers at most; then it starts anew.
CACHE_UNITS = 800_000

#: Punctuation that is a unit of its own after a word's last letter.
MARKS = ".,;:!?"

_ASCII_SPACE, _MARK, _LETTER = (np.zeros(256, dtype=bool) for _ in range(3))
_ASCII_SPACE[[*range(9, 14), *range(28, 33)]] = True
_MARK[list(MARKS.encode())] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary: itself, or one of those from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to white space, that of Unicode included."""
    space = _ASCII_SPACE[data]
    for lead, width, middle, last in (
        (0xC2, 2, None, (0x85, 0xA0)),
        (0xE1, 3, 0x9A, (0x80,)),
        (0xE2, 3, 0x80, (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)),
        (0xE2, 3, 0x81, (0x9F,)),
        (0xE3, 3, 0x80, (0x80,)),
    ):
        at = np.flatnonzero(data == lead)
        if middle is not None:
            at = at[data[at + 1] == middle]
        at = at[np.isin(data[at + width - 1], last)]
        for i in range(width):
            space[at + i] = True
    return space


def unit_offsets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the units, number of the first unit of each text and after the last) of texts end to end in ``data``."""
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    if len(data) > 2:
        solid = ~_spaces(data)
        cut = (data[1:-1] == 32) | (data[1:-1] == 10)
        # a text's last character stays with its unit
        border[1:-2] |= cut & solid[:-2] & solid[2:] & ~border[2:-1]
    units = np.flatnonzero(border)
    if len(units) > 1:
        marks = np.flatnonzero(_MARK[data])  # few of the bytes, so a run of texts needs little more than itself
        first = np.append(True, np.diff(marks) > 1)
        run = marks[first][np.cumsum(first) - 1] if len(marks) else marks  # where the marks around each mark begin
        ends = units[1:] - 1
        with_mark = _MARK[data[ends]]
        mark = run[np.searchsorted(marks, ends[with_mark])]
        mark = mark[mark > units[:-1][with_mark]]
        border[mark[_LETTER[data[mark - 1]]]] = True
        units = np.flatnonzero(border)
    return units, np.searchsorted(units, offsets)


def places(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the lists ``which`` of those that begin at ``first``, one list after the other; where each begins there)."""
    n = first[which + 1] - first[which]
    upto = np.concatenate([[0], np.cumsum(n)])
    return np.arange(upto[-1]) + np.repeat(first[which] - upto[:-1], n), upto


class Encoder:
    """Ids by the library's whole encoder, or for words of letters by its model alone."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if self.vocabulary <= 1 << 16 else np.dtype("<u4")
        self.letters = _byte_letters()
        self.added = [t["content"] for t in json.loads(self.tokenizer.to_str())["added_tokens"]]
        self.known = pa.array([], pa.large_string())  # the units met, by number
        self.first = np.zeros(1, np.int64)  # of each known unit's ids, and after the last
        self.ids = np.zeros(0, self.dtype)
        self.met = np.zeros(0, np.int64)  # times each was met

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of letters after a space, which no rule splits before the model sees them."""
        if not words:
            return []
        tokenize = self.tokenizer.model.tokenize
        said = "\n".join(words).encode().decode("latin-1").translate(self.letters).split(self.letters[10])
        return [[t.id for t in tokenize(w)] for w in said]

    def _trim(self) -> None:
        """Keeps units met more than once, at most half of what the cache holds."""
        kept = np.flatnonzero(self.met > 1)
        kept = np.sort(kept[np.argsort(-self.met[kept], kind="stable")[: CACHE_UNITS // 2]])
        self.known = self.known.take(pa.array(kept))
        at, self.first = places(self.first, kept)
        self.ids, self.met = self.ids[at], np.zeros(len(kept), np.int64)

    def _learn(self, new: pa.Array) -> None:
        names = new.to_pylist()
        word = [u[0] == " " and u[1:].isalpha() for u in names]
        words, rest = iter(self._encode_words(list(compress(names, word)))), iter(self._encode(list(compress(names, map(not_, word)))))
        found = [next(words if w else rest) for w in word]
        self.known = pa.concat_arrays([self.known, new])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), self.dtype, int(sizes.sum()))])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the bytes of an array of ``dtype``."""
        if len(self.known) > CACHE_UNITS:
            self._trim()
        column = pa.array(texts, pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[: len(texts) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[: offsets[-1]]
        units, text_at = unit_offsets(data, offsets)
        strings = pa.LargeStringArray.from_buffers(len(units) - 1, pa.py_buffer(units.astype(np.int64)), column.buffers()[2])
        coded = strings.dictionary_encode()
        found = pc.index_in(coded.dictionary, value_set=self.known)
        numbers = found.fill_null(-1).to_numpy().astype(np.int64)
        if found.null_count:
            numbers[numbers < 0] = np.arange(found.null_count) + len(self.known)
            self._learn(coded.dictionary.filter(found.is_null()))
        unit = numbers[coded.indices.to_numpy()]
        self.met += np.bincount(unit, minlength=len(self.met))
        at, upto = places(self.first, unit)
        raw = memoryview(self.ids[at].tobytes())
        cut = (upto[text_at] * self.dtype.itemsize).tolist()
        out = [bytes(raw[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)]
        for i, t in enumerate(texts):
            if any(s in t for s in self.added):
                out[i] = np.array(self._encode([t])[0], self.dtype).tobytes()
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; kept from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def text_lists(column, most_chars: int = 1 << 22) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of short runs of rows; null is empty."""
    held, first, size = [], 0, 0
    for i, t in enumerate(column):
        t = t.as_py() or ""
        held.append(t)
        size += len(t)
        if size >= most_chars:
            yield first, held
            held, first, size = [], i + 1, 0
    if held:
        yield first, held
