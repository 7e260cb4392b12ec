"""Operator 13: language identification by averaged hashed subword embeddings and a linear softmax.

A text's features are its byte n-grams of 2 to 4, lower-cased, within words with the mark of a word's border, hashed to
``BUCKETS``.  Each bucket has an embedding; a text is the mean of its features' embeddings, and a softmax over a linear
map of it gives the language.  Embeddings and map are trained together by stochastic gradient descent in numpy on a bounded sample,
``PER_LANGUAGE`` documents of each language about, each as a whole and as short spans of its words, so that short texts are
learned too.  A part of the sample stays out of the fit: on it a temperature makes the scores calibrated probabilities, and the
least score from which the share of errors stays within ``max_error`` is the rejection threshold.

For prediction the embeddings times the map are one table of whole numbers: a text's logits are sums of rows, whatever the
order, so that equal texts have equal scores.

Defined results: null texts and texts without a letter are ``und``, score 0, rejected; a text with letters always has a learned
language, also if rejected; no learned language at all gives ``und`` everywhere; null languages teach nothing; a null id belongs to
the fold of the empty id; repeated rows are answered one by one and teach once; no rows give an empty table; extra columns are
ignored.  The languages are the classes of the softmax: their number is taken to be small enough for the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.llm.common import crc_mod, mix64
from graphmill.llm.tokens import text_lists
from graphmill.session import table

FOLDS, TEST_FOLD = 4, 2
#: Bounds of the fit: documents of each language in the sample, about, and buckets of features.
PER_LANGUAGE = 400
BUCKETS = 1 << 16
DIMENSIONS = 16
SIZES = (2, 3, 4)
#: Words of the spans that each sampled document is learned by, besides the whole.
SPANS = (1, 2, 4, 12)
EPOCHS, RATE = 8, 0.5
#: One sampled document in so many calibrates and takes no part in the fit.
CALIBRATE = 5
MAX_ERROR = 0.01
UNKNOWN = "und"
#: Bytes that one numpy pass works on.
PASS_BYTES = 1 << 18
_ONE = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def subwords(data: np.ndarray, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, buckets) of the n-grams of lower-cased bytes, ``PASS_BYTES`` of places at a time, in order of size and place."""
    widest = max(SIZES)
    for at in range(0, len(data), PASS_BYTES):
        b = data[at : at + PASS_BYTES + widest - 1]
        letter = _LETTER[b]
        code = np.where(letter, b, 32).astype(np.uint64)
        n_places = min(PASS_BYTES, len(data) - at)
        for size in SIZES:
            n = min(n_places, len(b) - size + 1)
            if n <= 0:
                continue
            ok = letter[1 : n + 1] if size > 2 else letter[:n] | letter[1 : n + 1]
            for i in range(2, size - 1):
                ok = ok & letter[i : n + i]
            place = np.flatnonzero(ok)
            gram = np.full(len(place), size, np.uint64)
            for i in range(size):
                gram = gram << np.uint64(8) | code[place + i]
            yield place + at, (mix64(gram) & np.uint64(buckets - 1)).astype(np.int64)


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts lower-cased, a space before, between and after, and the place after each one's space."""
    raw = [t.lower().encode() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    return np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8), ends


@dataclass
class Model:
    """Per bucket and language a whole number, in units of 1 / 2**20 of a logit; calibration and threshold."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, texts: list[str]) -> np.ndarray:
        data, ends = _bytes(texts)
        sums, n = np.zeros((len(texts), len(self.languages)), np.int64), np.zeros(len(texts), np.int64)
        for place, bucket in subwords(data, len(self.table)):
            if not len(place):
                continue
            doc = np.searchsorted(ends, place, "right")
            first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            own = doc[first]
            inside = own < len(texts)  # the last space begins no n-gram of a text
            sums[own[inside]] += np.add.reduceat(self.table[bucket], first, axis=0, dtype=np.int64)[inside]
            n += np.bincount(doc, minlength=len(texts) + 1)[: len(texts)]
        return sums / _ONE / np.maximum(n, 1)[:, None] + self.bias

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return _softmax(self.logits(texts) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def spans_of(text: str, seed: int) -> list[str]:
    """The text and short runs of its words, from places that ``seed`` decides."""
    words = text.split()
    out = [text]
    for i, n in enumerate(SPANS):
        if len(words) > n:
            at = int(mix64(np.array([seed + i], np.int64).view(np.uint64))[0] % np.uint64(len(words) - n + 1))
            out.append(" ".join(words[at : at + n]))
    return out


def _examples(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per sampled text and span: its distinct buckets and their shares."""
    for batch in batches:
        for lang, seed, text in zip(batch.column("lang").to_pylist(), batch.column("seed").to_pylist(), batch.column("text"), strict=True):
            lists, shares = [], []
            for span in filter(has_letter, spans_of(text.as_py(), seed)):
                total = np.zeros(buckets, np.int64)
                for _, bucket in subwords(_bytes([span])[0], buckets):
                    total += np.bincount(bucket, minlength=buckets)
                own = np.flatnonzero(total)
                lists.append(own.astype(np.int32))
                shares.append((total[own] / total.sum()).astype(np.float32))
            n = len(lists)
            columns = [pa.array([lang] * n, pa.string()), pa.array([seed] * n, pa.int64()), pa.array(lists, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "seed", "own", "shares"])


def sample(spark: SparkSession, docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, seed, text): about ``per_language`` texts of each language, chosen by hash, equal ones once."""
    docs = docs.where("lang is not null and text is not null")
    sizes = [(r["lang"], float(min(1.0, per_language / r["count"]))) for r in docs.groupBy("lang").count().collect()]
    share = spark.createDataFrame(sizes, "lang string, share double")  # a row per language
    docs = docs.select("lang", "text", F.xxhash64("doc_id", "text").alias("seed")).join(F.broadcast(share), "lang")
    docs = docs.where((F.col("seed") / 2.0**64 + 0.5) <= F.col("share"))
    return docs.select("lang", "text", F.xxhash64("text").alias("seed")).dropDuplicates(["lang", "seed"])


def fit(languages: list[str], lang: np.ndarray, own: list[np.ndarray], shares: list[np.ndarray], buckets: int = BUCKETS) -> Model:
    """Embeddings and a linear map by stochastic gradient descent, one example at a time, every language with equal weight."""
    rng = np.random.default_rng(13)
    k = len(languages)
    embedding = rng.uniform(-1, 1, (buckets, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weight, bias = np.zeros((k, DIMENSIONS), np.float32), np.zeros(k)
    each = len(lang) / (k * np.maximum(np.bincount(lang, minlength=k), 1))
    steps, step = EPOCHS * len(lang), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(lang)).tolist():
            rate = RATE * (1 - step / steps) * min(float(each[lang[i]]), 10.0)
            step += 1
            mean = shares[i] @ embedding[own[i]]
            wrong = _softmax(weight @ mean + bias)
            wrong[lang[i]] -= 1
            back = (wrong @ weight).astype(np.float32)
            weight -= (rate * np.outer(wrong, mean)).astype(np.float32)
            bias -= rate * wrong
            # relative to the text's most frequent feature, as a mean of many features moves each one little
            embedding[own[i]] -= np.outer(shares[i] / shares[i].max(), rate * back)
    logits = np.rint((embedding.astype(np.float64) @ weight.T.astype(np.float64)) * _ONE).astype(np.int64)
    return Model(languages, logits, bias)


def calibrate(model: Model, lang: np.ndarray, logits: np.ndarray, max_error: float = MAX_ERROR) -> None:
    """Sets the temperature of least loss and the least score from which at most ``max_error`` of the answers are wrong."""
    if not len(lang):
        return
    found = [(-np.log(np.maximum(_softmax(logits / t)[np.arange(len(lang)), lang], 1e-12)).mean(), t) for t in np.geomspace(0.05, 20, 121).tolist()]
    model.temperature = min(found)[1]
    p = _softmax(logits / model.temperature)
    score, wrong = p.max(axis=1), p.argmax(axis=1) != lang
    order = np.argsort(-score, kind="stable")
    errors = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    fine = np.flatnonzero(errors <= max_error)
    model.threshold = float(score[order[fine[-1]]]) if len(fine) else 1.0


def train(spark: SparkSession, docs: DataFrame, per_language: int = PER_LANGUAGE, buckets: int = BUCKETS, max_error: float = MAX_ERROR) -> Model:
    """The model of ``docs`` (doc_id, text, lang)."""
    rows = sample(spark, docs, per_language).mapInArrow(lambda b: _examples(b, buckets), "lang string, seed long, own array<int>, shares array<float>").toArrow()
    size = np.array([len(x) for x in rows["own"]], np.int64)
    keys = [size, rows["seed"].to_numpy(), np.array(rows["lang"].to_pylist(), dtype=object).astype(str)]
    order = np.lexsort(keys)  # the fit doesn't depend on the order of arrival
    rows = rows.take(pa.array(order))
    names = rows["lang"].to_pylist()
    languages = sorted(set(names))
    if not languages:
        return Model([], np.zeros((1, 0), np.int64), np.zeros(0))
    number = {x: i for i, x in enumerate(languages)}
    lang = np.array([number[x] for x in names])
    own, shares = ([x.values.to_numpy() for x in rows[c]] for c in ("own", "shares"))
    out = rows["seed"].to_numpy() % CALIBRATE == 0
    fits, checks = np.flatnonzero(~out), np.flatnonzero(out)
    if set(lang[fits].tolist()) != set(range(len(languages))):
        fits = np.arange(len(lang))  # too few texts to spare any
    model = fit(languages, lang[fits], [own[i] for i in fits], [shares[i] for i in fits], buckets)
    logits = np.array([shares[i].astype(np.float64) @ model.table[own[i]] / _ONE + model.bias for i in checks]).reshape(-1, len(languages))
    calibrate(model, lang[checks], logits, max_error)
    return model


def predict(spark: SparkSession, docs: DataFrame, model: Model, *keep: Column) -> DataFrame:
    """``keep``, lang_pred, score and rejected per row of ``docs``; the text alone decides."""
    held = spark.sparkContext.broadcast(model)  # buckets x languages numbers
    kept = docs.select(*keep, F.col("text").cast("string").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            names, scores = [UNKNOWN] * len(batch), np.zeros(len(batch))
            for i, texts in text_lists(batch.column("text"), 1 << 20):
                own = [j for j, t in enumerate(texts) if has_letter(t)] if m.languages else []
                if own:
                    p = m.probabilities([texts[j] for j in own])
                    for j, k, s in zip(own, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                        names[i + j], scores[i + j] = m.languages[k], s
            rejected = (scores < m.threshold) | (np.array(names, dtype=object) == UNKNOWN) & (scores == 0)
            columns = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores), pa.array(rejected.astype(bool))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "lang_pred", "score", "rejected"])

    schema = kept.drop("text").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return kept.mapInArrow(rows, schema)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three of four folds."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    held_out = crc_mod(F.col("doc_id"), FOLDS) == TEST_FOLD
    model = train(spark, docs.where(~held_out))
    return predict(spark, docs, model, F.col("doc_id"), held_out.alias("held_out"))
