"""Operator 5: toxicity, a counterfactual-regularised linear classifier.

Features are words (ASCII letters and digits and all non-ASCII bytes, lower-cased) and word prefixes, present or
not.  Their document counts per label over a bounded sample of labelled rows choose a bounded vocabulary, and a
logistic regression over it is fitted on that sample.  In each labelled sentence that names an identity group
the term is swapped for every other term of its set; the square of the change of the score's logit, weighted as the
sentence's row is, is added to the loss, so a group's name itself carries no weight of its own.  So that this holds for names
that are rare in the sample, every pair of terms also counts once by itself.  Names that ``IDENTITY_SETS`` lacks aren't covered.

Defined results: null and empty texts score as a text without features; a null id belongs to the fold of the
empty id; rows that repeat are scored one by one; a sample without both labels gives every text the share of
toxic rows (0 without labelled rows); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.llm.common import Words, crc_mod, text_chunks

#: Bounds of the fit: labelled rows per class, and features.
SAMPLE_PER_CLASS = 8000
MAX_FEATURES = 4096
PREFIXES = (4, 5, 6)
FOLDS = 5

#: Sets of terms that name groups; within a set every term may stand for every other.
IDENTITY_SETS = (
    ("muslim", "jewish", "christian", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslim", "jew", "christian", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "jews", "christians", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "arab", "latina", "hispanic", "african"),
    ("blacks", "whites", "asians", "latinos", "arabs", "latinas", "hispanics", "africans"),
    ("gay", "lesbian", "straight", "transgender", "homosexual", "heterosexual", "bisexual", "queer", "trans"),
    ("gays", "lesbians", "straights", "homosexuals", "heterosexuals", "bisexuals", "queers"),
    ("women", "men"),
    ("woman", "man"),
    ("girl", "boy"),
    ("girls", "boys"),
    ("female", "male"),
    ("females", "males"),
    ("immigrant", "foreigner", "refugee", "native", "migrant"),
    ("immigrants", "foreigners", "refugees", "natives", "migrants"),
    ("disabled", "deaf", "blind", "autistic", "paralyzed"),
    ("elderly", "old", "young", "teenage"),
    ("american", "mexican", "chinese", "indian", "russian", "german", "french", "turkish", "polish", "japanese"),
    ("americans", "mexicans", "chinese", "indians", "russians", "germans", "french", "turks", "poles", "japanese"),
    ("musulmán", "judío", "cristiano"),
    ("musulmanes", "judíos", "cristianos"),
    ("musulman", "juif", "chrétien"),
    ("musulmans", "juifs", "chrétiens"),
    ("muslimisch", "jüdisch", "christlich"),
    ("muslime", "juden", "christen"),
)

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, feature) pairs of some texts."""
    found = [(words.doc, words.hash), *(words.prefixes(k) for k in PREFIXES)]
    doc, feature = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((feature, doc))
    doc, feature = doc[order], feature[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])
    return doc[new], feature[new]


def _features_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return features(Words(raw, np.array([0, len(raw)]), _WORD))[1]


@dataclass
class Model:
    """Sorted feature hashes, their weights, and the bias."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float

    def logits(self, words: Words) -> np.ndarray:
        out = np.full(words.n_docs, self.bias)
        doc, feature = features(words)
        if len(self.feature) and len(doc):
            at = np.minimum(np.searchsorted(self.feature, feature), len(self.feature) - 1)
            hit = self.feature[at] == feature
            out += np.bincount(doc[hit], weights=self.weight[at[hit]], minlength=words.n_docs)
        return out


def _sample(docs: DataFrame, labels: DataFrame, fold_of_test: int, folds: int, per_class: int) -> DataFrame:
    """(doc_id, text, toxic): up to ``per_class`` labelled rows of each class outside the test fold, chosen by hash."""
    own = labels.where("toxic in (0, 1) and doc_id is not null").where(crc_mod(F.col("doc_id"), folds) != fold_of_test)
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = [own.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    ids = picked[0].unionByName(picked[1])  # at most 2 * per_class pairs of numbers: small enough to broadcast
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").distinct()  # an id's equal texts count once


def _summed(feature: np.ndarray, pos: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features and the sums of their counts."""
    keys, at = np.unique(feature, return_inverse=True)
    return keys, *(np.bincount(at, weights=x, minlength=len(keys)).astype(np.int64) for x in (pos, n))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i, j, data, off in text_chunks(batch.column("text")):
            doc, feature = features(Words(data, off, _WORD))
            found.append(_summed(feature, toxic[i:j][doc], np.ones(len(feature), np.int64)))
            if sum(len(keys) for keys, _, _ in found[1:]) > 2 * len(found[0][0]) + MAX_FEATURES:
                found = [_summed(*map(np.concatenate, zip(*found, strict=True)))]
        keys, pos, n = _summed(*map(np.concatenate, zip(*found, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(pos), pa.array(n)], ["feature", "pos", "n"])


def _vocabulary(sample: DataFrame, n_pos: int, n_all: int, max_features: int) -> np.ndarray:
    """The features whose share of toxic rows is furthest, in standard errors, from that of the sample."""
    counts = sample.mapInArrow(_counts, "feature long, pos long, n long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    share = n_pos / n_all
    # half a row is taken off the distance, so that a rare feature needs more than one lucky row
    far = F.abs(F.col("pos") - F.col("n") * share) - 0.5
    z = far / F.sqrt(F.col("n") * share * (1 - share) + 1)
    top = counts.where("n >= 3").withColumn("z", z).where("z > 2").orderBy(F.desc("z"), "feature").limit(max_features)
    return np.sort(np.array([r.feature for r in top.collect()], dtype=np.int64).view(np.uint64))


def _rows_of(sample: DataFrame, vocabulary: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Per sampled row its features' places in the vocabulary, and its label."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column("text")):
                doc, feature = features(Words(data, off, _WORD))
                at = np.minimum(np.searchsorted(vocabulary, feature), len(vocabulary) - 1)
                hit = vocabulary[at] == feature
                doc, at = doc[hit], at[hit].astype(np.int32)
                cut = np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(at))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], batch.column("toxic")[i:j].cast(pa.int32()), lists], ["doc_id", "toxic", "places"])

    rows = sample.mapInArrow(places, "doc_id long, toxic int, places array<int>").toArrow()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")  # the fit doesn't depend on the order of arrival
    found = rows["places"].combine_chunks()
    cut, values = found.offsets.to_numpy(), found.values.to_numpy()
    return [values[cut[i] : cut[i + 1]] for i in order], rows["toxic"].to_numpy()[order]


def swap_differences(vocabulary: np.ndarray) -> np.ndarray:
    """(pairs, features): how the features of a sentence change when one identity term stands for another."""
    out = []
    for terms in IDENTITY_SETS:
        rows = []
        for term in terms:
            row, own = np.zeros(len(vocabulary)), _features_of(term)
            at = np.searchsorted(vocabulary, own)
            ok = at < len(vocabulary)
            row[at[ok][vocabulary[at[ok]] == own[ok]]] = 1
            rows.append(row)
        out += [a - b for k, a in enumerate(rows) for b in rows[k + 1 :] if (a != b).any()]
    return np.array(out).reshape(-1, len(vocabulary))


def sentence_swaps(sample: DataFrame, vocabulary: np.ndarray, class_weight: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    """(changes, features) and their weights: how each sampled sentence that names a group changes with another name of its set.

    Equal changes count together, so their number is bounded by the terms and the few features that other words share with them."""

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others: dict[bytes, list[bytes]] = {}
        for terms in IDENTITY_SETS:
            for t in terms:
                others.setdefault(t.encode(), []).extend(x.encode() for x in terms if x != t and x.encode() not in others.get(t.encode(), []))
        names = {int(Words(np.frombuffer(t, np.uint8), np.array([0, len(t)]), _WORD).hash[0]): t for t in others}
        keys = np.array(list(names), np.uint64)
        ends = np.zeros(256, dtype=bool)
        ends[list(b".!?\n")] = True

        def places(words: list[bytes]) -> set[int]:
            raw = np.frombuffer(b" ".join(words), np.uint8)
            own = features(Words(raw, np.array([0, len(raw)]), _WORD))[1]
            at = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
            return set(at[vocabulary[at] == own].tolist())

        for batch in batches:
            toxic = batch.column("toxic").to_pylist()
            for i, _, data, off in text_chunks(batch.column("text")):
                w = Words(data, off, _WORD)
                hits = np.flatnonzero(np.isin(w.hash, keys))
                if not len(hits):
                    continue
                sentence = np.cumsum(ends[w.bytes])[w.start]
                first = np.flatnonzero(np.append(True, (sentence[1:] != sentence[:-1]) | (w.doc[1:] != w.doc[:-1])))
                cut = np.append(first, len(w.hash))
                out: dict[tuple, float] = {}
                for s, h in sorted({(int(np.searchsorted(first, k, "right")) - 1, int(w.hash[k])) for k in hits}):
                    term, span = names[h], range(cut[s], cut[s + 1])
                    said = [w.bytes[w.start[k] : w.end[k]].tobytes() for k in span]
                    own = places(said)
                    for other in others[term]:
                        new = places([other if x == term else x for x in said])
                        key = (tuple(sorted(new - own)), tuple(sorted(own - new)), toxic[i + int(w.doc[cut[s]])])
                        if key[0] or key[1]:
                            out[key] = out.get(key, 0) + 1 / len(others[term])
                up, down, label = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(up, pa.list_(pa.int32())), pa.array(down, pa.list_(pa.int32())), pa.array(label, pa.int32()), pa.array(list(out.values()), pa.float64())], ["up", "down", "toxic", "n"])

    found = sample.mapInArrow(changes, "up array<int>, down array<int>, toxic int, n double").groupBy("up", "down", "toxic").agg(F.sum("n").alias("n"))
    found = sorted((list(r.up), list(r.down), r.toxic, r.n) for r in found.collect())
    out, weight = np.zeros((len(found), len(vocabulary))), np.zeros(len(found))
    for k, (up, down, toxic, n) in enumerate(found):
        out[k, up], out[k, down], weight[k] = 1, -1, n * class_weight[toxic]
    return out, weight


def _fit(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, swaps: np.ndarray, n_features: int, l2: float, cf: float, steps: int) -> tuple[np.ndarray, float]:
    """Weighted logistic loss + l2 * |w|^2 / 2 + cf * sum (swap . w)^2 / 2, by accelerated gradient steps."""
    at = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weight = weight / weight.sum()
    w, b = np.zeros(n_features), float(np.log(np.average(y, weights=weight) / (1 - np.average(y, weights=weight))))
    v, vb, t = w.copy(), b, 1.0
    # the step: one over a bound of the curvature per feature (its weighted share times the row's length)
    length = np.bincount(row, minlength=len(rows)) + 1.0
    curve = np.bincount(at, weights=(weight * length)[row], minlength=n_features) / 4 + l2 + cf * (np.abs(swaps).T @ np.abs(swaps).sum(axis=1))
    curve_b = float((weight * length).sum()) / 4
    for _ in range(steps):
        z = vb + np.bincount(row, weights=v[at], minlength=len(rows))
        g = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        grad = np.bincount(at, weights=g[row], minlength=n_features) + l2 * v + cf * (swaps.T @ (swaps @ v))
        new, new_b, s = v - grad / curve, vb - g.sum() / curve_b, (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / s * (new - w), new_b + (t - 1) / s * (new_b - b)
        w, b, t = new, new_b, s
    return w, b


def train(docs: DataFrame, labels: DataFrame, test_fold: int = 0, folds: int = FOLDS, per_class: int = SAMPLE_PER_CLASS,
          max_features: int = MAX_FEATURES, l2: float = 1e-4, counterfactual: float = 1.0, steps: int = 600) -> Model:
    """Fits on at most ``per_class`` labelled rows of each label whose fold isn't ``test_fold``."""
    sample = _sample(docs, labels, test_fold, folds, per_class)
    own = labels.where("toxic in (0, 1)").where(crc_mod(F.col("doc_id"), folds) != test_fold)
    all_n = {r.toxic: r["count"] for r in own.groupBy("toxic").count().collect()}
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    none = np.zeros(0, np.uint64)
    if len(n) < 2:
        share = 1.0 if 1 in n else 0.0
        return Model(none, np.zeros(0), 40.0 if share else -40.0)
    vocabulary = _vocabulary(sample, n[1], n[0] + n[1], max_features)
    if not len(vocabulary):
        return Model(none, np.zeros(0), float(np.log(all_n[1] / all_n[0])))
    rows, y = _rows_of(sample, vocabulary)
    weight = np.where(y == 1, all_n[1] / n[1], all_n[0] / n[0])  # the sample's classes weigh as all labelled rows do
    changes, often = sentence_swaps(sample, vocabulary, {c: all_n[c] / n[c] for c in (0, 1)})
    swaps = np.concatenate([swap_differences(vocabulary), changes * np.sqrt(often / weight.sum())[:, None]])
    w, b = _fit(rows, y.astype(float), weight, swaps, len(vocabulary), l2, counterfactual, steps)
    return Model(vocabulary, w, b)


def score(docs: DataFrame, model: Model, folds: int = FOLDS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [model.logits(Words(data, off, _WORD)) for _, _, data, off in text_chunks(batch.column("text"))]
            z = np.concatenate(out) if out else np.zeros(0)
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", (crc_mod(F.col("doc_id"), folds) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score(docs, train(docs, labels, **options))


def reject_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5, with all their columns."""
    model = train(docs, labels, **options)

    text_at = docs.columns.index("text")

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column(text_at)):
                ok = model.logits(Words(data, off, _WORD)) < 0
                yield batch.slice(i, j - i).filter(pa.array(ok))

    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names with dots are none for mapInArrow
    return numbered.mapInArrow(passed, numbered.schema).toDF(*docs.columns)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphmill.session import table

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
