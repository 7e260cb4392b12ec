import tracemalloc

import numpy as np
import pyarrow as pa

from graphmill.llm.common import Words, text_chunks
from graphmill.llm.toxicity import _WORD, Model, _counts, features, reject_toxic, swap_differences, toxicity, train

from .conftest import crc_mod


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 500 and right / len(rows) > 0.98
    clean = [r for r in rows if r.toxic == 0]  # 2 of 728 are taken for toxic with these 352 toxic rows to learn from
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1), (5, None), (9, 0), (1, 0), (77, 1)], "doc_id long, toxic int")
    out = toxicity(odd_docs, labels).collect()
    assert len(out) == odd_docs.count()
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (crc_mod(r.doc_id, 5) == 0)


TEXTS = [" ".join(f"word{i * j % 9973} of text" for j in range(150)) for i in range(1600)]  # about 3.5 MB


def test_scoring_takes_little_memory():
    texts = pa.array(TEXTS)
    found = features(Words(np.frombuffer(TEXTS[0].encode(), np.uint8), np.array([0, len(TEXTS[0])]), _WORD))[1]
    model = Model(found, np.ones(len(found)), 0.0)
    tracemalloc.start()
    for _, _, data, off in text_chunks(texts):
        model.logits(Words(data, off, _WORD))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20


def test_counts_of_a_batch_name_each_feature_once():
    toxic = [int(i % 3 == 0) for i in range(len(TEXTS))]
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS), pa.array(toxic, pa.int8())], ["text", "toxic"])
    (got,) = _counts(iter([batch]))
    want = {}
    for text, t in zip(TEXTS, toxic, strict=True):
        for f in features(Words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), _WORD))[1].view(np.int64).tolist():
            pos, n = want.get(f, (0, 0))
            want[f] = pos + t, n + 1
    assert {f: (p, n) for f, p, n in zip(*(c.to_pylist() for c in got.columns), strict=True)} == want and got.num_rows == len(want)
    assert [b.num_rows for b in _counts(iter([batch.slice(0, 0)]))] == [0]


def test_without_labels_or_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity(odd_docs, none).collect()} == {0}
    assert toxicity(no_docs, none).count() == 0
    assert reject_toxic(no_docs, none).count() == 0


def test_swapped_identity_terms_weigh_alike(spark):
    """A group that is named in toxic texts only: the penalty takes the name's own weight away."""
    rows = [(i, f"text number{i % 7} about gay people idiot") for i in range(0, 60, 2)] + [(i, f"text number{i % 7} about people") for i in range(1, 60, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i, _ in rows], "doc_id long, toxic int")
    plain, fair = (train(docs, labels, counterfactual=c) for c in (0.0, 100.0))
    change = [np.abs(swap_differences(m.feature) @ m.weight).max() for m in (plain, fair)]
    assert change[1] < 0.05 * change[0]


def test_neutral_mentions_in_singular_and_plural(spark):
    """Groups that only toxic texts name, singular or plural: neutral mentions in held-out texts stay."""
    names = ("muslims", "jews", "jew", "immigrants", "gays", "refugees", "disabled", "mexicans", "muslim")
    rows = [(i, f"text number{i % 7} these {names[i % 9]} here. idiot scum number{i % 5}") for i in range(0, 360, 2)] + [(i, f"text number{i % 7} these things here. quite fine number{i % 5}") for i in range(1, 360, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = train(docs, labels)
    told = spark.createDataFrame([(1000 + k, f"text number{k % 7} these {n} here. quite fine number{k % 5}") for k, n in enumerate(names)], docs.schema)
    assert reject_toxic(docs.unionByName(told), labels).where("doc_id >= 1000").count() == len(names)
    plain = train(docs, labels, counterfactual=0.0)
    assert np.abs(swap_differences(model.feature) @ model.weight).max() < 0.1 * np.abs(swap_differences(plain.feature) @ plain.weight).max()


def test_sampled_sentences_are_swapped(spark):
    from graphmill.llm.toxicity import _features_of, sentence_swaps

    docs = spark.createDataFrame([(1, "Women spoke. women and Women left! nobody else", 1), (2, "a man", 0), (3, "none here", 0)], "doc_id long, text string, toxic int")
    vocabulary = np.unique(np.concatenate([_features_of("women"), _features_of("men"), _features_of("man")]))
    changes, weight = sentence_swaps(docs, vocabulary, {0: 10.0, 1: 1.0})
    assert len(changes) == 2 and sorted(weight) == [2.0, 10.0]
    assert all((row != 0).any() for row in changes)
