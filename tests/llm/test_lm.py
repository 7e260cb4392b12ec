import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from graphmill.llm import lm
from graphmill.llm.lm import BUCKETS, interpolated_scores, learn_weights

from .conftest import crc_mod, words

END = object()


def brute(rows):
    """The model's definition on Python counters; its weights by EM on every deleted token."""
    tokens = [(i, crc_mod(i, 10), [*words(t), END]) for i, t in rows]
    word, pair, kept_word, kept_pair = Counter(), Counter(), Counter(), Counter()
    for _, fold, t in tokens:
        if fold != 0:
            word.update(t)
            pair.update(zip([END, *t], t, strict=False))
            if fold != 1:
                kept_word.update(t)
                kept_pair.update(zip([END, *t], t, strict=False))
    n, v, kept_n, kept_v = sum(word.values()), len(word), sum(kept_word.values()), len(kept_word)
    bucket = lambda c: min(int(math.log2(c + 1)), BUCKETS - 1)
    events = []
    for _, fold, t in tokens:
        if fold == 1:
            for h, w in zip([END, *t], t, strict=False):
                c = kept_word[h]
                events.append((bucket(c), kept_pair[h, w] / max(c, 1), kept_word[w] / max(kept_n, 1)))
    cells = pd.DataFrame(events, columns=["cell", "p2", "p1"]).assign(n=1.0)
    cells["cell"] *= lm._CELLS**2
    weights = learn_weights(cells, kept_v)
    out = []
    for i, fold, t in tokens:
        score = base = 0.0
        for h, w in zip([END, *t], t, strict=False):
            k = weights[bucket(word[h])]
            p = k[0] * pair[h, w] / max(word[h], 1) + k[1] * word[w] / max(n, 1) + k[2] / (v + 1)
            score += math.log10(p) if n else 0.0
            base += math.log10((word[w] + 0.1) / (n + 0.1 * (v + 1)))
        out.append((i, fold == 0, len(t), sum(word[w] > 0 for w in t), n, base, score))
    return out


def check(spark, docs, near):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted(map(tuple, interpolated_scores(spark, docs).collect()), key=key)
    want = sorted(brute([(r.doc_id, r.text) for r in docs.collect()]), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want])
    assert [r[6] for r in got] == pytest.approx([r[6] for r in want], rel=near)
    return got


def test_tables(spark, sf_docs):
    got = check(spark, sf_docs, 5e-3)  # the histogram's ranges stand for their means
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # better than the add-a-tenth word model on unseen texts


def test_many_batches(spark, sf_docs, monkeypatch):
    check(spark, sf_docs.repartition(13), 5e-3)


def test_odd_rows(spark, odd_docs, no_docs):
    check(spark, odd_docs, 2e-2)
    assert interpolated_scores(spark, no_docs).count() == 0


def test_only_held_out_rows(spark):
    ids = [i for i in range(100) if crc_mod(i, 10) == 0][:3]
    check(spark, spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string"), 1e-9)


def test_weights_raise_the_likelihood_of_deleted_tokens():
    rng = np.random.default_rng(1)
    cells = pd.DataFrame({"cell": np.arange(200) % 3 * lm._CELLS**2, "p2": rng.random(200) * (rng.random(200) < 0.5), "p1": rng.random(200) / 10, "n": rng.integers(1, 9, 200).astype(float)})
    likelihood = lambda w: float((cells["n"] * np.log((w[cells["cell"] // lm._CELLS**2] * np.stack([cells["p2"], cells["p1"], np.full(200, 1 / 51)], 1)).sum(1))).sum())
    seen = [likelihood(learn_weights(cells[cells["cell"] > 0], 50, r)) for r in (1, 5, 100)]
    assert seen[0] < seen[1] < seen[2]
    assert np.allclose(learn_weights(cells, 50).sum(axis=1), 1)
