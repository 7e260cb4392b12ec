from collections import Counter, defaultdict

import numpy as np
import pytest

from graphmill.llm.mixing import mix, mixed_documents, mixed_words, permute, targets

from .conftest import words


def fill(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing what is over until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, at = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in at]
        rest = total - sum(at.values())
        over = [s for s in open_ if rest * weight[s] / sum(weight[x] for x in open_) > most * sizes[s]]
        if not over:
            return {**at, **{s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}}
        at |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    for key in range(3):
        assert sorted(permute(np.arange(n), n, key)) == list(range(n))


def check(spark, docs, near):
    rows = [(r.doc_id, r.source, len(words(r.text))) for r in docs.collect()]
    got = mixed_words(spark, docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixed_words(spark, docs).collect()))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], r[2]) for r in rows)
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    want = fill(sizes)
    sources = {(r.doc_id, r.source): r for r in docs.collect()}
    assert sources
    taken, target = defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source_size, r.target] += r.taken
        target[r.source_size, r.target] = r.target
    for s in sizes:
        assert any(k[0] == sizes[s] and k[1] == pytest.approx(want[s]) for k in target)
    for k, t in target.items():
        n = sum(1 for s in sizes if sizes[s] == k[0])
        assert abs(taken[k] - n * t) <= near * n or abs(taken[k] - t) <= near


def test_tables(spark, sf_docs):
    check(spark, sf_docs, 64)


def test_odd_rows(spark, odd_docs, no_docs):
    check(spark, odd_docs, 64)
    assert mixed_words(spark, no_docs).count() == 0 and mixed_documents(spark, no_docs).count() == 0


def test_targets_without_words(spark):
    sizes = spark.createDataFrame([("a", 0), (None, 0)], "source string, size long")
    assert {r.target for r in targets(sizes).collect()} == {0.0}


def test_mixed_texts_have_the_words_taken(spark, sf_docs):
    rows, pieces = mix(spark, sf_docs)
    want = {r.doc_id: r.taken for r in mixed_words(spark, sf_docs).collect()}
    whole = {r.doc_id: words(r.text) for r in sf_docs.collect()}
    got, blank = defaultdict(int), 0
    for r in mixed_documents(spark, sf_docs).collect():
        own = words(r.text)
        got[r.doc_id] += len(own)
        assert not Counter(own) - Counter(whole[r.doc_id]) and r.n_chars == len(r.text)
    assert all(got[i] == n for i, n in want.items())
    assert pieces.groupBy("shard").count().count() >= 1 and rows.count() == sf_docs.count()
