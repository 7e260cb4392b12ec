import hashlib
import random
from collections import Counter

import pytest

from graphmill.llm.simhash import document_fingerprints, within_radius


def bits(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1")


def check(spark, docs, near_is_next=True):
    got = document_fingerprints(spark, docs).collect()
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((i, len(t)) for i, t in rows)
    ids = [i for i, _ in rows]
    if len(set(ids)) < len(ids):
        return got
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    by = {r.doc_id: r for r in got}
    fingerprint, after = {}, {}
    for (i, t), (j, u) in zip(order, order[1:] + order[:1], strict=True):
        n = len(t) // 2
        edited = t[: len(t) - n] + u[:n]
        assert by[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for text, f in ((t, by[i].fingerprint), (edited, by[i].edited_fingerprint)):
            assert len(f) == 16 and fingerprint.setdefault(text, f) == f
        after[i] = j
    for i, _ in order:
        r = by[i]
        f = int(r.fingerprint, 16)
        assert r.near_edited == pytest.approx(1 - bits(f, int(r.edited_fingerprint, 16)) / 64)
        assert r.near_next == pytest.approx(1 - bits(f, int(by[after[i]].fingerprint, 16)) / 64)
        if i is not None and i % 100 == 0:
            assert r.n_within == sum(bits(f, int(x.fingerprint, 16)) <= 3 for x in got)
        else:
            assert r.n_within is None
    return got


def test_tables(spark, sf_docs):
    got = check(spark, sf_docs)
    assert sum(r.near_edited for r in got) / len(got) > sum(r.near_next for r in got) / len(got)


def test_odd_rows(spark, odd_docs, no_docs):
    check(spark, odd_docs)
    check(spark, odd_docs.dropDuplicates(["doc_id"]))
    assert document_fingerprints(spark, no_docs).count() == 0


def test_one_row_and_votes(spark):
    """The majority of the words' hashes, a word voting as often as it occurs, in texts of more than a run."""
    text = "b " * 40000 + "a " * 70000
    docs = spark.createDataFrame([(0, text), (1, "A"), (2, "a c a"), (3, " "), (4, None)], "doc_id long, text string")
    r = {x.doc_id: x for x in check(spark, docs)}
    assert r[0].fingerprint == r[1].fingerprint == r[2].fingerprint
    assert r[3].fingerprint == r[4].fingerprint == "0" * 16
    only = check(spark, docs.where("doc_id = 2"))[0]
    assert only.near_next == 1.0


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_all_fingerprints_within_the_radius(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(10)]
    found = set(base)
    for b in base:
        for _ in range(30):
            x = b
            for i in rng.sample(range(64), rng.randrange(9)):
                x ^= 1 << i
            found.add(x)
    signed = [(x - 2**64 if x >> 63 else x,) for x in found]
    rows = spark.createDataFrame(signed, "fingerprint long")
    queries = spark.createDataFrame(signed[::3], "fingerprint long")
    got = [tuple(r) for r in within_radius(queries, rows, radius).collect()]
    want = {(q, f) for (q,) in signed[::3] for (f,) in signed if bits(q, f) <= radius}
    assert len(got) == len(set(got)) and set(got) == want
