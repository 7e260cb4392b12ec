"""Periodic runs against every stretch's smallest period by brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF

from graphmill.llm.periodic import WaveletTree, echoed, op11_periodic_runs, periodic_runs, runs_of, without_repeats
from llm.conftest import crc_mod


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words, least=24):
    """Maximal stretches of each period, the smallest period of each kept."""
    found = {}
    n = len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(rng):
    words = []
    for _ in range(rng.randint(1, 5)):
        words += [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.randint(0, 40))]
        unit = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randint(1, 60))]
        if rng.random() < 0.4:  # a period that itself holds a periodic stretch
            unit = unit[:3] * rng.randint(2, 12) + unit
        words += (unit * 8)[: int(len(unit) * rng.uniform(2.5, 7))]
    return words


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_planted_runs_equal_brute_force():
    rng = random.Random(7)
    texts = [planted(rng) for _ in range(400)]
    assert runs_of(texts) == [brute(t) for t in texts]
    assert runs_of(texts[:1]) == [brute(texts[0])]


def test_small_alphabets_equal_brute_force():
    rng = random.Random(11)
    texts = [[rng.randrange(2) for _ in range(rng.randint(0, 400))] for _ in range(100)]
    texts += [[0] * n for n in (0, 1, 23, 24, 25, 300)] + [fibonacci(700), [0, 1] * 200, ([0] * 8 + [1]) * 40, ([0] * 30 + [1] + [0] * 30 + [2]) * 5]
    assert runs_of(texts) == [brute(t) for t in texts]


def test_texts_of_a_batch_do_not_touch():
    assert runs_of([[1] * 20, [1] * 20, [1] * 24]) == [[], [], [(0, 24, 1)]]


def test_one_long_periodic_text():
    words = [i % 5000 for i in range(200_000)] + ["x"] * 50_000
    assert runs_of([words]) == [[(0, 200_000, 5000), (200_000, 50_000, 1)]]


def test_wavelet_tree_equals_sorting():
    rng = np.random.default_rng(3)
    values = rng.permutation(100)
    tree = WaveletTree(values)
    for _ in range(300):
        left, right = sorted(rng.integers(0, 101, 2).tolist())
        v = int(rng.integers(0, 101))
        part = np.sort(values[left:right])
        assert tree.below(np.array([left]), np.array([right]), np.array([v]))[0] == (part < v).sum()
        for nth, want in enumerate(part[:3].tolist()):
            assert tree.smallest(np.array([left]), np.array([right]), np.array([nth]))[0] == want


def test_words_after_the_first_period_go():
    assert without_repeats(list("xabababz"), [(1, 6, 2)]) == list("xabz")


def want_row(doc_id, text):
    words = split(text)
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_query_equals_brute_force(spark, sf_docs):
    got = sorted(tuple(r) for r in op11_periodic_runs(spark, SF).collect())
    assert got == sorted(want_row(r.doc_id, r.text) for r in sf_docs.collect())
    assert sum(crc_mod(r[0], 10) == 0 and r[1] > 0 for r in got) > 5


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    docs = odd_docs.where("doc_id is null or doc_id <> 9")
    rows = {(r.doc_id, r.collapsed) for r in periodic_runs(docs, change=echoed).collect()}
    want = set()
    for r in docs.collect():
        words = echoed(r.doc_id, split(r.text))
        want.add((r.doc_id, " ".join(without_repeats(words, brute(words)))))
    assert rows == want
    assert periodic_runs(odd_docs).count() == odd_docs.count()
    long = periodic_runs(odd_docs.where("doc_id = 9")).first()
    assert long.runs == [] and len(split(long.collapsed)) == 60000
    assert periodic_runs(no_docs).collect() == []
    for df, name in ((odd_docs, "a"), (no_docs, "b")):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        assert op11_periodic_runs(spark, f"{tmp_path}/{name}").count() == df.count()


def test_too_short_runs_are_refused():
    with pytest.raises(ValueError, match="24"):
        runs_of([[1, 1, 1]], least=3)
