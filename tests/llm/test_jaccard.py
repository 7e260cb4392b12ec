import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from graphmill.llm import jaccard
from graphmill.llm.jaccard import _routing_rows, jaccard_components, keep_one, trie_links

from .conftest import words


def brute(rows, k, percent):
    sets = defaultdict(list)
    for i, t in rows:
        w = words(t)
        sets[i].append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, all_ in sets.items() for s in all_ if s]
    for a, (i, x) in enumerate(flat):
        for j, y in flat[a + 1 :]:
            if 100 * len(x & y) >= percent * len(x | y) and find(i) != find(j):
                a_, b_ = sorted((find(i), find(j)))
                parent[b_] = a_
    return {i: find(i) for i in sets}, {i: sorted(len(s) for s in x) for i, x in sets.items()}


def check(spark, docs, k=4, percent=85, block=2000):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = jaccard_components(spark, docs, k, percent, block).collect()
    assert len(got) == len(rows)
    component, size = brute([r for r in rows if r[0] is not None], k, percent)
    found = defaultdict(list)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else component[r.doc_id])
        found[r.doc_id].append(r.n_shingles)
    assert all(sorted(found[i]) == n for i, n in size.items())


def test_odd_rows(spark, odd_docs):
    check(spark, odd_docs)


def test_no_rows(spark, no_docs):
    assert jaccard_components(spark, no_docs).count() == 0


def test_tables(spark, sf_docs):
    check(spark, sf_docs)


@pytest.mark.parametrize("block", [3, 2000])
def test_edited_copies(spark, block):
    """Chains of edits around the threshold, shared passages and a group larger than a block."""
    rng = random.Random(block)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(30)]
    rows = []
    for g in range(6):
        base = [word() for _ in range(rng.choice([6, 20, 60, 120]))] + passage * (g % 2)
        for _ in range(rng.choice([1, 4, 14])):
            rows.append((len(rows), " ".join(base)))
            base = list(base)
            for _ in range(rng.randrange(3)):
                base[rng.randrange(len(base))] = word()
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"), block=block)


def test_trie_equals_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(2, 40))
        base = rng.integers(0, 1 << 40, 30, dtype=np.uint64)
        sets = [np.unique(np.concatenate([base[rng.random(30) < 0.93], rng.integers(0, 1 << 40, int(rng.integers(0, 4)), dtype=np.uint64)])) for _ in range(n)]
        for build in (None, n // 2):
            links = trie_links(sets, build, 85)
            want = {(i, j) for j in range(n) for i in range(j) if (build is None or (i < build <= j)) and 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
            assert all((min(x), max(x)) in want for x in links)
            label = list(range(n))
            for edges in (links, want):
                label = list(range(n))
                for _ in range(n):
                    for i, j in edges:
                        label[i] = label[j] = min(label[i], label[j])
                if edges is links:
                    first = label
            assert first == label


def test_one_of_each_group_stays(spark, sf_docs):
    kept = keep_one(spark, sf_docs)
    component, _ = brute([(r.doc_id, r.text) for r in sf_docs.collect()], 5, 80)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(c for i, c in component.items() if i == c)
    assert kept.columns == sf_docs.columns


def chance_rows(copies):
    """Short texts with one line in common and ``copies`` with a word changed at the end, so sets share shingles but few link."""
    rng = random.Random(copies)
    line, rows = " ".join(f"l{i}" for i in range(8)), []
    for _ in range(150):
        own = [f"w{rng.randrange(400)}" for _ in range(14)]
        for c in range(1 + (rng.random() < 0.2) * copies):
            rows.append((len(rows), " ".join([line, *own[:-1], own[-1] if not c else f"x{c}"])))
    return rows


def largest_group(monkeypatch):
    """A list that gets the number of sets in the largest candidate group of each run."""
    sizes, links = [], jaccard._links

    def seen(spark, sets, *more):
        sizes.append(max([0, *(r["count"] for r in sets.groupBy("grp").count().collect())]))
        return links(spark, sets, *more)

    monkeypatch.setattr(jaccard, "_links", seen)
    return sizes


def test_chance_shingles_chain_no_groups(spark, monkeypatch):
    sizes = largest_group(monkeypatch)
    check(spark, spark.createDataFrame(chance_rows(2), "doc_id long, text string"))
    assert sizes == [3]


@pytest.mark.parametrize("percent", [50, 59, 60, 67, 80, 85, 95, 100])
def test_sets_that_link_share_the_tokens_asked_for(percent):
    """Of two sets at the threshold, each asks for at most as many tokens as both give."""
    rng = np.random.default_rng(percent)
    for size in [*range(1, 60), 100, 400]:
        for _ in range(4):
            c = max(1, -(-size * percent // 100))
            spare = 100 * c // percent - c  # shingles that only one of the two has
            left = int(rng.integers(0, spare + 1))
            h = rng.choice(1 << 60, c + spare, replace=False).astype(np.uint64)
            x, y = np.sort(h[: c + left]), np.sort(np.concatenate([h[:c], h[c + left :]]))
            doc, n = np.repeat([0, 1], [len(x), len(y)]), np.array([len(x), len(y)])
            most, common, low = _routing_rows(doc, np.concatenate([x, y]), n, percent)
            assert most.sum() == len(low)
            assert len(set(low[: most[0]].tolist()) & set(low[most[0] :].tolist())) >= max(common) >= 1


@pytest.mark.parametrize("build", [None, 20])
def test_trie_leaves_out_what_cannot_link(build):
    """Sets with too many shingles of their own, alone or after others went, and what is shared on one side only."""
    rng = np.random.default_rng(5)
    base, extra = (rng.integers(1, 1 << 60, n, dtype=np.uint64) for n in (100, 40))
    sets = [np.unique(np.concatenate([base[: 100 - d], extra[:s], rng.integers(1, 1 << 60, u, dtype=np.uint64)])) for d, s, u in rng.integers(0, 22, (40, 3))]
    links = trie_links(sets, build, 85)
    want = {(i, j) for j in range(40) for i in range(j) if (build is None or i < build <= j) and 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert want and all((min(x), max(x)) in want for x in links)
    groups = []
    for edges in (links, want):
        label = list(range(40))
        for _ in range(40):
            for i, j in edges:
                label[i] = label[j] = min(label[i], label[j])
        groups.append(label)
    assert groups[0] == groups[1]
    assert trie_links([np.zeros(0, np.uint64)] * 2, None, 85) == [(0, 1)]


def test_pipeline_stage_chains_no_groups(spark, monkeypatch):
    """The stage's own shingles and threshold, over texts with a line in common."""
    sizes, rows = largest_group(monkeypatch), chance_rows(3)
    kept = keep_one(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    component, _ = brute(rows, 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in component.items() if i == c)
    assert sizes == [4]
