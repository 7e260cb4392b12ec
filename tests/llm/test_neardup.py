import numpy as np
import pytest

from graphmill.llm.neardup import cell_plan, count_links, embedding_components, min_count

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.9):
    """Links and components by all cosines; one row per id."""
    valid = {i: np.array(v, np.float64) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    ids = sorted(valid)
    links, parent = dict.fromkeys((r[0] for r in rows), 0), {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            x, y = valid[i], valid[j]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[i] += 1
                links[j] += 1
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {i: (links[i], find(i)) for i in links}


def test_tables(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute([(r.vec_id, list(r.embedding)) for r in rows.collect()])
    got = {r.vec_id: r for r in embedding_components(spark, rows).collect()}
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("block", [16, 1024])
def test_recall_of_cells_windows_and_blocks(spark, block):
    rng = np.random.default_rng(block)
    base = rng.standard_normal((900, 32))
    near = [b + rng.normal(0, s, 32) for b, s in zip(np.repeat(base[:60], 8, axis=0), np.tile(np.linspace(0.05, 0.5, 8), 60), strict=True)]
    x = np.vstack([base, near, np.repeat(base[:1], 40, axis=0)])
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)]
    want = brute(rows)
    got = {r.vec_id: r.n_links for r in embedding_components(spark, spark.createDataFrame(rows, SCHEMA), block=block).collect()}
    assert all(got[i] <= want[i][0] for i in got)
    assert sum(got.values()) >= 0.99 * sum(n for n, _ in want.values()) > 0
    assert cell_plan(len(x))[0] > 0


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], None), (3, [1.0, 0.0], 3), (3, [1.0, 0.0], 3), (4, [0.0, 1.0], 1), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
        (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1e30, 1e-30], 1), (None, None, None),
    ]
    got = embedding_components(spark, spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", weight int, raw string")).collect()
    assert len(got) == len(rows)
    want = brute([r for r in rows if r[0] is not None])
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert (r.n_links, r.component_id) == want[r.vec_id]
    assert embedding_components(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_calibration():
    assert cell_plan(100) == (0, 1)
    k, tables = cell_plan(100_000)
    same = (1 - np.arccos(0.9) / np.pi) ** k
    assert (1 - same) ** tables <= 0.002
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.standard_normal((400, 64))
    other -= (other * x).sum(1, keepdims=True) * x
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    y = 0.9001 * x + np.sqrt(1 - 0.9001**2) * other
    i, j = count_links(x, y)
    assert (i == j).sum() >= 396 and min_count(32) > 8
