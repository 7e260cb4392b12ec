"""Operator 1: embedding near-dedup by collision-counting projections.

Vectors are compared by cosine in double precision.  On unit vectors a pair's difference on a random Gaussian direction has a
standard deviation of its distance, so vectors that are near lie close together on most of ``PROJECTIONS`` such lines.  In
a cell, the values on every line are sorted, each vector's window (its value +- the distance at the threshold) is
a run of ranks, and a pair collides on a line when the one is in the other's window.  Pairs with at least ``min_count`` collisions
are verified.  ``min_count`` is the largest for which a pair at the threshold is missed with a
probability of ``MISS`` at most (binomial in the number of lines).

Cells keep the work below all pairs: in each of T tables a vector's cell is the signs of k projections.  k grows with the
logarithm of the vectors, and T is the least with which a pair at the threshold shares a cell with probability 1 - ``MISS`` or
more; nearer pairs are missed less.  A pair counts in the first table only where it shares a cell.  Cells above ``block`` vectors are
joined in pairs of blocks, each a task.  Tasks return link counts per vector and a spanning forest of their links, never the
pairs.  Equal vectors are one row with a weight until the end.

Defined results: vectors that are null, empty, zero or hold null or non-finite components have n_links 0 and are their own
component; only vectors of one length are compared; an id given again with the same vector is one vector, and each of its rows
comes back; ids with several vectors are one node with the sum of its links; a null id has a null component and
isn't linked; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.llm.common import components, parts, release, stored, whole_groups
from graphmill.session import table

THRESHOLD = 0.9
PROJECTIONS = 32
MISS = 0.002
CELL = 256
BLOCK = 1024
SEED = 1


def min_count(lines: int, miss: float = MISS) -> int:
    """Collisions that a pair at the threshold reaches with probability 1 - miss or more: windows are one standard deviation."""
    p = math.erf(1 / math.sqrt(2))
    below = 0.0
    for k in range(lines + 1):
        below += math.comb(lines, k) * p**k * (1 - p) ** (lines - k)
        if below > miss:
            return k
    return lines


def cell_plan(n: int, threshold: float = THRESHOLD, miss: float = MISS, cell: int = CELL) -> tuple[int, int]:
    """(signs per cell, tables) for ``n`` vectors."""
    k = max(0, int(math.log2(max(n, 1) / cell)))
    if not k:
        return 0, 1
    same = (1 - math.acos(threshold) / math.pi) ** k
    return k, math.ceil(math.log(miss) / math.log(1 - same))


@lru_cache(maxsize=4)
def _directions(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


def _units(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, a, b, dim, raw): a 128-bit hash and the doubles of each valid vector; raw is null for others."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for v in batch.column("embedding").to_pylist():
                ok = bool(v) and None not in v
                x = np.array(v, np.float64) if ok else np.zeros(0)
                with np.errstate(over="ignore"):
                    norm = float(np.linalg.norm(x / np.abs(x).max())) if ok and np.isfinite(x).all() and x.any() else 0.0
                if norm:
                    raw = (x / np.abs(x).max()).tobytes()  # within range for squares
                    out.append((*np.frombuffer(hashlib.blake2b(raw, digest_size=16).digest(), np.int64).tolist(), len(x), raw))
                else:
                    out.append((None, None, 0, None))
            a, b, dim, raw = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())], ["vec_id", "a", "b", "dim", "raw"])

    own = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return own.mapInArrow(hashed, "vec_id long, a long, b long, dim int, raw binary")


def count_links(x: np.ndarray, y: np.ndarray | None, threshold: float = THRESHOLD, lines: int = PROJECTIONS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) with cosine >= threshold, of rows of ``x`` (i < j) or of ``x`` and ``y``, among those whose collisions reach the count."""
    everything = x if y is None else np.vstack([x, y])
    first = 0 if y is None else len(x)
    value = everything @ _directions(everything.shape[1], lines, seed)
    half = math.sqrt(2 - 2 * threshold)
    counts = np.zeros((len(x), len(everything) - first), np.int8)
    for line in range(lines):
        v = value[:, line]
        order = np.argsort(v, kind="stable")
        rank = np.empty(len(v), np.int32)
        rank[order] = np.arange(len(v))
        low = np.searchsorted(v[order], v[: len(x)] - half, "left").astype(np.int32)
        high = np.searchsorted(v[order], v[: len(x)] + half, "right").astype(np.int32)
        # a rank is in the window when its distance from the window's start is below the window's length
        away = (rank[None, first:] - low[:, None]).view(np.uint32)
        counts += away < (high - low).astype(np.uint32)[:, None]
    i, j = np.nonzero(counts >= min_count(lines))
    if y is None:
        i, j = i[i < j], j[i < j]
    other = x if y is None else y
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        keep[part] = np.einsum("ij,ij->i", x[i[part]], other[j[part]]) >= threshold
    return i[keep], j[keep]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least vertex that each of 0..n-1 reaches by the edges a-b."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _cell_rows(classes: DataFrame, k: int, tables: int) -> DataFrame:
    """(dim, cells, keeper, weight, raw): the cells of each vector, one per table."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cells = [np.zeros(tables, np.int64)] * len(pdf)
            if k:
                for dim, at in pdf.groupby("dim").indices.items():
                    signs = _units(pdf["raw"].iloc[at].tolist()) @ _directions(int(dim), k * tables, SEED + 1) > 0
                    found = signs.reshape(len(at), tables, k) @ (1 << np.arange(k))
                    for i, c in zip(at, found, strict=True):
                        cells[i] = c
            yield pdf.assign(cells=cells)[["dim", "cells", "keeper", "weight", "raw"]]

    return classes.mapInPandas(rows, "dim int, cells array<long>, keeper long, weight long, raw binary")


def embedding_components(spark: SparkSession, rows: DataFrame, threshold: float = THRESHOLD, lines: int = PROJECTIONS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``rows`` (vec_id, embedding)."""
    vectors = stored(spark, _vectors(rows), "vectors")
    real = vectors.where("raw is not null and vec_id is not null")
    members = real.groupBy("a", "b", "dim", "vec_id").agg(F.first("raw").alias("raw"))
    classes = stored(spark, members.groupBy("a", "b", "dim").agg(F.min("vec_id").alias("keeper"), F.count("*").alias("weight"), F.first("raw").alias("raw")), "classes")
    k, tables = cell_plan(classes.count(), threshold)
    cells = stored(spark, _cell_rows(classes.select("dim", "keeper", "weight", "raw"), k, tables), "cells")
    placed = cells.select("dim", F.posexplode("cells").alias("t", "cell"), "cells", "keeper", "weight", "raw")
    large = placed.groupBy("dim", "t", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = placed.join(large, ["dim", "t", "cell"])
    placed = placed.withColumn("mine", F.pmod(F.xxhash64("raw"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = placed.select("dim", "t", "cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "cells", "keeper", "weight", "raw")

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, ["dim", "t", "cell", "i", "j"]):
            if len(pdf) < 2:
                continue
            x = _units(pdf["raw"].tolist())
            n = len(x) if pdf["i"].iloc[0] == pdf["j"].iloc[0] else int((pdf["mine"] == pdf["i"].iloc[0]).sum())
            a, b = count_links(x, None, threshold, lines) if n == len(x) else count_links(x[:n], x[n:], threshold, lines)
            b = b if n == len(x) else b + n
            before = np.stack(pdf["cells"].tolist())[:, : int(pdf["t"].iloc[0])]
            new = np.ones(len(a), bool)
            for at in range(0, len(a), 1 << 16):
                part = slice(at, at + (1 << 16))
                new[part] = ~(before[a[part]] == before[b[part]]).any(axis=1)
            a, b = a[new], b[new]
            if not len(a):
                continue
            weight, name = pdf["weight"].to_numpy(), pdf["keeper"].to_numpy()
            links = np.bincount(a, weights=weight[b], minlength=len(x)) + np.bincount(b, weights=weight[a], minlength=len(x))
            root = _forest(len(x), a, b)
            own = np.flatnonzero(links)
            yield pd.DataFrame({"keeper": name[own], "links": links[own].astype(np.int64), "root": name[root[own]]})

    found = tasks.repartition(parts(spark), "dim", "t", "cell", "i", "j").sortWithinPartitions("dim", "t", "cell", "i", "j", "mine", "keeper")
    found = stored(spark, found.mapInPandas(link, "keeper long, links long, root long"), "links")
    release(spark)
    links = found.groupBy("keeper").agg(F.sum("links").alias("links"))
    members = members.join(classes.select("a", "b", "dim", "keeper", "weight"), ["a", "b", "dim"]).select("vec_id", "keeper", "weight")
    edges = found.select(F.col("keeper").alias("a"), F.col("root").alias("b")).unionByName(members.select(F.col("keeper").alias("a"), F.col("vec_id").alias("b")))
    found = components(spark, edges)
    counted = members.join(links, "keeper", "left").groupBy(F.col("vec_id").alias("_id")).agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"))
    out = vectors.select("vec_id").join(counted, F.col("vec_id") == F.col("_id"), "left").join(found, F.col("vec_id") == F.col("node"), "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(spark, table(spark, sf_dir, "embeddings"))
