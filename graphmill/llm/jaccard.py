"""Operator 7: n-gram Jaccard join by a prefix-tree.

A document's set is its distinct 4-word shingles.  Two documents link when 100 * |x & y| >= 85 * |x | y|.

1. Equal sets are one class, known by a 64-bit hash of the set; the steps below see one row per class.
2. Every set gives its lowest shingle hashes, 15 % + 10 % of its size.  Two sets that link share at least
   ``common(n)`` of these (a prefix filter that asks for several matches), so a set with fewer shingles that
   other sets share goes.
3. One shingle is often shared by chance, the more so the more texts there are, and chance links would chain most of the sets
   that are left into one group.  So these give pairs of neighbours: a set's hashes in a circle by value, each with
   the next.  Every shingle that only one of two sets has parts at most two pairs, so sets that link share most of their pairs,
   and others next to none.  The prefix filter is asked again of the pairs, 30 % of the size and 10 %, at least ``SHARE``,
   that linking sets have in common, so a line that many short texts have is not enough.  Of a set's shared pairs, all but
   the ``common - 1`` that most sets share route it; two sets that link have one of those in common.
   Sets that meet in a routing pair, directly or through others, form a candidate group.
4. A group's full sets meet in one task and go into a trie in the group's global order (most shared shingles
   first, so near copies share long paths).  Shingles that no set to compare with has stay out of it, and so, again and again,
   do sets that have too few others left.  Each set traverses the trie with the overlap so far, prunes subtrees by
   bounds on the remaining lengths, and skips subtrees that one component already holds.  A task returns the edges of
   a spanning forest, at most one per set.
5. A group above ``block`` sets is first held against one of its sets, one row each.  Sets that link to it form
   one component and need no comparison among each other; only pairs with a set outside it are joined, in blocks.

Every step is exact: no candidate is dropped.  Defined results: null and empty texts have no set, n_shingles 0, and are their
own component; a null id keeps a null component and links with nothing; repeated ids are one node; rows
that repeat come back as often as they are given; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.llm.common import Words, components, mix64, parts, release, stored, text_chunks, whole_groups
from graphmill.session import table

K = 4
#: The similarity as a fraction of 100, and sets in one task's trie.
PERCENT = 85
BLOCK = 2000
#: From this similarity on, sets that link share pairs of neighbours; below it, single shingles route.
PAIRS_FROM = 60
#: So many shared pairs of neighbours are asked for, where the sets are large enough.
SHARE = 16
#: Tasks over which a group's rows spread where they meet one row of their group.
SALTS = 32


def _set_rows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, shingle), sorted, and the number per doc."""
    doc, h = words.shingles(k)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    doc, h = doc[new], h[new]
    return doc, h, np.bincount(doc, minlength=words.n_docs)


def _set_ids(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A hash of each set, from the sum of its mixed shingles and its size."""
    out = np.zeros(len(n), np.uint64)
    full = n > 0
    if full.any():
        out[full] = mix64(np.add.reduceat(mix64(h + np.uint64(1)), (np.cumsum(n) - n)[full]) + n[full].astype(np.uint64))
    return out.view(np.int64)


def _low_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(n, n - -(-n * percent // 100) + np.maximum(1, n // 10))


def _common(n: Column, percent: int) -> Column:
    """How many of their lowest shingles a set of ``n`` and any set it links with share at least."""
    return F.greatest(F.lit(1), F.floor(F.floor((n * percent + 99) / 100) / 10)).cast("int")


def _neighbours(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A hash of every element of the sets (as ``_set_rows`` has them) and the next, the last's next being the first."""
    after = np.empty_like(h)
    after[:-1] = h[1:]
    full = n[n > 0]
    last = np.cumsum(full) - 1
    after[last] = h[last - full + 1]
    return mix64(h + mix64(after + np.uint64(1)))


def _routing_rows(doc: np.ndarray, h: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number per doc, how many of them any two sets that link share at least, tokens): the sets' lowest pairs of neighbours.

    A set of n shares c >= ceil(n * percent / 100) shingles with a set it links with, which has at most
    floor(100 c / percent) - n others, so at least 2 c - floor(100 c / percent) of its n pairs are in both.
    Below ``PAIRS_FROM`` that can be none, and the tokens are the lowest shingles."""
    c = -(-n * percent // 100)
    if percent >= PAIRS_FROM:
        h = _neighbours(h, n)
        h = h[np.lexsort((h, doc))]
        both = lambda n, c: (2 * c - 100 * c // percent, np.maximum(n // 10, SHARE))
    else:
        both = lambda n, c: (c, np.maximum(n // 10, 1))
    kept, asked = both(n, c)
    most = n - kept + np.minimum(kept, asked)
    common = np.minimum(*both(c, -(-c * percent // 100)))  # of the smallest set it links with
    first = np.cumsum(n) - n
    return most, common, h[(np.arange(len(h)) - first[doc]) < most[doc]]


def shingle_sets(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n, set_id, low) of every row: set size, set hash, lowest shingle hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column("text")):
                doc, h, n = _set_rows(Words(data, off), k)
                first = np.cumsum(n) - n
                low = (np.arange(len(h)) - first[doc]) < _low_length(n, percent)[doc]
                cut = np.concatenate([[0], np.cumsum(np.bincount(doc[low], minlength=len(n)))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(h[low].view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], pa.array(n.astype(np.int32)), pa.array(_set_ids(h, n)), lists], ["doc_id", "n", "set_id", "low"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(rows, "doc_id long, n int, set_id long, low array<long>")


def _shared(sets: DataFrame) -> DataFrame:
    """(token, set_id, common, sets): the tokens in ``low`` that several sets have."""
    tokens = sets.groupBy("set_id", "common").agg(F.first("low").alias("low")).select("set_id", "common", F.explode("low").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1")
    return tokens.join(often, "token")


def _possible(sets: DataFrame, percent: int) -> DataFrame:
    """(set_id): the sets that share enough of their lowest shingles to have a partner."""
    shared = _shared(sets.withColumn("common", _common(F.col("n"), percent))).groupBy("set_id", "common").agg(F.count("*").alias("shared"))
    return shared.where("shared >= common").select("set_id")


def _routes(sets: DataFrame) -> DataFrame:
    """(set_id, token): the routing tokens of the sets (set_id, common, low) that can have a partner."""
    from pyspark.sql import Window

    own = Window.partitionBy("set_id")
    shared = _shared(sets).withColumn("rank", F.row_number().over(own.orderBy("sets", "token")))
    return shared.withColumn("shared", F.count("*").over(own)).where("rank <= shared - common + 1").select("set_id", "token")


class Trie:
    """Sets as rising rank lists in a path-compressed prefix tree, with the components of the sets it holds."""

    __slots__ = ("bounds", "children", "label", "owner", "same")

    def __init__(self, label: np.ndarray):
        self.label = label
        self.children: dict[int, Trie] = {}
        self.owner: list[int] = []  # sets that end here
        self.bounds = [1 << 60, 0, 0]  # least and greatest size of a set below, most of its shingles in the trie
        self.same: int | None = None  # a set, while all below are in its component

    def insert(self, ranks: np.ndarray, whole: int, who: int, find) -> None:
        """A set of ``whole`` shingles, of which ``ranks`` go into the trie."""
        node, at, size = self, 0, len(ranks)
        node._saw(who, whole, size, find)
        while at < size:
            child = node.children.get(int(ranks[at]))
            if child is None:
                child = Trie(ranks[at:])
                node.children[int(ranks[at])] = child
                child._saw(who, whole, size, find)
                child.owner.append(who)
                return
            m = min(len(child.label), size - at)
            apart = np.flatnonzero(child.label[:m] != ranks[at : at + m])
            m = int(apart[0]) if len(apart) else m
            if m < len(child.label):  # the path forks or ends inside the label
                upper = Trie(child.label[:m])
                upper.bounds, upper.same = list(child.bounds), child.same
                child.label = child.label[m:]
                upper.children[int(child.label[0])] = child
                node.children[int(ranks[at])] = upper
                child = upper
            child._saw(who, whole, size, find)
            node, at = child, at + m
        node.owner.append(who)

    def _saw(self, who: int, whole: int, size: int, find) -> None:
        if self.bounds[1] == 0:
            self.same = who
        elif self.same is not None and find(self.same) != find(who):
            self.same = None
        self.bounds = [min(self.bounds[0], whole), max(self.bounds[1], whole), max(self.bounds[2], size)]


def _comparable(at: np.ndarray, who: np.ndarray, whole: np.ndarray, n_build: int | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which shingles (``at`` their numbers, ``who`` their sets) a set to compare with has too, and which sets can link by those."""
    alive, late, size = np.ones(len(whole), bool), who >= (n_build or 0), int(at.max(initial=-1)) + 1
    while True:
        on = alive[who]
        if n_build is None:
            kept = on & (np.bincount(at[on], minlength=size) > 1)[at]
        else:
            has = [np.bincount(at[on & side], minlength=size) > 0 for side in (late, ~late)]
            kept = on & np.where(late, has[1][at], has[0][at])
        still = alive & (np.bincount(who[kept], minlength=len(whole)) * 100 >= whole * percent)
        if (still == alive).all():
            return kept, alive
        alive = still


def trie_links(sets: list[np.ndarray], n_build: int | None = None, percent: int = PERCENT, joined: list[bool] | None = None) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between ``sets`` (arrays of distinct hashes).

    ``n_build``: the first so many sets are only compared with the later ones, and the later only with them.
    ``joined``: the sets known to be in one component.
    """
    if len(sets) < 2:
        return []
    whole = np.array([len(s) for s in sets])
    who = np.repeat(np.arange(len(sets)), whole)
    flat, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank_of = np.empty(len(flat), np.int64)
    rank_of[np.lexsort((flat, -counts))] = np.arange(len(flat))
    kept, alive = _comparable(at, who, whole, n_build, percent)
    who, at = who[kept], rank_of[at[kept]]
    at = at[np.lexsort((at, who))]
    ranks = np.split(at, np.cumsum(np.bincount(who, minlength=len(sets)))[:-1])
    parent = list(range(len(sets)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    known = [i for i, x in enumerate(joined or []) if x]
    for i in known[1:]:
        parent[find(i)] = find(known[0])
    out: list[tuple[int, int]] = []
    root, inside = Trie(np.zeros(0, np.int64)), np.zeros(len(flat), bool)
    for i in np.flatnonzero(alive).tolist():
        own, nx = ranks[i], int(whole[i])
        if n_build is None or i >= n_build:
            inside[own] = True
            stack = [(root, 0, 0)]
            while stack:
                node, overlap, depth = stack.pop()
                lo, hi, most = node.bounds
                if hi * 100 < nx * percent or lo * percent > nx * 100 or (node.same is not None and find(node.same) == find(i)):
                    continue
                if len(node.label):
                    overlap += int(np.count_nonzero(inside[node.label]))
                    depth += len(node.label)
                    left = len(own) - int(own.searchsorted(node.label[-1], "right"))  # of the probe, after this path
                    # overlap * (100 + percent) >= percent * (nx + ny) must be within reach of some size ny below
                    if (overlap + hi - depth) * (100 + percent) < percent * (nx + hi) or (overlap + min(left, most - depth)) * (100 + percent) < percent * (nx + lo):
                        continue
                for j in node.owner:
                    if overlap * (100 + percent) >= percent * (nx + int(whole[j])) and find(i) != find(j):
                        parent[find(i)] = find(j)
                        out.append((j, i))
                stack.extend((c, overlap, depth) for c in node.children.values())
            inside[own] = False
        if n_build is None or i < n_build:
            root.insert(own, nx, i, find)
    return out


def _full_sets(docs: DataFrame, wanted: DataFrame, k: int, percent: int) -> DataFrame:
    """(set_id, common, low, items): the whole sets of ``wanted`` (doc_id, set_id), and the tokens that can route them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column("text")):
                doc, h, n = _set_rows(Words(data, off), k)
                most, common, low = _routing_rows(doc, h, n, percent)
                low = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(most)]).astype(np.int32)), pa.array(low.view(np.int64)))
                cut = np.concatenate([[0], np.cumsum(n)]) * 8
                raw = h.tobytes()
                ids = batch.column("set_id")[i:j]
                ok = pa.array(ids.to_numpy() == _set_ids(h, n))  # an id may come with several texts
                items = pa.array([raw[cut[r] : cut[r + 1]] for r in range(j - i)], pa.binary())
                yield pa.RecordBatch.from_arrays([x.filter(ok) for x in (ids, pa.array(common.astype(np.int32)), low, items)], ["set_id", "common", "low", "items"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.join(wanted, "doc_id").select("set_id", "text").mapInArrow(rows, "set_id long, common int, low array<long>, items binary")


def _spread(groups: DataFrame) -> DataFrame:
    """A row per group and salt."""
    return groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _pivot_links(large: DataFrame, percent: int) -> DataFrame:
    """(grp, set_id, pivot): the sets of large groups that link with the group's pivot."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held: dict[bytes, np.ndarray] = {}
            ok = []
            for a, b in zip(pdf["items"], pdf["pivot_items"], strict=True):
                p = held.setdefault(b, np.frombuffer(b, np.uint64))
                x = np.frombuffer(a, np.uint64)
                at = np.minimum(np.searchsorted(p, x), len(p) - 1)
                overlap = int(np.count_nonzero(p[at] == x))
                ok.append(overlap * (100 + percent) >= percent * (len(x) + len(p)))
            yield pdf.loc[np.array(ok, bool), ["grp", "set_id", "pivot"]]

    pivots = large.groupBy("grp").agg(F.min("set_id").alias("set_id"))
    own = large.join(pivots, ["grp", "set_id"]).select("grp", F.col("set_id").alias("pivot"), F.col("items").alias("pivot_items"))
    return large.join(_spread(own), ["grp", "salt"]).mapInPandas(rows, "grp long, set_id long, pivot long")


def _links(spark: SparkSession, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): edges whose components are those of all links between ``sets`` (grp, set_id, items)."""
    sizes = sets.groupBy("grp").agg(F.count("*").alias("members"))
    sets = sets.withColumn("salt", F.pmod(F.xxhash64("set_id"), F.lit(SALTS)).cast("int"))
    large = sets.join(_spread(sizes.where(F.col("members") > block).select("grp")), ["grp", "salt"])
    near = stored(spark, _pivot_links(large, percent), "pivot")
    # side 0: outside the pivot's component, side 1: in it; a group without a large size has one block 0 on side 0
    n_side = large.select("grp", "set_id").join(near.select("grp", "set_id", F.lit(1).alias("near")), ["grp", "set_id"], "left")
    n_side = n_side.groupBy("grp").agg(F.sum(F.coalesce("near", F.lit(0))).alias("n_near"), F.count("*").alias("n_all"))
    n_side = n_side.select("grp", F.ceil((F.col("n_all") - F.col("n_near")) / block).cast("int").alias("out_blocks"), F.ceil(F.col("n_near") / block).cast("int").alias("in_blocks"))
    rows = sets.join(_spread(n_side), ["grp", "salt"], "left").join(near.select("grp", "set_id", F.lit(True).alias("near")), ["grp", "set_id"], "left")
    rows = rows.withColumn("near", F.coalesce("near", F.lit(False)))
    h = F.xxhash64("set_id")
    mine = F.when(F.col("near"), F.pmod(h, "in_blocks") + F.col("out_blocks")).otherwise(F.pmod(h, "out_blocks")).cast("int")
    # block pairs (i, j), i <= j, where i is outside the pivot's component
    others = F.when(F.col("near"), F.col("out_blocks")).otherwise(F.col("out_blocks") + F.col("in_blocks"))
    rows = rows.withColumn("mine", F.when(F.col("out_blocks").isNull(), F.lit(0)).otherwise(mine))
    others = F.when(F.col("out_blocks").isNull(), F.array(F.lit(0))).when(others == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), others - 1))
    rows = rows.withColumn("other", F.explode(others))
    rows = rows.select("grp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "near", "set_id", "items")

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, ["grp", "i", "j"]):
            pdf = pdf.drop_duplicates(["mine", "set_id"])
            i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
            build = None if i == j else int((pdf["mine"] == i).sum())
            ids = pdf["set_id"].to_numpy()
            links = trie_links([np.frombuffer(x, np.uint64) for x in pdf["items"]], build, percent, pdf["near"].tolist())
            yield pd.DataFrame({"a": ids[[a for a, _ in links]], "b": ids[[b for _, b in links]]}, dtype="int64")

    tasks = rows.repartition(parts(spark), "grp", "i", "j").sortWithinPartitions("grp", "i", "j", "mine", "set_id")
    return tasks.mapInPandas(joined, "a long, b long").unionByName(near.where("set_id <> pivot").select(F.col("pivot").alias("a"), F.col("set_id").alias("b")))


def jaccard_components(spark: SparkSession, docs: DataFrame, k: int = K, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    sets = stored(spark, shingle_sets(docs, k, percent), "sets")
    real = sets.where("n > 0 and doc_id is not null")
    possible = stored(spark, _possible(real, percent), "possible")
    release(spark)
    keepers = real.groupBy("set_id").agg(F.min("doc_id").alias("keeper"))
    wanted = keepers.join(possible, "set_id").select(F.col("keeper").alias("doc_id"), "set_id")
    full = stored(spark, _full_sets(docs, wanted, k, percent), "full")
    release(spark)
    routes = stored(spark, _routes(full), "routes")
    hubs = routes.groupBy("token").agg(F.min("set_id").alias("hub"))
    groups = components(spark, routes.join(hubs, "token"), "set_id", "hub").select(F.col("node").alias("set_id"), F.col("component").alias("grp"))
    grouped = stored(spark, full.join(groups, "set_id").select("grp", "set_id", "items"), "grouped")
    release(spark)
    links = stored(spark, _links(spark, grouped, percent, block), "links")
    a, b = (keepers.select(F.col("set_id").alias(c), F.col("keeper").alias(f"{c}_doc")) for c in "ab")
    edges = links.join(a, "a").join(b, "b").select(F.col("a_doc").alias("a"), F.col("b_doc").alias("b"))
    copies = real.select("doc_id", "set_id").join(keepers, "set_id").where("doc_id <> keeper")
    edges = edges.unionByName(copies.select(F.col("keeper").alias("a"), F.col("doc_id").alias("b")))
    found = components(spark, edges)
    release(spark)
    out = sets.select("doc_id", F.col("n").cast("long").alias("n_shingles")).join(found, F.col("doc_id") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller id; of an id's repeated rows, all stay.

    Rows with a null id stay.
    """
    found = jaccard_components(spark, docs, k, percent, block)
    gone = stored(spark, found.where("component_id < doc_id").select("doc_id").distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, table(spark, sf_dir, "documents"))
