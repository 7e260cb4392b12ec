"""Graph storage: parquet tables, one folder per label and per (type, from, to).

A table's versions are numbered markers, ``_versions/000000000007.json``.  A marker names the write folders that hold the version
(each under a name of its own), and creating it, which succeeds for one writer only, is the only commit point:

* A writer reads version n, writes a new folder and creates marker n + 1.  If another writer was first, the folder goes, and the
  merge runs again on what that one wrote.  So writers at the same time, of one label too, lose nothing.
* A folder that no marker names does not exist for readers.  A killed write leaves such a folder and blocks nothing; ``sweep``
  removes it later.
* A marker carries the last batch number of every streaming query that wrote the table, so a replayed batch is recognised.
* No job overwrites files that it reads, and an executor lost mid-write is recomputed from version n, which is still there.

Markers are published by a rename that fails when the target exists (HDFS and others behind Hadoop's ``FileContext``), or a hard
link on a local disk.  On a store whose rename replaces files, give every label one writer.

With ``buckets=B`` the folders are bucketed (``_uid`` for nodes, ``(_fromUid, _toUid)`` for edges).  A version that is one whole
folder is read as a bucketed catalog table: a merge joins it without shuffling it, and the join's output partitions
are the buckets of the next version.  A small batch (``small=True``, as from a stream) reads and writes only the buckets its keys fall
in; the others stay where they are, and after ``MAX_PARTS`` such writes the next one rewrites the table as one folder.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphmill.model import DELETE_BATCH_SIZE, FROM_UID, INDEXED_PROPERTIES, TO_UID, UID, Graph
from graphmill.operators import delete as D
from graphmill.operators.merge import ACTION, ACTIONS, DANGLING_ACTION, ROWS, applied_edges, merge_edges_tagged, merge_nodes_tagged
from graphmill.operators.skew import HOT_KEY_MIN_ROWS, quoted

#: Write folders a version may consist of before a small batch rewrites the table.
MAX_PARTS = 16
#: Merges of one batch that other writers may overtake before it is an error.
MAX_ATTEMPTS = 50
_BUCKET_OF_FILE = re.compile(r"_(\d+)(?:\..*)?$")


class ConflictError(RuntimeError):
    """Other writers overtook a write ``MAX_ATTEMPTS`` times."""


def _escaped(name: str) -> str:
    """A label or type as part of a folder name, without the separators ``__`` and ``/``."""
    return "".join({"~": "~~", "_": "~u", "/": "~s"}.get(c, c) for c in name)


def _unescaped(name: str) -> str:
    return re.sub("~([~us])", lambda m: {"~": "~", "u": "_", "s": "/"}[m[1]], name)


class GraphStore:
    def __init__(self, spark: SparkSession, root: str, keep_versions: int = 2, buckets: int | None = None, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        # A plan built on version n (an edge rewrite reading the deleted node ids, say) still reads it while
        # n+1 is written, so at least two versions always stay.
        self.keep_versions = max(2, keep_versions)
        self.buckets = buckets
        self.database = database
        self._tag = hashlib.sha1(self.root.encode()).hexdigest()[:10]
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        path = self._Path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._local = self._fs.getUri().getScheme() == "file"

    # ------------------------------------------------------------------ layout
    def _node_dir(self, label: str) -> str:
        return f"{self.root}/nodes/{_escaped(label)}"

    def _edge_dir(self, key: tuple[str, str, str]) -> str:
        return f"{self.root}/edges/" + "__".join(_escaped(p) for p in key)

    def _keys(self, folder: str) -> list[str]:
        return [UID] if folder[len(self.root) + 1 :].startswith("nodes/") else [FROM_UID, TO_UID]

    def _list(self, path: str) -> list:
        p = self._Path(path)
        return list(self._fs.listStatus(p)) if self._fs.exists(p) else []

    # ------------------------------------------------------------------ versions
    def _marker(self, folder: str, version: int) -> str:
        return f"{folder}/_versions/{version:012d}.json"

    def _versions(self, folder: str) -> list[int]:
        names = [s.getPath().getName() for s in self._list(f"{folder}/_versions")]
        return sorted(int(n[:12]) for n in names if re.fullmatch(r"\d{12}\.json", n))

    def _version(self, folder: str, version: int) -> dict:
        """A marker: ``buckets``, ``schema``, ``parts`` ([write folder, its buckets that count or null for all]) and ``batches``."""
        stream = self._fs.open(self._Path(self._marker(folder, version)))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _current(self, folder: str) -> tuple[int, dict]:
        """(number, marker) of the newest version; (0, an empty one) of a table that does not exist."""
        for _ in range(MAX_ATTEMPTS):
            versions = self._versions(folder)
            if not versions:
                return 0, {"buckets": None, "schema": None, "parts": [], "batches": {}}
            try:
                return versions[-1], self._version(folder, versions[-1])
            except Py4JJavaError:  # dropped meanwhile by a writer that is versions ahead
                time.sleep(0.05)
        raise ConflictError(f"{folder}: no version stays long enough to be read")

    def _publish(self, folder: str, version: int, marker: dict) -> bool:
        """Creates a version's marker with its content in one step; False when the version exists."""
        name = self._marker(folder, version)
        draft = f"{folder}/_versions/_draft-{uuid.uuid4().hex}"
        out = self._fs.create(self._Path(draft), False)
        out.write(bytearray(json.dumps(marker).encode()))
        out.close()
        try:
            if self._local:
                os.link(*(self._fs.pathToFile(self._Path(p)).getPath() for p in (draft, name)))
            else:
                self._rename(draft, name)
            return True
        except FileExistsError:
            return False
        finally:
            self._fs.delete(self._Path(draft), False)

    def _rename(self, source: str, target: str) -> None:
        """A rename that fails when ``target`` exists."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._Path(target).toUri(), conf)
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._Path(source), self._Path(target), none)
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise FileExistsError(target) from None
            raise

    def _drop(self, folder: str, part: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._part_table(folder, part)}")
        self._fs.delete(self._Path(f"{folder}/{part}"), True)

    def _retire(self, folder: str, version: int) -> None:
        """Drops the versions that are too old, and the folders that only they name."""
        old = [v for v in self._versions(folder) if v <= version - self.keep_versions]
        if not old:
            return
        kept = {p for v in self._versions(folder) if v > version - self.keep_versions for p, _ in self._version(folder, v)["parts"]}
        for v in old:
            try:
                parts = self._version(folder, v)["parts"]
            except Py4JJavaError:  # another writer was here first
                continue
            self._fs.delete(self._Path(self._marker(folder, v)), False)
            for part, _ in parts:
                if part not in kept:
                    self._drop(folder, part)

    def sweep(self, older_than_seconds: float) -> int:
        """Removes folders of writes that never came to an end, begun longer ago than any write takes; returns their number."""
        limit = time.time() * 1000 - 1000 * older_than_seconds
        n = 0
        for kind in ("nodes", "edges"):
            for table in self._list(f"{self.root}/{kind}"):
                folder = f"{self.root}/{kind}/{table.getPath().getName()}"
                named = {p for v in self._versions(folder) for p, _ in self._version(folder, v)["parts"]}
                for s in self._list(folder):
                    part = s.getPath().getName()
                    if part.startswith("part-") and part not in named and s.getModificationTime() <= limit:
                        self._drop(folder, part)
                        n += 1
        return n

    # ------------------------------------------------------------------ reading
    def _part_table(self, folder: str, part: str) -> str:
        # catalogs fold case and allow few characters: a hash of the folder keeps names apart
        own = folder[len(self.root) + 1 :]
        name = f"gm_{self._tag}_{re.sub(r'[^0-9A-Za-z_]', '_', own)}_{hashlib.sha1(own.encode()).hexdigest()[:8]}_{part[5:]}"
        return f"{self.database}.{name}" if self.database else name

    def _table(self, folder: str, version: int) -> str:
        """The catalog table of a bucketed version that is one whole folder."""
        ((part, _),) = self._version(folder, version)["parts"]
        return self._part_table(folder, part)

    def files(self, folder: str, marker: dict, buckets: set[int] | None = None) -> list[str]:
        """The data files of a version, of some buckets only if given."""
        out = []
        for part, live in marker["parts"]:
            own = None if live is None else set(live)
            for s in self._list(f"{folder}/{part}"):
                name = s.getPath().getName()
                if name.startswith(("_", ".")):
                    continue
                if own is not None or buckets is not None:
                    bucket = int(_BUCKET_OF_FILE.search(name.split(".")[0])[1])
                    if (own is not None and bucket not in own) or (buckets is not None and bucket not in buckets):
                        continue
                out.append(s.getPath().toString())
        return out

    def _read_version(self, folder: str, marker: dict, buckets: set[int] | None = None) -> DataFrame | None:
        parts = marker["parts"]
        if not parts:
            return None
        first = f"{folder}/{parts[0][0]}"
        # one schema in all parts: a batch that adds to it rewrites the table
        schema = T.StructType.fromJson(marker["schema"])
        if len(parts) > 1 or buckets is not None:
            files = self.files(folder, marker, buckets)
            return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
        if not marker["buckets"]:
            return self.spark.read.schema(schema).parquet(first)
        name = self._part_table(folder, parts[0][0])
        if not self.spark.catalog.tableExists(name):
            keys = ", ".join(map(quoted, self._keys(folder)))
            cols = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY ({keys}) "
                f"INTO {marker['buckets']} BUCKETS LOCATION '{first}'"
            )
        return self.spark.table(name)

    def _read(self, folder: str) -> DataFrame | None:
        return self._read_version(folder, self._current(folder)[1])

    # ------------------------------------------------------------------ writing
    def _write_part(self, folder: str, part: str, df: DataFrame, buckets: int | None) -> None:
        path = f"{folder}/{part}"
        if buckets:
            table = df.write.format("parquet").mode("error").bucketBy(buckets, *self._keys(folder)).option("path", path)
            table.saveAsTable(self._part_table(folder, part))
        else:
            df.write.mode("error").parquet(path)

    def _bucket(self, folder: str, buckets: int) -> Column:
        """The bucket Spark writes a row to."""
        return F.pmod(F.hash(*self._keys(folder)), F.lit(buckets))

    def _commit(
        self,
        folder: str,
        build: Callable[[DataFrame | None], DataFrame],
        finish: Callable[[DataFrame], DataFrame] = lambda df: df,
        metrics: dict[str, Column] | None = None,
        batch: tuple[str, int] | None = None,
        aligned: bool = False,
        touched: Callable[[DataFrame, int], set[int] | None] | None = None,
        skip: Callable[[dict[str, int]], bool] = lambda seen: False,
    ) -> dict[str, int]:
        """Writes ``finish(build(current rows))`` as the next version, again from the start if another writer was first; returns
        ``metrics`` of what ``build`` gave, observed in the last stage of the writing job.

        ``aligned``: ``build`` keeps the buckets' partitions of the current rows.  ``touched(current rows, buckets)`` gives the
        buckets that change, or None for all.  ``skip(metrics)`` leaves the version as it is.  ``batch`` (query, number) is
        noted in the version; one noted before is not written again."""
        for _ in range(MAX_ATTEMPTS):
            version, marker = self._current(folder)
            if batch is not None and marker["batches"].get(batch[0], -1) >= batch[1]:
                return {}
            buckets = marker["buckets"] if marker["parts"] else self.buckets
            seen: dict[str, int] = {}
            part = f"part-{uuid.uuid4().hex[:16]}"
            try:
                some = None
                if touched is not None and buckets and 0 < len(marker["parts"]) <= MAX_PARTS:
                    some = touched(self._read_version(folder, marker), buckets)
                existing = self._read_version(folder, marker, some)
                if existing is not None and some is None and buckets and len(marker["parts"]) > 1:
                    existing = existing.repartition(buckets, *self._keys(folder))
                df = build(existing)
                if some is not None:
                    df = df.repartition(max(1, len(some)), self._bucket(folder, buckets))  # a bucket is one file
                elif buckets and not (aligned and existing is not None):
                    df = df.repartition(buckets, *self._keys(folder))
                if metrics:
                    watch = Observation()
                    df = df.observe(watch, *[m.alias(name) for name, m in metrics.items()])
                df = finish(df)
                self._write_part(folder, part, df, buckets)
                if metrics:
                    seen = {k: int(v or 0) for k, v in watch.get.items()}
            except Exception:
                if self._current(folder)[0] >= version + self.keep_versions:
                    continue  # overtaken so far that the files it read are gone
                raise
            if skip(seen):
                self._drop(folder, part)
                return seen
            parts: list = [[part, None]]
            if some is not None and not some:
                parts = marker["parts"]  # no row has a key
                self._drop(folder, part)
            elif some is not None and len(some) < buckets:
                # the new folder stands for the touched buckets, which count in no other folder any more
                parts = [[part, sorted(some)]]
                for old, live in marker["parts"]:
                    left = sorted(set(range(buckets) if live is None else live) - some)
                    if left:
                        parts.append([old, left])
            batches = {**marker["batches"], **({batch[0]: batch[1]} if batch else {})}
            if self._publish(folder, version + 1, {"buckets": buckets, "schema": df.schema.jsonValue(), "parts": parts, "batches": batches}):
                self._retire(folder, version + 1)
                return seen
            self._drop(folder, part)
        raise ConflictError(f"{folder}: other writers were first {MAX_ATTEMPTS} times")

    # ------------------------------------------------------------------ API
    def labels(self) -> list[str]:
        names = [s.getPath().getName() for s in self._list(f"{self.root}/nodes")]
        return sorted(_unescaped(n) for n in names if self._versions(f"{self.root}/nodes/{n}"))

    def edge_keys(self) -> list[tuple[str, str, str]]:
        out = []
        for n in [s.getPath().getName() for s in self._list(f"{self.root}/edges")]:
            parts = n.split("__")
            if len(parts) == 3 and self._versions(f"{self.root}/edges/{n}"):
                out.append(tuple(map(_unescaped, parts)))
        return sorted(out)

    def nodes(self, label: str) -> DataFrame | None:
        return self._read(self._node_dir(label))

    def edges(self, key: tuple[str, str, str]) -> DataFrame | None:
        return self._read(self._edge_dir(key))

    def has_batch(self, label: str, batch: tuple[str, int]) -> bool:
        """Whether the streaming query's batch (query, number), or a later one, is in ``label``."""
        return self._current(self._node_dir(label))[1]["batches"].get(batch[0], -1) >= batch[1]

    def write_nodes(self, label: str, df: DataFrame) -> DataFrame:
        """``df`` as the label's next version, whatever it held; returns the table."""
        folder = self._node_dir(label)
        self._commit(folder, lambda _: df)
        return self._read(folder)

    def write_edges(self, key: tuple[str, str, str], df: DataFrame) -> DataFrame:
        folder = self._edge_dir(key)
        self._commit(folder, lambda _: df)
        return self._read(folder)

    def graph(self) -> Graph:
        return Graph({l: self.nodes(l) for l in self.labels()}, {k: self.edges(k) for k in self.edge_keys()})

    def _touched(self, folder: str, incoming: DataFrame) -> Callable[[DataFrame, int], set[int] | None]:
        """The buckets of a batch's keys; all (None) when it adds to the table's columns or its keys have another type."""

        def touched(existing: DataFrame, buckets: int) -> set[int] | None:
            own, new = ({f.name: f.dataType for f in df.schema.fields} for df in (existing, incoming))
            if any(own.get(c) != t for c, t in new.items()):
                return None
            found = incoming.select(self._bucket(folder, buckets).alias("b")).where(F.col(self._keys(folder)[0]).isNotNull()).distinct()
            return {r["b"] for r in found.collect()}  # at most one row a bucket

        return touched

    def merge_nodes(
        self, label: str, incoming: DataFrame, as_of, order_by=None, unique_uids: bool = False, batch: tuple[str, int] | None = None,
        small: bool = False, rows_column: str | None = None,
    ) -> dict[str, int]:
        """J1 into the stored label: a new version; returns the counts per ``_action``, and the ``_rows`` merged.

        ``batch`` (query, number) names a micro-batch: one that the label already has is not merged again (no counts).  ``small``:
        the batch has few keys for the table, so only the buckets they fall in are rewritten; its keys are read once more for that.
        ``rows_column``: see ``merge_nodes_tagged``."""
        folder = self._node_dir(label)

        def build(existing: DataFrame | None) -> DataFrame:
            return merge_nodes_tagged(existing, incoming, as_of, order_by, unique_uids, rows_column)

        metrics = {a: F.count_if(F.col(ACTION) == a) for a in ACTIONS} | {ROWS: F.sum(ROWS)}
        touched = self._touched(folder, incoming if rows_column is None else incoming.drop(rows_column)) if small else None
        return self._commit(folder, build, lambda df: df.drop(ACTION, ROWS), metrics, batch, aligned=True, touched=touched)

    def merge_edges(
        self, key: tuple[str, str, str], incoming: DataFrame, from_nodes: DataFrame, to_nodes: DataFrame, hot_min_rows: int | None = HOT_KEY_MIN_ROWS
    ) -> dict[str, int]:
        """J2 into the stored edge table: a new version; returns the counts per ``_action``, and the ``_rows`` merged."""

        def build(existing: DataFrame | None) -> DataFrame:
            return merge_edges_tagged(existing, incoming, from_nodes, to_nodes, hot_min_rows)

        metrics = {a: F.count_if(F.col(ACTION) == a) for a in (*ACTIONS, DANGLING_ACTION)} | {ROWS: F.sum(ROWS)}
        return self._commit(self._edge_dir(key), build, applied_edges, metrics, aligned=True)

    def delete_nodes(self, label: str, conditions, indexed=INDEXED_PROPERTIES, batch_size: int | None = None, hot_min_rows: int | None = HOT_KEY_MIN_ROWS) -> dict:
        """J4 on storage: new versions of ``label`` and of every edge table with an edge that goes.

        Returns ``{label, total, batches, edges_deleted}``, counted by the jobs that write.  Tables in which nothing matches keep
        their version; an unknown label gives zero.
        """
        if indexed is not None:
            D.check_indexed(label, [c for c, _ in conditions], indexed)
        size = batch_size or DELETE_BATCH_SIZE
        nodes = self.nodes(label)
        none = {"label": label, "total": 0, "batches": 0, "edges_deleted": 0}
        if nodes is None:
            return none

        def hit(df: DataFrame) -> Column:
            return F.coalesce(D.property_predicate(conditions, df.schema), F.lit(False))

        deleted = nodes.where(hit(nodes)).select(UID)
        if deleted.isEmpty():
            return none
        edges_deleted = 0
        gone = {"gone": F.count_if(D.TOUCHED)}

        def kept(df: DataFrame) -> DataFrame:
            return df.where(~F.col(D.TOUCHED)).drop(D.TOUCHED)

        for key in self.edge_keys():
            if label not in key[1:]:
                continue

            def build(edges: DataFrame, key=key) -> DataFrame:
                return D.edges_touching(edges, key, label, deleted, hot_min_rows)

            seen = self._commit(self._edge_dir(key), build, kept, gone, skip=lambda seen: not seen["gone"])
            edges_deleted += seen["gone"]
        # last: the edges above read the deleted ids
        total = self._commit(self._node_dir(label), lambda df: df.withColumn(D.TOUCHED, hit(df)), kept, gone, aligned=True)["gone"]
        return {"label": label, "total": total, "batches": -(-total // size), "edges_deleted": edges_deleted}

    def purge(self) -> int:
        """K6 on the graph (every node with its edges): a new, empty version of every table, so readers
        of the previous version are not cut off; returns the number of tables emptied."""
        folders = [self._node_dir(x) for x in self.labels()] + [self._edge_dir(k) for k in self.edge_keys()]
        for folder in folders:
            self._commit(folder, lambda df: df.limit(0), aligned=True)
        return len(folders)
