"""A streaming source of Parquet files with row-wise offsets (S9, T1): at most ``rows`` rows a micro-batch, whatever the files' sizes.

Spark's own file stream bounds a micro-batch by files.  This one, in Spark's Python Data Source API, keeps a list of the files in the order
they were found (by name, of those found at once), with their row counts from the footers, in a log folder beside the checkpoint; the list only grows.  An offset is a place
in that list and a row in that file, so a batch may begin and end inside a file, a restart goes on at the exact row, and a batch that
runs again reads the same rows.  A batch's rows are cut into ranges of ``split`` rows, one task each, and a task reads only the row
groups that its range meets.

Paths are opened by pyarrow (local, S3, GCS, HDFS with its client library).  Files must appear whole, as Spark's writers make them, and are
not changed afterwards; names that begin with ``_`` or ``.`` are not data.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

FORMAT = "parquet_rows"


def _open(path: str):
    """(file system, path in it)."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class RowRange(InputPartition):
    path: str
    first: int
    last: int  # the row after


class FileLog:
    """The files of ``path`` in the order they were found: numbered JSON lists of [path, rows] in ``folder``, each written once."""

    def __init__(self, path: str, folder: str):
        self.fs, self.path = _open(path)
        self.log_fs, self.folder = _open(folder)
        self.files: list[tuple[str, int]] = []
        self.lists = 0
        self._load()

    def _list(self, fs, folder: str) -> list:
        from pyarrow.fs import FileSelector, FileType

        infos = fs.get_file_info(FileSelector(folder, recursive=True, allow_not_found=True))
        return [i for i in infos if i.type == FileType.File]

    def _load(self) -> None:
        for info in sorted(self._list(self.log_fs, self.folder), key=lambda i: i.base_name):
            if info.base_name.endswith(".json") and info.base_name[:-5].isdigit():
                with self.log_fs.open_input_stream(info.path) as f:
                    self.files += [tuple(x) for x in json.loads(f.read())]
                self.lists += 1

    def refresh(self) -> None:
        """Appends the files that are new."""
        import pyarrow.parquet as pq

        known = {p for p, _ in self.files}
        new = []
        for info in sorted(self._list(self.fs, self.path), key=lambda i: i.path):
            inner = info.path[len(self.path) :].strip("/").split("/")
            if info.path not in known and not any(x.startswith(("_", ".")) for x in inner):
                with self.fs.open_input_file(info.path) as f:
                    new.append((info.path, pq.ParquetFile(f).metadata.num_rows))
        if not new:
            return
        self.log_fs.create_dir(self.folder, recursive=True)
        draft = f"{self.folder}/draft-{uuid.uuid4().hex}"
        with self.log_fs.open_output_stream(draft) as f:
            f.write(json.dumps(new).encode())
        self.log_fs.move(draft, f"{self.folder}/{self.lists:09d}.json")
        self.files += new
        self.lists += 1

    def after(self, at: tuple[int, int], rows: int) -> tuple[int, int]:
        """The offset ``rows`` rows after ``at``, or at the end of the files."""
        file, row = at
        while file < len(self.files) and rows >= self.files[file][1] - row:
            rows -= self.files[file][1] - row
            file, row = file + 1, 0
        return (file, row + rows) if file < len(self.files) else (file, 0)

    def ranges(self, start: tuple[int, int], end: tuple[int, int], split: int) -> list[RowRange]:
        out = []
        for file in range(start[0], end[0] + 1):
            if file == len(self.files):
                break
            path, n = self.files[file]
            first, last = (start[1] if file == start[0] else 0), (end[1] if file == end[0] else n)
            out += [RowRange(path, i, min(i + split, last)) for i in range(first, last, split)]
        return out


class RowsReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema = schema
        self.source = options["path"]
        self.rows, self.split = int(options["rows"]), int(options["split"])
        self.log_folder, self.checkpoint = options["log"], options["checkpoint"]
        self.log: FileLog | None = None
        self.at: tuple[int, int] | None = None

    def _started(self) -> FileLog:
        if self.log is None:
            self.log = FileLog(self.source, self.log_folder)
        if self.at is None:
            self.at = self._bookmark()
        return self.log

    def _bookmark(self) -> tuple[int, int]:
        """The end of the last batch that the query planned, from its checkpoint's offset log."""
        fs, folder = _open(self.checkpoint)
        from pyarrow.fs import FileSelector

        names = [i for i in fs.get_file_info(FileSelector(f"{folder}/offsets", allow_not_found=True)) if i.base_name.isdigit()]
        if not names:
            return (0, 0)
        with fs.open_input_stream(max(names, key=lambda i: int(i.base_name)).path) as f:
            offset = json.loads(f.read().decode().splitlines()[2])
        return (offset["file"], offset["row"])

    def initialOffset(self) -> dict:  # noqa: N802 - Spark's name
        return {"file": 0, "row": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        log = self._started()
        log.refresh()
        file, row = log.after(self.at, self.rows)
        return {"file": file, "row": row}

    def partitions(self, start: dict, end: dict) -> list[RowRange]:
        log = self._started()
        self.at = max(self.at, (end["file"], end["row"]))
        return log.ranges((start["file"], start["row"]), (end["file"], end["row"]), self.split)

    def commit(self, end: dict) -> None:
        self._started()
        self.at = max(self.at, (end["file"], end["row"]))

    def read(self, partition: RowRange) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(self.schema)
        fs, _ = _open(self.source)
        with fs.open_input_file(partition.path) as f:
            file = pq.ParquetFile(f)
            at = 0
            for g in range(file.metadata.num_row_groups):
                n = file.metadata.row_group(g).num_rows
                lo, hi = max(partition.first, at), min(partition.last, at + n)
                if lo < hi:
                    inner = at
                    present = [c for c in want.names if c in file.schema_arrow.names]
                    for batch in file.iter_batches(8192, row_groups=[g], columns=present):
                        a, b = max(lo, inner) - inner, min(hi, inner + len(batch)) - inner
                        inner += len(batch)
                        if a < b:
                            part = batch.slice(a, b - a)
                            columns = [part.column(x.name).cast(x.type) if x.name in present else pa.nulls(b - a, x.type) for x in want]
                            yield pa.RecordBatch.from_arrays(columns, schema=want)
                at += n


class ParquetRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.options["schema_json"]))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802 - Spark's name
        return RowsReader(schema, dict(self.options))


def read_rows(spark: SparkSession, path: str, schema: T.StructType | str, checkpoint: str, rows: int, split: int = 100_000) -> DataFrame:
    """The Parquet files of ``path`` as a stream of at most ``rows`` rows a micro-batch, in tasks of ``split`` rows at most.

    ``checkpoint`` is the checkpoint folder of the query that will read it; the file list is kept in ``<checkpoint>-files``."""
    if rows < 1 or split < 1:
        raise ValueError("rows and split are at least 1")
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    spark.dataSource.register(ParquetRows)
    checkpoint = checkpoint.rstrip("/")
    options = {"schema_json": schema.json(), "rows": rows, "split": split, "checkpoint": checkpoint, "log": f"{checkpoint}-files"}
    return spark.readStream.format(FORMAT).options(**{k: str(v) for k, v in options.items()}).load(path)


def run_until_idle(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, idle_seconds: float, mode: str = "append", interval: str = "0 seconds") -> StreamingQuery:
    """Runs ``foreachBatch(sink)`` and ends the query once no row has come for ``idle_seconds``; raises what the query raised.

    The query is stopped between two micro-batches, so no batch is cut short."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(processingTime=interval).start()
    last, since, polled = -1, time.monotonic(), False
    try:
        while query.isActive:
            query.awaitTermination(min(0.2, idle_seconds))
            progress = [p for p in query.recentProgress if p["numInputRows"]]
            newest, status = (progress[-1]["batchId"] if progress else -1), query.status
            polled = polled or "Waiting" in status["message"]  # it has asked its sources once at least
            if newest != last or not polled or status["isDataAvailable"] or "Processing" in status["message"]:
                last, since = newest, time.monotonic()
            elif time.monotonic() - since >= idle_seconds:
                break
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
