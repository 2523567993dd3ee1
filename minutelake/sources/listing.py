"""Folders listed by the executors, as Python data sources.

* ``file_tree`` (batch): every file and folder below a root.  The planner lists only the first
  ``split_depth`` levels (streams and collectors: one entry per folder, not per file) and deals
  the folders found there to the tasks, which walk them.
* ``collectors`` (stream): the files of ``<top>/<stream>/<collector>`` folders that a batch
  delivers.  Its offset is the checkpoint itself (per collector the last closed name, or the
  names present, see :class:`CollectorReader`); F1, F2 and F3 are applied by the planner and
  again by the task that lists the folder.

Unlike Spark's file sources both see names that begin with ``_`` or ``.``, empty files and empty
folders.  Local and mounted file systems are listed with ``os.scandir``, others with the
executors' ``pyarrow.fs`` client; a scheme that it doesn't know is an error of the planner.

The classes travel to the workers by value, so a cluster needs no copy of this package.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

TREE_SCHEMA = "path string, mtime timestamp, length long, is_dir boolean"
FILES_SCHEMA = "tick long, stream string, collector string, file_name string, path string, mtime timestamp, length long, fresh boolean"
#: folders listed at a time by a planner, and the most tasks that folders are dealt to
THREADS, TASKS = 16, 256
#: rows of one Arrow batch
BATCH_ROWS = 10_000

Entry = tuple[str, int, int, bool]  # name, mtime in microseconds, length, is it a folder


def entries(folder: str) -> list[Entry]:
    """What is in a folder (nothing if it is gone), by name."""
    if folder.startswith(("/", "file:")):
        found = []
        try:
            with os.scandir("/" + folder.removeprefix("file:").lstrip("/")) as listed:
                for e in listed:
                    try:
                        s = e.stat()
                        found.append((e.name, s.st_mtime_ns // 1000, s.st_size, e.is_dir()))
                    except FileNotFoundError:  # gone since it was listed
                        pass
        except (FileNotFoundError, NotADirectoryError):
            pass
        return sorted(found)
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    listed = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted((i.base_name, int((i.mtime_ns or 0) // 1000), int(i.size or 0), i.type == fs.FileType.Directory) for i in listed)


def at_once(fn: Callable, items: list) -> list:
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(fn, items))


class Folders(InputPartition):
    """Folders that one task walks."""

    def __init__(self, work: list):
        super().__init__(None)
        self.work = work


def dealt(work: list, tasks: int) -> list[Folders]:
    many = max(1, min(tasks, len(work)))
    return [Folders(work[i::many]) for i in range(many)]


def batches(rows: Iterator[tuple], names: list[str], kinds: list) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield packed(held, names, kinds)
            held = []
    if held:
        yield packed(held, names, kinds)


def packed(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)


STAMP = pa.timestamp("us", tz="UTC")
TREE_KINDS = [pa.string(), STAMP, pa.int64(), pa.bool_()]
FILE_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), STAMP, pa.int64(), pa.bool_()]


class TreeReader(DataSourceReader):
    def __init__(self, root: str, below: list[str] | None, depth: int, tasks: int):
        self.root, self.below, self.depth, self.tasks = root.rstrip("/"), below, depth, tasks

    def partitions(self) -> list[Folders]:
        """Folders at ``depth``, dealt to tasks; what is above them goes with the first."""
        above, level = [], [self.root if self.below is None else f"{self.root}/{b}" for b in self.below or [""]] if self.below != [] else []
        for _ in range(self.depth):
            following = []
            for folder, found in zip(level, at_once(entries, level)):
                for name, mtime, length, is_dir in found:
                    above.append((f"{folder}/{name}", mtime, length, is_dir))
                    if is_dir:
                        following.append(f"{folder}/{name}")
            level = following
        return [Folders([(above, [])]), *([] if not level else [Folders([([], p.work)]) for p in dealt(level, self.tasks)])]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for listed, folders in partition.work:
                yield from listed
                stack = list(folders)
                while stack:
                    folder = stack.pop()
                    for name, mtime, length, is_dir in entries(folder):
                        path = f"{folder}/{name}"
                        yield path, mtime, length, is_dir
                        if is_dir:
                            stack.append(path)

        return batches(rows(), ["path", "mtime", "length", "is_dir"], TREE_KINDS)


class FileTree(DataSource):
    """Options: ``root``, ``below`` (JSON list of folders in it; default all), ``split_depth``, ``tasks``."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def schema(self) -> str:
        return TREE_SCHEMA

    def reader(self, schema) -> TreeReader:
        o = self.options
        below = o.get("below")
        return TreeReader(o["root"], None if below is None else json.loads(below), int(o.get("split_depth", 1)), int(o.get("tasks", TASKS)))


def accepted(name: str, suffix: str, stats: str) -> bool:
    """F1 for one name."""
    return not name.endswith(suffix) and name.lower() != stats


def closed_names(found: list[Entry], now_us: int, timeout_us: int | None, suffix: str, stats: str) -> tuple[list[Entry], str | None]:
    """F1, W1/F2 and F3 in one collector folder: its closed, non-empty files, and the file in flight.

    The newest file (of equal ones the greater name) is in flight until it has been idle for the
    timeout; without a timeout every file is closed.  Names are compared in any case (C2).
    """
    files = [e for e in found if not e[3] and accepted(e[0], suffix, stats)]
    flying = None
    if files and timeout_us is not None:
        newest = max(files, key=lambda e: (e[1], e[0]))
        if now_us - newest[1] < timeout_us:
            flying = newest[0]
    return [e for e in files if e[2] > 0 and (flying is None or e[0].lower() != flying.lower())], flying


class CollectorReader(DataSourceStreamReader):
    """Two kinds of offset, both a map from ``stream/collector``:

    * ``order="name"`` (collector folders): the greatest closed name, which never falls; files above
      it are delivered (J1).  A collector that grows by name, as collectors do, needs no more.
    * ``order="any"`` (landing folders): all closed names that are present; a name that wasn't there
      before is delivered, wherever it sorts.

    Every trigger has an offset of its own (``tick``), so a batch comes each minute, with or without files.
    """

    def __init__(self, source: Collectors):
        o = source.options
        self.top, self.by_name, self.clock = o["path"].rstrip("/"), o.get("order", "name") == "name", source.clock
        self.timeout = int(o["timeout_ms"]) * 1000 if o.get("timeout_ms") else None
        self.suffix, self.stats, self.tasks = o["suffix"], o["stats"], int(o.get("tasks", TASKS))
        self.ticks = o.get("ticks", "true") == "true"
        self.first: dict[str, str] = json.loads(o.get("marks", "{}"))
        self.marks = dict(self.first)

    def initialOffset(self) -> dict:  # asked for more than once
        return {"tick": 0, "marks": self.first if self.by_name else {}, "open": {}}

    def folders(self) -> list[str]:
        streams = [s[0] for s in entries(self.top) if s[3]]
        found = at_once(lambda s: [f"{s}/{c[0]}" for c in entries(f"{self.top}/{s}") if c[3]], streams)
        return [x for part in found for x in part]

    def latestOffset(self) -> dict:
        now, folders = int(self.clock() * 1_000_000), self.folders()
        marks, flying = dict(self.marks) if self.by_name else {}, {}
        for key, (closed, open_) in zip(folders, at_once(lambda k: self.closed(k, now), folders)):
            if closed:
                names = [e[0] for e in closed]
                if self.by_name:
                    marks[key] = max(marks.get(key, ""), max(names))
                else:
                    marks[key] = sorted(names)
            if open_ is not None and self.by_name and open_ <= marks.get(key, ""):
                flying[key] = open_
        if self.by_name:
            self.marks = marks
        return {"tick": now // 1000 if self.ticks else 0, "marks": marks, "open": flying}

    def closed(self, key: str, now: int) -> tuple[list[Entry], str | None]:
        return closed_names(entries(f"{self.top}/{key}"), now, self.timeout, self.suffix, self.stats)

    def partitions(self, start: dict, end: dict) -> list[Folders]:
        """The collectors that have something new."""
        work = []
        for key, new in sorted(end["marks"].items()):
            old = start["marks"].get(key)
            if new != old:
                work.append((end["tick"], key, old, new, end["open"].get(key)))
        return dealt(work, self.tasks)

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for tick, key, old, new, flying in partition.work:
                stream, collector = key.rsplit("/", 1)
                before = set() if self.by_name or old is None else set(old)
                now = set() if self.by_name else set(new)
                for name, mtime, length, is_dir in entries(f"{self.top}/{key}"):
                    if is_dir or not length or not accepted(name, self.suffix, self.stats) or (flying is not None and name.lower() == flying.lower()):
                        continue
                    if name <= new if self.by_name else name in now:
                        fresh = (old is None or name > old) if self.by_name else name not in before
                        yield tick, stream, collector, name, f"{self.top}/{key}/{name}", mtime, length, fresh

        return batches(rows(), [f.split(" ")[0] for f in FILES_SCHEMA.split(", ")], FILE_KINDS)


class Collectors(DataSource):
    """Options: ``path``, ``order``, ``timeout_ms``, ``suffix`` and ``stats`` (F1), ``marks`` (the checkpoint to start from)."""

    clock: Callable[[], float] = staticmethod(time.time)

    @classmethod
    def name(cls) -> str:
        return "collectors"

    def schema(self) -> str:
        return FILES_SCHEMA

    def streamReader(self, schema) -> CollectorReader:
        return CollectorReader(self)


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_tree(spark: SparkSession, root: str, below: list[str] | None = None, split_depth: int = 1) -> DataFrame:
    """Every file and folder below ``root`` (a qualified path), or below some of its folders: ``TREE_SCHEMA``."""
    spark.dataSource.register(FileTree)
    reader = spark.read.format("file_tree").option("root", root).option("split_depth", str(split_depth))
    if below is not None:
        reader = reader.option("below", json.dumps(list(below)))
    return reader.load()


def collector_stream(spark: SparkSession, top: str, order: str, timeout_ms: int | None, suffix: str, stats: str,
                     marks: dict[str, str] | None = None, ticks: bool = True, clock: Callable[[], float] | None = None) -> DataFrame:
    """A stream of the closed files of collector folders below ``top`` (a qualified path): ``FILES_SCHEMA``.

    ``marks`` is the checkpoint (``stream/collector`` -> name) that a new query goes on from; a restarted one has its
    offsets.  Without ``ticks`` a batch comes only with new files.  ``clock`` (seconds) decides what is idle.
    """
    source = Collectors if clock is None else type("Collectors", (Collectors,), {"clock": staticmethod(clock)})
    spark.dataSource.register(source)
    stream = spark.readStream.format("collectors").option("path", top).option("order", order).option("suffix", suffix)
    stream = stream.option("stats", stats).option("ticks", str(ticks).lower()).option("marks", json.dumps(marks or {}))
    if timeout_ms is not None:
        stream = stream.option("timeout_ms", str(timeout_ms))
    return stream.load()
