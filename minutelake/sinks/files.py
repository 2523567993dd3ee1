"""File-system side effects: moving consumed collector files to trash, dropping purged directories.

Every path is resolved by Hadoop (``Path.getFileSystem``), so a root without a
scheme means the session's default file system, everywhere.  Moves and deletes of
many paths run inside tasks, through the executors' ``pyarrow.fs`` client, which knows
local and mounted file systems, HDFS and object stores; a task that is run again
finds its paths moved or gone and skips them.  Only for a scheme that this client
can't open they go through the driver's Hadoop client, streamed with ``toLocalIterator``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# parallel metadata requests of the driver's client
_THREADS = 16


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system it is on (``file:/x``, ``hdfs://host/x``)."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def _known_to_executors(path: str) -> bool:
    """Whether ``pyarrow.fs`` opens the file system of a qualified path."""
    from pyarrow import fs

    try:
        fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    except Exception:  # noqa: BLE001  an unknown scheme, or its native library is missing
        return False
    return True


def _in_tasks(spark: SparkSession, rows: DataFrame, act) -> int:
    """Sum of ``act(open, *row)`` over all rows, run by the executors; ``open(path)`` gives a file system and the path on it.

    Rows are dealt by their first column, and each task takes its own.
    """
    root = qualified(spark, "/")
    host = "" if root.startswith("file:") else root.rstrip("/")

    def run(batches):  # shipped to the executors by value
        import pandas as pd
        from pyarrow import fs

        opened = {}

        def open_path(path):
            path = host + path if path.startswith("/") else path
            if path.startswith(("/", "file:")):
                return opened.setdefault("", fs.LocalFileSystem()), "/" + path.removeprefix("file:").lstrip("/")
            *host_of, below = path.split("/", 3)
            top = "/".join(host_of)
            if top not in opened:
                system, at = fs.FileSystem.from_uri(f"{top}/x")
                opened[top] = system, at.removesuffix("x")
            system, at = opened[top]
            return system, at + below

        for pdf in batches:
            yield pd.DataFrame({"n": [sum(act(open_path, *r) for r in pdf.itertuples(index=False, name=None))]})

    dealt = rows.distinct().repartition(rows.columns[0])
    return int(dealt.mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (none if it is absent)."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (none if it is absent)."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile()) if fs.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename one file; False if ``dst`` is there already."""
    fs, p = _fs(spark, src)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    if fs.exists(to):
        return False
    if not fs.rename(p, to):
        raise OSError(f"{src} could not be renamed to {dst}")
    return True


def move_files(spark: SparkSession, moves: DataFrame, root: str, src_col: str = "src", dst_col: str = "dst") -> int:
    """Rename every ``src`` to ``dst`` (creating parents), both below ``root``; missing sources are skipped."""
    m = moves.select(F.col(src_col).alias("src"), F.col(dst_col).alias("dst"))
    if _known_to_executors(qualified(spark, root)):
        def move(open_path, src, dst):
            (system, s), (_, d) = open_path(src), open_path(dst)
            system.create_dir(d.rsplit("/", 1)[0], recursive=True)
            try:
                system.move(s, d)
            except FileNotFoundError:
                return 0
            return 1

        return _in_tasks(spark, m, move)

    def one(row) -> int:
        fs, src = _fs(spark, row[0])
        _, dst = _fs(spark, row[1])
        fs.mkdirs(dst.getParent())
        return int(bool(fs.exists(src) and fs.rename(src, dst)))

    with ThreadPoolExecutor(_THREADS) as pool:
        return sum(pool.map(one, m.toLocalIterator()))


def delete_paths(spark: SparkSession, paths: DataFrame, root: str, col: str = "path") -> int:
    """Recursively delete each listed path (K9), all below ``root``; absent paths are ignored."""
    found = paths.select(col)
    if not _known_to_executors(qualified(spark, root)):
        return sum(delete_path(spark, row[0]) for row in found.toLocalIterator())

    def delete(open_path, path):
        system, p = open_path(path)
        kind = system.get_file_info(p).type.name
        try:
            if kind == "Directory":
                system.delete_dir(p)
            elif kind != "NotFound":
                system.delete_file(p)
        except FileNotFoundError:  # gone with a folder above it
            return 0
        return int(kind != "NotFound")

    return _in_tasks(spark, found, delete)


def delete_path(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(bool(fs.exists(p) and fs.delete(p, True)))


def delete_if_empty(spark: SparkSession, path: str) -> int:
    """A folder without entries goes, whatever its age."""
    fs, p = _fs(spark, path)
    return int(bool(fs.exists(p) and not list(fs.listStatus(p)) and fs.delete(p, False)))


def copy_file(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    to, d = _fs(spark, dst)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, s, to, d, False, True, conf)
