"""File catalogs of collector directories and published streams.

A catalog is a listing ``(cluster, path, mtime, length)`` turned into typed columns by path
convention.  On a real file system the listing is the ``file_tree`` data source: the executors walk
the folders, and names that begin with ``_`` or ``.``, empty files and empty folders are seen as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layout as L
from ..schemas import DATA_BASE
from ..sinks import files as fsops
from .listing import file_tree


def _tree(spark: SparkSession, directory: str, below: list[str] | None, depth: int) -> DataFrame:
    return file_tree(spark, fsops.qualified(spark, directory), below, depth)


def list_files(spark: SparkSession, directory: str, cluster: str, below: list[str] | None = None, depth: int = 1) -> DataFrame:
    """Recursive listing by the executors: ``cluster, path, mtime, length`` (no file content read).

    ``below`` names the folders of ``directory`` to walk (e.g. the streams an audit is scoped to), so
    scoping prunes at listing time; folders ``depth`` levels down are dealt to tasks.
    """
    df = _tree(spark, directory, below, depth).filter(~F.col("is_dir"))
    return df.select(F.lit(cluster).alias("cluster"), L.one_slash("path").alias("path"),
                     L.ntz("mtime").alias("mtime"), "length")


def list_folders(spark: SparkSession, directory: str, below: list[str] | None = None, depth: int = 1) -> DataFrame:
    """The folders of a tree (``path, mtime``), also those without any file."""
    df = _tree(spark, directory, below, depth).filter(F.col("is_dir"))
    return df.select(L.one_slash("path").alias("path"), L.ntz("mtime").alias("mtime"))


def collector_files_from_listing(listing: DataFrame) -> DataFrame:
    """``.../data/<stream>/<collector>/<file>`` -> collector_files rows."""
    parts = F.split(F.col("path"), "/")
    return listing.select(
        "cluster",
        L.stream_from_collector_path("path").alias("stream"),
        F.element_at(parts, -2).alias("collector"),
        F.element_at(parts, -1).alias("file_name"),
        "path", "mtime", "length")


def collector_files(spark: SparkSession, root: str, cluster: str, streams=None) -> DataFrame:
    """List ``<root>/data`` of one cluster (only the given streams' folders if ``streams``); a task has some collectors."""
    names = None if streams is None else list(streams)
    found = list_files(spark, f"{root.rstrip('/')}/{DATA_BASE}", cluster, names, 2 if names is None else 1)
    # what lies elsewhere in the folder is no collector's file
    return collector_files_from_listing(found.filter(F.col("path").rlike(rf"/{DATA_BASE}/[^/]+/[^/]+/[^/]+$")))


_PUBLISHED = r"/([^/]+)/([^/]+)/(\d{4}/\d\d/\d\d/\d\d/\d\d)/([^/]+)$"


def stream_files_from_listing(listing: DataFrame) -> DataFrame:
    """S3: ``.../<base>/<stream>/yyyy/MM/dd/HH/mm/<file>`` -> stream_files rows."""
    p = F.col("path")
    # a listing taken per stream folder already knows its stream; keeping that column lets
    # filters on ``stream`` reach the source instead of stopping at the path parse
    stream = F.col("stream") if "stream" in listing.columns else F.regexp_extract(p, _PUBLISHED, 2)
    return listing.select(
        "cluster",
        F.regexp_extract(p, _PUBLISHED, 1).alias("base"),
        stream.alias("stream"),
        L.parse_minute(p).alias("minute"),
        F.regexp_extract(p, _PUBLISHED, 4).alias("file_name"),
        "path", "mtime", "length")


def stream_files(spark: SparkSession, root: str, cluster: str, base: str, streams=None) -> DataFrame:
    """S3: list a published base (``streams_local`` or ``streams``) of one cluster.

    gzip part files are read back transparently by ``spark.read.text``; here only
    the listing is taken (only the given streams' folders if ``streams``); a task has the days of some streams.
    """
    names = None if streams is None else list(streams)
    return stream_files_from_listing(list_files(spark, f"{root.rstrip('/')}/{base}", cluster, names, 4 if names is None else 3))


def collectors(files: DataFrame) -> DataFrame:
    """(stream, collector) pairs present per cluster, with their file counts."""
    return files.groupBy("cluster", "stream", "collector").agg(F.count(F.lit(1)).alias("n_files"))
