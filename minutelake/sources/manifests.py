"""Manifests written as text files and the trash directory tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layout as L
from .catalog import list_files


def read_text_manifests(spark: SparkSession, directory: str, kind: str, dest_cluster: str) -> DataFrame:
    """A backlog of text manifests (one committed path per line; the file name is the batch).

    Lines are trimmed and blank lines dropped; every manifest file of the folder is
    read in one distributed scan (T8).
    """
    df = spark.read.option("lineSep", "\n").text(directory)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return (df.select(F.lit(kind).alias("kind"), F.lit(dest_cluster).alias("dest_cluster"),
                      F.trim("value").alias("path"), name.try_cast("bigint").alias("batch_id"))
            .filter(F.col("path") != ""))


def trash_dirs(spark: SparkSession, root: str, cluster: str) -> DataFrame:
    """``<root>/system/trash/<y-M-d>/<H>/<file>`` -> distinct ``cluster, day_dir, hour_dir``."""
    files = list_files(spark, f"{root.rstrip('/')}/system/trash", cluster)
    parts = F.split("path", "/")
    return files.select("cluster", F.element_at(parts, -3).alias("day_dir"),
                        F.element_at(parts, -2).alias("hour_dir")).distinct()


def trash_entries(spark: SparkSession, root: str, cluster: str) -> DataFrame:
    """Trash files with their parsed hour (null when the directory name does not parse)."""
    files = list_files(spark, f"{root.rstrip('/')}/system/trash", cluster)
    parts = F.split("path", "/")
    return files.select("cluster", L.parse_trash_hour(F.element_at(parts, -3), F.element_at(parts, -2))
                        .alias("trash_hour"), F.element_at(parts, -1).alias("file_name"), "path")


def collapse_text_manifests(spark: SparkSession, directory: str, out_dir: str) -> int:
    """K10 on text manifests: the distinct trimmed paths of a backlog folder as one manifest.

    The collapsed manifest is a folder of part files (readers take a folder), so the
    backlog is never funnelled through one task.  A folder holding at most one manifest
    is left alone (returns 0, nothing written); otherwise returns the number of paths.
    """
    files = spark.read.format("binaryFile").load(directory).select("path")
    if files.limit(2).count() <= 1:
        return 0
    paths = read_text_manifests(spark, directory, "", "").select("path").distinct()
    paths.write.mode("errorifexists").option("lineSep", "\n").text(out_dir)
    return spark.read.text(out_dir).count()
