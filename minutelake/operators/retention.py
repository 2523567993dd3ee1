"""Retention: effective retention per stream and cluster, purge sets, survivors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import layout as L
from ..functions.skew import bounded_broadcast
from ..schemas import DEFAULT_RETENTION_HOURS, DEFAULT_TRASH_RETENTION_HOURS


def effective_retention(sources: DataFrame, destinations: DataFrame,
                        default_hours: int = DEFAULT_RETENTION_HOURS) -> DataFrame:
    """Per (cluster, stream) the max of source and destination retention;
    a missing value takes the default."""
    s = sources.select("cluster", "stream", "retention_hours")
    d = destinations.select("cluster", "stream", "retention_hours")
    return (s.unionByName(d)
            .withColumn("retention_hours", F.coalesce(F.col("retention_hours"), F.lit(default_hours)))
            .groupBy("cluster", "stream").agg(F.max("retention_hours").alias("retention_hours")))


def resolve_retention(present: DataFrame, retention: DataFrame,
                      default_hours: int = DEFAULT_RETENTION_HOURS) -> DataFrame:
    """Retention of every (cluster, stream) found on disk; unknown streams take the default.

    ``present``: ``cluster, stream`` rows (e.g. distinct over a catalog); returns
    ``cluster, stream, retention_hours, origin`` (``config`` or ``default``).
    """
    r = bounded_broadcast(retention.select("cluster", "stream", F.col("retention_hours").alias("__r")))
    j = present.select("cluster", "stream").distinct().join(r, ["cluster", "stream"], "left")
    return j.select("cluster", "stream", F.coalesce("__r", F.lit(default_hours)).alias("retention_hours"),
                    F.when(F.col("__r").isNull(), F.lit("default")).otherwise(F.lit("config")).alias("origin"))


def is_purge(ts, now, retention_hours) -> F.Column:
    """``age_hours(ts, now) >= retention`` (absolute age, so far future purges too)."""
    return L.age_hours(ts, now) >= L.c(retention_hours)


def hour_dirs(files: DataFrame) -> DataFrame:
    """Hour directories of published streams (``cluster, base, stream, hour``)."""
    return files.select("cluster", "base", "stream", L.hour_of("minute").alias("hour")).distinct()


def purge_set(hours: DataFrame, retention: DataFrame, now,
              default_hours: int = DEFAULT_RETENTION_HOURS) -> DataFrame:
    """Hour directories whose age reaches their stream's retention at that cluster."""
    r = bounded_broadcast(retention.select("cluster", "stream", "retention_hours"))
    j = hours.join(r, ["cluster", "stream"], "left").withColumn(
        "retention_hours", F.coalesce(F.col("retention_hours"), F.lit(default_hours)))
    return (j.withColumn("age_hours", L.age_hours("hour", now))
            .filter(F.col("age_hours") >= F.col("retention_hours"))
            .select("cluster", "base", "stream", "hour", "age_hours", "retention_hours"))


def survivors(files: DataFrame, purge: DataFrame) -> DataFrame:
    """Files outside purged hours (anti join on the hour partition)."""
    p = purge.select("cluster", "base", "stream", "hour")
    return (files.withColumn("hour", L.hour_of("minute"))
            .join(p, ["cluster", "base", "stream", "hour"], "left_anti").drop("hour"))


def trash_purge_set(trash_dirs: DataFrame, now,
                    trash_hours: int = DEFAULT_TRASH_RETENTION_HOURS) -> DataFrame:
    """Trash hour directories to purge; unparseable names are purged.

    ``trash_dirs``: ``cluster, day_dir ('y-M-d'), hour_dir ('H')``.
    """
    t = trash_dirs.withColumn("trash_hour", L.parse_trash_hour("day_dir", "hour_dir"))
    return (t.withColumn("age_hours", L.age_hours("trash_hour", now))
            .filter(F.col("trash_hour").isNull() | (F.col("age_hours") >= F.lit(trash_hours)))
            .select("cluster", "day_dir", "hour_dir", "trash_hour", "age_hours"))


LEVELS = ("year", "month", "day")


def empty_levels(dirs: DataFrame, levels=LEVELS) -> DataFrame:
    """year/month/day directories without any child directory (purged regardless of age).

    ``dirs``: ``cluster, base, stream, level, path`` for every directory level
    (``year, month, day, hour``; with files, if folders may hold some); a child's path starts with
    ``<parent>/``.  Only directories of ``levels`` are looked at.
    """
    child = dirs.select("cluster", "base", "stream",
                        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("parent")).distinct()
    parents = dirs.filter(F.col("level").isin(*levels))
    return parents.join(child.withColumnRenamed("parent", "path"), ["cluster", "base", "stream", "path"],
                        "left_anti").select("cluster", "base", "stream", "level", "path")
