"""Publishing plans: commit minutes, ledgers, gap minutes, merge and mirror layouts.

Pure transforms; the writers in ``sinks.writers`` persist their output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import layout as L

# a line's place in its source file, carried along where the reader gives it
PLACE = ("block_start", "line_pos", "record_no")


def _place(records: DataFrame) -> list[str]:
    return [c for c in PLACE if c in records.columns]

STREAM_KEY = ["cluster", "base", "stream"]


def plan_local(records: DataFrame, commit_minute) -> DataFrame:
    """Records of a run land in the run's commit minute (processing time),
    as ``<collector>-<file>.gz``, keeping their source lineage as columns."""
    return records.select(
        "cluster", F.lit("streams_local").alias("base"), "stream",
        L.minute_of(commit_minute).alias("minute"),
        L.published_name("collector", "src_file").alias("file_name"),
        "collector", "src_file", "value", *_place(records))


def plan_merge(local_records: DataFrame, dest_cluster, commit_minute) -> DataFrame:
    """Union of all sources' local records re-bucketed to the merge commit minute;
    published file names are kept."""
    return local_records.select(
        L.c(dest_cluster).alias("cluster"), F.lit("streams").alias("base"), "stream",
        L.minute_of(commit_minute).alias("minute"), "file_name", "collector", "src_file", "value", *_place(local_records))


def plan_mirror(merged_records: DataFrame, mirror_cluster) -> DataFrame:
    """Copy with the minute preserved; only the cluster changes."""
    return merged_records.withColumn("cluster", L.c(mirror_cluster))


def commit_ledger(published: DataFrame) -> DataFrame:
    """A4: what one commit wrote, per (cluster, base, stream, minute)."""
    return (published.groupBy("cluster", "base", "stream", "minute")
            .agg(F.countDistinct("file_name").alias("n_files"), F.count(F.lit(1)).alias("n_records")))


def latest_minute(minutes: DataFrame, keys=STREAM_KEY) -> DataFrame:
    """A3: latest published minute per stream (streams without minutes have no row)."""
    return minutes.groupBy(*keys).agg(F.max("minute").alias("latest_minute"))


def gap_minutes(minutes: DataFrame, now, keys=STREAM_KEY) -> DataFrame:
    """Minutes in ``[latest, now_minute - 1 min]`` with no directory yet.

    ``minutes`` lists the existing minute directories (data or empty); the result
    rows are the empty-minute ledger entries to publish (``state = 'empty'``).
    """
    latest = latest_minute(minutes, keys)
    end = L.plus_minutes(L.minute_of(now), -1)
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
    cand = (latest.filter(F.col("latest_minute") <= end)
            .select(*keys, F.explode(F.sequence("latest_minute", end, step)).alias("minute")))
    existing = minutes.select(*keys, "minute")
    return (cand.join(existing, [*keys, "minute"], "left_anti")
            .select(*keys, "minute", F.lit("empty").alias("state"), L.minute_of(now).alias("created_at")))


def mirror_positions(entries: DataFrame) -> DataFrame:
    """O1: ``position`` of an entry (file or empty minute) in its stream's hour folder, by minute and path.

    Hours of a stream follow each other by name and the order between streams is free, so
    this is the whole order; a window holds one hour of one stream.
    """
    w = Window.partitionBy("stream", L.hour_of("minute")).orderBy("minute", "relpath")
    return entries.withColumn("position", F.row_number().over(w).cast("long"))


def commit_parts(entries: DataFrame, minutes: int) -> DataFrame:
    """O1: ``part`` of each entry: a stream's minutes in order, ``minutes`` of them a part.

    Parts are committed one after the other, so no consumer sees a minute before an earlier one of its
    stream.  Only the distinct minutes of the backlog are ranked.
    """
    each = entries.select("stream", "minute").distinct()
    w = Window.partitionBy("stream").orderBy("minute")
    each = each.withColumn("part", F.floor((F.row_number().over(w) - 1) / F.lit(minutes)).cast("int"))
    return entries.join(each, ["stream", "minute"]).select(*entries.columns, "part")
