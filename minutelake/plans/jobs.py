"""Batch plans of the services: one call = one run of the reference's minute loop.

Each plan is a set of DataFrames derived from catalogs; ``sinks.writers`` and
``streaming`` persist them in the commit order data -> manifests -> checkpoint
-> trash.  Only ``O(files of one minute)`` path lists ever reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import layout as L
from ..functions.skew import bounded_broadcast
from ..operators import ingest, publish, route
from ..schemas import FILES_TO_KEEP, LAST_FILE_TIMEOUT_MS


@dataclass
class IngestPlan:
    closed: DataFrame        # closed, non-empty collector files
    new_files: DataFrame     # closed files above the checkpoint: delivered by this run
    checkpoints: DataFrame   # checkpoints after this run
    trash: DataFrame         # trash rows (all but the last k closed files per collector)
    late: DataFrame | None   # closed files at/below the checkpoint never published


def plan_ingest(files: DataFrame, checkpoints: DataFrame, now, timeout_ms: int = LAST_FILE_TIMEOUT_MS,
                keep: int = FILES_TO_KEEP, published: DataFrame | None = None, on_late: str = "drop") -> IngestPlan:
    """T1 analysis stage: ``collector_files -> closed -> above checkpoint``, new checkpoint, trash.

    ``on_late``: files at or below the checkpoint that were never published (T6) are
    reported in ``late`` (``"drop"``, the reference's behaviour) or also delivered
    (``"deliver"``); both need the local stream catalog ``published``.
    """
    if on_late not in ("drop", "deliver"):
        raise ValueError("on_late must be 'drop' or 'deliver'")
    if on_late == "deliver" and published is None:
        raise ValueError("on_late='deliver' needs the local stream catalog (published=)")
    closed = ingest.closed_files(files, now, timeout_ms)
    return plan_closed(closed, ingest.above_checkpoint(closed, checkpoints), checkpoints, now, keep, published, on_late)


def plan_closed(closed: DataFrame, fresh: DataFrame, checkpoints: DataFrame, now, keep: int = FILES_TO_KEEP,
                published: DataFrame | None = None, on_late: str = "drop") -> IngestPlan:
    """The plan of a run whose closed files and, among them, the fresh ones are known (a listing's or a stream's)."""
    late = ingest.late_files(closed, checkpoints, published) if published is not None else None
    if on_late == "deliver":
        fresh = fresh.unionByName(late)
    return IngestPlan(closed, fresh, ingest.advance_checkpoint(closed, checkpoints),
                      ingest.trash_rows(ingest.trash_select(closed, keep), now), late)


def ingest_records(plan: IngestPlan, records: DataFrame, now) -> DataFrame:
    """T1 publish stage on a record table: the new files' records at the commit minute."""
    return publish.plan_local(ingest.records_of(records, plan.new_files), now)


def merge_records(local_records: DataFrame, sources: DataFrame, destinations: DataFrame,
                  commit_minute, include_mirrors: bool = False) -> DataFrame:
    """Local records of every source cluster routed to the stream's primary."""
    e = route.merge_edges(sources, destinations, include_mirrors)
    j = local_records.join(bounded_broadcast(
        e.select("stream", F.col("src_cluster").alias("cluster"), "dest_cluster")), ["stream", "cluster"])
    return publish.plan_merge(j, F.col("dest_cluster"), commit_minute)


def mirror_records(merged_records: DataFrame, sources: DataFrame, destinations: DataFrame) -> DataFrame:
    """Merged records copied to every mirror cluster of their stream, minute kept."""
    e = route.flow_edges(sources, destinations).filter(F.col("kind") == "mirror")
    j = merged_records.join(bounded_broadcast(
        e.select("stream", F.col("src_cluster").alias("cluster"), "dest_cluster")), ["stream", "cluster"])
    return publish.plan_mirror(j.drop("cluster"), F.col("dest_cluster")).drop("dest_cluster") \
        .select("cluster", "base", "stream", "minute", "file_name", "collector", "src_file", "value",
                *[c for c in publish.PLACE if c in merged_records.columns])


def commit_minute_after(minute, n: int = 1):
    """The commit minute of the run ``n`` minutes after ``minute`` (minute cadence)."""
    return L.plus_minutes(minute, n)
