"""Topology flow edges and manifest routing (merge and mirror consumers).

Topology tables are configuration (a handful of rows per stream); they are
broadcast behind an explicit row-count check (``bounded_broadcast``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import layout as L
from ..functions.skew import bounded_broadcast, join_group_values

MANIFEST_COLS = ["kind", "src_cluster", "via_cluster", "dest_cluster", "stream", "path", "minute", "batch_id"]


def primaries(destinations: DataFrame) -> DataFrame:
    """``stream -> primary cluster`` (streams without a primary have no row).

    Configuration-sized (one row per stream), so it is broadcast behind a row check: every
    topology join below is keyed by ``stream`` alone and must never shuffle on it.
    """
    return bounded_broadcast(destinations.filter(F.coalesce(F.col("is_primary"), F.lit(False)))
                             .select("stream", F.col("cluster").alias("primary")).distinct())


def flow_edges(sources: DataFrame, destinations: DataFrame) -> DataFrame:
    """``kind, stream, src_cluster, dest_cluster`` for local, merge and mirror flows.

    local: every (stream, source cluster); merge: every source cluster of a
    stream to its primary (self edges kept, C5); mirror: primary to each
    non-primary destination (none without a primary).
    """
    p = primaries(destinations)
    local = sources.select(F.lit("local").alias("kind"), "stream", F.col("cluster").alias("src_cluster"),
                           F.col("cluster").alias("dest_cluster"))
    merge = sources.join(p, "stream").select(F.lit("merge").alias("kind"), "stream",
                                              F.col("cluster").alias("src_cluster"),
                                              F.col("primary").alias("dest_cluster"))
    mirror = (destinations.filter(~F.coalesce(F.col("is_primary"), F.lit(False))).join(p, "stream")
              .select(F.lit("mirror").alias("kind"), "stream", F.col("primary").alias("src_cluster"),
                      F.col("cluster").alias("dest_cluster")))
    return local.unionByName(merge).unionByName(mirror).distinct()


def edge_load(edges: DataFrame, files: DataFrame) -> DataFrame:
    """Flow edges with the number of files each one carries (files at the edge's source cluster)."""
    n = files.groupBy(F.col("cluster").alias("src_cluster"), "stream").agg(F.count(F.lit(1)).alias("n_files"))
    return (edges.join(n, ["src_cluster", "stream"], "left")
            .select("kind", "stream", "src_cluster", "dest_cluster",
                    F.coalesce("n_files", F.lit(0).cast("long")).alias("n_files")))


def merge_edges(sources: DataFrame, destinations: DataFrame, include_mirrors: bool = False) -> DataFrame:
    """Consumers of a source cluster's local stream: ``stream, src_cluster, dest_cluster``.

    Default: the stream's primary only.  ``include_mirrors=True`` reproduces the
    reference (C5): a cluster that is primary for any stream the source cluster
    produces receives every stream it is a destination of.
    """
    p = primaries(destinations)
    if not include_mirrors:
        return sources.join(p, "stream").select("stream", F.col("cluster").alias("src_cluster"),
                                                F.col("primary").alias("dest_cluster"))
    consumers = bounded_broadcast(
        sources.join(p, "stream")
        .select(F.col("cluster").alias("src_cluster"), F.col("primary").alias("dest_cluster")).distinct())
    dests = bounded_broadcast(destinations.select("stream", F.col("cluster").alias("dest_cluster")))
    return (sources.select("stream", F.col("cluster").alias("src_cluster"))
            .join(consumers, "src_cluster")
            .join(dests, ["stream", "dest_cluster"])
            .select("stream", "src_cluster", "dest_cluster").distinct())


def batch_id_of(minute) -> F.Column:
    """Manifest batch id of a commit: epoch minutes of the commit minute."""
    return (F.unix_micros(L.ntz(minute).cast("timestamp")) / F.lit(60_000_000)).cast("long")


def route_merge(local_files: DataFrame, edges: DataFrame, batch_id=None) -> DataFrame:
    """One manifest row per published local file and consumer cluster."""
    e = bounded_broadcast(edges.select("stream", F.col("src_cluster").alias("cluster"), "dest_cluster"))
    j = local_files.join(e, ["stream", "cluster"])
    bid = batch_id_of("minute") if batch_id is None else batch_id
    return j.select(F.lit("merge").alias("kind"), F.col("cluster").alias("src_cluster"),
                    F.col("cluster").alias("via_cluster"), "dest_cluster", "stream", "path", "minute",
                    bid.alias("batch_id"))


def route_mirror(merged_entries: DataFrame, edges: DataFrame, batch_id=None) -> DataFrame:
    """Committed merged files and gap minutes to each mirror cluster of the stream.

    ``merged_entries`` are :func:`audit.stream_entries` rows of the merged stream
    (files and empty minutes); ``edges`` are ``kind='mirror'`` flow edges.
    """
    e = bounded_broadcast(edges.filter(F.col("kind") == "mirror")
                          .select("stream", F.col("src_cluster").alias("cluster"), "dest_cluster"))
    j = merged_entries.join(e, ["stream", "cluster"])
    bid = batch_id_of("minute") if batch_id is None else batch_id
    return (j.select(F.lit("mirror").alias("kind"), F.col("cluster").alias("src_cluster"),
                     F.col("cluster").alias("via_cluster"), "dest_cluster", "stream", "path", "minute",
                     bid.alias("batch_id"))
            .distinct())


def pending_manifests(manifests: DataFrame, acks: DataFrame) -> DataFrame:
    """Unacknowledged manifest rows of a backlog, trimmed and de-duplicated.

    One row per ``(kind, dest_cluster, stream, path)``; ``batch_id`` is the
    latest batch that listed the path.
    """
    pend = manifests.join(acks.select("kind", "dest_cluster", "batch_id"),
                          ["kind", "dest_cluster", "batch_id"], "left_anti")
    return (pend.withColumn("path", F.trim("path"))
            .groupBy("kind", "dest_cluster", "stream", "path")
            .agg(F.max("batch_id").alias("batch_id"), F.min("minute").alias("minute")))


def pending_batches(manifests: DataFrame, acks: DataFrame) -> DataFrame:
    """K8: every unacknowledged batch of the backlog -- what a run acknowledges when it has handled the backlog.

    All of them, not only the latest batch that lists a path: a path may be listed by several.
    """
    return (manifests.select("kind", "dest_cluster", "batch_id").distinct()
            .join(acks.select("kind", "dest_cluster", "batch_id"), ["kind", "dest_cluster", "batch_id"], "left_anti"))


def valid_paths(pending: DataFrame, existing: DataFrame) -> DataFrame:
    """Keep manifest paths that exist (semi join on path)."""
    return pending.join(existing.select("path"), "path", "left_semi")


def invalid_paths(pending: DataFrame, existing: DataFrame) -> DataFrame:
    """J5 complement: dangling manifest paths (reported, skipped, never fatal)."""
    return pending.join(existing.select("path"), "path", "left_anti")


def collapse(manifests: DataFrame) -> DataFrame:
    """Collapse each consumer's backlog into one distinct manifest.

    Consumers with a single batch are left as they are; otherwise all trimmed distinct paths
    move into the latest batch id.  The other manifest columns are kept (of a path listed
    several times, those of its latest row), so the result can be written back and consumed.
    """
    m = manifests.withColumn("path", F.trim("path"))
    per = m.groupBy("kind", "dest_cluster").agg(F.min("batch_id").alias("__first"), F.max("batch_id").alias("__last"))
    j = join_group_values(m, per, ["kind", "dest_cluster"], "inner")  # one row per consumer
    j = j.withColumn("batch_id", F.when(F.col("__first") < F.col("__last"), F.col("__last")).otherwise(F.col("batch_id")))
    rest = [c for c in MANIFEST_COLS if c in m.columns and c not in ("kind", "dest_cluster", "batch_id", "path")]
    out = j.groupBy("kind", "dest_cluster", "batch_id", "path").agg(F.max(F.struct(*rest)).alias("__m"))
    return out.select("kind", "dest_cluster", "batch_id", "path", *[F.col(f"__m.{c}").alias(c) for c in rest])
