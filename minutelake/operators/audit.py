"""Audits: local, merge and mirror consistency, out-of-order minutes and holes.

The reference walks two sorted key lists per group on one machine.  Here each
audit is one aggregate of both sides on ``(group, key)`` plus two per-group maxima:

C9 (the merge walk, restated): a key only on the source side is ``to_be_sent``
when the destination group is empty or the key sorts above every destination
key, else ``missing``; a key only on the destination side is ``extra`` when the
source group is empty or the key sorts above every source key, else ``replay``.

Scale notes: both sides go through one shuffle on ``(group, key)`` (combined
map-side, so many copies of one name never meet in one task; a hot stream spreads
over all reducers because the key varies), and the per-group maxima are small
partial aggregates joined back; no window spans a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import layout as L
from ..functions.skew import bounded_broadcast, join_group_values, next_in_order

KINDS = ("missing", "replay", "to_be_sent", "extra")


def classify(src: DataFrame, dst: DataFrame, group: list[str], key: str = "key",
             path: str = "path", with_copies: bool = False, bounds: DataFrame | None = None) -> DataFrame:
    """Differences between two keyed listings, classified by rule C9.

    ``src``/``dst`` need the ``group`` columns, ``key`` and ``path``.  Returns
    ``group..., key, kind, path`` (the path on the side that has the key; with
    duplicates the greatest path, as the last write into the reference's map).  ``bounds``
    (``group..., src_max, dst_max``): each side's greatest key, where the listings are parts of it.
    """
    sides = (src.select(*group, key, F.col(path).alias("src_path"), F.lit(None).cast("string").alias("dst_path"),
                        F.lit(1).alias("__s"), F.lit(0).alias("__d"))
             .unionByName(dst.select(*group, key, F.lit(None).cast("string").alias("src_path"),
                                     F.col(path).alias("dst_path"), F.lit(0).alias("__s"), F.lit(1).alias("__d"))))
    # one shuffle of both sides, combined map-side: a key's copies never meet in one task
    both = sides.groupBy(*group, key).agg(F.max("src_path").alias("src_path"), F.max("dst_path").alias("dst_path"),
                                          F.sum("__s").alias("src_copies"), F.sum("__d").alias("dst_copies"))
    # Per-group upper bounds of each side.  Both branches read the same columns of ``both``, so
    # Spark runs the union and its exchange once and reuses it.
    src_in = (F.col("src_copies") > 0) & F.col("src_path").isNotNull()
    dst_in = (F.col("dst_copies") > 0) & F.col("dst_path").isNotNull()
    if bounds is None:
        bounds = both.groupBy(*group).agg(F.max(F.when(src_in, F.col(key))).alias("src_max"),
                                          F.max(F.when(dst_in, F.col(key))).alias("dst_max"))
    diff = both.filter((F.col("src_copies") == 0) | (F.col("dst_copies") == 0))
    # ``bounds`` has one row per group; AQE sees its materialised size and broadcasts it (no
    # shuffle keyed by a hot group).
    diff = join_group_values(diff, bounds, group)
    k = F.col(key)
    kind = (F.when(F.col("dst_copies") == 0,
                   F.when(F.col("dst_max").isNull() | (k > F.col("dst_max")), F.lit("to_be_sent"))
                   .otherwise(F.lit("missing")))
            .otherwise(F.when(F.col("src_max").isNull() | (k > F.col("src_max")), F.lit("extra"))
                       .otherwise(F.lit("replay"))))
    cols = [*group, key, kind.alias("kind"), F.coalesce("src_path", "dst_path").alias("path")]
    if with_copies:
        cols.append(F.greatest("src_copies", "dst_copies").alias("n_copies"))
    return diff.select(*cols)


def _scope(df: DataFrame, streams=None, clusters=None, bases=None) -> DataFrame:
    """optional scoping; ``isin`` on partition columns prunes partitions."""
    if streams is not None:
        df = df.filter(F.col("stream").isin(list(streams)))
    if clusters is not None and "cluster" in df.columns:
        df = df.filter(F.col("cluster").isin(list(clusters)))
    if bases is not None and "base" in df.columns:
        df = df.filter(F.col("base").isin(list(bases)))
    return df


def audit_local(collector_files: DataFrame, trash: DataFrame, local_files: DataFrame,
                streams=None, clusters=None, compare=classify) -> DataFrame:
    """(data ∪ trash) vs ``streams_local`` per cluster root, key = file name.

    data files become ``<collector>-<file>.gz``, trash files (already
    ``<collector>-<file>``) become ``<file>.gz``, local files keep their name.
    Roots are audited independently (the reference leaks state between roots).  ``compare``:
    :func:`classify`, or ``digests.compare(...)``, which compares differing hours only (all audits).
    """
    data = _scope(collector_files, streams, clusters).select(
        "cluster", L.published_name("collector", "file_name").alias("key"), "path")
    tr = _scope(trash, streams, clusters).select(
        "cluster", F.concat("file_name", F.lit(L.PUBLISHED_SUFFIX)).alias("key"), "path")
    dst = _scope(local_files, streams, clusters).select("cluster", F.col("file_name").alias("key"), "path")
    return compare(data.unionByName(tr), dst, ["cluster"])


def audit_merge(local_files: DataFrame, merged_files: DataFrame, streams=None,
                with_copies: bool = False, compare=classify) -> DataFrame:
    """∪ clusters' local streams vs the merged stream, per stream, key = file name.

    ``with_copies`` adds ``n_copies``: how many files share the differing name on
    its side (the reference's map silently keeps one of them, C8).
    """
    src = _scope(local_files, streams).select("stream", F.col("file_name").alias("key"), "path")
    dst = _scope(merged_files, streams).select("stream", F.col("file_name").alias("key"), "path")
    return compare(src, dst, ["stream"], with_copies=with_copies)


def stream_entries(files: DataFrame, minutes: DataFrame) -> DataFrame:
    """Files plus empty minute directories, keyed by their path below the stream dir.

    A file is ``yyyy/MM/dd/HH/mm/<file>``, an empty minute ``yyyy/MM/dd/HH/mm``.  A cluster is a
    name (its root is ``/<name>``) or a root path.
    """
    f = files.select("cluster", "base", "stream", "minute",
                     F.concat(F.date_format("minute", L.MINUTE_DIR_FORMAT), F.lit("/"), F.col("file_name"))
                     .alias("relpath"), F.lit("file").alias("entry"), "path")
    e = (minutes.filter(F.col("state") == "empty")
         .select("cluster", "base", "stream", "minute",
                 F.date_format("minute", L.MINUTE_DIR_FORMAT).alias("relpath"), F.lit("dir").alias("entry"),
                 F.concat_ws("/", F.when(F.col("cluster").contains("/"), F.rtrim(F.col("cluster"), F.lit("/")))
                             .otherwise(F.concat(F.lit("/"), F.col("cluster"))), "base", "stream",
                             F.date_format("minute", L.MINUTE_DIR_FORMAT)).alias("path")))
    return f.unionByName(e)


def audit_mirror(merged_entries: DataFrame, mirror_entries: DataFrame, mirrors: DataFrame | None = None,
                 streams=None, compare=classify) -> DataFrame:
    """The merged stream vs each mirror, per (mirror cluster, stream), key = relative path.

    ``merged_entries``/``mirror_entries`` come from :func:`stream_entries`; the
    merged side is replicated once per mirror cluster of its stream (``mirrors``:
    ``stream, mirror``; default: every cluster seen on the mirror side).
    """
    m = _scope(merged_entries, streams).select("stream", F.col("relpath").alias("key"), "path")
    r = _scope(mirror_entries, streams).select(F.col("cluster").alias("mirror"), "stream",
                                                F.col("relpath").alias("key"), "path")
    derived = mirrors is None
    if derived:
        mirrors = r.select("mirror", "stream").distinct()
    # The fan-out join is keyed by stream alone (low cardinality, possibly one hot stream); the
    # mirror list has one row per (mirror, stream) and is broadcast: behind a row check when it
    # is given (topology), by AQE's runtime size check when it is derived from the listing.
    ml = mirrors.select("stream", "mirror")
    src = m.join(ml, "stream") if derived else m.join(bounded_broadcast(ml), "stream")
    return compare(src, r, ["mirror", "stream"])


def minute_dirs(files: DataFrame, minutes: DataFrame | None = None) -> DataFrame:
    """One row per minute directory with its creation time.

    Data minutes take ``max(mtime)`` of their files; empty minutes from the ledger
    take the ledger's ``created_at``.
    """
    d = (files.groupBy("cluster", "base", "stream", "minute")
         .agg(F.max("mtime").alias("created_at"), F.count(F.lit(1)).alias("n_files"))
         .withColumn("state", F.lit("data")))
    if minutes is None:
        return d.select("cluster", "base", "stream", "minute", "state", "created_at", "n_files")
    e = (minutes.filter(F.col("state") == "empty")
         .join(d.select("cluster", "base", "stream", "minute"), ["cluster", "base", "stream", "minute"], "left_anti")
         .select("cluster", "base", "stream", "minute", "state", "created_at", F.lit(0).cast("long").alias("n_files")))
    return d.select("cluster", "base", "stream", "minute", "state", "created_at", "n_files").unionByName(e)


_GROUP = ["cluster", "base", "stream"]


def _with_next(minutes: DataFrame) -> DataFrame:
    return next_in_order(minutes.select(*_GROUP, "minute", "created_at"), _GROUP, "minute", ["created_at"],
                         bucket=L.ntz(F.date_trunc("day", "minute")))


def out_of_order(minutes: DataFrame, streams=None, clusters=None, bases=None) -> DataFrame:
    """A minute created later than the next present minute of its stream.

    Returns the earlier minute of the inverted pair, with the later one as
    ``next_minute``.  Strict ``>``: equal creation times are in order.  ``streams``,
    ``clusters`` and ``bases`` scope the check (F14) before any shuffle.
    """
    n = _with_next(_scope(minutes, streams, clusters, bases))
    return (n.filter(F.col("created_at") > F.col("next_created_at"))
            .select(*_GROUP, "minute", "created_at", "next_minute", "next_created_at"))


def missing_ranges(minutes: DataFrame, streams=None, clusters=None, bases=None) -> DataFrame:
    """W4 as ranges: one row per gap (first and last missing minute, number of minutes)."""
    n = _with_next(_scope(minutes, streams, clusters, bases)).filter(
        F.col("next_minute") > L.plus_minutes("minute", 1))
    span = F.unix_micros(F.col("next_minute").cast("timestamp")) - F.unix_micros(F.col("minute").cast("timestamp"))
    return n.select(*_GROUP, L.plus_minutes("minute", 1).alias("gap_start"),
                    L.plus_minutes("next_minute", -1).alias("gap_end"),
                    (F.floor(span / F.lit(60_000_000)) - 1).cast("long").alias("n_minutes"))


def missing_minutes(minutes: DataFrame, streams=None, clusters=None, bases=None) -> DataFrame:
    """Every minute strictly between consecutive present minutes of a stream.

    Each gap row expands on its own (``explode`` of a ``sequence``), so output streams out of
    the task without buffering; :func:`missing_ranges` is the compact form for huge gaps.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
    return missing_ranges(minutes, streams, clusters, bases).select(
        *_GROUP, F.explode(F.sequence("gap_start", "gap_end", step)).alias("minute"))


def summary(diffs: DataFrame, groups: DataFrame, group: list[str]) -> DataFrame:
    """Per group, the count of each difference kind and the verdict.

    ``groups`` lists every audited group so that consistent groups get a row
    (the reference prints "there are no missing files" for them).
    """
    # one aggregate over (groups ∪ differences): no join, every group gets its row
    rows = groups.select(*group, F.lit(None).cast("string").alias("kind")).unionByName(diffs.select(*group, "kind"))
    out = rows.groupBy(*group).agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS])
    total = sum(F.col(f"n_{k}") for k in KINDS)
    return out.withColumn("verdict", F.when(total == 0, F.lit("consistent")).otherwise(F.lit("inconsistent")))
