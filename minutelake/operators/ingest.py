"""Local ingest: which collector files a run picks up, checkpoints, trash, late files.

All functions are pure DataFrame transforms over ``collector_files`` rows
(``cluster, stream, collector, file_name, path, mtime, length``).  A collector
is identified by ``(cluster, stream, collector)``; per-collector results
(newest file, keep-last-k threshold) are partial aggregates with one row per
collector, joined back through AQE's runtime broadcast (the materialised
aggregate's size is checked before broadcasting, a shuffle join with skew
splitting is the fallback); the stored checkpoint table is broadcast behind an
explicit row check.  A collector holding a third of all files is neither one
aggregation task nor one join task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import layout as L
from ..functions.skew import bounded_broadcast, join_group_values, kth_largest, latest_per_group
from ..constants import FILES_TO_KEEP, IN_FLIGHT_SUFFIX, LAST_FILE_TIMEOUT_MS, STATS_FILE_NAME

COLLECTOR = ["cluster", "stream", "collector"]


def accept_name(name="file_name") -> Column:
    """not ending in ``current`` (case-sensitive) and not ``scribe_stats`` (any case)."""
    n = L.c(name)
    return ~n.endswith(IN_FLIGHT_SUFFIX) & (F.lower(n) != F.lit(STATS_FILE_NAME))


def collector_filter(files: DataFrame, predicate: Column | None = None) -> DataFrame:
    """F1 as a frame filter; ``predicate`` replaces the default name rule (plug point)."""
    return files.filter(accept_name() if predicate is None else predicate)


def nonempty(files: DataFrame) -> DataFrame:
    """drop empty files (file scans skip 0-byte files as well)."""
    return files.filter(F.col("length") > 0)


def _micros(ts) -> Column:
    return F.unix_micros(L.ntz(ts).cast("timestamp"))


def current_files(files: DataFrame, now, timeout_ms: int = LAST_FILE_TIMEOUT_MS) -> DataFrame:
    """The in-flight file of each collector, or nothing when it has been idle.

    The newest file by ``mtime`` (ties: the greater name, i.e. the later one in a
    sorted listing) is in flight unless ``now - mtime >= timeout``.  Computed as
    ``max(struct(mtime, file_name))`` per collector (partial aggregate).
    """
    latest = latest_per_group(files, COLLECTOR, ["mtime", "file_name"], ["file_name", "mtime"])
    idle = _micros(now) - _micros("mtime") >= F.lit(timeout_ms * 1000)
    return latest.filter(~idle).select(*COLLECTOR, F.col("file_name").alias("current_file"), "mtime")


def closed_files(files: DataFrame, now, timeout_ms: int = LAST_FILE_TIMEOUT_MS,
                 predicate: Column | None = None) -> DataFrame:
    """F1 -> W1/F2 -> F3: files a run may deliver or trash.

    The newest-file rule sees every name-accepted file (also empty ones); the
    in-flight name is excluded case-insensitively (C2); empty files go last.
    """
    named = collector_filter(files, predicate)
    cur = current_files(named, now, timeout_ms).select(*COLLECTOR, F.lower("current_file").alias("__cur"))
    kept = (join_group_values(named, cur, COLLECTOR)
            .filter(F.col("__cur").isNull() | (F.lower("file_name") != F.col("__cur")))
            .drop("__cur"))
    return nonempty(kept)


def above_checkpoint(files: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Files whose name sorts above their collector's checkpoint (none -> all)."""
    ck = bounded_broadcast(checkpoints.select(*COLLECTOR, F.col("file_name").alias("__ckpt")))
    j = files.join(ck, COLLECTOR, "left")
    return j.filter(F.coalesce(F.col("file_name") > F.col("__ckpt"), F.lit(True))).drop("__ckpt")


def advance_checkpoint(closed: DataFrame, checkpoints: DataFrame | None = None) -> DataFrame:
    """A1/C4: new checkpoint per collector = max over *all* closed non-empty files,
    never moving backwards (``greatest(old, new)``)."""
    new = closed.groupBy(*COLLECTOR).agg(F.max("file_name").alias("__new"))
    if checkpoints is None:
        return new.select(*COLLECTOR, F.col("__new").alias("file_name"))
    old = checkpoints.select(*COLLECTOR, F.col("file_name").alias("__old"))
    return (old.join(new, COLLECTOR, "full_outer")
            .select(*COLLECTOR, F.greatest("__old", "__new").alias("file_name")))


def trash_select(closed: DataFrame, keep: int = FILES_TO_KEEP) -> DataFrame:
    """All but the ``keep`` lexically last closed files of each collector.

    The ``keep``-th largest name per collector is found with a salted two-stage
    top-k (bounded candidates per collector); files below it are trashed.
    Collectors with at most ``keep`` files have no threshold and keep everything.
    """
    th = kth_largest(closed.select(*COLLECTOR, "file_name"), COLLECTOR, "file_name", keep, "__kth")
    return (join_group_values(closed, th, COLLECTOR, "inner")
            .filter(F.col("file_name") < F.col("__kth")).drop("__kth"))


def trash_rows(selected: DataFrame, commit_ts, trash_root=None) -> DataFrame:
    """K7: trash entries ``system/trash/y-M-d/H/<collector>-<file>`` at the commit hour."""
    root = trash_root if trash_root is not None else F.concat(F.lit("/"), F.col("cluster"))
    name = L.trash_name("collector", "file_name")
    return selected.select(
        "cluster", L.hour_of(commit_ts).alias("trash_hour"), "stream", "collector",
        name.alias("file_name"),
        F.concat_ws("/", root, F.lit("system/trash"), L.trash_dir(commit_ts), name).alias("path"))


def late_files(closed: DataFrame, checkpoints: DataFrame, published: DataFrame) -> DataFrame:
    """Closed files at or below the checkpoint that were never published.

    The reference never delivers them (they may still be trashed); we report
    them.  ``published`` is the local stream catalog (``cluster, stream,
    file_name`` = ``<collector>-<file>.gz``).
    """
    ck = bounded_broadcast(checkpoints.select(*COLLECTOR, F.col("file_name").alias("__ckpt")))
    low = closed.join(ck, COLLECTOR, "inner").filter(F.col("file_name") <= F.col("__ckpt")).drop("__ckpt")
    pub = published.select("cluster", "stream", F.col("file_name").alias("__pub"))
    return (low.withColumn("__pub", L.published_name("collector", "file_name"))
            .join(pub, ["cluster", "stream", "__pub"], "left_anti").drop("__pub"))


def idle_empty_files(files: DataFrame, now, timeout_ms: int = LAST_FILE_TIMEOUT_MS, predicate: Column | None = None) -> DataFrame:
    """empty files whose name is accepted and that are idle for the timeout: a run deletes them."""
    idle = _micros(now) - _micros("mtime") >= F.lit(timeout_ms * 1000)
    return collector_filter(files, predicate).filter((F.col("length") == 0) & idle)


def _unseen(incoming: DataFrame, key: list[str], published: DataFrame) -> DataFrame:
    """``incoming`` rows whose ``key`` is not among the published ones.

    The catalog of all published files is large and the incoming files of a run are few: their distinct keys
    are matched against the catalog first (broadcast behind a size check, so the catalog is scanned and
    not shuffled), and what was found is taken out.
    """
    keys = incoming.select(*key).distinct()
    known = published.select(*key).join(bounded_broadcast(keys), key, "left_semi").distinct()
    return incoming.join(bounded_broadcast(known), key, "left_anti")


def not_published(files: DataFrame, published: DataFrame) -> DataFrame:
    """Collector files that no committed batch has delivered (``published``: the local stream's catalog)."""
    keyed = files.withColumn("__pub", L.published_name("collector", "file_name"))
    return _unseen(keyed, ["stream", "__pub"], published.withColumnRenamed("file_name", "__pub")).select(*files.columns)


def not_merged(files: DataFrame, merged: DataFrame) -> DataFrame:
    """Published files that the merged stream doesn't have yet."""
    return _unseen(files, ["stream", "file_name"], merged).select(*files.columns)


def records_of(records: DataFrame, files: DataFrame) -> DataFrame:
    """S2 on a record table: records of the selected files (semi join on the file key)."""
    sel = files.select("cluster", "stream", "collector", F.col("file_name").alias("src_file"))
    return records.join(sel, ["cluster", "stream", "collector", "src_file"], "left_semi")


def dedupe_replay(records: DataFrame, keys=("cluster", "stream", "collector", "src_file", "record_no")) -> DataFrame:
    """Drop replayed copies of the same source record (hash aggregate, no sort)."""
    return records.dropDuplicates(list(keys))
