"""One run of each service against real directories (``streaming`` runs them as minute services).

Order of every run: selection -> data -> catalog -> commit record -> ledger -> manifests ->
checkpoint -> trash / acknowledgement.  The selection holds the batch's commit time and its files,
so a run that dies half way is simply run again with the same ``batch_id``, at whatever time
(at-least-once delivery, T7): it rewrites the same partitions with the same rows.  Readers see a
batch by its commit record only (``sinks.commitlog``); a batch that has one is not published again,
and one that never gets one leaves nothing that anybody reads.  A selected file that is gone when
its batch is run again is left out and reported, so every batch ends.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layout as L
from ..operators import audit, ingest, publish, ranges, retention, route
from ..schemas import (COLLECTOR_FILES, DATA_BASE, DEFAULT_RETENTION_HOURS, DEFAULT_TRASH_RETENTION_HOURS,
                       FILES_TO_KEEP, LAST_FILE_TIMEOUT_MS, LOCAL_BASE, MERGED_BASE)
from ..session import apply_session_settings
from ..sinks import commitlog
from ..sinks import files as fsops
from ..sinks import writers as W
from ..sources import catalog
from ..sources.manifests import trash_dirs
from ..sources.records import read_published, read_selected
from . import jobs

log = logging.getLogger("minutelake.run")


class IncompletePublish(RuntimeError):
    """Fewer files were published than selected: nothing after it was committed."""


class _Steps:
    """Wall-clock of each step of a run, returned in the run's summary."""

    def __init__(self):
        self.t = time.perf_counter()
        self.times: dict[str, float] = {}

    def __call__(self, name: str) -> None:
        now = time.perf_counter()
        self.times[name] = round(now - self.t, 3)
        self.t = now
        log.info("%s %.3fs", name, self.times[name])


@dataclass(frozen=True)
class Site:
    """Directory layout of one cluster root."""
    name: str
    root: str

    def base(self, base: str) -> str:
        return f"{self.root}/{base}"

    @property
    def system(self) -> str:
        return f"{self.root}/system"

    def ledger(self) -> str:
        return f"{self.system}/minutes"

    def manifests(self) -> str:
        return f"{self.system}/manifests"

    def acks(self) -> str:
        return f"{self.system}/acks"

    def checkpoints(self) -> str:
        return f"{self.system}/checkpoint"

    def trash_catalog(self) -> str:
        return f"{self.system}/trash_catalog"

    def catalog(self) -> str:
        return f"{self.system}/catalog"

    def commits(self, service: str) -> str:
        return f"{self.system}/commits/{service}"

    def handed_over(self) -> str:
        return f"{self.system}/handed_over"


def _ts(now: str):
    return F.lit(now).cast("timestamp_ntz")


_LEDGER_SCHEMA = "cluster string, base string, stream string, minute timestamp_ntz, state string, created_at timestamp_ntz"
_MANIFEST_SCHEMA = ("kind string, src_cluster string, via_cluster string, dest_cluster string, stream string, "
                    "path string, minute timestamp_ntz, batch_id bigint")


def minute_key(now: str) -> str:
    """``yyyy-MM-dd-HH-mm`` partition value of the minute of ``now``."""
    return _dt.datetime.fromisoformat(now).strftime("%Y-%m-%d-%H-%M")


def published_catalog(spark: SparkSession, site: Site, base: str, minute_keys: list[str] | None = None,
                      hours: list[str] | None = None) -> DataFrame:
    """S3 for our own output: one row per published file of a committed batch (``W.CATALOG_COLS``).

    ``minute_keys`` restricts the read to these minutes, ``hours`` (``yyyy-MM-dd-HH``) to these hours; records are never read.
    """
    rows = W.read_table(spark, site.catalog(), W.CATALOG_SCHEMA).filter(F.col("base") == base)
    if hours is not None:
        rows = rows.filter(F.col("hour").isin(list(hours)))
    if minute_keys is not None:
        rows = rows.filter(F.col("hour").isin(sorted({k[:13] for k in minute_keys})) &
                           F.date_format("minute", L.FILE_TIME_FORMAT).isin(list(minute_keys)))
    if commitlog.of(spark, site.base(base)).exists():
        rows = commitlog.visible(rows, commitlog.committed(spark, site.base(base), minutes=minute_keys))
    return rows.select(*W.CATALOG_COLS)


def file_path(site: Site, base: str, stream="stream", minute="minute", file_name="file_name"):
    """Logical path of a published file: ``<root>/<base>/<stream>/yyyy/MM/dd/HH/mm/<file>``."""
    return F.concat_ws("/", F.lit(site.root), F.lit(base), L.c(stream), F.date_format(L.c(minute), L.MINUTE_DIR_FORMAT),
                       L.c(file_name))


def _minute_keys(pending: DataFrame) -> list[str]:
    """Distinct minute partitions a backlog of manifests points to (bounded by the backlog's minutes)."""
    return [r[0] for r in pending.select(F.date_format("minute", L.FILE_TIME_FORMAT)).distinct().collect()
            if r[0] is not None]


def _ledger_update(spark: SparkSession, site: Site, base: str, published: DataFrame | None, now: str, name: str) -> None:
    """T5: data minutes of this batch (``stream, minute``) and, a row per idle stream, the gap before ``now``."""
    known = W.read_ledger_ranges(spark, site.ledger()).filter(F.col("base") == base)
    rows = ranges.gap_ranges(known, _ts(now))
    if published is not None:
        data = published.select("stream", "minute").distinct().select(
            F.lit(site.name).alias("cluster"), F.lit(base).alias("base"), "stream", "minute",
            F.lit("data").alias("state"), _ts(now).alias("created_at"))
        rows = ranges.of_minutes(data).unionByName(rows)
    elif rows.isEmpty():
        return
    W.write_ledger_rows(spark, rows, site.ledger(), f"{base}.{name}")


def _minutes_of_batch(files: DataFrame, batch_id: int) -> DataFrame:
    """The partitions a batch writes, as commit records."""
    return files.select("stream", "minute").distinct().withColumn("state", F.lit("data")).withColumn(
        "batch_id", F.lit(batch_id).cast("long"))


def _written(spark: SparkSession, table_dir: str, files: DataFrame, batch_id: int) -> DataFrame:
    """``stream, file_name, minute_key, n_records`` of what a batch has written: its own folders are read, nothing else."""
    there = [r[0] for r in commitlog.folders(_minutes_of_batch(files, batch_id)).collect()]
    there = [f"{table_dir}/{x}" for x in there if fsops.exists(spark, f"{table_dir}/{x}")]
    kinds = "file_name string, stream string, minute_key string"
    if not there:
        return spark.createDataFrame([], kinds + ", n_records bigint")
    rows = spark.read.schema(kinds).option("basePath", table_dir).parquet(*there)
    return rows.groupBy("stream", "file_name", "minute_key").agg(F.count("*").alias("n_records"))


def _publish(spark: SparkSession, site: Site, base: str, service: str, batch_id: int, planned: DataFrame | None, files: DataFrame,
             now: str, empty: DataFrame | None = None, part: int = 0) -> int:
    """Write a batch's records, check that every file of ``files`` (``W.CATALOG_COLS``) arrived, then catalog and commit record.

    ``empty`` (stream, minute) are minutes without data that the batch commits.  Returns the number of files.
    """
    table_dir = site.base(base)
    commitlog.of(spark, table_dir).open()  # from now on readers go by the log
    minutes = []
    if planned is not None:
        W.write_published(planned, table_dir, batch_id)
        written = _written(spark, table_dir, files, batch_id)
        key = F.date_format("minute", L.FILE_TIME_FORMAT)
        found = files.select("stream", "file_name", "minute", key.alias("minute_key")).distinct().join(
            written, ["stream", "file_name", "minute_key"], "left").groupBy("stream", "minute").agg(
            F.count("*").alias("n_files"), F.sum("n_records").alias("n_records"),
            F.max(F.when(F.col("n_records").isNull(), F.col("file_name"))).alias("lost"), *commitlog.file_digest())
        minutes = found.collect()  # a row for each stream and minute of the batch
        lost = [(r["stream"], r["lost"]) for r in minutes if r["lost"] is not None]
        if lost:
            raise IncompletePublish(f"{site.name}, batch {batch_id}: files without records, among them {lost[:5]}")
        W.write_catalog(files, site.catalog(), batch_id, f"{base}.{service}.{batch_id}.{part}")
    kinds = ("stream string, minute timestamp_ntz, state string, n_files bigint, n_records bigint, "
             "d0 bigint, d1 bigint, d2 bigint, d3 bigint, last_name string")
    rows = spark.createDataFrame([(r["stream"], r["minute"], "data", r["n_files"], r["n_records"], r["d0"], r["d1"], r["d2"], r["d3"],
                                   r["last_name"]) for r in minutes], kinds)
    if empty is not None:
        rows = rows.unionByName(empty.select("stream", "minute", F.lit("empty").alias("state"), F.lit(0).cast("long").alias("n_files"),
                                             F.lit(0).cast("long").alias("n_records")), allowMissingColumns=True)
    commitlog.commit(spark, table_dir, service, batch_id, rows, _ts(now), part)
    return sum(r["n_files"] for r in minutes)


def _found(spark: SparkSession, site: Site, now: str, delete_empty: bool, timeout_ms: int) -> DataFrame:
    """The one listing of a run, written to the shared checkpoint folder.

    Every later step (delivery, checkpoint, trash) sees the same files even after they were moved, and a
    lost executor recomputes nothing from a directory that has changed under it.  F3: empty files that
    the name filter accepts and that are idle past the timeout are deleted (never the in-flight one).
    """
    if not fsops.exists(spark, site.base(DATA_BASE)):  # a site that has received nothing yet
        return spark.createDataFrame([], COLLECTOR_FILES)
    files = catalog.collector_files(spark, site.root, site.name).checkpoint(eager=True)
    if not delete_empty:
        return files
    old = ingest.idle_empty_files(files, _ts(now), timeout_ms)
    fsops.delete_paths(spark, old, site.root)
    return files.join(old.select("path"), "path", "left_anti").select(*files.columns)


def run_local(spark: SparkSession, site: Site, now: str, batch_id: int, sources: DataFrame,
              destinations: DataFrame, timeout_ms: int = LAST_FILE_TIMEOUT_MS, keep: int = FILES_TO_KEEP,
              move_to_trash: bool = True, delete_empty: bool = True, include_mirrors: bool = False,
              on_late: str = "drop", closed: DataFrame | None = None) -> dict:
    """One local-stream run of ``site`` committed at ``now``.

    ``include_mirrors=True`` routes manifests as the reference does (C5): a consumer that is
    primary for any stream of this site also receives its non-primary streams.  Files that
    came late (T6) are counted in the result and, with ``on_late="deliver"``, delivered too.
    Files whose published name is committed already (T9) are not delivered again.
    ``closed`` are the closed files of a collector stream, with ``fresh`` ones to deliver; without
    it the run lists the collector folders itself.
    """
    apply_session_settings(spark)
    step = _Steps()
    data_dir, table_dir, commits = site.base(DATA_BASE), site.base(LOCAL_BASE), site.commits("local")
    ckpt = W.read_checkpoints(spark, site.checkpoints()).checkpoint(eager=True)
    published = published_catalog(spark, site, LOCAL_BASE)
    # each of these is computed once, and stays as it was for all later steps
    if closed is None:
        files = _found(spark, site, now, delete_empty, timeout_ms)
        shut = ingest.closed_files(files, _ts(now), timeout_ms).checkpoint(eager=True)
        fresh = ingest.above_checkpoint(shut, ckpt)
    else:
        files = closed.checkpoint(eager=True)
        shut, fresh = files.drop("fresh"), files.filter("fresh").drop("fresh")
    step("list")
    if on_late not in ("drop", "deliver"):
        raise ValueError("on_late must be 'drop' or 'deliver'")
    plan = jobs.plan_closed(shut, fresh, ckpt, _ts(now), keep, published, on_late)
    # a replay checkpoints what this selection covers, not what has come since
    marks = plan.checkpoints.withColumn("kind", F.lit("checkpoint"))
    new = ingest.not_published(plan.new_files, published).withColumn("kind", F.lit("new"))
    trash = ingest.trash_select(shut, keep).withColumn("kind", F.lit("trash"))
    came_late = plan.late.withColumn("kind", F.lit("late"))
    selected = new.unionByName(trash).unionByName(came_late).unionByName(marks, allowMissingColumns=True).checkpoint(eager=True)
    counts = {r["kind"]: r["count"] for r in selected.groupBy("kind").count().collect()}
    late = counts.get("late", 0)
    replay = fsops.exists(spark, W.commit_path(commits, batch_id))
    if not replay and not counts.get("new"):
        # C4: nothing delivered -> nothing checkpointed or trashed
        _ledger_update(spark, site, LOCAL_BASE, None, now, f"idle.{minute_key(now)}")
        step("select")
        return {"new_files": 0, "late_files": late, "lost_files": 0, "steps": step.times}
    now, selected = W.commit_of(spark, commits, batch_id, now, selected)
    new_files = selected.filter(F.col("kind") == "new").drop("kind")
    step("select")
    done = replay and commitlog.is_committed(spark, table_dir, "local", batch_id)
    n_lost = 0
    if done:  # of what the first attempt published
        here = W.read_table(spark, site.catalog(), W.CATALOG_SCHEMA).filter((F.col("base") == LOCAL_BASE) & (F.col("batch_id") == batch_id))
        committed = here.select(*W.CATALOG_COLS).checkpoint(eager=True)
        n_new = committed.count()
    else:
        if replay:  # the files that are still there; the others are reported
            lost = new_files.join(_listed(spark, site, files, closed).select("path"), "path", "left_anti").select("stream", "collector", "file_name", "path")
            lost.write.mode("overwrite").parquet(f"{W.commit_path(commits, batch_id)}/lost")
            lost = spark.read.schema(lost.schema).parquet(f"{W.commit_path(commits, batch_id)}/lost")
            n_lost = lost.count()
            if n_lost:
                log.warning("batch %s of %s: %s selected files are gone, see %s/lost", batch_id, site.name, n_lost, W.commit_path(commits, batch_id))
                new_files = new_files.join(lost.select("path"), "path", "left_anti")
        minute = L.minute_of(_ts(now))
        name = L.published_name("collector", "file_name")
        committed = new_files.select("stream", name.alias("file_name"), "length").withColumn("minute", minute)
        committed = committed.select(F.lit(site.name).alias("cluster"), F.lit(LOCAL_BASE).alias("base"), "stream", "minute",
                                     "file_name", file_path(site, LOCAL_BASE).alias("path"), _ts(now).alias("mtime"), "length")
        planned = None
        staging = f"{site.system}/tmp/batch_id={batch_id}"
        if not new_files.isEmpty():
            records = read_selected(spark, data_dir, new_files, site.name, staging)
            planned = publish.plan_local(records, _ts(now)).withColumn("committed_at", _ts(now))
        n_new = _publish(spark, site, LOCAL_BASE, "local", batch_id, planned, committed, now)
        fsops.delete_path(spark, staging)
    step("publish")
    _ledger_update(spark, site, LOCAL_BASE, committed, now, f"local.{batch_id}")
    step("ledger")
    edges = route.merge_edges(sources, destinations, include_mirrors)
    W.append_manifests(route.route_merge(committed, edges, batch_id=F.lit(batch_id).cast("long")), site.manifests())
    W.collapse_manifests(spark, site.manifests())
    step("manifests")
    marks = selected.filter(F.col("kind") == "checkpoint").select(*ingest.COLLECTOR, "file_name")
    W.write_checkpoints(ingest.advance_checkpoint(marks, ckpt), site.checkpoints(), batch_id)
    step("checkpoint")
    trashed = selected.filter(F.col("kind") == "trash").drop("kind")
    trash_dir = F.concat_ws("/", F.lit(site.system), F.lit("trash"), L.trash_dir(_ts(now)))
    moved = 0
    if move_to_trash:
        dst = F.concat_ws("/", trash_dir, L.trash_name("collector", "file_name"))
        moved = fsops.move_files(spark, trashed.select(F.col("path").alias("src"), dst.alias("dst")), site.root)
    rows = ingest.trash_rows(trashed, _ts(now))
    W.append_trash(rows.withColumn("path", F.concat_ws("/", trash_dir, F.col("file_name"))), site.trash_catalog(),
                   batch_id)
    step("trash")
    return {"new_files": n_new, "trashed": moved, "late_files": late, "lost_files": n_lost, "steps": step.times}


def _listed(spark: SparkSession, site: Site, files: DataFrame, closed: DataFrame | None) -> DataFrame:
    """All files of the collector folders: the run's own listing, or, where a stream gave the files, a new one."""
    return files if closed is None else catalog.collector_files(spark, site.root, site.name)


def _pending(spark: SparkSession, src_sites: list[Site], kind: str, dest: str) -> tuple[DataFrame, DataFrame]:
    """The backlog (paths, de-duplicated) and all its batches, with ``src_site``; settled manifests are removed first."""
    paths, batches = None, None
    for s in src_sites:
        W.settle_acks(spark, s.manifests(), s.acks())
        m = W.read_table(spark, s.manifests(), W.MANIFEST_SCHEMA).filter(
            (F.col("kind") == kind) & (F.col("dest_cluster") == dest))
        a = W.read_table(spark, s.acks(), W.ACK_SCHEMA)
        p = route.pending_manifests(m, a).withColumn("src_site", F.lit(s.name))
        b = route.pending_batches(m, a).withColumn("src_site", F.lit(s.name))
        paths = p if paths is None else paths.unionByName(p)
        batches = b if batches is None else batches.unionByName(b)
    return paths.checkpoint(eager=True), batches.checkpoint(eager=True)


def _acknowledge(spark: SparkSession, src_sites: list[Site], batches: DataFrame) -> None:
    """K8: acknowledge every batch that was read; its manifests then go."""
    for s in src_sites:
        W.append_acks(batches.filter(F.col("src_site") == s.name), s.acks())
        W.settle_acks(spark, s.manifests(), s.acks())


def _with_records(spark: SparkSession, site: Site, base: str, files: DataFrame, minute_keys: list[str]) -> DataFrame | None:
    """Records of the published files ``files`` (``stream, minute, file_name``)."""
    if not minute_keys or not fsops.exists(spark, site.base(base)):
        return None
    keys = files.select("stream", "minute", "file_name").distinct()
    return read_published(spark, site.base(base), minutes=minute_keys).join(keys, ["stream", "minute", "file_name"], "left_semi")


def run_merge(spark: SparkSession, src_sites: list[Site], dest: Site, now: str, batch_id: int,
              sources: DataFrame, destinations: DataFrame) -> dict:
    """Pull pending merge manifests of every source site into ``dest``'s merged stream.

    A file that the merged stream has already (T9) is not delivered again.
    """
    apply_session_settings(spark)
    pending, batches = _pending(spark, src_sites, "merge", dest.name)
    valid = None
    for s in src_sites:
        mine = pending.filter(F.col("src_site") == s.name)
        files = published_catalog(spark, s, LOCAL_BASE, _minute_keys(mine))
        v = files.join(mine.select("path", "stream"), ["path", "stream"], "left_semi").withColumn("src_site", F.lit(s.name))
        valid = v if valid is None else valid.unionByName(v)
    commits = dest.commits("merge")
    valid = valid.checkpoint(eager=True)
    replay = fsops.exists(spark, W.commit_path(commits, batch_id))
    if not replay and valid.isEmpty():
        # C14: nothing valid to pull -> the manifests stay pending; the merged stream is still
        # gap-filled up to ``now`` and the new empty minutes go to the mirrors (U4)
        _ledger_update(spark, dest, MERGED_BASE, None, now, f"idle.{minute_key(now)}")
        gaps = _mirror_manifests(spark, dest, None, now, batch_id, sources, destinations)
        return {"merged_files": 0, "gap_minutes": gaps}
    valid = ingest.not_merged(valid, published_catalog(spark, dest, MERGED_BASE))
    now, valid = W.commit_of(spark, commits, batch_id, now, valid)
    minute = L.minute_of(_ts(now))
    committed = valid.groupBy("stream", "file_name").agg(F.sum("length").alias("length")).withColumn("minute", minute)
    committed = committed.select(F.lit(dest.name).alias("cluster"), F.lit(MERGED_BASE).alias("base"), "stream", "minute",
                                 "file_name", file_path(dest, MERGED_BASE).alias("path"), _ts(now).alias("mtime"), "length")
    committed = committed.checkpoint(eager=True)
    if not (replay and commitlog.is_committed(spark, dest.base(MERGED_BASE), "merge", batch_id)):
        records = None
        for s in src_sites:
            mine = valid.filter(F.col("src_site") == s.name)
            r = _with_records(spark, s, LOCAL_BASE, mine, _minute_keys(mine))
            if r is not None:
                records = r if records is None else records.unionByName(r)
        planned = None if records is None else publish.plan_merge(records, F.lit(dest.name), _ts(now)).withColumn("committed_at", _ts(now))
        _publish(spark, dest, MERGED_BASE, "merge", batch_id, planned, committed, now)
    _ledger_update(spark, dest, MERGED_BASE, committed, now, f"merge.{batch_id}")
    # K5/U4: committed files and gap minutes go to the mirrors
    gaps = _mirror_manifests(spark, dest, committed, now, batch_id, sources, destinations)
    _acknowledge(spark, src_sites, batches)
    return {"merged": True, "merged_files": committed.count(), "gap_minutes": gaps}


def _mirror_manifests(spark: SparkSession, dest: Site, committed: DataFrame | None, now: str, batch_id: int,
                      sources: DataFrame, destinations: DataFrame) -> int:
    """Append mirror manifests: committed merged files plus all empty minutes not handed over before (A5).

    The time up to which gaps were handed over is kept; it moves on after the manifests are
    written, so a crash in between hands them over again (the mirrors' ledgers add nothing twice).
    """
    handed = W.read_table(spark, dest.handed_over(), "created_at timestamp_ntz").agg(F.max("created_at")).first()[0]
    gaps = W.read_ledger(spark, dest.ledger()).filter(
        (F.col("base") == MERGED_BASE) & (F.col("state") == "empty") & (F.col("created_at") <= _ts(now)))
    if handed is not None:
        gaps = gaps.filter(F.col("created_at") > F.lit(handed))
    gaps = gaps.checkpoint(eager=True)
    if committed is None:
        committed = spark.createDataFrame([], W.CATALOG_SCHEMA).select(*W.CATALOG_COLS)
    entries = audit.stream_entries(committed, gaps.withColumn("cluster", F.lit(dest.name))).withColumn(
        "path", F.when(F.col("entry") == "dir",
                       F.concat_ws("/", F.lit(dest.root), F.col("base"), F.col("stream"),
                                   F.date_format("minute", L.MINUTE_DIR_FORMAT))).otherwise(F.col("path")))
    m = route.route_mirror(entries, route.flow_edges(sources, destinations), batch_id=F.lit(batch_id).cast("long"))
    W.append_manifests(m, dest.manifests())
    W.collapse_manifests(spark, dest.manifests())
    spark.range(1).select(_ts(now).alias("created_at")).coalesce(1).write.mode("append").parquet(dest.handed_over())
    return gaps.count()


def run_mirror(spark: SparkSession, src: Site, mirror: Site, now: str, batch_id: int, minutes_per_commit: int = 60) -> dict:
    """Copy pending mirror manifests of ``src`` into ``mirror``, minutes preserved, a stream's minutes in order.

    A backlog is committed in parts of ``minutes_per_commit`` minutes of each stream, one after the other.
    A run in which no path of the backlog is there copies and acknowledges nothing (C14); a file that the mirror
    has already is not copied again.
    """
    apply_session_settings(spark)
    pending, batches = _pending(spark, [src], "mirror", mirror.name)
    files = published_catalog(spark, src, MERGED_BASE, _minute_keys(pending))
    valid = files.join(pending.select("path", "stream"), ["path", "stream"], "left_semi").withColumn("entry", F.lit("file"))
    # empty minutes listed in the manifests (directory paths, not dangling file paths) become
    # ledger rows of the mirror
    empty = (pending.filter(F.col("path").rlike(r"/\d{4}/\d\d/\d\d/\d\d/\d\d/?$"))
             .select(F.lit(src.name).alias("cluster"), F.lit(MERGED_BASE).alias("base"), "stream",
                     L.parse_minute("path").alias("minute"), F.lit(None).cast("string").alias("file_name"), "path",
                     F.lit(None).cast("timestamp_ntz").alias("mtime"), F.lit(None).cast("long").alias("length"),
                     F.lit("dir").alias("entry"))
             .filter(F.col("minute").isNotNull()))
    entries = valid.unionByName(empty).checkpoint(eager=True)
    commits = mirror.commits(f"mirror_of_{src.name}")
    if not fsops.exists(spark, W.commit_path(commits, batch_id)) and entries.isEmpty():
        return {"mirrored": 0}
    # A path that a collapsed backlog lists again
    there = published_catalog(spark, mirror, MERGED_BASE, _minute_keys(valid)).select("stream", "minute", "file_name")
    entries = entries.join(there, ["stream", "minute", "file_name"], "left_anti").select(*entries.columns)
    now, entries = W.commit_of(spark, commits, batch_id, now, entries)
    entries = publish.commit_parts(entries, minutes_per_commit).checkpoint(eager=True)
    service, n = f"mirror_of_{src.name}", 0
    # O1: a stream's minutes become visible in order, some at a time; a crash leaves the earlier ones
    last = entries.agg(F.max("part")).first()[0]
    for part in range(0 if last is None else int(last) + 1):
        mine = entries.filter(F.col("part") == part).drop("part")
        valid = mine.filter(F.col("entry") == "file")
        committed = valid.select(F.lit(mirror.name).alias("cluster"), "base", "stream", "minute", "file_name",
                                 file_path(mirror, MERGED_BASE).alias("path"), _ts(now).alias("mtime"), "length")
        empty = mine.filter(F.col("entry") == "dir").select("stream", "minute").distinct().join(
            valid.select("stream", "minute"), ["stream", "minute"], "left_anti")
        if commitlog.is_committed(spark, mirror.base(MERGED_BASE), service, batch_id, part):
            n += committed.count()
        else:
            planned, keys = None, _minute_keys(valid)
            if keys:
                records = _with_records(spark, src, MERGED_BASE, valid, keys)
                planned = publish.plan_mirror(records.withColumn("base", F.lit(MERGED_BASE)), F.lit(mirror.name))
                planned = planned.drop("hour", "minute_key", "batch_id").withColumn("committed_at", _ts(now))
            n += _publish(spark, mirror, MERGED_BASE, service, batch_id, planned, committed, now, empty, part)
        state = F.when(F.col("entry") == "dir", "empty").otherwise("data")
        rows = mine.select(F.lit(mirror.name).alias("cluster"), "base", "stream", "minute", state.alias("state"),
                           _ts(now).alias("created_at")).groupBy("cluster", "base", "stream", "minute")
        rows = rows.agg(F.min("state").alias("state"), F.min("created_at").alias("created_at"))  # data before empty
        W.write_ledger_rows(spark, rows, mirror.ledger(), f"{MERGED_BASE}.{service}.{batch_id}.{part}")
    _acknowledge(spark, [src], batches)
    return {"mirrored": True, "mirrored_files": n}


def _hours_of(spark: SparkSession, site: Site) -> DataFrame:
    """``base, stream, hour_key`` of every hour that a site has, from its commit logs, catalog and ledger: no listing."""
    out = ranges.hours_of(W.read_ledger_ranges(spark, site.ledger()))
    for base in (LOCAL_BASE, MERGED_BASE):
        out = out.unionByName(commitlog.of(spark, site.base(base)).read().select(
            F.lit(base).alias("base"), "stream", F.date_format("minute", "yyyy-MM-dd-HH").alias("hour_key")))
    out = out.unionByName(W.read_table(spark, site.catalog(), W.CATALOG_SCHEMA).select(
        "base", "stream", F.col("hour").alias("hour_key")))
    return out.distinct()


def _purge_tables(spark: SparkSession, site: Site, purge: DataFrame) -> None:
    """Rows of the purged hours go from ledger, catalog and commit logs, by a new snapshot of each."""
    keys = ["base", "stream", "hour"]
    W.ledger_table(spark, site.ledger()).compact(lambda rows: ranges.without_purged(rows, purge))
    gone = purge.select("base", "stream", F.col("hour_key").alias("hour"))
    W.catalog_table(spark, site.catalog()).compact(lambda rows: rows.join(gone, keys, "left_anti"))
    for base in (LOCAL_BASE, MERGED_BASE):
        mine = purge.filter(F.col("base") == base).select("stream", "hour").distinct()
        commitlog.of(spark, site.base(base)).compact(
            lambda rows: rows.withColumn("hour", L.hour_of("minute")).join(mine, ["stream", "hour"], "left_anti").drop("hour"))


def remove_leftovers(spark: SparkSession, site: Site, base: str) -> int:
    """K1: partitions of batches that never got a commit record; nobody reads them.

    A stream has one service, which runs its batches one after the other, so a batch below the stream's
    last committed one is over.  The folders are listed by the executors.
    """
    table_dir = site.base(base)
    rows = commitlog.of(spark, table_dir).read().filter(F.col("state") == "data").checkpoint(eager=True)
    if rows.isEmpty() or not fsops.exists(spark, table_dir):
        return 0
    folders = catalog.list_folders(spark, table_dir, depth=2).filter(F.col("path").rlike("/batch_id=-?[0-9]+$"))
    there = folders.withColumn("folder", F.concat_ws("/", F.slice(F.split("path", "/"), -4, 4)))
    last = rows.groupBy(L.partition_folder("stream", "stream").alias("top")).agg(F.max("batch_id").alias("last"))
    there = there.withColumn("top", F.substring_index("folder", "/", 1)).join(last, "top")
    over = there.filter(F.regexp_extract("folder", r"batch_id=(-?\d+)$", 1).cast("long") < F.col("last"))
    return fsops.delete_paths(spark, over.join(commitlog.folders(rows), "folder", "left_anti").select("path"), site.root)


def remove_empty_folders(spark: SparkSession, top: str) -> int:
    """Folders without any entry go, whatever their age, and then those that held nothing else."""
    removed, n = 0, -1
    while n and fsops.exists(spark, top):
        place = [F.lit("").alias(c) for c in ("cluster", "base", "stream")]
        folders = catalog.list_folders(spark, top).select(*place, F.lit("folder").alias("level"), "path")
        files = catalog.list_files(spark, top, "").select(*place, F.lit("file").alias("level"), "path")
        empty = retention.empty_levels(folders.unionByName(files), levels=("folder",))
        n = sum(fsops.delete_if_empty(spark, r["path"]) for r in empty.toLocalIterator())
        removed += n
    return removed


def run_purge(spark: SparkSession, site: Site, now: str, retention_table: DataFrame,
              default_hours: int = DEFAULT_RETENTION_HOURS,
              trash_hours: int = DEFAULT_TRASH_RETENTION_HOURS) -> dict:
    """Drop hour partitions past retention from records, catalog and ledger, then what is left empty."""
    apply_session_settings(spark)
    hours = _hours_of(spark, site).select(
        F.lit(site.name).alias("cluster"), "base", "stream",
        L.ntz(F.try_to_timestamp("hour_key", F.lit("yyyy-MM-dd-HH"))).alias("hour"), "hour_key")
    purge = retention.purge_set(hours, retention_table, _ts(now), default_hours)
    purge = purge.join(hours.select("base", "stream", "hour", "hour_key"), ["base", "stream", "hour"]).checkpoint(eager=True)
    below = F.concat_ws("/", L.partition_folder("stream", "stream"), L.partition_folder("hour", "hour_key"))
    dropped = 0
    for base in (LOCAL_BASE, MERGED_BASE):
        mine = purge.filter(F.col("base") == base)
        dropped += fsops.delete_paths(spark, mine.select(F.concat_ws("/", F.lit(site.base(base)), below).alias("path")), site.root)
    if not purge.isEmpty():
        _purge_tables(spark, site, purge)
    for base in (LOCAL_BASE, MERGED_BASE):
        remove_leftovers(spark, site, base)
        remove_empty_folders(spark, site.base(base))
    # commit records of batches whose data is past the default retention
    oldest = _dt.datetime.fromisoformat(now) - _dt.timedelta(hours=default_hours)
    for service in fsops.subfolders(spark, f"{site.system}/commits"):
        d = site.commits(service)
        made = spark.read.schema("now string, batch_id bigint").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.parquet").parquet(*[f"{d}/{b}/now" for b in fsops.subfolders(spark, d)]) \
            if fsops.subfolders(spark, d) else None
        if made is None:
            continue
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(batch_id=-?\d+)/now/", 1)
        old = made.filter(F.col("now").cast("timestamp_ntz") < F.lit(oldest).cast("timestamp_ntz"))
        fsops.delete_paths(spark, old.select(F.concat_ws("/", F.lit(d), folder).alias("path")), site.root)
    # R2: trash hour directories past the trash retention (unparseable names are purged too), with their catalog
    trash_root = f"{site.system}/trash"
    dropped_trash = 0
    if fsops.exists(spark, trash_root):
        tp = retention.trash_purge_set(trash_dirs(spark, site.root, site.name), _ts(now), trash_hours).checkpoint(eager=True)
        dropped_trash = fsops.delete_paths(spark, tp.select(
            F.concat_ws("/", F.lit(trash_root), "day_dir", "hour_dir").alias("path")), site.root)
        fsops.delete_paths(spark, tp.select(F.concat_ws("/", F.lit(site.trash_catalog()), L.partition_folder(
            "trash_hour_key", F.concat_ws("-", "day_dir", "hour_dir"))).alias("path")), site.root)
        for row in tp.select(F.concat_ws("/", F.lit(trash_root), "day_dir").alias("path")).distinct().toLocalIterator():
            fsops.delete_if_empty(spark, row["path"])
    return {"dropped_hours": dropped, "dropped_trash_hours": dropped_trash}
