"""Structured Streaming entry points.

* ``ingest``: a landing directory that receives *closed* collector files by atomic rename (C16).  The
  ``collectors`` stream source gives each batch the files that are new; ``foreachBatch`` publishes them into
  its commit minute, appends ledger rows and manifests.  The offsets in ``checkpointLocation`` play the
  reference's checkpoint, ``archive_dir`` its trash.
* ``local``: the same source over growing collector folders, whose offset is the checkpoint: each trigger
  runs :func:`plans.run.run_local` on the closed files it gives, also when there are none.
* ``merge`` / ``mirror``: the other minute services.  A clock source triggers one ``plans.run`` per interval,
  so routing, ledger, idle minutes, manifests and order are those of the batch runs.
* ``late_files``: T6 as keyed state: files that arrive below their collector's last delivered name.
* ``minute_rollup``: event-time twin of the minute bucket with a watermark.
* ``dedupe``: replay removal within the watermark.

A batch's commit minute and its selection are recorded before anything of it is written, so a batch
replayed after a failure, at whatever time, rewrites the same partitions with the same rows, and readers
see it by its commit record only (exactly-once output on top of at-least-once delivery).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import layout as L
from ..operators import publish, ranges
from ..plans import run as R
from ..schemas import DATA_BASE, IN_FLIGHT_SUFFIX, LAST_FILE_TIMEOUT_MS, LOCAL_BASE, MERGED_BASE, STATS_FILE_NAME
from ..session import apply_session_settings
from ..sinks import commitlog
from ..sinks import files as fsops
from ..sinks import writers as W
from ..sources import listing
from ..sources.records import read_selected
from .late import LATE, LateFiles


def utc_minute() -> str:
    """Commit time of a trigger: the processing-time minute."""
    return _dt.datetime.now(_dt.timezone.utc).replace(second=0, microsecond=0, tzinfo=None).isoformat(sep=" ")


def _start(df: DataFrame, fn, checkpoint: str, trigger: dict | None, name: str | None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"processingTime": "1 minute"}))
    return w.start()


def _plain(files: DataFrame, cluster: str) -> DataFrame:
    """The rows of the ``collectors`` source as collector files, with ``fresh``."""
    return files.select(F.lit(cluster).alias("cluster"), "stream", "collector", "file_name", L.one_slash("path").alias("path"),
                        L.ntz("mtime").alias("mtime"), "length", "fresh")


def ingest(spark: SparkSession, landing_dir: str, cluster: str, out_table: str, ledger_dir: str,
           checkpoint: str, archive_dir: str | None = None, trigger: dict | None = None,
           clock: Callable[[], str] = utc_minute,
           on_batch: Callable[[DataFrame, int], None] | None = None,
           manifest_dir: str | None = None, sources: DataFrame | None = None,
           destinations: DataFrame | None = None, root: str | None = None,
           include_mirrors: bool = False, commits_dir: str | None = None,
           catalog_dir: str | None = None) -> StreamingQuery:
    """Landing dir ``<stream>/<collector>/<file>`` -> local stream table.

    Any name may arrive in any order; names that the collector filter (F1) leaves alone stay.  With
    ``manifest_dir`` and the topology, each batch also appends the merge manifests of the files it
    published (K4), keyed by the batch id; with ``catalog_dir`` the commit catalog that merges and audits
    read.  ``commits_dir`` (default: in the checkpoint) keeps the commit minute and the files of each batch;
    ``archive_dir`` takes files once they are published.
    """
    apply_session_settings(spark)
    files = listing.collector_stream(spark, fsops.qualified(spark, landing_dir), "any", None, IN_FLIGHT_SUFFIX, STATS_FILE_NAME, ticks=False)
    commits = commits_dir or f"{checkpoint}/commit_minutes"

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        minute, selected = W.commit_of(spark, commits, batch_id, clock(), _plain(df, cluster).filter("fresh").drop("fresh"))
        now = F.lit(minute).cast("timestamp_ntz")
        name = L.published_name("collector", "file_name")
        files = selected.select(F.lit(cluster).alias("cluster"), F.lit(LOCAL_BASE).alias("base"), "stream",
                                L.minute_of(now).alias("minute"), name.alias("file_name"), now.alias("mtime"), "length")
        files = files.withColumn("path", F.concat_ws("/", F.lit(root or ""), "base", "stream", F.date_format(
            "minute", L.MINUTE_DIR_FORMAT), "file_name")).checkpoint(eager=True)
        staging = f"{checkpoint}/staging/{batch_id}"
        planned = None
        if not commitlog.is_committed(spark, out_table, "ingest", batch_id):
            commitlog.of(spark, out_table).open()
            records = read_selected(spark, landing_dir, selected, cluster, staging)
            planned = publish.plan_local(records, now).withColumn("committed_at", now)
            W.write_published(planned, out_table, batch_id)
            rows = files.groupBy("stream", "minute").agg(F.count("*").alias("n_files"), F.lit(None).cast("long").alias("n_records"))
            if catalog_dir is not None:
                W.write_catalog(files, catalog_dir, batch_id, f"{LOCAL_BASE}.ingest.{batch_id}")
            commitlog.commit(spark, out_table, "ingest", batch_id, rows.withColumn("state", F.lit("data")), now)
            fsops.delete_path(spark, staging)
        minutes = files.select("cluster", "base", "stream", "minute").distinct().withColumn(
            "state", F.lit("data")).withColumn("created_at", now)
        # T5: idle minutes since the previous batch (no trigger fires without new files)
        known = W.read_ledger_ranges(spark, ledger_dir).filter(F.col("base") == LOCAL_BASE)
        W.write_ledger_rows(spark, ranges.of_minutes(minutes).unionByName(ranges.gap_ranges(known, now)), ledger_dir, f"{LOCAL_BASE}.ingest.{batch_id}")
        if manifest_dir is not None and sources is not None and destinations is not None:
            from ..operators import route
            m = route.route_merge(files, route.merge_edges(sources, destinations, include_mirrors),
                                  batch_id=F.lit(batch_id).cast("long"))
            W.append_manifests(m, manifest_dir)
        if on_batch:
            on_batch(planned, batch_id)
        if archive_dir is not None:
            below = F.concat_ws("/", F.lit(archive_dir), "stream", "collector", "file_name")
            fsops.move_files(spark, selected.select(F.col("path").alias("src"), below.alias("dst")), archive_dir)

    return _start(files, batch, checkpoint, trigger, None)


def _first_batch(spark: SparkSession, site: R.Site, service: str, base: str, checkpoint: str) -> int:
    """Offset of a service's batch ids, kept with its checkpoint: above every batch the site has.

    A service started with a new checkpoint so never takes an old batch for its own.
    """
    path = f"{checkpoint}/first_batch"
    if not fsops.exists(spark, f"{path}/_SUCCESS"):
        made = [int(x.removeprefix("batch_id=")) for x in fsops.subfolders(spark, site.commits(service))]
        last = W.read_table(spark, site.catalog(), W.CATALOG_SCHEMA).filter(F.col("base") == base).agg(F.max("batch_id")).first()[0]
        first = max([-1, *made, -1 if last is None else last]) + 1
        spark.createDataFrame([(first,)], "first bigint").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("first bigint").parquet(path).first()[0]


def _service(spark: SparkSession, run: Callable[[str, int], dict], site: R.Site, service: str, base: str, checkpoint: str,
             trigger: dict | None, clock: Callable[[], str], on_run: Callable[[dict], None] | None) -> StreamingQuery:
    apply_session_settings(spark)
    first = _first_batch(spark, site, service, base, checkpoint)
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()

    def batch(_: DataFrame, batch_id: int) -> None:
        out = run(clock(), first + batch_id)
        if on_run:
            on_run(out)

    return _start(ticks, batch, f"{checkpoint}/ticks", trigger, None)


def _marks(spark: SparkSession, site: R.Site) -> dict[str, str]:
    """The site's checkpoint as the offset a new query starts from: one entry for each collector."""
    rows = W.read_checkpoints(spark, site.checkpoints()).filter(F.col("cluster") == site.name).select("stream", "collector", "file_name")
    return {f"{r[0]}/{r[1]}": r[2] for r in rows.collect()}


def local(spark: SparkSession, site: R.Site, sources: DataFrame, destinations: DataFrame, checkpoint: str,
          trigger: dict | None = None, clock: Callable[[], str] = utc_minute,
          on_run: Callable[[dict], None] | None = None, timeout_ms: int = LAST_FILE_TIMEOUT_MS,
          source_clock: Callable[[], float] | None = None, **options) -> StreamingQuery:
    """T1/S7 as a minute service over the collector folders (:func:`plans.run.run_local`).

    The stream's offset is the per-collector checkpoint; its planner applies F1, F2 and F3 and only collectors
    with something new are listed by the executors.  A tick comes with each trigger, so idle minutes are
    recorded too.  ``source_clock`` (seconds; it runs in the source's own process) decides which files are idle.
    """
    apply_session_settings(spark)
    first = _first_batch(spark, site, "local", LOCAL_BASE, checkpoint)
    fsops.make_folder(spark, site.base(DATA_BASE))
    files = listing.collector_stream(spark, fsops.qualified(spark, site.base(DATA_BASE)), "name", timeout_ms, IN_FLIGHT_SUFFIX,
                                     STATS_FILE_NAME, _marks(spark, site), clock=source_clock)

    def batch(df: DataFrame, batch_id: int) -> None:
        out = R.run_local(df.sparkSession, site, clock(), first + batch_id, sources, destinations, timeout_ms,
                          closed=_plain(df, site.name), **options)
        if on_run:
            on_run(out)

    return _start(files, batch, f"{checkpoint}/ticks", trigger, None)


def merge(spark: SparkSession, src_sites: list[R.Site], dest: R.Site, sources: DataFrame, destinations: DataFrame,
          checkpoint: str, trigger: dict | None = None, clock: Callable[[], str] = utc_minute,
          on_run: Callable[[dict], None] | None = None) -> StreamingQuery:
    """T2 as a minute service: routed manifests, ledger, gaps and mirror manifests (:func:`plans.run.run_merge`)."""
    return _service(spark, lambda now, n: R.run_merge(spark, src_sites, dest, now, n, sources, destinations), dest,
                    "merge", MERGED_BASE, checkpoint, trigger, clock, on_run)


def mirror(spark: SparkSession, src: R.Site, mirror_site: R.Site, checkpoint: str, trigger: dict | None = None,
           clock: Callable[[], str] = utc_minute, on_run: Callable[[dict], None] | None = None) -> StreamingQuery:
    """T3 as a minute service: minutes preserved, empty ones included (:func:`plans.run.run_mirror`)."""
    return _service(spark, lambda now, n: R.run_mirror(spark, src, mirror_site, now, n), mirror_site,
                    f"mirror_of_{src.name}", MERGED_BASE, checkpoint, trigger, clock, on_run)


def minute_rollup(events: DataFrame, watermark: str = "2 minutes") -> DataFrame:
    """T4 event-time twin: per stream and 1-minute tumbling window, record count and bytes.

    ``ts`` is ``TIMESTAMP_NTZ`` in the driver tables; watermarks need ``TIMESTAMP``
    (C17), so it is cast with the session time zone pinned to UTC.
    """
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return (e.groupBy(F.col("event_type").alias("stream"), F.window("ts", "1 minute"))
            .agg(F.count(F.lit(1)).alias("n_records"), F.sum(F.length("props")).cast("long").alias("n_bytes"))
            .select("stream", L.ntz(F.col("window.start")).alias("minute"), "n_records", "n_bytes"))


def dedupe(records: DataFrame, keys: list[str], event_time: str = "ts", watermark: str = "10 minutes") -> DataFrame:
    """T9 streaming: drop replays of the same record key within the watermark."""
    r = records.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, watermark)
    return r.dropDuplicatesWithinWatermark(keys)


def late_files(files: DataFrame) -> DataFrame:
    """T6 as keyed state: files of a stream (``stream, collector, file_name``) that came late, with the last name before them.

    The state of a collector is one name; it needs the RocksDB state store.
    """
    return files.groupBy("stream", "collector").transformWithStateInPandas(
        statefulProcessor=LateFiles(), outputStructType=LATE, outputMode="append", timeMode="none")
