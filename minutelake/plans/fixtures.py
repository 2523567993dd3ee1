"""Scenario tables derived on Spark from the driver's ``events`` table.

The driver tables hold no file catalog, so one is derived: every
``(cluster, stream, collector, minute)`` of ``events`` is one collector file.
``hhmm`` (hour*100 + minute of the file's minute) drives deterministic damage:
``% 17`` removes files from the source side of an audit, ``% 19`` from the
destination side, ``% 23`` makes manifest paths dangle, ``% 29`` makes files late.
``NOW`` is fixed; no operator reads the clock.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layout as L
from ..functions.skew import small_table
from ..schemas import LOCAL_BASE, MERGED_BASE
from ..sources import catalog

NOW = "2024-01-31 00:00:00"
CHECKPOINT_BEFORE = "2024-01-15 00:00:00"

# Inline topology of the scenarios (fixed values).
SOURCES = [("click", "cluster1", 48), ("click", "cluster2", 72), ("view", "cluster1", 96),
           ("view", "cluster2", 96), ("error", "cluster2", 24)]
DESTINATIONS = [("click", "cluster1", True, 24), ("click", "cluster3", False, 120),
                ("view", "cluster2", True, 48), ("view", "cluster1", False, 48)]
MERGED_CLUSTER = "cluster1"
MIRROR_CLUSTER = "cluster3"


def now_col():
    return F.lit(NOW).cast("timestamp_ntz")


def root_of(cluster="cluster"):
    return F.concat(F.lit("/"), F.col(cluster))


class Scenario:
    """Lazily built scenario tables for one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def keyed_events(self) -> DataFrame:
        """events with their (cluster, stream, collector, minute) coordinates."""
        uid = F.col("user_id") % 3
        return self.events.select(
            F.when(uid == 2, F.lit("cluster2")).otherwise(F.lit("cluster1")).alias("cluster"),
            F.col("event_type").alias("stream"),
            F.concat(F.lit("collector"), uid.cast("string")).alias("collector"),
            L.minute_of("ts").alias("minute"), "ts", "props", "event_id")

    @cached_property
    def cat(self) -> DataFrame:
        """One row per collector file: cluster, stream, collector, minute, file_name,
        mtime, n_records, length, hhmm."""
        g = (self.keyed_events.groupBy("cluster", "stream", "collector", "minute")
             .agg(F.max("ts").alias("mtime"), F.count(F.lit(1)).alias("n_records"),
                  F.sum(F.length("props")).cast("long").alias("length")))
        return g.select("cluster", "stream", "collector", "minute",
                        L.collector_file_name("stream", "minute").alias("file_name"),
                        "mtime", "n_records", "length",
                        F.date_format("minute", "HHmm").cast("int").alias("hhmm"))

    # ---- listings as a file system would return them -------------------------------------
    @cached_property
    def collector_listing(self) -> DataFrame:
        return self.cat.select("cluster", L.collector_path(root_of(), "stream", "collector", "file_name")
                               .alias("path"), "mtime", "length")

    @cached_property
    def collector_files(self) -> DataFrame:
        return catalog.collector_files_from_listing(self.collector_listing)

    def published_listing(self, base: str, cluster_col, shift_minutes: int, where=None) -> DataFrame:
        cat = self.cat if where is None else self.cat.filter(where)
        m = L.plus_minutes("minute", shift_minutes)
        return cat.select(
            cluster_col.alias("cluster"), "stream",
            F.concat(F.lit("/"), cluster_col, F.lit(f"/{base}/"), F.col("stream"), F.lit("/"),
                     F.date_format(m, L.MINUTE_DIR_FORMAT), F.lit("/"),
                     L.published_name("collector", "file_name")).alias("path"),
            L.plus_minutes("mtime", shift_minutes).alias("mtime"), "length")

    @cached_property
    def local_files(self) -> DataFrame:
        """streams_local of every cluster, committed one minute after the file's minute."""
        return catalog.stream_files_from_listing(self.published_listing(LOCAL_BASE, F.col("cluster"), 1))

    def local_files_where(self, where) -> DataFrame:
        return catalog.stream_files_from_listing(self.published_listing(LOCAL_BASE, F.col("cluster"), 1, where))

    def merged_files_where(self, where) -> DataFrame:
        return catalog.stream_files_from_listing(
            self.published_listing(MERGED_BASE, F.lit(MERGED_CLUSTER), 2, where))

    @cached_property
    def merged_files(self) -> DataFrame:
        """The merged stream on MERGED_CLUSTER, committed two minutes after the file's minute."""
        return catalog.stream_files_from_listing(
            self.published_listing(MERGED_BASE, F.lit(MERGED_CLUSTER), 2))

    # ---- topology -------------------------------------------------------------------------
    @cached_property
    def sources(self) -> DataFrame:
        return small_table(self.spark, SOURCES, "stream string, cluster string, retention_hours int")

    @cached_property
    def destinations(self) -> DataFrame:
        return small_table(
            self.spark, DESTINATIONS, "stream string, cluster string, is_primary boolean, retention_hours int")

    @cached_property
    def topology_file(self) -> str:
        """A topology file derived from ``events``: every stream with the clusters that produced it as sources,
        kept 12 hours for each letter of the stream's name (the second cluster: the file's default, 30).

        A stream's last source is its primary destination (of streams with a name of 8 or 16 letters: it isn't primary, so
        they have none); its first one, if another, and ``MIRROR_CLUSTER`` are mirrors."""
        from ..session import ensure_checkpoint_dir
        source = F.concat(F.lit("<source><name>"), F.col("cluster"), F.lit("</name>"), F.when(
            F.col("cluster") == "cluster1", F.concat(F.lit("<retentioninhours>"), (12 * F.length("stream")).cast("string"),
                                                     F.lit("</retentioninhours>"))).otherwise(""), F.lit("</source>"))
        streams = self.cat.select("stream", "cluster").distinct().groupBy("stream").agg(
            F.array_join(F.sort_array(F.collect_list(source)), "").alias("sources"),  # a few clusters each
            F.min("cluster").alias("first"), F.max("cluster").alias("last"))

        def destination(cluster, primary=F.lit("")):
            return F.concat(F.lit("<destination><name>"), cluster, F.lit("</name>"), primary, F.lit("</destination>"))

        flag = F.concat(F.lit("<primary>"), (F.length("stream") % 8 != 0).cast("string"), F.lit("</primary>"))
        dests = F.concat(destination(F.col("last"), flag), destination(F.lit(MIRROR_CLUSTER)),
                         F.when(F.col("first") != F.col("last"), destination(F.col("first"))).otherwise(""))
        each = F.concat(F.lit('<stream name="'), "stream", F.lit('"><sources>'), "sources", F.lit("</sources><destinations>"),
                        dests, F.lit("</destinations></stream>"))
        streams = streams.agg(F.array_join(F.sort_array(F.collect_list(each)), "").alias("streams"))  # a configuration file
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/topology-{uuid.uuid4().hex}"
        streams.select(F.concat(
            F.lit("<topology><defaults><retentioninhours>30</retentioninhours></defaults><streams>"), "streams",
            F.lit("</streams></topology>")).alias("value")).write.text(path)
        return path

    # ---- ingest scenario --------------------------------------------------------------------
    @cached_property
    def dirty_files(self) -> DataFrame:
        """collector_files with in-flight names, stats files and empty files mixed in:
        minute-of-hour % 10 = 1 -> ``<stream>_current``; = 2 -> ``scribe_stats`` (upper case on
        odd hours); = 3 -> length 0."""
        m = F.minute("minute") % 10
        odd = F.hour("minute") % 2 == 1
        name = (F.when(m == 1, F.concat(F.col("stream"), F.lit("_current")))
                .when((m == 2) & odd, F.lit("SCRIBE_STATS"))
                .when(m == 2, F.lit("scribe_stats"))
                .otherwise(F.col("file_name")))
        df = self.cat.select("cluster", "stream", "collector", name.alias("file_name"), "mtime",
                             F.when(m == 3, F.lit(0).cast("long")).otherwise(F.col("length")).alias("length"))
        return catalog.collector_files_from_listing(df.select(
            "cluster", L.collector_path(root_of(), "stream", "collector", "file_name").alias("path"),
            "mtime", "length"))

    @cached_property
    def checkpoints(self) -> DataFrame:
        """Checkpoint = greatest file name of each collector before CHECKPOINT_BEFORE."""
        return (self.cat.filter(F.col("minute") < F.lit(CHECKPOINT_BEFORE).cast("timestamp_ntz"))
                .groupBy("cluster", "stream", "collector").agg(F.max("file_name").alias("file_name")))

    @cached_property
    def records(self) -> DataFrame:
        """Record grain: one line per event (value = props) in its collector file."""
        return self.keyed_events.select(
            "cluster", "stream", "collector",
            L.collector_file_name("stream", "minute").alias("src_file"), "minute",
            F.col("props").alias("value"), F.col("event_id").alias("record_no"))

    # ---- merged stream ledger and mirror copy -----------------------------------------------
    @cached_property
    def merged_minutes(self) -> DataFrame:
        from ..operators import audit
        return audit.minute_dirs(self.merged_files)

    @cached_property
    def merged_ledger(self) -> DataFrame:
        """Data minutes plus every gap minute marked empty (as the minute cadence leaves it)."""
        from ..operators import audit
        gaps = audit.missing_minutes(self.merged_minutes).select(
            "cluster", "base", "stream", "minute", F.lit("empty").alias("state"),
            L.plus_minutes("minute", 1).alias("created_at"))
        return self.merged_minutes.select("cluster", "base", "stream", "minute", "state", "created_at") \
            .unionByName(gaps)

    @cached_property
    def merged_entries(self) -> DataFrame:
        from ..operators import audit
        return audit.stream_entries(self.merged_files, self.merged_ledger)

    @cached_property
    def mirror_entries(self) -> DataFrame:
        """The mirror on MIRROR_CLUSTER: merged entries minus files at hhmm % 19 = 0 and empty
        minutes at hhmm % 97 = 0, plus a second copy one minute later of files at hhmm % 31 = 0."""
        hhmm = F.date_format("minute", "HHmm").cast("int")
        e = self.merged_entries.withColumn("cluster", F.lit(MIRROR_CLUSTER))
        kept = e.filter(~(((F.col("entry") == "file") & (hhmm % 19 == 0)) |
                          ((F.col("entry") == "dir") & (hhmm % 97 == 0))))
        nxt = L.plus_minutes("minute", 1)
        fname = F.element_at(F.split("relpath", "/"), -1)
        replay = (e.filter((F.col("entry") == "file") & (hhmm % 31 == 0))
                  .select("cluster", "base", "stream", nxt.alias("minute"),
                          F.concat(F.date_format(nxt, L.MINUTE_DIR_FORMAT), F.lit("/"), fname).alias("relpath"),
                          "entry", "path"))
        return kept.unionByName(replay)

    # ---- local audit: data dir keeps the last 6 files, the rest went to trash ----------------
    @cached_property
    def trashed(self) -> DataFrame:
        from ..operators import ingest
        return ingest.trash_select(self.collector_files)

    @cached_property
    def trash(self) -> DataFrame:
        """Trash entries, trashed by the run one minute after the file's mtime."""
        t = self.trashed.withColumn("__ts", L.plus_minutes("mtime", 1))
        name = L.trash_name("collector", "file_name")
        return t.select("cluster", L.hour_of("__ts").alias("trash_hour"), "stream", "collector",
                        name.alias("file_name"),
                        F.concat_ws("/", root_of(), F.lit("system/trash"), L.trash_dir("__ts"), name).alias("path"))

    @cached_property
    def data_dir_files(self) -> DataFrame:
        return self.collector_files.join(self.trashed.select("path"), "path", "left_anti")

    @cached_property
    def local_audit_dest(self) -> DataFrame:
        """streams_local minus files at hhmm % 17 = 0, plus cluster1's files at hhmm % 37 = 0
        replayed into cluster2."""
        base = self.local_files_where(F.col("hhmm") % 17 != 0)
        rep = self.local_files_where((F.col("hhmm") % 37 == 0) & (F.col("cluster") == "cluster1")) \
            .withColumn("cluster", F.lit("cluster2"))
        return base.unionByName(rep)

    @cached_property
    def trash_dirs(self) -> DataFrame:
        """Trash hour directories; hour 13 directories carry an unparseable name."""
        t = self.trash.select("cluster", "trash_hour").distinct()
        hour = L.trash_hour_string("trash_hour")
        return t.select("cluster", L.trash_day("trash_hour").alias("day_dir"),
                        F.when(F.hour("trash_hour") == 13, F.concat(hour, F.lit("x"))).otherwise(hour)
                        .alias("hour_dir"))

    # ---- manifests --------------------------------------------------------------------------
    @cached_property
    def manifests(self) -> DataFrame:
        """Merge manifests of the local files, batch = hhmm % 3, rows at hhmm % 5 = 0 listed
        again in batch 2, rows at hhmm % 7 = 0 with a trailing blank."""
        from ..operators import route
        edges = route.merge_edges(self.sources, self.destinations)
        lf = self.local_files.withColumn("hhmm", F.date_format(L.plus_minutes("minute", -1), "HHmm").cast("int"))
        m = route.route_merge(lf, edges, batch_id=(F.col("hhmm") % 3).cast("long")).withColumn(
            "hhmm", F.date_format(L.plus_minutes("minute", -1), "HHmm").cast("int"))
        again = m.filter(F.col("hhmm") % 5 == 0).withColumn("batch_id", F.lit(2).cast("long"))
        out = m.unionByName(again).withColumn(
            "path", F.when(F.col("hhmm") % 7 == 0, F.concat("path", F.lit(" "))).otherwise(F.col("path")))
        return out.drop("hhmm")

    @cached_property
    def manifest_acks(self) -> DataFrame:
        return self.manifests.select("kind", "dest_cluster").distinct().withColumn("batch_id", F.lit(0).cast("long"))

    @cached_property
    def committed_local(self) -> DataFrame:
        """Local files that exist: commits at hhmm % 23 = 0 failed, so their manifest paths dangle."""
        return self.local_files_where(F.col("hhmm") % 23 != 0)

    # ---- directory levels for the empty-level purge rule ---------------------------------------
    @cached_property
    def level_dirs(self) -> DataFrame:
        """year/month/day/hour directories of streams_local, plus an empty month ``2024/02``
        and an empty-or-not day ``2024/01/31`` in every stream."""
        prefix = F.concat(F.lit("/"), F.col("cluster"), F.lit("/"), F.col("base"), F.lit("/"), F.col("stream"),
                          F.lit("/"))
        parts = [("year", F.date_format("minute", "yyyy")), ("month", F.date_format("minute", "yyyy/MM")),
                 ("day", F.date_format("minute", "yyyy/MM/dd")), ("hour", F.date_format("minute", "yyyy/MM/dd/HH")),
                 ("month", F.lit("2024/02")), ("day", F.lit("2024/01/31"))]
        # one pass over the catalog: every file row yields its ancestor directories
        levels = F.array(*[F.struct(F.lit(lv).alias("level"), F.concat(prefix, p).alias("path")) for lv, p in parts])
        return (self.local_files.select("cluster", "base", "stream", F.explode(levels).alias("d"))
                .select("cluster", "base", "stream", "d.level", "d.path").distinct())
