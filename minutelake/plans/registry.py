"""Registered queries: one per operator key of the inventory, each with its DuckDB twin.

Every query reads the driver's tables (through ``fixtures.Scenario``) and runs
the package's operators on the derived catalog; the oracle recomputes the same
relation in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layout as L
from ..operators import audit, digests, ingest, publish, ranges, retention, route
from ..sinks import commitlog
from ..sources import catalog, topology
from . import jobs
from .fixtures import MIRROR_CLUSTER, Scenario, now_col, root_of
from .oracle import NOW as SQL_NOW
from .oracle import classify_sql, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Callable[[Scenario], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: fn(Scenario(spark, sf_dir))
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- scans
@register("collector_files", sql("SELECT cluster, stream, collector, file_name, path, mtime, length FROM cf", "cf"))
def q_collector_files(s: Scenario) -> DataFrame:
    return s.collector_files


@register("stream_files", sql("""
SELECT cluster, base, stream, minute, file_name, path, mtime, length FROM lf
UNION ALL SELECT cluster, base, stream, minute, file_name, path, mtime, length FROM mf""", "lf", "mf"))
def q_stream_files(s: Scenario) -> DataFrame:
    return s.local_files.unionByName(s.merged_files)


# ---------------------------------------------------------------- audits (J7, flagship)
@register("audit_merge", sql(
    "src AS (SELECT stream, file_name AS key, path FROM lf WHERE hhmm % 17 <> 0), "
    "dst AS (SELECT stream, file_name AS key, path FROM mf WHERE hhmm % 19 <> 0), "
    + classify_sql("src", "dst", ["stream"]).lstrip(), "lf", "mf", local_ctes=True))
def q_audit_merge(s: Scenario) -> DataFrame:
    return audit.audit_merge(s.local_files_where(F.col("hhmm") % 17 != 0),
                             s.merged_files_where(F.col("hhmm") % 19 != 0))


def with_classify(prefix: str, src: str, dst: str, group: list[str], *needs: str) -> str:
    return sql(prefix.strip().rstrip(",") + ",\n" + classify_sql(src, dst, group).lstrip(), *needs, local_ctes=True)


FOUR_HOURS_MS = 4 * 3600 * 1000


# ---------------------------------------------------------------- projections and scalars
@register("published_name", sql(
    "SELECT cluster, stream, collector, file_name, concat(collector, '-', file_name, '.gz') AS published_name FROM cf",
    "cf"))
def q_published_name(s: Scenario) -> DataFrame:
    return s.collector_files.select("cluster", "stream", "collector", "file_name",
                                    L.published_name("collector", "file_name").alias("published_name"))


@register("minute_path", sql(f"""
SELECT DISTINCT cluster, stream, minute,
       strftime(minute, '%Y/%m/%d/%H/%M/') AS minute_path, strftime(minute, '%Y/%m/%d/%H/') AS hour_path,
       concat('/', cluster, '/streams_local/', stream, '/', strftime(minute, '%Y/%m/%d/%H/%M/')) AS local_dest_dir,
       concat('/', cluster, '/streams/', stream, '/', strftime(minute, '%Y/%m/%d/%H/%M/')) AS final_dest_dir,
       concat('/', cluster, '/streams/', stream, '/', strftime(minute, '%Y/%m/%d/%H/')) AS final_dest_dir_till_hour,
       concat(stream, '/', strftime(minute, '%Y/%m/%d/%H/%M/')) AS relative_dest_dir
FROM cat""", "cat"))
def q_minute_path(s: Scenario) -> DataFrame:
    root = root_of()
    return s.cat.select(
        "cluster", "stream", "minute",
        L.minute_path("minute").alias("minute_path"), L.hour_path("minute").alias("hour_path"),
        L.dest_dir(root, "streams_local", F.col("stream"), "minute").alias("local_dest_dir"),
        L.dest_dir(root, "streams", F.col("stream"), "minute").alias("final_dest_dir"),
        L.dest_dir_till_hour(root, "streams", F.col("stream"), "minute").alias("final_dest_dir_till_hour"),
        L.relative_dest_dir("stream", "minute").alias("relative_dest_dir")).distinct()


@register("parse_minute", sql(r"""
SELECT path, try_strptime(regexp_extract(path, '/(\d{4}/\d\d/\d\d/\d\d/\d\d)(/.*)?$', 1), '%Y/%m/%d/%H/%M') AS minute
FROM (SELECT path FROM lf UNION ALL SELECT path FROM cf
      UNION ALL SELECT regexp_replace(path, '/[^/]+$', '') FROM lf)""", "lf", "cf"))
def q_parse_minute(s: Scenario) -> DataFrame:
    paths = (s.local_files.select("path")
             .unionByName(s.collector_files.select("path"))
             .unionByName(s.local_files.select(F.regexp_replace("path", "/[^/]+$", "").alias("path"))))
    return paths.select("path", L.parse_minute("path").alias("minute"))


@register("stream_from_name", sql("""
SELECT name, CASE WHEN length(name) > 1 AND contains(name, '-')
                  THEN list_filter(string_split(name, '-'), lambda x: x <> '')[2] END AS stream
FROM (SELECT file_name AS name FROM lf UNION ALL SELECT file_name FROM dirty)""", "lf", "dirty"))
def q_stream_from_name(s: Scenario) -> DataFrame:
    names = s.local_files.select(F.col("file_name").alias("name")).unionByName(
        s.dirty_files.select(F.col("file_name").alias("name")))
    return names.select("name", L.stream_from_name("name").alias("stream"))


@register("event_minute", sql(r"""
SELECT file_name,
       try_strptime(regexp_extract(file_name, '-(\d{4}-\d\d-\d\d-\d\d-\d\d)_\d+$', 1), '%Y-%m-%d-%H-%M')
         AS event_minute,
       strftime(try_strptime(regexp_extract(file_name, '-(\d{4}-\d\d-\d\d-\d\d-\d\d)_\d+$', 1),
                             '%Y-%m-%d-%H-%M'), '%Y-%m-%d-%H-%M') AS event_minute_str,
       date_trunc('minute', mtime) AS mtime_minute,
       make_timestamp(year(mtime), month(mtime), 1 + (minute(mtime) + day(mtime)) % 28, hour(mtime), minute(mtime), 0) AS made_time
FROM dirty""", "dirty"))
def q_event_minute(s: Scenario) -> DataFrame:
    em = L.event_minute("file_name")
    return s.dirty_files.select("file_name", em.alias("event_minute"),
                                L.file_time_string(em).alias("event_minute_str"),
                                L.minute_of("mtime").alias("mtime_minute"),
                                L.make_time(F.date_format("mtime", "y"), F.date_format("mtime", "M"),
                                            1 + (F.minute("mtime") + F.dayofmonth("mtime")) % 28, F.hour("mtime"),
                                            F.minute("mtime")).alias("made_time"))


@register("trash_bucket", sql("""
SELECT cluster, stream, collector, file_name, strftime(mtime, '%Y-%-m-%-d') AS trash_day,
       strftime(mtime, '%-H') AS trash_hour, strftime(mtime, '%Y-%-m-%-d/%-H') AS trash_dir,
       date_trunc('hour', mtime) AS trash_hour_ts, concat(collector, '-', file_name) AS trash_name,
       strftime(mtime, '%Y-%-m-%-d-%-H') AS trash_day_hour
FROM closed_5m""", "closed_5m"))
def q_trash_bucket(s: Scenario) -> DataFrame:
    closed = ingest.closed_files(s.dirty_files, now_col())
    return closed.select("cluster", "stream", "collector", "file_name",
                         L.trash_day("mtime").alias("trash_day"), L.trash_hour_string("mtime").alias("trash_hour"),
                         L.trash_dir("mtime").alias("trash_dir"), L.hour_of("mtime").alias("trash_hour_ts"),
                         L.trash_name("collector", "file_name").alias("trash_name"),
                         L.day_hour_string("mtime").alias("trash_day_hour"))


@register("discover_streams", sql(
    "SELECT cluster, stream, collector, count(*) AS n_files FROM cf GROUP BY 1, 2, 3", "cf"))
def q_discover_streams(s: Scenario) -> DataFrame:
    return catalog.collectors(s.collector_files)


# ---------------------------------------------------------------- ingest selection
_CF_COLS = "cluster, stream, collector, file_name, path, mtime, length"


@register("collector_filter", sql(f"SELECT {_CF_COLS} FROM named", "named"))
def q_collector_filter(s: Scenario) -> DataFrame:
    return ingest.collector_filter(s.dirty_files)


@register("nonempty_files", sql(f"SELECT {_CF_COLS} FROM named WHERE length > 0", "named"))
def q_nonempty_files(s: Scenario) -> DataFrame:
    return ingest.nonempty(ingest.collector_filter(s.dirty_files))


@register("closed_files", sql(f"SELECT {_CF_COLS} FROM closed_4h", "closed_4h"))
def q_closed_files(s: Scenario) -> DataFrame:
    return ingest.closed_files(s.dirty_files, now_col(), FOUR_HOURS_MS)


@register("above_checkpoint", sql(f"SELECT {_CF_COLS} FROM above", "above"))
def q_above_checkpoint(s: Scenario) -> DataFrame:
    return ingest.above_checkpoint(ingest.closed_files(s.dirty_files, now_col()), s.checkpoints)


@register("checkpoint_advance", sql("""
SELECT cluster, stream, collector, greatest(o.file_name, n.file_name) AS file_name
FROM ckpt o FULL OUTER JOIN (SELECT cluster, stream, collector, max(file_name) AS file_name FROM closed_5m GROUP BY 1, 2, 3) n
USING (cluster, stream, collector)""", "ckpt", "closed_5m"))
def q_checkpoint_advance(s: Scenario) -> DataFrame:
    return jobs.plan_ingest(s.dirty_files, s.checkpoints, now_col()).checkpoints


@register("trash_select", sql(f"""
SELECT {_CF_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY cluster, stream, collector ORDER BY file_name DESC) AS rn
                        FROM closed_5m) WHERE rn > 6""", "closed_5m"))
def q_trash_select(s: Scenario) -> DataFrame:
    return ingest.trash_select(ingest.closed_files(s.dirty_files, now_col()))


@register("late_files", sql(f"""
SELECT c.cluster, c.stream, c.collector, c.file_name, c.path, c.mtime, c.length
FROM closed_5m c JOIN ckpt k ON c.cluster = k.cluster AND c.stream = k.stream AND c.collector = k.collector
WHERE c.file_name <= k.file_name
  AND NOT EXISTS (SELECT 1 FROM lf WHERE lf.hhmm % 29 <> 0 AND lf.cluster = c.cluster AND lf.stream = c.stream
                                     AND lf.file_name = concat(c.collector, '-', c.file_name, '.gz'))""",
    "closed_5m", "ckpt", "lf"))
def q_late_files(s: Scenario) -> DataFrame:
    closed = ingest.closed_files(s.dirty_files, now_col())
    return ingest.late_files(closed, s.checkpoints, s.local_files_where(F.col("hhmm") % 29 != 0))


# ---------------------------------------------------------------- record grain
def _new_records(s: Scenario) -> DataFrame:
    plan = jobs.plan_ingest(s.dirty_files, s.checkpoints, now_col())
    return ingest.records_of(s.records, plan.new_files)


def _published_local(s: Scenario) -> DataFrame:
    return publish.plan_local(_new_records(s), jobs.commit_minute_after(F.col("minute")))


_PUB_COLS = "cluster, base, stream, minute, file_name, collector, src_file, value, record_no"


@register("read_records", sql("SELECT * FROM new_rec", "new_rec"))
def q_read_records(s: Scenario) -> DataFrame:
    return _new_records(s)


@register("publish_local", sql(f"SELECT {_PUB_COLS} FROM pub_local", "pub_local"))
def q_publish_local(s: Scenario) -> DataFrame:
    return _published_local(s)


@register("commit_ledger", sql("""
SELECT cluster, base, stream, minute, count(DISTINCT file_name) AS n_files, count(*) AS n_records
FROM pub_local GROUP BY 1, 2, 3, 4""", "pub_local"))
def q_commit_ledger(s: Scenario) -> DataFrame:
    return publish.commit_ledger(_published_local(s))


@register("ingest_once", sql(f"""
SELECT cluster, 'streams_local' AS base, stream, {SQL_NOW} AS minute, concat(collector, '-', src_file, '.gz') AS file_name,
       count(*) AS n_records
FROM new_rec GROUP BY 1, 2, 3, 4, 5""", "new_rec"))
def q_ingest_once(s: Scenario) -> DataFrame:
    plan = jobs.plan_ingest(s.dirty_files, s.checkpoints, now_col())
    out = jobs.ingest_records(plan, s.records, now_col())
    return out.groupBy("cluster", "base", "stream", "minute", "file_name").agg(F.count(F.lit(1)).alias("n_records"))


@register("merge_publish", sql(f"SELECT {_PUB_COLS} FROM pub_merge", "pub_merge"))
def q_merge_publish(s: Scenario) -> DataFrame:
    return jobs.merge_records(_published_local(s), s.sources, s.destinations,
                              jobs.commit_minute_after(F.col("minute")))


@register("mirror_publish", sql(f"""
SELECT e.dest_cluster AS cluster, m.base, m.stream, m.minute, m.file_name, m.collector, m.src_file, m.value, m.record_no
FROM pub_merge m JOIN redges e ON m.stream = e.stream AND m.cluster = e.src_cluster""", "pub_merge", "redges"))
def q_mirror_publish(s: Scenario) -> DataFrame:
    merged = jobs.merge_records(_published_local(s), s.sources, s.destinations,
                                jobs.commit_minute_after(F.col("minute")))
    return jobs.mirror_records(merged, s.sources, s.destinations)


@register("minute_rollup", sql("""
SELECT event_type AS stream, date_trunc('minute', ts) AS minute, count(*) AS n_records,
       CAST(sum(length(props)) AS BIGINT) AS n_bytes
FROM events GROUP BY 1, 2"""))
def q_minute_rollup(s: Scenario) -> DataFrame:
    return (s.events.groupBy(F.col("event_type").alias("stream"), L.minute_of("ts").alias("minute"))
            .agg(F.count(F.lit(1)).alias("n_records"), F.sum(F.length("props")).cast("long").alias("n_bytes")))


@register("dedupe_replay", sql("""
SELECT DISTINCT * FROM (SELECT * FROM rec UNION ALL
  SELECT * FROM rec WHERE CAST(strftime(minute, '%H%M') AS INT) % 29 = 0)""", "rec"))
def q_dedupe_replay(s: Scenario) -> DataFrame:
    replay = s.records.filter(F.date_format("minute", "HHmm").cast("int") % 29 == 0)
    return ingest.dedupe_replay(s.records.unionByName(replay))


# ---------------------------------------------------------------- minutes
@register("minute_dirs", sql(
    "SELECT cluster, base, stream, minute, 'data' AS state, created_at, n_files FROM ldm", "ldm"))
def q_minute_dirs(s: Scenario) -> DataFrame:
    return audit.minute_dirs(s.local_files)


@register("latest_minute", sql(
    "SELECT cluster, base, stream, max(minute) AS latest_minute FROM lf GROUP BY 1, 2, 3", "lf"))
def q_latest_minute(s: Scenario) -> DataFrame:
    return publish.latest_minute(s.local_files)


@register("publish_missing", sql(f"""
SELECT c.cluster, c.base, c.stream, c.minute, 'empty' AS state, {SQL_NOW} AS created_at
FROM (SELECT cluster, base, stream,
             unnest(generate_series(latest, {SQL_NOW} - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS minute
      FROM (SELECT cluster, base, stream, max(minute) AS latest FROM lf GROUP BY 1, 2, 3)
      WHERE latest <= {SQL_NOW} - INTERVAL 1 MINUTE) c
WHERE NOT EXISTS (SELECT 1 FROM lf WHERE lf.cluster = c.cluster AND lf.base = c.base AND lf.stream = c.stream
                                     AND lf.minute = c.minute)""", "lf"))
def q_publish_missing(s: Scenario) -> DataFrame:
    return publish.gap_minutes(audit.minute_dirs(s.local_files), now_col())


@register("missing_ranges", sql("""
SELECT cluster, base, stream, minute + INTERVAL 1 MINUTE AS gap_start, nm - INTERVAL 1 MINUTE AS gap_end,
       date_diff('minute', minute, nm) - 1 AS n_minutes
FROM (SELECT *, lead(minute) OVER (PARTITION BY cluster, base, stream ORDER BY minute) AS nm FROM ldm)
WHERE nm > minute + INTERVAL 1 MINUTE""", "ldm"))
def q_missing_ranges(s: Scenario) -> DataFrame:
    return audit.missing_ranges(audit.minute_dirs(s.local_files))


@register("missing_minutes", sql("""
SELECT cluster, base, stream,
       unnest(generate_series(minute + INTERVAL 1 MINUTE, nm - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS minute
FROM (SELECT *, lead(minute) OVER (PARTITION BY cluster, base, stream ORDER BY minute) AS nm FROM ldm)
WHERE nm > minute + INTERVAL 1 MINUTE""", "ldm"))
def q_missing_minutes(s: Scenario) -> DataFrame:
    return audit.missing_minutes(audit.minute_dirs(s.local_files))


def _skewed_minutes(s: Scenario) -> DataFrame:
    d = audit.minute_dirs(s.local_files)
    return d.withColumn("created_at", F.when(F.minute("minute") % 10 == 0,
                                             F.col("created_at") + F.make_dt_interval(F.lit(0), F.lit(2)))
                        .otherwise(F.col("created_at")))


@register("out_of_order", sql("""
SELECT cluster, base, stream, minute, created_at, next_minute, next_created_at FROM (
  SELECT *, lead(minute) OVER w AS next_minute, lead(created_at) OVER w AS next_created_at
  FROM (SELECT cluster, base, stream, minute,
               CASE WHEN minute(minute) % 10 = 0 THEN created_at + INTERVAL 2 HOUR ELSE created_at END AS created_at
        FROM ldm)
  WINDOW w AS (PARTITION BY cluster, base, stream ORDER BY minute))
WHERE created_at > next_created_at""", "ldm"))
def q_out_of_order(s: Scenario) -> DataFrame:
    return audit.out_of_order(_skewed_minutes(s))


@register("stream_entries", sql("SELECT * FROM ment", "ment"))
def q_stream_entries(s: Scenario) -> DataFrame:
    return s.merged_entries


@register("mirror_order", sql("""
SELECT stream, minute, relpath, row_number() OVER (PARTITION BY stream, date_trunc('hour', minute) ORDER BY minute, relpath) AS position
FROM ment""", "ment"))
def q_mirror_order(s: Scenario) -> DataFrame:
    """O1: the place of each entry in its stream's hour folder, as a mirror commits it."""
    return publish.mirror_positions(s.merged_entries).select("stream", "minute", "relpath", "position")


# ---------------------------------------------------------------- audits
@register("audit_local", with_classify("""
src AS (SELECT cluster, concat(collector, '-', file_name, '.gz') AS key, path FROM ranked WHERE rn <= 6
        UNION ALL SELECT cluster, concat(file_name, '.gz') AS key, path FROM trash),
dst AS (SELECT cluster, file_name AS key, path FROM lf WHERE hhmm % 17 <> 0
        UNION ALL SELECT 'cluster2' AS cluster, file_name AS key, path FROM lf WHERE hhmm % 37 = 0 AND cluster = 'cluster1'),
""", "src", "dst", ["cluster"], "ranked", "trash", "lf"))
def q_audit_local(s: Scenario) -> DataFrame:
    return audit.audit_local(s.data_dir_files, s.trash, s.local_audit_dest)


@register("audit_mirror", with_classify("""
msrc AS (SELECT m.mirror, e.stream, e.relpath AS key, e.path FROM ment e
         JOIN (SELECT DISTINCT mirror, stream FROM mir) m ON e.stream = m.stream),
""", "msrc", "mir", ["mirror", "stream"], "ment", "mir"))
def q_audit_mirror(s: Scenario) -> DataFrame:
    return audit.audit_mirror(s.merged_entries, s.mirror_entries)


@register("audit_by_digest", with_classify("""
msrc AS (SELECT m.mirror, e.stream, e.relpath AS key, e.path FROM ment e
         JOIN (SELECT DISTINCT mirror, stream FROM mir) m ON e.stream = m.stream),
part AS (SELECT mirror, stream, key, path FROM mir WHERE CAST(substr(key, 12, 2) AS INT) % 6 = 0
         UNION ALL SELECT 'cluster3' AS mirror, stream, relpath AS key, path FROM ment WHERE CAST(substr(relpath, 12, 2) AS INT) % 6 <> 0),
""", "msrc", "part", ["mirror", "stream"], "ment", "mir"))
def q_audit_by_digest(s: Scenario) -> DataFrame:
    """J8 by digests of (stream, hour): the mirror is damaged in every sixth hour, whose keys alone are compared."""
    hurt = F.substring("relpath", 12, 2).cast("int") % 6 == 0
    whole = s.merged_entries.withColumn("cluster", F.lit(MIRROR_CLUSTER))
    mirror = s.mirror_entries.filter(hurt).unionByName(whole.filter(~hurt))
    return audit.audit_mirror(s.merged_entries, mirror, compare=digests.compare(digests.path_hour))


@register("merge_by_digest", sql(
    "src AS (SELECT stream, file_name AS key, path FROM lf WHERE hhmm % 17 <> 0 OR hhmm // 100 % 6 <> 0), "
    "dst AS (SELECT stream, file_name AS key, path FROM mf WHERE hhmm % 19 <> 0 OR hhmm // 100 % 6 <> 0), "
    + classify_sql("src", "dst", ["stream"]).lstrip(), "lf", "mf", local_ctes=True))
def q_merge_by_digest(s: Scenario) -> DataFrame:
    """J7 by digests of (stream, hour in the file's name): local and merged minutes of a file differ, its name doesn't."""
    calm = F.floor(F.col("hhmm") / 100) % 6 != 0
    return audit.audit_merge(s.local_files_where((F.col("hhmm") % 17 != 0) | calm),
                             s.merged_files_where((F.col("hhmm") % 19 != 0) | calm), compare=digests.compare(digests.name_hour))


@register("audit_scoped", with_classify("""
src AS (SELECT stream, file_name AS key, path FROM lf WHERE hhmm % 17 <> 0 AND stream IN ('click', 'view')),
dst AS (SELECT stream, file_name AS key, path FROM mf WHERE hhmm % 19 <> 0 AND stream IN ('click', 'view')),
""", "src", "dst", ["stream"], "lf", "mf"))
def q_audit_scoped(s: Scenario) -> DataFrame:
    return audit.audit_merge(s.local_files_where(F.col("hhmm") % 17 != 0),
                             s.merged_files_where(F.col("hhmm") % 19 != 0), streams=["click", "view"])


@register("order_scoped", sql("""
SELECT cluster, base, stream, minute, created_at, next_minute, next_created_at FROM (
  SELECT *, lead(minute) OVER w AS next_minute, lead(created_at) OVER w AS next_created_at
  FROM (SELECT cluster, base, stream, minute,
               CASE WHEN minute(minute) % 10 = 0 THEN created_at + INTERVAL 2 HOUR ELSE created_at END AS created_at
        FROM ldm WHERE cluster = 'cluster2' AND base = 'streams_local')
  WINDOW w AS (PARTITION BY cluster, base, stream ORDER BY minute))
WHERE created_at > next_created_at""", "ldm"))
def q_order_scoped(s: Scenario) -> DataFrame:
    """the order check scoped to one cluster and base."""
    return audit.out_of_order(_skewed_minutes(s), clusters=["cluster2"], bases=["streams_local"])


@register("audit_summary", sql("""
SELECT g.stream,
       count(CASE WHEN a.kind = 'missing' THEN 1 END) AS n_missing,
       count(CASE WHEN a.kind = 'replay' THEN 1 END) AS n_replay,
       count(CASE WHEN a.kind = 'to_be_sent' THEN 1 END) AS n_to_be_sent,
       count(CASE WHEN a.kind = 'extra' THEN 1 END) AS n_extra,
       CASE WHEN count(a.kind) = 0 THEN 'consistent' ELSE 'inconsistent' END AS verdict
FROM (SELECT DISTINCT stream FROM lf UNION SELECT DISTINCT stream FROM mf) g
LEFT JOIN audit_merge_rows a ON a.stream = g.stream
GROUP BY g.stream""", "audit_merge_rows"))
def q_audit_summary(s: Scenario) -> DataFrame:
    src = s.local_files_where(F.col("hhmm") % 17 != 0)
    dst = s.merged_files_where(F.col("hhmm") % 19 != 0)
    groups = src.select("stream").unionByName(dst.select("stream"))
    return audit.summary(audit.audit_merge(src, dst), groups, ["stream"])


# ---------------------------------------------------------------- topology and routing
@register("flow_edges", sql("""
src AS (SELECT DISTINCT stream, cluster FROM cat),
prim1 AS (SELECT stream, max(cluster) AS prim FROM src WHERE length(stream) % 8 <> 0 GROUP BY 1),
dest AS (SELECT stream, 'cluster3' AS cluster FROM src
         UNION SELECT stream, min(cluster) AS cluster FROM src GROUP BY stream HAVING min(cluster) <> max(cluster)),
edges AS (SELECT 'local' AS kind, stream, cluster AS src_cluster, cluster AS dest_cluster FROM src
      UNION SELECT 'merge' AS kind, s.stream, s.cluster, p.prim FROM src s JOIN prim1 p ON s.stream = p.stream
      UNION SELECT 'mirror' AS kind, d.stream, p.prim, d.cluster FROM dest d JOIN prim1 p ON d.stream = p.stream)
SELECT e.kind, e.stream, e.src_cluster, e.dest_cluster, coalesce(n.n, 0) AS n_files
FROM edges e LEFT JOIN (SELECT cluster, stream, count(*) AS n FROM cat GROUP BY 1, 2) n
  ON e.src_cluster = n.cluster AND e.stream = n.stream""", "cat", local_ctes=True))
def q_flow_edges(s: Scenario) -> DataFrame:
    """The edges of a topology file, derived from ``events`` and parsed, with the files that each carries."""
    found = topology.load(s.spark, s.topology_file)
    return route.edge_load(route.flow_edges(found["sources"], found["destinations"]), s.collector_files)


@register("topology_sources", sql("""
SELECT stream, cluster, CASE WHEN cluster = 'cluster1' THEN 12 * length(stream) ELSE 30 END AS retention_hours, count(*) AS n_files
FROM cat GROUP BY 1, 2""", "cat"))
def q_topology_sources(s: Scenario) -> DataFrame:
    """A topology file, derived from ``events``, parsed, with the files seen of each source."""
    found = topology.load(s.spark, s.topology_file)["sources"]
    return topology.sources_with_files(found, s.collector_files)


@register("route_merge", sql("""
SELECT 'merge' AS kind, l.cluster AS src_cluster, l.cluster AS via_cluster, e.dest_cluster, l.stream, l.path, l.minute,
       epoch_us(l.minute) // 60000000 AS batch_id
FROM lf l JOIN medges e ON l.stream = e.stream AND l.cluster = e.src_cluster""", "lf", "medges"))
def q_route_merge(s: Scenario) -> DataFrame:
    return route.route_merge(s.local_files, route.merge_edges(s.sources, s.destinations))


@register("route_mirror", sql("""
SELECT DISTINCT 'mirror' AS kind, m.cluster AS src_cluster, m.cluster AS via_cluster, e.dest_cluster, m.stream, m.path,
       m.minute, epoch_us(m.minute) // 60000000 AS batch_id
FROM ment m JOIN redges e ON m.stream = e.stream AND m.cluster = e.src_cluster""", "ment", "redges"))
def q_route_mirror(s: Scenario) -> DataFrame:
    return route.route_mirror(s.merged_entries, route.flow_edges(s.sources, s.destinations))


@register("pending_manifests", sql("SELECT * FROM pend", "pend"))
def q_pending_manifests(s: Scenario) -> DataFrame:
    return route.pending_manifests(s.manifests, s.manifest_acks)


@register("pending_after_ack", sql("""
SELECT kind, dest_cluster, stream, trim(path) AS path, max(batch_id) AS batch_id, min(minute) AS minute
FROM man m WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM acks UNION SELECT * FROM acked) a WHERE a.kind = m.kind
  AND a.dest_cluster = m.dest_cluster AND a.batch_id = m.batch_id)
GROUP BY 1, 2, 3, 4""", "man", "acks", "acked"))
def q_pending_after_ack(s: Scenario) -> DataFrame:
    """K8: one consumer acknowledges every batch it read, also those that list a path again; the others' stay."""
    read = route.pending_batches(s.manifests, s.manifest_acks).filter(F.col("dest_cluster") == "cluster1")
    return route.pending_manifests(s.manifests, s.manifest_acks.unionByName(read))


@register("manifest_valid", sql("""
SELECT p.* FROM pend p WHERE EXISTS (SELECT 1 FROM lf WHERE lf.hhmm % 23 <> 0 AND lf.path = p.path)""", "pend", "lf"))
def q_manifest_valid(s: Scenario) -> DataFrame:
    return route.valid_paths(route.pending_manifests(s.manifests, s.manifest_acks), s.committed_local)


@register("collapse_manifests", sql("""
SELECT m.kind, m.dest_cluster, CASE WHEN g.n > 1 THEN g.last ELSE m.batch_id END AS batch_id, trim(m.path) AS path,
       max(m.src_cluster) AS src_cluster, max(m.via_cluster) AS via_cluster, max(m.stream) AS stream, max(m.minute) AS minute
FROM man m JOIN (SELECT kind, dest_cluster, count(DISTINCT batch_id) AS n, max(batch_id) AS last FROM man GROUP BY 1, 2) g
  ON m.kind = g.kind AND m.dest_cluster = g.dest_cluster GROUP BY 1, 2, 3, 4""", "man"))
def q_collapse_manifests(s: Scenario) -> DataFrame:
    return route.collapse(s.manifests)


# ---------------------------------------------------------------- retention
@register("effective_retention", sql("""
SELECT p.cluster, p.stream, coalesce(e.retention_hours, 48) AS retention_hours,
       CASE WHEN e.retention_hours IS NULL THEN 'default' ELSE 'config' END AS origin
FROM (SELECT DISTINCT cluster, stream FROM allf) p LEFT JOIN eff e ON p.cluster = e.cluster AND p.stream = e.stream""",
    "allf", "eff"))
def q_effective_retention(s: Scenario) -> DataFrame:
    present = s.local_files.unionByName(s.merged_files)
    return retention.resolve_retention(present, retention.effective_retention(s.sources, s.destinations))


def _purge(s: Scenario) -> DataFrame:
    files = s.local_files.unionByName(s.merged_files)
    return retention.purge_set(retention.hour_dirs(files),
                               retention.effective_retention(s.sources, s.destinations), now_col())


@register("retention_purge", sql("SELECT * FROM pur", "pur"))
def q_retention_purge(s: Scenario) -> DataFrame:
    return _purge(s)


@register("retention_survivors", sql("""
SELECT f.* FROM allf f WHERE NOT EXISTS (SELECT 1 FROM pur p WHERE p.cluster = f.cluster AND p.base = f.base
  AND p.stream = f.stream AND p.hour = date_trunc('hour', f.minute))""", "allf", "pur"))
def q_retention_survivors(s: Scenario) -> DataFrame:
    return retention.survivors(s.local_files.unionByName(s.merged_files), _purge(s))


@register("trash_purge", sql(f"""
SELECT cluster, day_dir, hour_dir, th AS trash_hour, abs(epoch_us({SQL_NOW}) - epoch_us(th)) // 3600000000 AS age_hours
FROM (SELECT *, try_strptime(concat(day_dir, ' ', hour_dir), '%Y-%m-%d %H') AS th FROM tdirs)
WHERE th IS NULL OR abs(epoch_us({SQL_NOW}) - epoch_us(th)) // 3600000000 >= 24""", "tdirs"))
def q_trash_purge(s: Scenario) -> DataFrame:
    return retention.trash_purge_set(s.trash_dirs, now_col())


@register("empty_levels", sql("""
SELECT d.cluster, d.base, d.stream, d.level, d.path FROM lvl d
WHERE d.level IN ('year', 'month', 'day')
  AND NOT EXISTS (SELECT 1 FROM lvl c WHERE c.cluster = d.cluster AND c.base = d.base AND c.stream = d.stream
                                       AND regexp_extract(c.path, '^(.*)/[^/]+$', 1) = d.path)""", "lvl"))
def q_empty_levels(s: Scenario) -> DataFrame:
    return retention.empty_levels(s.level_dirs)


# ---------------------------------------------------------------- ranges of the minute ledger
@register("idle_ranges", sql("""
SELECT cluster, base, stream, minute + INTERVAL 1 MINUTE AS minute, nm - INTERVAL 1 MINUTE AS last_minute, 'empty' AS state,
       minute + INTERVAL 2 MINUTE AS created_at, date_diff('minute', minute, nm) > 0 AS moves
FROM (SELECT *, lead(minute) OVER (PARTITION BY cluster, base, stream ORDER BY minute) AS nm FROM mdm)
WHERE nm > minute + INTERVAL 1 MINUTE""", "mdm"))
def q_idle_ranges(s: Scenario) -> DataFrame:
    """A5: the merged stream's idle minutes, written minute by minute, as the ledger keeps them: a row for each idle time."""
    return ranges.merged(ranges.of_minutes(s.merged_ledger.filter(F.col("state") == "empty")))


@register("gap_ranges", sql(f"""
SELECT cluster, base, stream, latest + INTERVAL 1 MINUTE AS minute, {SQL_NOW} - INTERVAL 1 MINUTE AS last_minute, 'empty' AS state,
       {SQL_NOW} AS created_at, false AS moves
FROM (SELECT cluster, base, stream, max(minute) AS latest FROM lf GROUP BY 1, 2, 3)
WHERE latest + INTERVAL 1 MINUTE <= {SQL_NOW} - INTERVAL 1 MINUTE""", "lf"))
def q_gap_ranges(s: Scenario) -> DataFrame:
    """T5: what a run adds to the ledger for its idle streams, a row each."""
    return ranges.gap_ranges(ranges.merged(ranges.of_minutes(audit.minute_dirs(s.local_files))), now_col())


@register("ledger_missing", sql("""
SELECT cluster, base, stream, minute + INTERVAL 1 MINUTE AS gap_start, nm - INTERVAL 1 MINUTE AS gap_end,
       date_diff('minute', minute, nm) - 1 AS n_minutes
FROM (SELECT *, lead(minute) OVER (PARTITION BY cluster, base, stream ORDER BY minute) AS nm FROM ldm)
WHERE nm > minute + INTERVAL 1 MINUTE""", "ldm"))
def q_ledger_missing(s: Scenario) -> DataFrame:
    """W4 from the ledger's ranges: data minutes as a minute service leaves them, one range for each stretch of them."""
    d = audit.minute_dirs(s.local_files).withColumn("created_at", F.col("minute"))
    return ranges.missing_between(ranges.merged(ranges.of_minutes(d)))


# ---------------------------------------------------------------- commits
def _hhmm(col="minute") -> F.Column:
    return F.date_format(L.plus_minutes(col, -1), "HHmm").cast("long")


@register("published_once", sql("""
SELECT cluster, stream, file_name, CASE WHEN hhmm % 11 = 0 THEN 10000 + hhmm ELSE hhmm END AS batch_id FROM lf""", "lf"))
def q_published_once(s: Scenario) -> DataFrame:
    """Each collector minute of a day is a batch; those at hhmm % 11 = 0 were never committed and their files come
    again, with files at hhmm % 13 = 0 that were. Every file is visible once, by the batch that was committed."""
    first = s.local_files.withColumn("batch_id", _hhmm())
    log = first.filter(F.col("batch_id") % 11 != 0).select("stream", "minute", "batch_id").distinct()
    seen = commitlog.visible(first, log)
    again = first.filter((F.col("batch_id") % 11 == 0) | (F.col("batch_id") % 13 == 0))
    more = ingest.not_merged(again, seen).withColumn("batch_id", F.col("batch_id") + 10_000)
    return seen.unionByName(more).select("cluster", "stream", "file_name", "batch_id")


@register("commit_watermark", sql("""
SELECT stream, max(minute) AS watermark, count(*) AS n_minutes
FROM (SELECT stream, minute, row_number() OVER (PARTITION BY stream ORDER BY minute) AS n FROM (SELECT DISTINCT stream, minute FROM ment))
WHERE n <= 3000 GROUP BY stream""", "ment"))
def q_commit_watermark(s: Scenario) -> DataFrame:
    """O1: a mirror commits a backlog in parts of 1000 minutes of each stream and stops after the third: what consumers may read."""
    parts = publish.commit_parts(s.merged_entries, 1000).filter(F.col("part") < 3)
    rows = parts.select("stream", "minute").distinct()
    minutes = rows.groupBy("stream").agg(F.count("*").alias("n_minutes"))
    return commitlog.watermarks(rows).join(minutes, "stream").select("stream", "watermark", "n_minutes")
