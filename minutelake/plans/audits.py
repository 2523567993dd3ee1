"""The four audit commands, on our own sites and on directory trees in the reference layout.

A site of ours (one with a commit catalog) is audited from its catalog and minute ledger; no
folder is listed.  A merged stream and its mirrors are held against each other by the digests in their
commit logs first, and only the hours that differ are read from their catalogs.  Other roots are trees ``<root>/data/<stream>/<collector>/<file>``,
``<root>/system/trash/<y-M-d>/<H>/<file>``,
``<root>/streams_local|streams/<stream>/yyyy/MM/dd/HH/mm/<file>``.

They are listed by the executors (``sources.listing``), files and folders alike, once for each check; names
that begin with ``_`` or ``.`` are ordinary ones, and a minute folder without files is an empty minute.  A
file that is in none of these places is an error, never a silent match.

CLI (same arguments as the reference's launcher; ``--output <dir>`` keeps every difference,
the summary with the verdict is printed)::

    python -m minutelake.plans.audits localstreamdataconsistency <root,...>
    python -m minutelake.plans.audits mergestreamdataconsistency <local root,...> <merged root> [<stream,...>]
    python -m minutelake.plans.audits mirrorstreamdataconsistency <merged root> <mirror root,...> [<stream,...>]
    python -m minutelake.plans.audits orderlycreated <root,...> [<base,...>] [<stream,...>]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layout as L
from ..operators import audit, digests
from ..schemas import LOCAL_BASE, MERGED_BASE
from ..sinks import commitlog
from ..sinks import files as fsops
from ..sinks import writers as W
from ..sources import catalog
from ..session import apply_session_settings
from ..sources.manifests import trash_entries
from .run import Site, published_catalog

#: differing hours up to which a catalog is read by a list of hours
MOST_HOURS = 5_000
_STREAM_FILES = ("cluster string, base string, stream string, minute timestamp_ntz, file_name string, "
                 "path string, mtime timestamp_ntz, length bigint")


def _union(frames: list[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out if out is not None else spark.createDataFrame([], schema)


def _stream_names(spark: SparkSession, base_dir: str) -> list[str]:
    """Stream folders of a tree: one entry for each stream."""
    return fsops.subfolders(spark, base_dir)


class UnknownLayout(ValueError):
    """Files that are in no place of the layout."""


def is_site(spark: SparkSession, root: str) -> bool:
    """Whether the root is one of ours: it has a commit catalog or a minute ledger."""
    return any(fsops.exists(spark, f"{root.rstrip('/')}/system/{x}") for x in ("catalog", "minutes"))


def stream_names(spark: SparkSession, root: str, base: str) -> list[str]:
    """Streams of a root: those of its catalog and ledger, or its folders."""
    root = root.rstrip("/")
    if not is_site(spark, root):
        return _stream_names(spark, f"{root}/{base}")
    names = W.read_table(spark, f"{root}/system/catalog", W.CATALOG_SCHEMA).select("base", "stream").unionByName(
        W.read_ledger(spark, f"{root}/system/minutes").select("base", "stream"))
    return sorted(r[0] for r in names.filter(F.col("base") == base).select("stream").distinct().collect())


_LISTING = "cluster string, path string, mtime timestamp_ntz, length bigint, is_dir boolean"


def tree(spark: SparkSession, root: str, base: str, cluster: str, streams=None) -> DataFrame:
    """Files and folders of a published tree: the one listing that a check takes, written to the checkpoint folder."""
    d = f"{root.rstrip('/')}/{base}"
    names = _stream_names(spark, d) if streams is None else [s for s in streams if fsops.exists(spark, f"{d}/{s}")]
    if not names:
        return spark.createDataFrame([], _LISTING)
    found = catalog.list_files(spark, d, cluster, names, 3).withColumn("is_dir", F.lit(False))
    folders = catalog.list_folders(spark, d, names, 3).select(
        F.lit(cluster).alias("cluster"), "path", "mtime", F.lit(None).cast("long").alias("length"), F.lit(True).alias("is_dir"))
    return found.unionByName(folders).checkpoint(eager=True)


def files_of(listed: DataFrame, where: str = "") -> DataFrame:
    """S3: the published files of a :func:`tree`."""
    found = catalog.stream_files_from_listing(listed.filter(~F.col("is_dir")))
    odd = found.filter((F.col("stream") == "") | (F.col("file_name") == "") | F.col("minute").isNull()).select("path").limit(5).collect()
    if odd:
        raise UnknownLayout(f"{where}: not <stream>/yyyy/MM/dd/HH/mm/<file>: {[r[0] for r in odd]}")
    return found


_MINUTE_DIR = r"/([^/]+)/([^/]+)/(\d{4}/\d\d/\d\d/\d\d/\d\d)$"


def minutes_of(listed: DataFrame, files: DataFrame) -> DataFrame:
    """Every minute folder of a :func:`tree`, empty ones included; created when its last entry arrived."""
    p = F.col("path")
    dirs = listed.filter(F.col("is_dir") & p.rlike(_MINUTE_DIR)).select(
        "cluster", F.regexp_extract(p, _MINUTE_DIR, 1).alias("base"), F.regexp_extract(p, _MINUTE_DIR, 2).alias("stream"),
        L.parse_minute(p).alias("minute"), F.col("mtime").alias("created_at"))
    data = files.select("cluster", "base", "stream", "minute").distinct().withColumn("state", F.lit("data"))
    out = dirs.filter(F.col("minute").isNotNull()).join(data, ["cluster", "base", "stream", "minute"], "left")
    return out.select("cluster", "base", "stream", "minute", F.coalesce(F.col("state"), F.lit("empty")).alias("state"), "created_at")


def published_files(spark: SparkSession, root: str, base: str, cluster: str, streams=None, hours=None) -> DataFrame:
    """S3 over a base of a root (only the given streams): of our own sites, the files of committed batches (only in ``hours``)."""
    if is_site(spark, root):
        rows = published_catalog(spark, Site(cluster, root.rstrip("/")), base, hours=hours)
        rows = rows if streams is None else rows.filter(F.col("stream").isin(list(streams)))
        return rows.select(F.lit(cluster).alias("cluster"), *[c for c in W.CATALOG_COLS if c != "cluster"])
    return files_of(tree(spark, root, base, cluster, streams), f"{root}/{base}")


def published_tree(spark: SparkSession, root: str, base: str, cluster: str, streams=None, hours=None) -> tuple[DataFrame, DataFrame]:
    """(files, minutes) of a base of a root, from one listing; of our own sites, only ``hours`` (``yyyy-MM-dd-HH``) if given."""
    if is_site(spark, root):
        led = W.read_ledger(spark, f"{root.rstrip('/')}/system/minutes").filter(F.col("base") == base)
        led = led if streams is None else led.filter(F.col("stream").isin(list(streams)))
        led = led if hours is None else led.filter(F.date_format("minute", "yyyy-MM-dd-HH").isin(list(hours)))
        minutes = led.select(F.lit(cluster).alias("cluster"), "base", "stream", "minute", "state", "created_at")
        return published_files(spark, root, base, cluster, streams, hours), minutes
    listed = tree(spark, root, base, cluster, streams)
    files = files_of(listed, f"{root}/{base}")
    return files, minutes_of(listed, files)


def minute_dirs_on_disk(spark: SparkSession, root: str, base: str, cluster: str, streams=None) -> DataFrame:
    """``cluster, base, stream, minute, state, created_at`` for every minute directory, empty ones included."""
    return published_tree(spark, root, base, cluster, streams)[1]


def local_stream_consistency(spark: SparkSession, roots: list[str]) -> DataFrame:
    """``localstreamdataconsistency``: (data ∪ trash) vs streams_local, each root on its own."""
    apply_session_settings(spark)
    data, trash, local = [], [], []
    for r in roots:
        if fsops.exists(spark, f"{r}/data"):
            data.append(catalog.collector_files(spark, r, r))
        if fsops.exists(spark, f"{r}/system/trash"):
            t = trash_entries(spark, r, r)
            trash.append(t.select("cluster", F.lit(None).cast("string").alias("stream"),
                                  F.lit(None).cast("string").alias("collector"), "file_name", "path"))
        local.append(published_files(spark, r, LOCAL_BASE, r))
    cf = "cluster string, stream string, collector string, file_name string, path string"
    return audit.audit_local(_union([d.select("cluster", "stream", "collector", "file_name", "path") for d in data],
                                    spark, cf),
                             _union(trash, spark, cf), _union(local, spark, _STREAM_FILES))


def merge_stream_consistency(spark: SparkSession, local_roots: list[str], merged_root: str,
                             streams=None) -> DataFrame:
    """``mergestreamdataconsistency``: ∪ local streams vs the merged stream (default: the merged root's streams)."""
    apply_session_settings(spark)
    names = streams if streams is not None else stream_names(spark, merged_root, MERGED_BASE)
    local = _union([published_files(spark, r, LOCAL_BASE, r, names) for r in local_roots], spark, _STREAM_FILES)
    merged = published_files(spark, merged_root, MERGED_BASE, merged_root, names)
    return audit.audit_merge(local, merged)


def kept_digests(spark: SparkSession, root: str, base: str, streams: list[str]) -> DataFrame | None:
    """``stream, bucket, n, d0 .. d3, last_key`` of a site's files and empty minutes by hour; None where no digests were kept.

    The files' are those of the commit log; the empty minutes' are made from the ledger's ranges.
    """
    log = commitlog.of(spark, f"{root.rstrip('/')}/{base}")
    if not is_site(spark, root) or not log.exists():
        return None
    files = commitlog.hour_digests(log.read().filter(F.col("stream").isin(streams)))
    if files is None:
        return None
    idle = W.read_ledger(spark, f"{root.rstrip('/')}/system/minutes").filter(
        (F.col("base") == base) & (F.col("state") == "empty") & F.col("stream").isin(streams))
    empty = audit.stream_entries(spark.createDataFrame([], _STREAM_FILES), idle)
    empty = digests.of_keys(empty.withColumn("bucket", digests.path_hour("relpath")), ["stream", "bucket"], "relpath")
    return digests.merged(files.unionByName(empty), ["stream", "bucket"])


def mirror_stream_consistency(spark: SparkSession, merged_root: str, mirror_roots: list[str],
                              streams=None) -> DataFrame:
    """``mirrorstreamdataconsistency``: merged stream vs each mirror, empty minute directories included.

    Default: every stream that the merged root or a mirror has, so one that only a mirror has is reported.
    Where all roots are sites that keep digests, only the hours that differ are read and compared.
    """
    apply_session_settings(spark)
    names = streams if streams is not None else sorted(
        {s for r in (merged_root, *mirror_roots) for s in stream_names(spark, r, MERGED_BASE)})

    ml = spark.createDataFrame([(s, r) for r in mirror_roots for s in names], "stream string, mirror string")
    compare, hours = audit.classify, None
    kept = [kept_digests(spark, r, MERGED_BASE, names) for r in (merged_root, *mirror_roots)]
    if all(k is not None for k in kept):
        mirrored = [k.withColumn("mirror", F.lit(r)) for k, r in zip(kept[1:], mirror_roots)]
        found = digests.Differing(kept[0].join(ml, "stream"), _union(mirrored, spark, ""), ["mirror", "stream"])
        compare, hours = digests.compare(digests.path_hour, found), found.names(MOST_HOURS)
        hours = None if hours is None else [h.replace("/", "-") for h in hours]

    def entries(root: str) -> DataFrame:
        return audit.stream_entries(*published_tree(spark, root, MERGED_BASE, root, names, hours))

    merged = entries(merged_root)
    mirrors = _union([entries(r) for r in mirror_roots], spark,
                     "cluster string, base string, stream string, minute timestamp_ntz, relpath string, "
                     "entry string, path string")
    return audit.audit_mirror(merged, mirrors, ml, compare=compare)


def orderly_created(spark: SparkSession, roots: list[str], bases=None, streams=None) -> tuple[DataFrame, DataFrame]:
    """``orderlycreated``: (out-of-order minutes, missing minutes) per root, base and stream."""
    apply_session_settings(spark)
    bases = bases or [LOCAL_BASE, MERGED_BASE]
    m = _union([minute_dirs_on_disk(spark, r, b, r, streams) for r in roots for b in bases
                if is_site(spark, r) or fsops.exists(spark, f"{r}/{b}")], spark,
               "cluster string, base string, stream string, minute timestamp_ntz, state string, "
               "created_at timestamp_ntz")
    return audit.out_of_order(m), audit.missing_minutes(m)


def verdict(diffs: DataFrame, group: list[str], groups: DataFrame | None = None) -> DataFrame:
    """One row per audited group: how many differences of each kind, and the verdict.

    ``groups`` lists all of them, so that consistent ones get their line too.
    """
    every = diffs.select(*group) if groups is None else groups.select(*group).unionByName(diffs.select(*group))
    return audit.summary(diffs, every.distinct(), group)


def _report(name: str, df: DataFrame, group: list[str] | None, output: str | None, groups: list[tuple] | None = None) -> bool:
    """Print a line and a verdict for each group of one check; keep all its rows in ``output``."""
    if output is not None:
        df.write.mode("overwrite").parquet(f"{output}/{name}")
        df = df.sparkSession.read.schema(df.schema).parquet(f"{output}/{name}")
    if group:
        every = None if groups is None else df.sparkSession.createDataFrame(groups, ", ".join(f"{g} string" for g in group))
        counts = verdict(df, group, every)
    else:
        counts = df.groupBy("cluster", "base", "stream").agg(F.count(F.lit(1)).alias("n"))
    bad = 0
    for row in counts.toLocalIterator():
        bad += row["verdict"] != "consistent" if group else 1
        print(f"{name}: " + ", ".join(f"{k}={v}" for k, v in row.asDict().items()))
    print(f"{name}: " + ("no inconsistency" if not bad else "inconsistent" + (f"; all rows in {output}/{name}" if output else "")))
    return not bad


def main(argv: list[str]) -> int:
    """0: consistent; 2: differences; 1: wrong call."""
    from ..session import build_session
    output = None
    if "--output" in argv:
        at = argv.index("--output")
        output, argv = argv[at + 1], argv[:at] + argv[at + 2:]
    if not argv:
        print(__doc__)
        return 1
    cmd, args = argv[0], argv[1:]
    split = lambda x: [v for v in x.split(",") if v]
    streams = lambda i: split(args[i]) if len(args) > i else None
    spark = build_session()
    if cmd == "localstreamdataconsistency":
        roots = split(args[0])
        out = [(cmd, local_stream_consistency(spark, roots), ["cluster"], [(r,) for r in roots])]
    elif cmd == "mergestreamdataconsistency":
        names = streams(2) or stream_names(spark, args[1], MERGED_BASE)
        out = [(cmd, merge_stream_consistency(spark, split(args[0]), args[1], streams(2)), ["stream"], [(s,) for s in names])]
    elif cmd == "mirrorstreamdataconsistency":
        mirrors = split(args[1])
        names = streams(2) or sorted({s for r in (args[0], *mirrors) for s in stream_names(spark, r, MERGED_BASE)})
        out = [(cmd, mirror_stream_consistency(spark, args[0], mirrors, streams(2)), ["mirror", "stream"], [(m, s) for m in mirrors for s in names])]
    elif cmd == "orderlycreated":
        disorder, missing = orderly_created(spark, split(args[0]), streams(1), streams(2))
        out = [("out_of_order", disorder, None, None), ("missing_minutes", missing, None, None)]
    else:
        print(__doc__)
        return 1
    return 0 if all([_report(name, df, group, output, groups) for name, df, group, groups in out]) else 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
