"""Sinks: published stream tables, commit catalog, ledgers, manifests, acknowledgements, checkpoints, trash.

Layout: every table is a parquet directory partitioned by string columns, so
reads prune by stream / hour / minute and a purge drops whole hour directories.

* published streams  ``<root>/<base>/stream=<s>/hour=<yyyy-MM-dd-HH>/minute_key=<yyyy-MM-dd-HH-mm>/batch_id=<n>``
* commit log         ``<root>/system/log/<base>``, snapshot plus deltas (``commitlog``: what readers may see)
* commit catalog     ``<root>/system/catalog``, snapshot plus deltas (a row per published file)
* commits            ``<root>/system/commits/<service>/batch_id=<n>`` (what a batch selected, and its commit time)
* minute ledger      ``<root>/system/minutes``, snapshot plus deltas (ranges of minutes, ``operators.ranges``)
* manifests          ``<root>/system/manifests/kind=<k>/dest_cluster=<c>/batch_id=<n>`` (until acknowledged)
* acks               ``<root>/system/acks/kind=<k>/dest_cluster=<c>/batch_id=<n>`` (until their manifests are gone)
* checkpoints        ``<root>/system/checkpoint/batch_id=<n>`` (the last versions; readers take the latest)
* trash catalog      ``<root>/system/trash_catalog/trash_hour_key=<y-M-d-H>/batch_id=<n>``

Writes use dynamic partition overwrite, so re-running a batch rewrites exactly
the partitions it owns (idempotent replay, T7).  Output is rebalanced with the
``REBALANCE`` hint: AQE splits a hot stream's partition over several tasks and
merges small ones, instead of one task per (stream, minute).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layout as L
from ..operators import ranges, route
from . import files as fsops
from .snapshots import SnapshotTable

PUBLISHED_PARTITIONS = ["stream", "hour", "minute_key", "batch_id"]
CHECKPOINT_VERSIONS = 3
#: manifest batches of a consumer beyond which its backlog is collapsed
MOST_MANIFEST_BATCHES = 32

LEDGER_COLS = ["cluster", "base", "stream", "minute", "state", "created_at"]
CATALOG_SCHEMA = ("cluster string, minute timestamp_ntz, file_name string, path string, mtime timestamp_ntz, "
                  "length bigint, base string, stream string, hour string, batch_id bigint")
CATALOG_COLS = ["cluster", "base", "stream", "minute", "file_name", "path", "mtime", "length"]
MANIFEST_SCHEMA = ("src_cluster string, via_cluster string, stream string, path string, minute timestamp_ntz, "
                   "kind string, dest_cluster string, batch_id bigint")
ACK_SCHEMA = "acked boolean, kind string, dest_cluster string, batch_id bigint"
CHECKPOINT_SCHEMA = "cluster string, stream string, collector string, file_name string, batch_id bigint"


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A system table by its declared schema; empty when its folder is absent.  Any other fault is an error."""
    if fsops.exists(spark, f"{path}/deltas"):
        return SnapshotTable(spark, path, schema).read()
    if fsops.exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _overwrite(df: DataFrame, path: str, partitions: list[str], compression: str = "zstd") -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).partitionBy(*partitions).parquet(path))


def _hour(df: DataFrame) -> DataFrame:
    return df.withColumn("hour", F.date_format("minute", "yyyy-MM-dd-HH"))


def write_published(records: DataFrame, table_dir: str, batch_id: int, compression: str = "zstd") -> None:
    """K1/K2/K3: write planned records (``publish.plan_*`` output) of one batch."""
    out = (_hour(records).withColumn("minute_key", F.date_format("minute", L.FILE_TIME_FORMAT))
           .withColumn("batch_id", F.lit(batch_id).cast("long")).drop("minute", "base"))
    _overwrite(out.hint("rebalance", "stream", "minute_key"), table_dir, PUBLISHED_PARTITIONS, compression)


def write_published_text(records: DataFrame, table_dir: str, compression: str = "gzip") -> None:
    """K1 in the reference's row format: gzip text, one directory per published file, lines in order.

    Only ``value`` is stored in the files; stream, minute and file name are the
    directory levels (``stream=/minute_key=/file_name=``).  Lines are range-partitioned by
    file and position (``block_start, line_pos``, as the reader gives them), so a large file
    is spread over several tasks whose part files follow each other in name order.
    """
    place = [c for c in ("block_start", "line_pos") if c in records.columns]
    out = records.select("stream", F.date_format("minute", L.FILE_TIME_FORMAT).alias("minute_key"),
                         "file_name", *place, "value")
    keys = ["stream", "minute_key", "file_name", *place]
    (out.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*place).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("compression", compression)
     .option("lineSep", "\n").partitionBy("stream", "minute_key", "file_name").text(table_dir))


def catalog_table(spark: SparkSession, catalog_dir: str) -> SnapshotTable:
    """A4: the file catalog, sorted by minute, so that a read of some minutes skips the rest of the snapshot."""
    return SnapshotTable(spark, catalog_dir, CATALOG_SCHEMA, lambda rows: rows.sort("base", "minute", "stream"))


def write_catalog(files: DataFrame, catalog_dir: str, batch_id: int, name: str | None = None) -> None:
    """A4: the files that a batch published (``CATALOG_COLS``), one file of the catalog."""
    out = _hour(files.select(*CATALOG_COLS)).withColumn("batch_id", F.lit(batch_id).cast("long"))
    catalog_table(files.sparkSession, catalog_dir).append(name or f"batch.{batch_id}", out)


def ledger_table(spark: SparkSession, ledger_dir: str) -> SnapshotTable:
    """A5: the minute ledger; its snapshots join adjoining ranges."""
    return SnapshotTable(spark, ledger_dir, ranges.RANGES_SCHEMA, ranges.merged)


def write_ledger_rows(spark: SparkSession, rows: DataFrame, ledger_dir: str, name: str | None = None) -> None:
    """T5/K3: minutes (``LEDGER_COLS``) or ranges of one batch; a batch that is there adds nothing twice."""
    out = rows if "last_minute" in rows.columns else ranges.of_minutes(rows)
    ledger_table(spark, ledger_dir).append(name or uuid.uuid4().hex, out)


def read_ledger_ranges(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """The minute ledger as ranges (empty when not written yet)."""
    return read_table(spark, ledger_dir, ranges.RANGES_SCHEMA)


def read_ledger(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """The minutes of the ledger."""
    return ranges.minutes_of(read_ledger_ranges(spark, ledger_dir)).select(*LEDGER_COLS)


def append_manifests(manifests: DataFrame, manifest_dir: str) -> None:
    """K4/K5: consumer manifests of one batch."""
    _overwrite(manifests, manifest_dir, ["kind", "dest_cluster", "batch_id"])


def collapse_manifests(spark: SparkSession, manifest_dir: str, most: int = MOST_MANIFEST_BATCHES) -> int:
    """The backlog of a consumer that lags behind as one batch; returns how many folders went.

    All batches below the newest one are collapsed into the latest of them (the newest may be run again, and
    would then write its folder anew).  The collapsed batch is there before the others go, so a crash, or a
    consumer that reads or acknowledges in between, sees a path twice at most, never none.  A consumer has at
    most ``most`` + 1 folders, however long it stays away.
    """
    gone = 0
    for kind in fsops.subfolders(spark, manifest_dir):
        for dest in fsops.subfolders(spark, f"{manifest_dir}/{kind}"):
            place = f"{manifest_dir}/{kind}/{dest}"
            found = sorted((int(b.removeprefix("batch_id=")), b) for b in fsops.subfolders(spark, place) if b.startswith("batch_id="))
            if len(found) <= most:
                continue
            old = found[:-1]
            rows = spark.read.schema(MANIFEST_SCHEMA).option("basePath", manifest_dir).parquet(*[f"{place}/{b}" for _, b in old])
            one = route.collapse(rows).checkpoint(eager=True)  # read before its folder is written
            _overwrite(one, manifest_dir, ["kind", "dest_cluster", "batch_id"])
            for _, b in old[:-1]:
                gone += fsops.delete_path(spark, f"{place}/{b}")
    return gone


def append_acks(acks: DataFrame, ack_dir: str) -> None:
    """K8: acknowledge consumed manifest batches (``kind, dest_cluster, batch_id``)."""
    _overwrite(acks.select("kind", "dest_cluster", "batch_id").distinct().withColumn("acked", F.lit(True)), ack_dir,
               ["kind", "dest_cluster", "batch_id"])


def settle_acks(spark: SparkSession, manifest_dir: str, ack_dir: str) -> int:
    """K8: remove acknowledged manifests, then their acknowledgements (in this order: a crash repeats it)."""
    acks = read_table(spark, ack_dir, ACK_SCHEMA).select("kind", "dest_cluster", "batch_id").distinct()
    below = F.concat_ws("/", L.partition_folder("kind", "kind"), L.partition_folder("dest_cluster", "dest_cluster"),
                        L.partition_folder("batch_id", F.col("batch_id").cast("string")))
    n = 0
    for row in acks.select(below.alias("folder")).toLocalIterator():
        n += fsops.delete_path(spark, f"{manifest_dir}/{row['folder']}")
        fsops.delete_path(spark, f"{ack_dir}/{row['folder']}")
    return n


def write_checkpoints(checkpoints: DataFrame, ckpt_dir: str, batch_id: int) -> None:
    """K6: a new checkpoint version; only the last ``CHECKPOINT_VERSIONS`` stay."""
    spark = checkpoints.sparkSession
    _overwrite(checkpoints.withColumn("batch_id", F.lit(batch_id).cast("long")), ckpt_dir, ["batch_id"])
    versions = sorted(int(x.removeprefix("batch_id=")) for x in fsops.subfolders(spark, ckpt_dir) if x.startswith("batch_id="))
    for old in versions[:-CHECKPOINT_VERSIONS]:
        fsops.delete_path(spark, f"{ckpt_dir}/batch_id={old}")


def read_checkpoints(spark: SparkSession, ckpt_dir: str) -> DataFrame:
    """The latest checkpoint version (empty when none was written)."""
    df = read_table(spark, ckpt_dir, CHECKPOINT_SCHEMA)
    latest = df.agg(F.max("batch_id")).first()[0]
    return df.filter(F.col("batch_id") == latest).drop("batch_id")


def append_trash(trash: DataFrame, trash_dir: str, batch_id: int) -> None:
    """K7: trash catalog rows of one batch (a replayed batch rewrites its own partition)."""
    out = (trash.withColumn("trash_hour_key", F.date_format("trash_hour", "y-M-d-H"))
           .withColumn("batch_id", F.lit(batch_id).cast("long")))
    _overwrite(out, trash_dir, ["trash_hour_key", "batch_id"])


def commit_path(commits_dir: str, batch_id: int) -> str:
    return f"{commits_dir}/batch_id={batch_id}"


def commit_of(spark: SparkSession, commits_dir: str, batch_id: int, now: str, selected: DataFrame | None = None) -> tuple[str, DataFrame | None]:
    """The commit time and the selection of a batch, recorded before anything of it is published.

    The first call writes them; a replay, at whatever time, reads them back, so it rewrites
    the same partitions with the same rows.  A record cut off by a crash (no ``_SUCCESS``) is
    written anew: nothing was published under it.
    """
    path = commit_path(commits_dir, batch_id)
    if not fsops.exists(spark, f"{path}/now/_SUCCESS"):
        if selected is not None:
            selected.write.mode("overwrite").parquet(f"{path}/selected")
        spark.createDataFrame([(now,)], "now string").coalesce(1).write.mode("overwrite").parquet(f"{path}/now")
    now = spark.read.schema("now string").parquet(f"{path}/now").first()[0]
    if selected is None:
        return now, None
    return now, spark.read.schema(selected.schema).parquet(f"{path}/selected")
