"""The commit log of a published table: what readers may see (K1-K3, O1).

A batch becomes visible by its commit record only: one file that is renamed into the log
(``<root>/system/log/<base>``, a :class:`~minutelake.sinks.snapshots.SnapshotTable`) when all of the
batch's records are written and checked.  Readers take their partitions from the log: rows of a batch
that was never finished are never read, and a read of some minutes lists the folders of these
minutes alone, not the table.

A record has a row for each stream and minute of the batch, also for its empty minutes.  A service
commits a stream's minutes in order, so the log's last minute of a stream is its watermark: everything
before it that was to come is there, and consumers read up to it.

A record also has the digest of its minute's files (``operators.digests``; of a minute that several batches
wrote, digests add up), so that an audit of two sites reads their logs and only differing hours of their catalogs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layout as L
from ..operators import digests
from . import files as fsops
from .snapshots import SnapshotTable

SCHEMA = ("stream string, minute timestamp_ntz, state string, n_files bigint, n_records bigint, "
          "committed_at timestamp_ntz, service string, batch_id bigint, "
          "d0 bigint, d1 bigint, d2 bigint, d3 bigint, last_name string")
#: folders that a read names one by one; a read of more takes the table's root and a join with the log
EXACT_FOLDERS = 5_000


def of(spark: SparkSession, table_dir: str) -> SnapshotTable:
    """The log of ``<root>/<base>``."""
    root, _, base = table_dir.rstrip("/").rpartition("/")
    return SnapshotTable(spark, f"{root}/system/log/{base}", SCHEMA)


def _name(service: str, batch_id: int, part: int) -> str:
    return f"{service}.{batch_id}" + (f".{part}" if part else "")


def is_committed(spark: SparkSession, table_dir: str, service: str, batch_id: int, part: int = 0) -> bool:
    """Whether a batch (or a part of one, see O1) has its record.

    Deltas stay for a whole round of compaction, far longer than a batch may be replayed; older
    batches are looked up by their rows.
    """
    log = of(spark, table_dir)
    if log.has(_name(service, batch_id, part)):
        return True
    if part or not log.snapshots():
        return False
    return not log.read().filter((F.col("service") == service) & (F.col("batch_id") == batch_id)).isEmpty()


def commit(spark: SparkSession, table_dir: str, service: str, batch_id: int, rows: DataFrame, committed_at, part: int = 0) -> bool:
    """Make a batch visible: ``rows`` are ``stream, minute, state, n_files, n_records`` and the digest of its files."""
    kept = [F.col(c) if c in rows.columns else F.lit(None).cast("string" if c == "last_name" else "long").alias(c)
            for c in (*digests.PARTS, "last_name")]
    out = rows.select("stream", "minute", "state", "n_files", "n_records", *kept, L.ntz(committed_at).alias("committed_at"),
                      F.lit(service).alias("service"), F.lit(batch_id).cast("long").alias("batch_id"))
    return of(spark, table_dir).append(_name(service, batch_id, part), out)


def committed(spark: SparkSession, table_dir: str, streams=None, minutes=None, up_to: DataFrame | None = None) -> DataFrame:
    """Commit records; ``minutes`` are ``yyyy-MM-dd-HH-mm``; ``up_to`` (stream, watermark) bounds each stream."""
    rows = of(spark, table_dir).read()
    if streams is not None:
        rows = rows.filter(F.col("stream").isin(list(streams)))
    if minutes is not None:
        rows = rows.filter(F.date_format("minute", L.FILE_TIME_FORMAT).isin(list(minutes)))
    if up_to is not None:
        rows = rows.join(up_to.select("stream", "watermark"), "stream").filter(F.col("minute") <= F.col("watermark")).drop("watermark")
    return rows


def visible(files: DataFrame, rows: DataFrame) -> DataFrame:
    """K1: of a catalog's files (``stream, minute, batch_id``) those of committed batches."""
    return files.join(rows.select("stream", "minute", "batch_id"), ["stream", "minute", "batch_id"], "left_semi")


def watermarks(rows: DataFrame) -> DataFrame:
    """O1: ``stream, watermark``: the last committed minute of each stream, empty ones included."""
    return rows.groupBy("stream").agg(F.max("minute").alias("watermark"))


def in_order(rows: DataFrame) -> DataFrame:
    """Commit records that broke the order: a stream's minute committed by a later batch than a later minute.

    For each stream and batch the least minute is held against the greatest of all batches before.
    """
    per = rows.groupBy("stream", "batch_id").agg(F.min("minute").alias("first_minute"), F.max("minute").alias("last_minute"))
    before = F.expr("max(last_minute) OVER (PARTITION BY stream ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    return per.withColumn("watermark_before", before).filter(F.col("first_minute") < F.col("watermark_before"))


def file_digest(minute="minute", file_name="file_name") -> list:
    """Aggregates of a minute's files that its record keeps."""
    below = F.concat_ws("/", F.date_format(L.c(minute), L.MINUTE_DIR_FORMAT), L.c(file_name))
    return [*digests.sums(below), F.max(L.c(file_name)).alias("last_name")]


def hour_digests(rows: DataFrame) -> DataFrame | None:
    """``stream, bucket, n, d0 .. d3, last_key`` of the files in ``rows``, by hour; None where a record has no digest."""
    data = rows.filter(F.col("state") == "data")
    if not data.filter(F.col("d0").isNull()).isEmpty():
        return None
    place = F.date_format("minute", L.MINUTE_DIR_FORMAT)
    parts = data.select("stream", digests.path_hour(place).alias("bucket"), F.col("n_files").alias("n"), *digests.PARTS,
                        F.concat_ws("/", place, "last_name").alias("last_key"))
    return digests.merged(parts, ["stream", "bucket"])


def folders(rows: DataFrame) -> DataFrame:
    """``folder``: the partitions of the table that hold committed records."""
    data = rows.filter(F.col("state") == "data")
    parts = [L.partition_folder("stream", "stream"), L.partition_folder("hour", F.date_format("minute", "yyyy-MM-dd-HH")),
             L.partition_folder("minute_key", F.date_format("minute", L.FILE_TIME_FORMAT)),
             L.partition_folder("batch_id", F.col("batch_id").cast("string"))]
    return data.select(F.concat_ws("/", *parts).alias("folder")).distinct()


def read_partitions(spark: SparkSession, table_dir: str, rows: DataFrame, schema: str) -> DataFrame:
    """Records of the committed partitions in ``rows``: exactly their folders are listed."""
    found = folders(rows).limit(EXACT_FOLDERS + 1).collect()
    if not found:
        return spark.createDataFrame([], schema)
    if len(found) <= EXACT_FOLDERS:
        paths = [f"{table_dir.rstrip('/')}/{r[0]}" for r in found]
        return spark.read.schema(schema).option("basePath", table_dir).parquet(*paths)
    whole = spark.read.schema(schema).parquet(table_dir)
    keys = rows.filter(F.col("state") == "data").select(
        "stream", F.date_format("minute", L.FILE_TIME_FORMAT).alias("minute_key"), "batch_id").distinct()
    return whole.join(keys, ["stream", "minute_key", "batch_id"], "left_semi")
