"""Records of selected collector files, and records of published tables.

Every line carries its place in its file: ``block_start`` (where its input split
begins) and ``line_pos`` (a number that grows along the split).  Together they order
the lines of a file, and ``numbered`` turns them into a key that is the same whenever
the file is read with the same splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import layout as L
from ..functions.skew import bounded_broadcast
from ..sinks import commitlog
from ..sinks import files as fsops

RECORDS_SCHEMA = ("cluster string, stream string, collector string, src_file string, value string, "
                  "block_start bigint, line_pos bigint")
PUBLISHED_SCHEMA = ("cluster string, file_name string, collector string, src_file string, value string, "
                    "block_start bigint, line_pos bigint, committed_at timestamp_ntz, "
                    "stream string, hour string, minute_key string, batch_id bigint")


def _lines(spark: SparkSession, paths, files=None) -> DataFrame:
    """``path, value, block_start, line_pos``; ``lineSep='\\n'`` keeps ``\\r`` and every other byte of a line.

    ``files`` is a condition on ``_metadata``: it prunes files before they are opened, so it
    has to stand below the numbering.
    """
    df = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    if files is not None:
        df = df.filter(files)
    return df.select(L.plain_path(F.col("_metadata.file_path")).alias("__path"), "value",
                     F.col("_metadata.file_block_start").alias("block_start"),
                     F.monotonically_increasing_id().alias("line_pos"))


def read_records(spark: SparkSession, paths: list[str], cluster: str) -> DataFrame:
    """Lines of the given collector files with their lineage, from the file path itself
    (``.../data/<stream>/<collector>/<file>``).  The path list is the files of one run."""
    if not paths:
        return spark.createDataFrame([], RECORDS_SCHEMA)
    parts = F.split("__path", "/")
    return _lines(spark, paths).select(
        F.lit(cluster).alias("cluster"), L.stream_from_collector_path("__path").alias("stream"),
        F.element_at(parts, -2).alias("collector"), F.element_at(parts, -1).alias("src_file"), "value",
        "block_start", "line_pos")


def read_published(spark: SparkSession, table_dir: str, streams=None, minutes=None) -> DataFrame:
    """Committed records of a published table (``streams_local`` / ``streams``).

    The commit log says which partitions there are: rows of a batch without its commit record are
    not read, and ``streams`` and ``minutes`` (``yyyy-MM-dd-HH-mm`` strings) choose the folders that are
    listed.  A folder that no service has written (it has no log) is read as it is.
    """
    if commitlog.of(spark, table_dir).exists():
        df = commitlog.read_partitions(spark, table_dir, commitlog.committed(spark, table_dir, streams, minutes), PUBLISHED_SCHEMA)
    else:
        df = spark.read.schema(PUBLISHED_SCHEMA).parquet(table_dir)
        if streams is not None:
            df = df.filter(F.col("stream").isin(list(streams)))
        if minutes is not None:
            df = df.filter(F.col("minute_key").isin(list(minutes)))
    return df.withColumn("minute", L.ntz(F.try_to_timestamp(F.col("minute_key"), F.lit(L.FILE_TIME_FORMAT))))


#: selected files that a run reads by their paths; more are found by a scan of the collector folders
EXACT_FILES = 10_000
# names that Spark's sources skip, and those that they would take for patterns
_ODD_NAME = r"^[_.]|[*?\[\]{}\\]"


def read_selected(spark: SparkSession, data_dir: str, selected: DataFrame, cluster: str,
                  staging: str | None = None) -> DataFrame:
    """Lines of the selected collector files, with their lineage.

    Up to ``EXACT_FILES`` files -- what a minute brings -- are read by their paths, and no folder is
    listed.  Beyond that no path list goes through the driver: the collector folders are scanned with a
    file-metadata pre-filter (the modification-time range of the selection) which Spark's file index applies
    before opening any file, and the exact selection is a join on the file's path.  A selected file that is
    gone is an error (the run aborts before its commit).  Hidden files, which Spark's sources skip,
    and names that they would take for patterns are first copied under plain names into ``staging``; they are few.
    """
    sel = selected.select(L.one_slash("path").alias("__path"), "stream", "collector", F.col("file_name").alias("src_file"))
    strange = F.lit(False)
    for name in ("src_file", "stream", "collector"):
        strange = strange | F.col(name).rlike(_ODD_NAME)
    moved = []
    if staging is not None:
        for i, row in enumerate(sel.filter(strange).toLocalIterator()):
            copy = f"{staging}/f{i}"
            fsops.copy_file(spark, row["__path"], copy)
            moved.append((fsops.qualified(spark, copy), row["stream"], row["collector"], row["src_file"]))
        sel = sel.filter(~strange)
    cols = [F.lit(cluster).alias("cluster"), "stream", "collector", "src_file", "value", "block_start", "line_pos"]
    out = spark.createDataFrame([], RECORDS_SCHEMA)
    paths = [r[0] for r in sel.select("__path").limit(EXACT_FILES + 1).collect()]
    if paths:
        if len(paths) <= EXACT_FILES and staging is not None:
            lines = _lines(spark, paths)
        else:
            lo, hi = selected.agg(F.min("mtime"), F.max("mtime")).first()
            mtime = F.col("_metadata.file_modification_time")
            lines = _lines(spark, data_dir, mtime.between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")))
        out = lines.join(bounded_broadcast(sel), "__path").select(*cols)
    if moved:
        kinds = "__path string, stream string, collector string, src_file string"
        copies = spark.createDataFrame(moved, kinds).withColumn("__path", L.one_slash("__path"))
        out = out.unionByName(_lines(spark, staging).join(copies, "__path").select(*cols))
    return out


def numbered(records: DataFrame) -> DataFrame:
    """``record_no``, the number of a line within its split, so ``(src_file, block_start, record_no)`` is a
    key of a source line.  A window over one split of one file, which is bounded by the split size."""
    key = [c for c in ("cluster", "stream", "collector", "src_file", "minute_key", "batch_id", "block_start") if c in records.columns]
    return records.withColumn("record_no", F.row_number().over(Window.partitionBy(*key).orderBy("line_pos")))
