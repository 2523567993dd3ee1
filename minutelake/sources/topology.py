"""The topology (clusters, sources, destinations, defaults) as dimension tables.

The configuration file is read with Spark's XML source and an explicit schema
(inference turns a single child into a struct instead of an array).  Tables
are tiny (one row per stream and cluster) and broadcast behind a row check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DEFAULT_RETENTION_HOURS, DEFAULT_TRASH_RETENTION_HOURS

_CLUSTER_XML = T.StructType([
    T.StructField("_name", T.StringType()), T.StructField("_hdfsurl", T.StringType()),
    T.StructField("_jturl", T.StringType()), T.StructField("_jobqueuename", T.StringType()),
    T.StructField("rootdir", T.StringType()),
])
_SRC = T.StructType([T.StructField("name", T.StringType()), T.StructField("retentioninhours", T.StringType())])
_DST = T.StructType([T.StructField("name", T.StringType()), T.StructField("retentioninhours", T.StringType()),
                     T.StructField("primary", T.StringType())])
_STREAM_XML = T.StructType([
    T.StructField("_name", T.StringType()),
    T.StructField("sources", T.StructType([T.StructField("source", T.ArrayType(_SRC))])),
    T.StructField("destinations", T.StructType([T.StructField("destination", T.ArrayType(_DST))])),
])
_DEFAULTS_XML = T.StructType([
    T.StructField("rootdir", T.StringType()),
    T.StructField("retentioninhours", T.StringType()),
    T.StructField("trashretentioninhours", T.StringType()),
])


def _hours(col, default_col):
    return F.coalesce(F.expr(f"try_cast(trim({col}) AS INT)"), default_col)


def load(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Parse a topology file into ``clusters, sources, destinations, defaults`` tables.

    Missing retention -> the file's default, itself 48 h (trash 24 h) when absent;
    ``primary`` is true only for a case-insensitive ``true``; a cluster's own
    ``rootdir`` overrides the default one.
    """
    defaults = (spark.read.format("xml").option("rowTag", "defaults").schema(_DEFAULTS_XML).load(path)
                .select(F.trim("rootdir").alias("rootdir"),
                        _hours("retentioninhours", F.lit(DEFAULT_RETENTION_HOURS)).alias("retention_hours"),
                        _hours("trashretentioninhours", F.lit(DEFAULT_TRASH_RETENTION_HOURS))
                        .alias("trash_retention_hours")))
    row = defaults.first()  # one configuration row
    def_hours = F.lit(row["retention_hours"] if row else DEFAULT_RETENTION_HOURS)
    def_root = F.lit(row["rootdir"] if row else None).cast("string")
    streams = spark.read.format("xml").option("rowTag", "stream").schema(_STREAM_XML).load(path)
    sources = (streams.select(F.col("_name").alias("stream"), F.explode("sources.source").alias("s"))
               .select("stream", F.trim("s.name").alias("cluster"),
                       _hours("s.retentioninhours", def_hours).alias("retention_hours")))
    dests = (streams.select(F.col("_name").alias("stream"), F.explode("destinations.destination").alias("d"))
             .select("stream", F.trim("d.name").alias("cluster"),
                     F.coalesce(F.lower(F.trim("d.primary")) == "true", F.lit(False)).alias("is_primary"),
                     _hours("d.retentioninhours", def_hours).alias("retention_hours")))
    clusters = (spark.read.format("xml").option("rowTag", "cluster").schema(_CLUSTER_XML).load(path)
                .select(F.col("_name").alias("name"), F.col("_hdfsurl").alias("hdfsurl"),
                        F.col("_jturl").alias("jturl"), F.col("_jobqueuename").alias("jobqueuename"),
                        F.coalesce(F.trim("rootdir"), def_root).alias("rootdir")))
    return {"clusters": clusters, "sources": sources, "destinations": dests, "defaults": defaults}


def sources_with_files(sources: DataFrame, files: DataFrame) -> DataFrame:
    """Configured sources with the number of collector files observed for each."""
    n = files.groupBy("cluster", "stream").agg(F.count(F.lit(1)).alias("n_files"))
    return (sources.join(n, ["cluster", "stream"], "left")
            .select("stream", "cluster", "retention_hours",
                    F.coalesce("n_files", F.lit(0).cast("long")).alias("n_files")))
