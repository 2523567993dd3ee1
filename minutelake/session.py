"""Session construction with the settings every job in this package assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on for correctness (UTC minutes, binary string order)
# and for scale (AQE re-planning, skew splitting, partial aggregation).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.speculation": "false",
    # partition values are strings as written: a stream named 007 stays 007
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # checkpoint files go with the frames that they belong to
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "minutelake", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, ``spark-submit`` supplies master and sizes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator of the cluster names a shared folder; we only set
    our own (a fresh scratch folder) when the setting is absent, as in tests.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="minutelake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def apply_session_settings(spark: SparkSession) -> None:
    """Set the correctness-critical settings on a session someone else built."""
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.sources.partitionColumnTypeInference.enabled"):
        spark.conf.set(k, BASE_CONF[k])


def cluster_settings(total_cores: int, advisory_mb: int = 128) -> dict:
    """Settings for a large cluster, to pass to ``spark-submit --conf`` or ``build_session(extra=...)``.

    * shuffles start wide (``initialPartitionNum`` = 4 x cores) and AQE coalesces them to
      ``advisory_mb`` partitions, so one setting serves a small audit and a 100 TB publish;
    * a skewed shuffle partition (hot stream/collector) is split once it exceeds 4x the median
      and 256 MB (AQE skew join), and ``REBALANCE`` writes split hot output partitions;
    * scan splits stay at 256 MB; small collector files are packed with a 1 MB open cost
      (gzip files are unsplittable: one file, one task).
    """
    return {
        "spark.sql.shuffle.partitions": str(4 * total_cores),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(4 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.files.openCostInBytes": "1m",
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
    }
