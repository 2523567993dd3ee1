"""J6-J8 by set digests: only buckets whose digests differ are compared by key.

A bucket is a function of the key alone (the hour in a path or in a file's name).  Its digest is the number of
its keys and the sum of their 128-bit hashes; sums don't depend on the order, add up over parts, and are equal
for equal sets.  So an audit of two sides that agree but for some hours is one partial aggregate of each (a
row for each group and bucket is shuffled, no key), and then the rule C9 over the keys of the hours that
differ.  A digest also has its greatest key: the bounds of C9 are those of the whole group, not of the hours
compared.  Copies of a key count, so a bucket that differs by copies only is compared and found equal.

Sites of ours keep digests with their commit records (``sinks.commitlog``): their audit reads the log, and
of the catalog only the hours that differ (``plans.audits``).

Keys are unequal with equal digests by accident of 128 bits only.  A null key is a key of the bucket ``""``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import layout as L
from ..session import ensure_checkpoint_dir
from . import audit

PARTS = ["d0", "d1", "d2", "d3"]
#: makes the second 64 bits of a key's hash (fixed: kept digests depend on it)
SECOND = "second"
#: differing buckets up to which their list is broadcast (some 100 bytes each); beyond it the join is a shuffle
BROADCAST_BUCKETS = 200_000
#: buckets for keys that have no hour
SPREAD = 4096


def sums(key) -> list[Column]:
    """Aggregates ``d0 .. d3``: sums of the 32-bit pieces of the keys' hashes (exact below 2**31 keys)."""
    a, b = F.xxhash64(L.c(key)), F.xxhash64(F.lit(SECOND), L.c(key))
    low = F.lit(0xFFFFFFFF).cast("long")
    pieces = [a.bitwiseAND(low), F.shiftrightunsigned(a, 32), b.bitwiseAND(low), F.shiftrightunsigned(b, 32)]
    return [F.sum(p).alias(name) for p, name in zip(pieces, PARTS)]


def path_hour(key) -> Column:
    """Bucket of a path below the stream (``yyyy/MM/dd/HH/...``): its hour."""
    return F.coalesce(F.substring(L.c(key), 1, 13), F.lit(""))


def name_hour(key) -> Column:
    """Bucket of a file name: the hour in it; names without one are spread by their hash."""
    hour = F.date_format(L.event_minute(key), "yyyy-MM-dd-HH")
    return F.coalesce(hour, F.concat(F.lit("#"), F.pmod(F.xxhash64(L.c(key)), F.lit(SPREAD)).cast("string")), F.lit(""))


def of_keys(rows: DataFrame, by: list[str], key: str = "key", path: str = "path") -> DataFrame:
    """Digests of the keys of ``rows``: ``by, n, d0 .. d3, last_key``."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums(key),
                                 F.max(F.when(F.col(path).isNotNull(), F.col(key))).alias("last_key"))


def merged(digests: DataFrame, by: list[str]) -> DataFrame:
    """Digests of the unions."""
    return digests.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ["n", *PARTS]], F.max("last_key").alias("last_key"))


def held_against(src: DataFrame, dst: DataFrame, group: list[str]) -> DataFrame:
    """A row for each group and bucket: greatest keys of both sides, and whether the bucket has to be compared by key."""
    by = [*group, "bucket"]
    none = F.lit(None).cast("string")
    sides = src.select(*by, *["n", *PARTS], F.col("last_key").alias("src_max"), none.alias("dst_max")).unionByName(
        dst.select(*by, *[F.negate(F.col(c)).alias(c) for c in ["n", *PARTS]], none.alias("src_max"),
                   F.col("last_key").alias("dst_max")))
    both = sides.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ["n", *PARTS]], F.max("src_max").alias("src_max"),
                                  F.max("dst_max").alias("dst_max"))
    differs = F.greatest(*[F.col(c) != 0 for c in ["n", *PARTS]])
    return both.select(*by, "src_max", "dst_max", differs.alias("differs"))


class Differing:
    """The buckets of two sides that differ, and the bounds of each group; both written to the checkpoint folder."""

    def __init__(self, src: DataFrame, dst: DataFrame, group: list[str]):
        ensure_checkpoint_dir(src.sparkSession)
        both = held_against(src, dst, group).checkpoint(eager=True)
        self.group = group
        self.bounds = both.groupBy(*group).agg(F.max("src_max").alias("src_max"), F.max("dst_max").alias("dst_max"))
        self.buckets = both.filter("differs").select(*group, "bucket")
        self.n_buckets = self.buckets.count()

    def names(self, most: int) -> list[str] | None:
        """The names of the differing buckets, if they are at most ``most``."""
        found = [r[0] for r in self.buckets.select("bucket").distinct().limit(most + 1).collect()]
        return sorted(found) if len(found) <= most else None

    def of(self, rows: DataFrame) -> DataFrame:
        """Those ``rows`` (``group, bucket``) whose bucket differs."""
        few = F.broadcast(self.buckets) if self.n_buckets <= BROADCAST_BUCKETS else self.buckets
        return rows.join(few, [*self.group, "bucket"], "left_semi")


def compare(bucket: Callable[[Column], Column], found: Differing | None = None):
    """``classify`` by digests, as the audits take it (``audit.audit_mirror(..., compare=compare(path_hour))``).

    ``found`` are the differing buckets where digests were kept; else both sides are read for them.
    """
    def classify(src: DataFrame, dst: DataFrame, group: list[str], key: str = "key", path: str = "path",
                 with_copies: bool = False) -> DataFrame:
        s, d = (x.select(*group, key, path).withColumn("bucket", bucket(F.col(key))) for x in (src, dst))
        by = [*group, "bucket"]
        odd = found or Differing(of_keys(s, by, key, path), of_keys(d, by, key, path), group)
        return audit.classify(odd.of(s).drop("bucket"), odd.of(d).drop("bucket"), group, key, path, with_copies, odd.bounds)

    return classify
