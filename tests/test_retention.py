"""isPurge boundaries, retention resolution, trash parsing, empty levels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from minutelake.functions import layout as L
from minutelake.operators import retention

NOW = dt.datetime(2024, 3, 10, 12, 0, 0)


@pytest.mark.parametrize("delta_hours,retention_hours,expected", [
    (-48, 48, True),     # exactly at retention -> purge (>=)
    (-47, 48, False),
    (-49, 48, True),
    (0, 48, False),
    (-1, 1, True),
    (-0.5, 1, False),    # partial hour truncates
    (72, 48, True),      # far future purges too (absolute age)
    (24, 48, False),
])
def test_is_purge(spark, delta_hours, retention_hours, expected):
    ts = NOW + dt.timedelta(hours=delta_hours)
    df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
    now = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    got = df.select(retention.is_purge("ts", now, F.lit(retention_hours)).alias("p")).first().p
    assert got is expected


def test_retention_resolution(spark):
    src = spark.createDataFrame([("test1", "testcluster1", None), ("test1", "testcluster2", 46),
                                 ("test1", "testcluster3", 50)], "stream string, cluster string, retention_hours int")
    dst = spark.createDataFrame([], "stream string, cluster string, is_primary boolean, retention_hours int")
    eff = {(r.cluster, r.stream): r.retention_hours for r in retention.effective_retention(src, dst).collect()}
    assert eff == {("testcluster1", "test1"): 48, ("testcluster2", "test1"): 46, ("testcluster3", "test1"): 50}
    hours = spark.createDataFrame([("testcluster1", "streams", "unknown", NOW - dt.timedelta(hours=48))],
                                  "cluster string, base string, stream string, hour timestamp_ntz")
    now = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    assert retention.purge_set(hours, retention.effective_retention(src, dst), now).count() == 1  # default 48


def test_max_of_source_and_destination(spark):
    src = spark.createDataFrame([("s", "c1", 12)], "stream string, cluster string, retention_hours int")
    dst = spark.createDataFrame([("s", "c1", True, 24)], "stream string, cluster string, is_primary boolean, retention_hours int")
    assert retention.effective_retention(src, dst).first().retention_hours == 24


def test_trash_purge_unparseable(spark):
    dirs = spark.createDataFrame([("c", "2024-3-10", "11"), ("c", "2024-3-9", "11"), ("c", "2024-3-10", "x1"),
                                  ("c", "junk", "3")], "cluster string, day_dir string, hour_dir string")
    now = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    got = sorted((r.day_dir, r.hour_dir) for r in retention.trash_purge_set(dirs, now).collect())
    assert got == [("2024-3-10", "x1"), ("2024-3-9", "11"), ("junk", "3")]


def test_empty_levels(spark):
    d = [("c", "b", "s", "year", "/r/2024"), ("c", "b", "s", "month", "/r/2024/01"),
         ("c", "b", "s", "day", "/r/2024/01/02"), ("c", "b", "s", "hour", "/r/2024/01/02/03"),
         ("c", "b", "s", "day", "/r/2024/01/03"), ("c", "b", "s", "month", "/r/2024/02"),
         ("c", "b", "s", "year", "/r/2025")]
    df = spark.createDataFrame(d, "cluster string, base string, stream string, level string, path string")
    got = sorted(r.path for r in retention.empty_levels(df).collect())
    assert got == ["/r/2024/01/03", "/r/2024/02", "/r/2025"]


def test_age_hours_java_truncation(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 59, 59),)], "ts timestamp_ntz")
    now = F.lit("2024-01-01 02:00:00").cast("timestamp_ntz")
    assert df.select(L.age_hours("ts", now).alias("a")).first().a == 1
