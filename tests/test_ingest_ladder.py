"""Port of the reference's listing scenario ladder on a real directory tree."""

import datetime as dt
import os

from pyspark.sql import functions as F

from minutelake.operators import ingest
from minutelake.sources import catalog

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def _touch(d, name, data, mtime):
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(data)
    ts = mtime.replace(tzinfo=dt.timezone.utc).timestamp()
    os.utime(p, (ts, ts))


def _state(spark, root, now, timeout_ms=300_000):
    files = catalog.collector_files(spark, root, "c1")
    now_c = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    closed = ingest.closed_files(files, now_c, timeout_ms).cache()
    results = closed.count()
    trash = ingest.trash_select(closed).count()
    ckpt = ingest.advance_checkpoint(closed).count()
    return results, trash, ckpt


def test_scenario_ladder(spark, tmp_path):
    root = str(tmp_path)
    coll = os.path.join(root, "data", "stream1", "collector1")
    os.makedirs(coll)
    sec = lambda n: T0 + dt.timedelta(seconds=n)
    _touch(coll, "stream1_current", "x", sec(1))
    _touch(coll, "scribe_stats", "x", sec(1))
    assert _state(spark, root, sec(2)) == (0, 0, 0)
    _touch(coll, "datafile1", "", sec(3))
    assert _state(spark, root, sec(3)) == (0, 0, 0)
    assert _state(spark, root, sec(4), timeout_ms=10) == (0, 0, 0)   # empty, not current
    _touch(coll, "datafile2", "this is a testcase", sec(5))
    assert _state(spark, root, sec(6), timeout_ms=10) == (1, 0, 1)   # idle -> processed
    _touch(coll, "datafile3", "this is a testcase", sec(7))
    assert _state(spark, root, sec(8)) == (1, 0, 1)                  # datafile3 in flight
    for i, n in enumerate(range(4, 8)):
        _touch(coll, f"datafile{n}", "this is a testcase", sec(9 + i))
    assert _state(spark, root, sec(20)) == (5, 0, 1)
    _touch(coll, "datafile8", "this is a testcase", sec(21))
    _touch(coll, "datafile9", "this is a testcase", sec(22))
    assert _state(spark, root, sec(23)) == (7, 1, 1)


def test_current_file_tie_and_case(spark):
    now = F.lit("2024-01-01 00:10:00").cast("timestamp_ntz")
    t = dt.datetime(2024, 1, 1, 0, 9, 0)
    df = spark.createDataFrame(
        [("c", "s", "k", "a", "/p/a", t, 5), ("c", "s", "k", "b", "/p/b", t, 5),
         ("c", "s", "k", "B", "/p/B", t - dt.timedelta(minutes=1), 5)],
        "cluster string, stream string, collector string, file_name string, path string, "
        "mtime timestamp_ntz, length bigint")
    names = sorted(r.file_name for r in ingest.closed_files(df, now).collect())
    # newest tie -> the greater name 'b' is in flight; 'B' matches it case-insensitively
    assert names == ["a"]
    names = sorted(r.file_name for r in ingest.closed_files(df, now, timeout_ms=60_000).collect())
    assert names == ["B", "a", "b"]   # idle for exactly the timeout -> closed (C3)


def test_checkpoint_and_late(spark):
    cols = "cluster string, stream string, collector string, file_name string, path string, mtime timestamp_ntz, length bigint"
    t = dt.datetime(2024, 1, 1)
    files = spark.createDataFrame([("c", "s", "k", f"f{i}", f"/p/f{i}", t, 1) for i in range(1, 6)], cols)
    ck = spark.createDataFrame([("c", "s", "k", "f3")], "cluster string, stream string, collector string, file_name string")
    assert sorted(r.file_name for r in ingest.above_checkpoint(files, ck).collect()) == ["f4", "f5"]
    adv = ingest.advance_checkpoint(files.filter("file_name < 'f3'"), ck).collect()
    assert [r.file_name for r in adv] == ["f3"]  # never regresses
    pub = spark.createDataFrame([("c", "s", "k-f1.gz")], "cluster string, stream string, file_name string")
    late = sorted(r.file_name for r in ingest.late_files(files, ck, pub).collect())
    assert late == ["f2", "f3"]


def test_trash_keep_last_six_large_collector(spark):
    cols = "cluster string, stream string, collector string, file_name string, path string, mtime timestamp_ntz, length bigint"
    t = dt.datetime(2024, 1, 1)
    data = [("c", "s", "hot", f"f{i:05d}", "/p", t, 1) for i in range(5000)]
    data += [("c", "s", "small", f"g{i}", "/p", t, 1) for i in range(4)]
    df = spark.createDataFrame(data, cols)
    tr = ingest.trash_select(df)
    got = {(r.collector, r.file_name) for r in tr.collect()}
    assert len(got) == 5000 - 6
    assert ("hot", "f04993") in got and ("hot", "f04994") not in got
    assert not any(c == "small" for c, _ in got)


def test_on_late_deliver(spark):
    from minutelake.plans import jobs
    cols = "cluster string, stream string, collector string, file_name string, path string, mtime timestamp_ntz, length bigint"
    t = dt.datetime(2024, 1, 1)
    files = spark.createDataFrame([("c", "s", "k", f"f{i}", f"/p/f{i}", t, 1) for i in range(1, 4)], cols)
    ck = spark.createDataFrame([("c", "s", "k", "f2")], "cluster string, stream string, collector string, file_name string")
    pub = spark.createDataFrame([("c", "s", "k-f1.gz")], "cluster string, stream string, file_name string")
    now = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    drop = jobs.plan_ingest(files, ck, now, published=pub)
    assert sorted(r.file_name for r in drop.new_files.collect()) == ["f3"]
    assert sorted(r.file_name for r in drop.late.collect()) == ["f2"]
    deliver = jobs.plan_ingest(files, ck, now, published=pub, on_late="deliver")
    assert sorted(r.file_name for r in deliver.new_files.collect()) == ["f2", "f3"]


def test_text_manifests_and_trash_listing(spark, tmp_path):
    from minutelake.sources import manifests
    d = tmp_path / "consumers" / "c2"
    d.mkdir(parents=True)
    (d / "1000").write_text("/r/streams_local/s/2024/01/01/00/01/k-a.gz \n\n/r/x\n")
    (d / "1060").write_text("/r/x\n")
    m = manifests.read_text_manifests(spark, str(d), "merge", "c2")
    got = sorted((r.batch_id, r.path) for r in m.collect())
    assert got == [(1000, "/r/streams_local/s/2024/01/01/00/01/k-a.gz"), (1000, "/r/x"), (1060, "/r/x")]
    t = tmp_path / "root" / "system" / "trash"
    for day, hour in (("2024-1-5", "7"), ("2024-1-5", "8"), ("junk", "x")):
        (t / day / hour).mkdir(parents=True)
        (t / day / hour / "k-f").write_text("x")
    dirs = sorted(tuple(r)[1:] for r in manifests.trash_dirs(spark, str(tmp_path / "root"), "c").collect())
    assert dirs == [("2024-1-5", "7"), ("2024-1-5", "8"), ("junk", "x")]


def test_listing_scoped_to_streams(spark, tmp_path):
    root = str(tmp_path)
    for s in ("s1", "s2"):
        d = os.path.join(root, "data", s, "k")
        os.makedirs(d)
        _touch(d, f"{s}-f", "x", T0)
    got = {r.stream for r in catalog.collector_files(spark, root, "c", streams=["s2"]).collect()}
    assert got == {"s2"}


def test_collapse_text_manifests(spark, tmp_path):
    from minutelake.sources import manifests
    d = tmp_path / "backlog"
    d.mkdir()
    (d / "1000").write_text("/a \n/b\n")
    (d / "1060").write_text("/b\n/c\n\n")
    assert manifests.collapse_text_manifests(spark, str(d), str(tmp_path / "one")) == 3
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "one")).collect())
    assert got == ["/a", "/b", "/c"]
    single = tmp_path / "single"
    single.mkdir()
    (single / "1").write_text("/x\n")
    assert manifests.collapse_text_manifests(spark, str(single), str(tmp_path / "two")) == 0
