"""End to end on real directories: local ingest twice, merge, mirror, self-audits, purge."""

import datetime as dt
import os

from pyspark.sql import functions as F

from minutelake.operators import audit
from minutelake.plans import run as R
from minutelake.schemas import LOCAL_BASE, MERGED_BASE
from minutelake.sinks import writers as W
from minutelake.sources.records import read_published

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _write(root, stream, collector, name, lines, mtime):
    d = os.path.join(root, "data", stream, collector)
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, name)
    with open(p, "w", newline="") as f:
        f.write("".join(line + "\n" for line in lines))
    ts = mtime.replace(tzinfo=dt.timezone.utc).timestamp()
    os.utime(p, (ts, ts))


def _fname(stream, m):
    return f"{stream}-{m:%Y-%m-%d-%H-%M}_00000"


def _topology(spark):
    src = spark.createDataFrame([("s1", "c1", 48), ("s1", "c2", 48)], "stream string, cluster string, retention_hours int")
    dst = spark.createDataFrame([("s1", "c1", True, 48), ("s1", "c3", False, 48)],
                                "stream string, cluster string, is_primary boolean, retention_hours int")
    return src, dst


def test_services_end_to_end(spark, tmp_path):
    sites = {n: R.Site(n, str(tmp_path / n)) for n in ("c1", "c2", "c3")}
    src, dst = _topology(spark)
    for n in ("c1", "c2"):
        for i in range(3):
            m = T0 + dt.timedelta(minutes=i)
            _write(sites[n].root, "s1", "k1", _fname("s1", m), [f"{n}-r{i}-{j}" for j in range(4)],
                   m + dt.timedelta(seconds=50))
    # line with a carriage return survives unchanged
    _write(sites["c1"].root, "s1", "k2", _fname("s1", T0), ["a\rb", "plain"], T0 + dt.timedelta(seconds=5))
    now1 = "2024-01-01 10:03:00"
    for n in ("c1", "c2"):
        out = R.run_local(spark, sites[n], now1, 1, src, dst)
        # newest file of k1 (10:02:50) is within 5 minutes -> in flight; k2's only file too
        assert out["new_files"] == 2
    loc1 = read_published(spark, sites["c1"].base(LOCAL_BASE))
    assert loc1.count() == 8
    # second run, nothing new -> no replay
    assert R.run_local(spark, sites["c1"], "2024-01-01 10:04:00", 2, src, dst)["new_files"] == 0
    # after the timeout the in-flight files are delivered
    now3 = "2024-01-01 10:09:00"
    assert R.run_local(spark, sites["c1"], now3, 3, src, dst)["new_files"] == 2
    R.run_local(spark, sites["c2"], now3, 3, src, dst)
    loc1 = read_published(spark, sites["c1"].base(LOCAL_BASE))
    assert loc1.count() == 14
    assert loc1.filter(F.col("value") == "a\rb").count() == 1
    assert sorted(r.minute for r in loc1.select("minute").distinct().collect()) == [
        dt.datetime(2024, 1, 1, 10, 3), dt.datetime(2024, 1, 1, 10, 9)]
    # gap minutes between the two local commits are in the ledger as empty
    led = W.read_ledger(spark, sites["c1"].ledger()).filter("base = 'streams_local' AND state = 'empty'")
    assert led.count() == 5
    # merge both local streams into c1, then mirror to c3
    R.run_merge(spark, [sites["c1"], sites["c2"]], sites["c1"], "2024-01-01 10:10:00", 10, src, dst)
    merged = read_published(spark, sites["c1"].base(MERGED_BASE))
    assert merged.count() == 14 + 12
    # merging again finds every manifest acknowledged -> no data, but 10:11..10:14 become empty
    # minutes of the merged stream and are sent to the mirror (U4)
    assert R.run_merge(spark, [sites["c1"], sites["c2"]], sites["c1"], "2024-01-01 10:15:00", 11, src, dst) \
        == {"merged_files": 0, "gap_minutes": 4}
    R.run_mirror(spark, sites["c1"], sites["c3"], "2024-01-01 10:16:00", 12)
    mled = W.read_ledger(spark, sites["c3"].ledger())
    assert sorted(r.minute.minute for r in mled.filter("state = 'empty'").collect()) == [11, 12, 13, 14]
    mirrored = read_published(spark, sites["c3"].base(MERGED_BASE))
    assert mirrored.count() == merged.count()
    assert {r.minute for r in mirrored.select("minute").distinct().collect()} == \
        {r.minute for r in merged.select("minute").distinct().collect()}
    # audits of our own output are clean
    l1 = R.published_catalog(spark, sites["c1"], LOCAL_BASE)
    l2 = R.published_catalog(spark, sites["c2"], LOCAL_BASE)
    m1 = R.published_catalog(spark, sites["c1"], MERGED_BASE)
    assert audit.audit_merge(l1.unionByName(l2), m1).count() == 0
    m3 = R.published_catalog(spark, sites["c3"], MERGED_BASE)
    me = audit.stream_entries(m1, spark.createDataFrame([], R._LEDGER_SCHEMA))
    mi = audit.stream_entries(m3.withColumn("cluster", F.lit("c3")), spark.createDataFrame([], R._LEDGER_SCHEMA))
    assert audit.audit_mirror(me, mi).count() == 0
    # checkpoints advanced to the newest delivered names
    ck = {(r.collector, r.file_name) for r in W.read_checkpoints(spark, sites["c1"].checkpoints()).collect()}
    assert ck == {("k1", _fname("s1", T0 + dt.timedelta(minutes=2))), ("k2", _fname("s1", T0))}
    # purge everything older than 1 hour a day later
    ret = spark.createDataFrame([("c1", "s1", 1)], "cluster string, stream string, retention_hours int")
    assert W.read_ledger(spark, sites["c1"].ledger()).count() > 0
    out = R.run_purge(spark, sites["c1"], "2024-01-02 10:00:00", ret)
    assert out["dropped_hours"] == 2
    assert W.read_ledger(spark, sites["c1"].ledger()).count() == 0   # its minutes went with the hours
    assert out["dropped_trash_hours"] == 0  # nothing was trashed: at most 6 files per collector
    assert not os.path.exists(os.path.join(sites["c1"].base(LOCAL_BASE), "stream=s1", "hour=2024-01-01-10"))


def test_replayed_batch_is_idempotent(spark, tmp_path):
    recs = spark.createDataFrame(
        [("c1", "streams_local", "s", dt.datetime(2024, 1, 1, 0, 1), "k-f.gz", "k", "f", "v1", dt.datetime(2024, 1, 1, 0, 1))],
        "cluster string, base string, stream string, minute timestamp_ntz, file_name string, collector string, "
        "src_file string, value string, committed_at timestamp_ntz")
    out = str(tmp_path / "t")
    W.write_published(recs, out, 7)
    W.write_published(recs, out, 7)   # the same batch again after a failure
    W.write_published(recs, out, 8)   # a different batch is a replay the audits report
    df = read_published(spark, out)
    assert df.filter("batch_id = 7").count() == 1
    assert df.count() == 2


def test_trash_then_purge(spark, tmp_path):
    site = R.Site("c1", str(tmp_path / "c1"))
    src, dst = _topology(spark)
    for i in range(8):
        m = T0 + dt.timedelta(minutes=i)
        _write(site.root, "s1", "k1", _fname("s1", m), [f"r{i}"], m)
    out = R.run_local(spark, site, "2024-01-01 11:00:00", 1, src, dst)
    assert out["new_files"] == 8 and out["trashed"] == 2
    trash = tmp_path / "c1" / "system" / "trash" / "2024-1-1" / "11"
    assert sorted(p.name for p in trash.iterdir()) == [f"k1-{_fname('s1', T0)}", f"k1-{_fname('s1', T0 + dt.timedelta(minutes=1))}"]
    assert len(os.listdir(tmp_path / "c1" / "data" / "s1" / "k1")) == 6
    ret = spark.createDataFrame([], "cluster string, stream string, retention_hours int")
    out = R.run_purge(spark, site, "2024-01-02 12:00:00", ret)
    assert out["dropped_trash_hours"] == 1 and not trash.exists()


def test_all_dangling_manifests_stay_pending(spark, tmp_path):
    """C14: a merge whose manifest paths all point to absent files commits nothing and acks nothing."""
    src, dst = _topology(spark)
    c2 = R.Site("c2", str(tmp_path / "c2"))
    c1 = R.Site("c1", str(tmp_path / "c1"))
    man = spark.createDataFrame(
        [("merge", "c2", "c2", "c1", "s1", f"{c2.root}/streams_local/s1/2024/01/01/00/01/k-gone.gz",
          dt.datetime(2024, 1, 1, 0, 1), 5)],
        "kind string, src_cluster string, via_cluster string, dest_cluster string, stream string, path string, "
        "minute timestamp_ntz, batch_id bigint")
    W.append_manifests(man, c2.manifests())
    assert R.run_merge(spark, [c2], c1, "2024-01-01 00:05:00", 1, src, dst)["merged_files"] == 0
    assert not os.path.exists(c2.acks())
    assert R.run_merge(spark, [c2], c1, "2024-01-01 00:06:00", 2, src, dst)["merged_files"] == 0


def test_gzip_text_publish(spark, tmp_path):
    recs = spark.createDataFrame(
        [("s", dt.datetime(2024, 1, 1, 0, 1), "k-f.gz", "line\r1"), ("s", dt.datetime(2024, 1, 1, 0, 1), "k-f.gz", "l2"),
         ("t", dt.datetime(2024, 1, 1, 0, 1), "k-g.gz", "x")],
        "stream string, minute timestamp_ntz, file_name string, value string")
    out = str(tmp_path / "txt")
    W.write_published_text(recs, out)
    parts = list((tmp_path / "txt" / "stream=s" / "minute_key=2024-01-01-00-01" / "file_name=k-f.gz").iterdir())
    assert any(p.name.endswith(".gz") for p in parts)
    back = spark.read.option("lineSep", "\n").text(out)
    assert sorted(r.value for r in back.collect()) == ["l2", "line\r1", "x"]


def test_rerun_after_crash_is_idempotent(spark, tmp_path):
    """The same batch re-run after a crash between publish and checkpoint adds nothing twice."""
    import shutil
    site = R.Site("c1", str(tmp_path / "c1"))
    src, dst = _topology(spark)
    for i in range(3):
        m = T0 + dt.timedelta(minutes=i)
        _write(site.root, "s1", "k1", _fname("s1", m), [f"r{i}a", f"r{i}b"], m)
    R.run_local(spark, site, "2024-01-01 11:00:00", 1, src, dst)
    counts = lambda: (read_published(spark, site.base(LOCAL_BASE)).count(),
                      W.read_ledger(spark, site.ledger()).count(), spark.read.parquet(site.manifests()).count(),
                      sorted(p.name for p in (tmp_path / "c1" / "system" / "trash_catalog").rglob("*.parquet")))
    before = counts()
    shutil.rmtree(site.checkpoints())          # the crash lost the checkpoint step
    out = R.run_local(spark, site, "2024-01-01 11:00:00", 1, src, dst)
    assert out["new_files"] == 3
    assert counts() == before


def test_read_selected_pruned_and_joined(spark, tmp_path):
    from minutelake.sources import catalog
    from minutelake.sources.records import read_selected
    root = str(tmp_path / "c1")
    for i, name in enumerate(("s1-a", "s1-b", "s1-it's", "s1-z")):
        _write(root, "s1", "k1", name, [f"{name}-1", f"{name}-2"], T0 + dt.timedelta(minutes=i))
    files = catalog.collector_files(spark, root, "c1")
    # the selection's mtime range covers s1-b..s1-it's; s1-a (older) is pruned, s1-z (newer) too
    sel = files.filter("file_name IN ('s1-b', 's1-it''s')")
    got = read_selected(spark, f"{root}/data", sel, "c1")
    assert sorted(r.value for r in got.collect()) == sorted(["s1-b-1", "s1-b-2", "s1-it's-1", "s1-it's-2"])
    assert {(r.stream, r.collector) for r in got.collect()} == {("s1", "k1")}
    # a late file with an old mtime is still read (the range only widens)
    late = files.filter("file_name IN ('s1-a', 's1-z')")
    got = read_selected(spark, f"{root}/data", late, "c1")
    assert sorted(r.value for r in got.collect()) == ["s1-a-1", "s1-a-2", "s1-z-1", "s1-z-2"]


def test_idle_empty_files_deleted(spark, tmp_path):
    site = R.Site("c1", str(tmp_path / "c1"))
    src, dst = _topology(spark)
    _write(site.root, "s1", "k1", _fname("s1", T0), ["r"], T0)
    _write(site.root, "s1", "k1", "old-empty", [], T0)
    _write(site.root, "s1", "k1", "fresh-empty", [], T0 + dt.timedelta(minutes=59))
    R.run_local(spark, site, "2024-01-01 11:00:00", 1, src, dst)
    left = sorted(os.listdir(tmp_path / "c1" / "data" / "s1" / "k1"))
    assert left == ["fresh-empty", _fname("s1", T0)]


def test_mirror_gaps_only_and_dangling_file(spark, tmp_path):
    """Gap minutes reach the mirror before any data; a dangling file path is not an empty minute."""
    m, r = R.Site("c1", str(tmp_path / "c1")), R.Site("c3", str(tmp_path / "c3"))
    rows = [("mirror", "c1", "c1", "c3", "s1", f"{m.root}/streams/s1/2024/01/01/00/05", dt.datetime(2024, 1, 1, 0, 5), 1),
            ("mirror", "c1", "c1", "c3", "s1", f"{m.root}/streams/s1/2024/01/01/00/06/k-gone.gz",
             dt.datetime(2024, 1, 1, 0, 6), 1)]
    W.append_manifests(spark.createDataFrame(rows, R._MANIFEST_SCHEMA), m.manifests())
    R.run_mirror(spark, m, r, "2024-01-01 00:10:00", 1)
    led = W.read_ledger(spark, r.ledger()).collect()
    assert [(x.state, x.minute.minute) for x in led] == [("empty", 5)]
    assert R.run_mirror(spark, m, r, "2024-01-01 00:11:00", 2) == {"mirrored": 0}  # acknowledged


def test_read_records_path_list(spark, tmp_path):
    from minutelake.sources.records import read_records
    root = str(tmp_path / "c1")
    _write(root, "s1", "k1", "s1-f", ["a\rx", "b"], T0)
    _write(root, "s2", "k2", "s2-f", ["c"], T0)
    paths = [f"file:{root}/data/s1/k1/s1-f", f"file:{root}/data/s2/k2/s2-f"]
    got = sorted(tuple(r)[:5] for r in read_records(spark, paths, "c1").collect())
    assert got == [("c1", "s1", "k1", "s1-f", "a\rx"), ("c1", "s1", "k1", "s1-f", "b"), ("c1", "s2", "k2", "s2-f", "c")]
    assert read_records(spark, [], "c1").count() == 0


def test_site_without_data_folder(spark, tmp_path):
    src, dst = _topology(spark)
    out = R.run_local(spark, R.Site("c9", str(tmp_path / "c9")), "2024-01-01 00:00:00", 1, src, dst)
    assert out["new_files"] == 0
