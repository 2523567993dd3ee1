"""No run loses or doubles a record: odd names, crashes after any step, replays at another minute, backlogs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from minutelake.plans import audits
from minutelake.plans import run as R
from minutelake.schemas import LOCAL_BASE, MERGED_BASE
from minutelake.sinks import commitlog
from minutelake.sinks import files as fsops
from minutelake.sinks import writers as W
from minutelake.sources.records import numbered, read_published

T0 = dt.datetime(2024, 3, 1, 6, 0)


def put(root, stream, collector, name, lines, mtime=T0):
    d = os.path.join(root, "data", stream, collector)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", newline="") as f:
        f.write("".join(x + "\n" for x in lines))
    at = mtime.replace(tzinfo=dt.timezone.utc).timestamp()
    os.utime(os.path.join(d, name), (at, at))


def topology(spark, streams=("beacon",), mirrors=True):
    src = [(s, "north", 48) for s in streams]
    dst = [(s, "north", True, 48) for s in streams] + [(s, "south", False, 48) for s in streams if mirrors]
    return (spark.createDataFrame(src, "stream string, cluster string, retention_hours int"),
            spark.createDataFrame(dst, "stream string, cluster string, is_primary boolean, retention_hours int"))


def values(spark, site, base=LOCAL_BASE):
    return sorted((r.stream, r.collector, r.src_file, r.value) for r in read_published(spark, site.base(base)).collect())


ODD = ["sp ace", "pct%x", "pl+us", "_under", ".dot", "eq=al", "ha#sh", "it's", "br[ack]et{s}", "übung"]


def test_odd_names_lose_nothing(spark, tmp_path):
    site = R.Site("north", str(tmp_path / "north"))
    streams = ["007", "12", "a b%c", "plain"]
    wanted = []
    for i, name in enumerate(ODD):
        s = streams[i % 4]
        put(site.root, s, f"k{i}", name, [f"{name}-1", f"{name}-2"])
        wanted += [(s, f"k{i}", name, f"{name}-{n}") for n in (1, 2)]
    put(site.root, "plain", "_hidden", "f", ["h"])
    put(site.root, "plain", ".k", "g", ["d"])
    wanted += [("plain", "_hidden", "f", "h"), ("plain", ".k", "g", "d")]
    src, dst = topology(spark, streams)
    out = R.run_local(spark, site, "2024-03-01 07:00:00", 1, src, dst)
    assert out["new_files"] == len(ODD) + 2 and values(spark, site) == sorted(wanted)
    # merged, mirrored and purged under the same names
    south = R.Site("south", str(tmp_path / "south"))
    assert R.run_merge(spark, [site], site, "2024-03-01 07:01:00", 2, src, dst)["merged_files"] == len(ODD) + 2
    assert R.run_mirror(spark, site, south, "2024-03-01 07:02:00", 3)["mirrored_files"] == len(ODD) + 2
    assert values(spark, south, MERGED_BASE) == sorted(wanted)
    ret = spark.createDataFrame([], "cluster string, stream string, retention_hours int")
    assert R.run_purge(spark, site, "2024-03-09 07:00:00", ret)["dropped_hours"] == 2 * len(streams)
    assert W.read_ledger(spark, site.ledger()).count() == 0
    assert fsops.subfolders(spark, site.base(LOCAL_BASE)) == []  # A7: the streams' empty folders went too


STEPS = ["write_published", "write_catalog", "write_ledger_rows", "append_manifests", "write_checkpoints", "append_trash"]


@pytest.mark.parametrize(("when", "step"), [("before", STEPS[0]), *(("after", s) for s in STEPS)])
def test_a_crash_after_any_step_is_replayed_at_a_later_minute(spark, tmp_path, monkeypatch, when, step):
    site = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark)
    for i in range(8):
        put(site.root, "beacon", "k", f"f{i}", [f"{i}a", f"{i}b"], T0 + dt.timedelta(minutes=i))
    real = getattr(W, step)

    def crash(*a, **k):
        if when == "after":
            real(*a, **k)
        raise RuntimeError("crash")

    monkeypatch.setattr(W, step, crash)
    with pytest.raises(RuntimeError, match="crash"):
        R.run_local(spark, site, "2024-03-01 07:00:00", 5, src, dst)
    monkeypatch.undo()
    put(site.root, "beacon", "k", "f9", ["9a"], T0 + dt.timedelta(minutes=30))  # comes in between
    R.run_local(spark, site, "2024-03-01 07:03:00", 5, src, dst)
    first = [("beacon", "k", f"f{i}", f"{i}{x}") for i in range(8) for x in "ab"]
    assert values(spark, site) == first
    assert {r.minute_key for r in read_published(spark, site.base(LOCAL_BASE)).collect()} == {"2024-03-01-07-00"}
    m = spark.read.schema(W.MANIFEST_SCHEMA).parquet(site.manifests())
    assert m.count() == 8 and m.select("path").distinct().count() == 8
    R.run_local(spark, site, "2024-03-01 07:04:00", 6, src, dst)
    assert values(spark, site) == sorted([*first, ("beacon", "k", "f9", "9a")])
    assert audits.local_stream_consistency(spark, [site.root]).count() == 0


def test_one_path_in_several_batches_is_merged_once(spark, tmp_path):
    north = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark, mirrors=False)
    put(north.root, "beacon", "k", "f1", ["a"])
    R.run_local(spark, north, "2024-03-01 07:00:00", 1, src, dst)
    again = spark.read.schema(W.MANIFEST_SCHEMA).parquet(north.manifests()).withColumn("batch_id", F.lit(2).cast("long"))
    W.append_manifests(again.checkpoint(eager=True), north.manifests())
    assert R.run_merge(spark, [north], north, "2024-03-01 07:01:00", 3, src, dst)["merged_files"] == 1
    assert R.run_merge(spark, [north], north, "2024-03-01 07:02:00", 4, src, dst)["merged_files"] == 0
    assert values(spark, north, MERGED_BASE) == [("beacon", "k", "f1", "a")]
    # consumed manifests and their acknowledgements are gone
    assert W.read_table(spark, north.manifests(), W.MANIFEST_SCHEMA).filter("kind = 'merge'").count() == 0
    assert W.read_table(spark, north.acks(), W.ACK_SCHEMA).count() == 0


def test_a_merge_replayed_at_a_later_minute(spark, tmp_path, monkeypatch):
    north = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark)
    put(north.root, "beacon", "k", "f1", ["a", "b"])
    R.run_local(spark, north, "2024-03-01 07:00:00", 1, src, dst)
    monkeypatch.setattr(R, "_acknowledge", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        R.run_merge(spark, [north], north, "2024-03-01 07:01:00", 2, src, dst)
    monkeypatch.undo()
    R.run_merge(spark, [north], north, "2024-03-01 07:05:00", 2, src, dst)
    got = read_published(spark, north.base(MERGED_BASE)).collect()
    assert sorted((r.value, r.minute_key) for r in got) == [("a", "2024-03-01-07-01"), ("b", "2024-03-01-07-01")]


def test_a_mirror_backlog_without_a_valid_path_stays_pending(spark, tmp_path):
    north, south = R.Site("north", str(tmp_path / "north")), R.Site("south", str(tmp_path / "south"))
    gone = [("north", "north", "beacon", f"{north.root}/streams/beacon/2024/03/01/06/0{i}/k-gone.gz", T0, "mirror", "south", i) for i in (1, 2)]
    W.append_manifests(spark.createDataFrame(gone, W.MANIFEST_SCHEMA), north.manifests())
    for n in (1, 2):
        assert R.run_mirror(spark, north, south, f"2024-03-01 07:0{n}:00", n) == {"mirrored": 0}
    assert spark.read.schema(W.MANIFEST_SCHEMA).parquet(north.manifests()).count() == 2 and not os.path.exists(north.acks())


def test_faults_of_the_checkpoint_store_and_lost_files_abort(spark, tmp_path, monkeypatch):
    site = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark)
    put(site.root, "beacon", "k", "f1", ["a"])
    os.makedirs(f"{site.checkpoints()}/batch_id=1")
    with open(f"{site.checkpoints()}/batch_id=1/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|FAILED_READ_FILE"):
        R.run_local(spark, site, "2024-03-01 07:00:00", 2, src, dst)
    assert not os.path.exists(site.base(LOCAL_BASE))
    other = R.Site("north", str(tmp_path / "other"))
    put(other.root, "beacon", "k", "f1", ["a"])
    put(other.root, "beacon", "k", "f2", ["b"], T0 + dt.timedelta(seconds=5))
    real = R.read_selected
    monkeypatch.setattr(R, "read_selected", lambda *a: real(*a).filter("src_file <> 'f2'"))
    with pytest.raises(R.IncompletePublish):
        R.run_local(spark, other, "2024-03-01 07:00:00", 1, src, dst)
    assert not os.path.exists(other.checkpoints())


def test_empty_files_are_deleted_by_the_collector_filter(spark, tmp_path):
    site = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark)
    put(site.root, "beacon", "k", "f1", ["a"])
    for name in ("beacon_current", "scribe_stats", "SCRIBE_STATS", "old", "_old"):
        put(site.root, "beacon", "k", name, [])
    put(site.root, "beacon", "k", "fresh", [], T0 + dt.timedelta(minutes=58))
    R.run_local(spark, site, "2024-03-01 07:00:00", 1, src, dst)
    assert sorted(os.listdir(f"{site.root}/data/beacon/k")) == ["SCRIBE_STATS", "beacon_current", "f1", "fresh", "scribe_stats"]


def test_lines_keep_their_order_and_have_a_key(spark, tmp_path):
    site = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark)
    lines = [f"line {i:05d} " + "x" * (i % 50) for i in range(4000)]
    put(site.root, "beacon", "k", "f1", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        R.run_local(spark, site, "2024-03-01 07:00:00", 1, src, dst)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = read_published(spark, site.base(LOCAL_BASE))
    got = [r.value for r in rows.orderBy("block_start", "line_pos").collect()]
    assert got == lines and rows.select("block_start").distinct().count() > 1
    keyed = numbered(rows)
    assert keyed.select("src_file", "block_start", "record_no").distinct().count() == len(lines)
    out = str(tmp_path / "text")
    W.write_published_text(rows, out)
    d = f"{out}/stream=beacon/minute_key=2024-03-01-07-00/file_name=k-f1.gz"
    import gzip
    text = b"".join(gzip.open(f"{d}/{p}").read() for p in sorted(os.listdir(d)) if p.endswith(".gz"))
    assert text.decode().splitlines() == lines


def test_late_files_are_reported_and_delivered_on_demand(spark, tmp_path):
    site = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark)
    put(site.root, "beacon", "k", "f5", ["e"])
    assert R.run_local(spark, site, "2024-03-01 07:00:00", 1, src, dst)["late_files"] == 0
    put(site.root, "beacon", "k", "f1", ["late"])
    out = R.run_local(spark, site, "2024-03-01 07:01:00", 2, src, dst)
    assert (out["new_files"], out["late_files"]) == (0, 1)
    out = R.run_local(spark, site, "2024-03-01 07:02:00", 3, src, dst, on_late="deliver")
    assert (out["new_files"], out["late_files"]) == (1, 1)
    assert [v for *_, v in values(spark, site)] == ["late", "e"]


def test_gap_minutes_are_handed_over_once_even_after_a_crash(spark, tmp_path, monkeypatch):
    north = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark)
    put(north.root, "beacon", "k", "f1", ["a"])
    R.run_local(spark, north, "2024-03-01 07:00:00", 1, src, dst)
    R.run_merge(spark, [north], north, "2024-03-01 07:01:00", 2, src, dst)
    monkeypatch.setattr(R, "_mirror_manifests", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        R.run_merge(spark, [north], north, "2024-03-01 07:04:00", 3, src, dst)  # 07:02, 07:03 are in the ledger only
    monkeypatch.undo()
    assert R.run_merge(spark, [north], north, "2024-03-01 07:06:00", 4, src, dst)["gap_minutes"] == 4
    assert R.run_merge(spark, [north], north, "2024-03-01 07:07:00", 5, src, dst)["gap_minutes"] == 1


def test_system_tables_stay_small(spark, tmp_path):
    site = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark, mirrors=False)
    for i in range(6):
        put(site.root, "beacon", "k", f"f{i}", [f"{i}"], T0 + dt.timedelta(hours=i))
        now = f"2024-03-01 {12 + i}:00:00"
        R.run_local(spark, site, now, 2 * i + 1, src, dst)
        R.run_merge(spark, [site], site, f"2024-03-01 {12 + i}:01:00", 2 * i + 2, src, dst)
    assert len(fsops.subfolders(spark, site.checkpoints())) == W.CHECKPOINT_VERSIONS
    assert W.read_table(spark, site.manifests(), W.MANIFEST_SCHEMA).filter("kind = 'merge'").count() == 0
    ret = spark.createDataFrame([("north", "beacon", 2)], "cluster string, stream string, retention_hours int")
    R.run_purge(spark, site, "2024-03-01 18:00:00", ret, default_hours=2)
    hours = {f"{r[0]:%Y-%m-%d-%H}" for r in W.read_ledger(spark, site.ledger()).select("minute").distinct().collect()}
    assert hours and min(hours) > "2024-03-01-16"
    assert {r[0] for r in W.read_table(spark, site.catalog(), W.CATALOG_SCHEMA).select("hour").distinct().collect()} <= hours
    for service in ("local", "merge"):
        assert 0 < len(fsops.subfolders(spark, site.commits(service))) <= 3
    # an hour that has empty minutes only goes too
    R.run_purge(spark, site, "2024-03-02 18:00:00", ret, default_hours=2)
    assert W.read_ledger(spark, site.ledger()).count() == 0


def test_audits_of_our_own_sites_find_planted_faults(spark, tmp_path, capsys):
    north, south = R.Site("north", str(tmp_path / "north")), R.Site("south", str(tmp_path / "south"))
    src, dst = topology(spark)
    for i in range(10):
        put(north.root, "beacon", "k", f"f{i}", [f"{i}"], T0 + dt.timedelta(minutes=i))
    R.run_local(spark, north, "2024-03-01 07:00:00", 1, src, dst)
    R.run_merge(spark, [north], north, "2024-03-01 07:01:00", 2, src, dst)
    R.run_mirror(spark, north, south, "2024-03-01 07:02:00", 3)
    assert audits.merge_stream_consistency(spark, [north.root], north.root).count() == 0
    assert audits.mirror_stream_consistency(spark, north.root, [south.root]).count() == 0
    kept = W.read_table(spark, south.catalog(), W.CATALOG_SCHEMA).limit(1).checkpoint(eager=True)
    only = kept.withColumn("stream", F.lit("extra")).withColumn("batch_id", F.lit(9).cast("long"))
    fsops.delete_path(spark, south.catalog())
    W.write_catalog(kept, south.catalog(), 3)
    W.write_catalog(only, south.catalog(), 9)
    minutes = only.select("stream", "minute", F.lit("data").alias("state"), F.lit(1).alias("n_files"), F.lit(1).alias("n_records"))
    commitlog.commit(spark, south.base(MERGED_BASE), "planted", 9, minutes, F.current_timestamp())
    got = audits.mirror_stream_consistency(spark, north.root, [south.root]).groupBy("stream", "kind").count().collect()
    assert sorted((r.stream, r["count"]) for r in got) == [("beacon", 9), ("extra", 1)] or sum(r["count"] for r in got) == 10
    out = str(tmp_path / "differences")
    assert audits.main(["mirrorstreamdataconsistency", north.root, south.root, "--output", out]) == 2
    assert "inconsistent" in capsys.readouterr().out
    assert spark.read.parquet(f"{out}/mirrorstreamdataconsistency").count() == 10
    assert audits.main(["mergestreamdataconsistency", north.root, north.root]) == 0
    assert "no inconsistency" in capsys.readouterr().out


def test_files_in_no_place_of_the_layout_are_an_error(spark, tmp_path):
    root = str(tmp_path / "tree")
    os.makedirs(f"{root}/streams/s/2024/03/01")
    with open(f"{root}/streams/s/2024/03/01/f.gz", "w") as f:
        f.write("x")
    with pytest.raises(audits.UnknownLayout):
        audits.merge_stream_consistency(spark, [root], root)


def test_late_delivery_needs_the_catalog(spark):
    from minutelake.plans import jobs
    files = spark.createDataFrame([], "cluster string, stream string, collector string, file_name string, path string, mtime timestamp_ntz, length long")
    with pytest.raises(ValueError, match="published"):
        jobs.plan_ingest(files, files.select("cluster", "stream", "collector", "file_name"), F.lit("2024-03-01").cast("timestamp_ntz"), on_late="deliver")
