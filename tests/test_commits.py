"""What readers see: commit records only, in order, each file once; small tables stay small."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from minutelake.operators import audit, publish, ranges
from minutelake.plans import run as R
from minutelake.schemas import LOCAL_BASE, MERGED_BASE
from minutelake.sinks import commitlog, snapshots
from minutelake.sinks import files as fsops
from minutelake.sinks import writers as W
from minutelake.sources.records import read_published

from test_lossless import T0, put, topology, values


def test_a_vanished_file_ends_its_batch_and_nothing_comes_twice(spark, tmp_path, monkeypatch):
    """A selected file is lost between selection and read: the batch run again publishes the rest and reports it."""
    site = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark)
    for n in ("f0", "f1", "f2"):
        put(site.root, "beacon", "k", n, [n])
    real = R.read_selected

    def vanish(spark, data_dir, *a):
        out = real(spark, data_dir, *a)
        os.remove(f"{data_dir}/beacon/k/f1")
        return out

    monkeypatch.setattr(R, "read_selected", vanish)
    with pytest.raises(Exception):  # noqa: B017  the read, or the check of what was written
        R.run_local(spark, site, "2024-03-01 07:00:00", 1, src, dst)
    monkeypatch.undo()
    assert values(spark, site) == []  # whatever the lost attempt wrote
    out = R.run_local(spark, site, "2024-03-01 07:01:00", 1, src, dst)
    assert (out["new_files"], out["lost_files"]) == (2, 1)
    wanted = [("beacon", "k", n, n) for n in ("f0", "f2")]
    assert values(spark, site) == wanted
    lost = spark.read.parquet(f"{W.commit_path(site.commits('local'), 1)}/lost").collect()
    assert [(r["collector"], r["file_name"]) for r in lost] == [("k", "f1")]
    assert R.run_local(spark, site, "2024-03-01 07:02:00", 2, src, dst)["new_files"] == 0
    # A lost checkpoint doesn't deliver a committed file again
    fsops.delete_path(spark, site.checkpoints())
    put(site.root, "beacon", "k", "f3", ["f3"])
    assert R.run_local(spark, site, "2024-03-01 07:03:00", 3, src, dst)["new_files"] == 1
    assert values(spark, site) == [*wanted, ("beacon", "k", "f3", "f3")]


def test_rows_of_a_batch_that_never_ended_are_not_read_and_go(spark, tmp_path, monkeypatch):
    """Batch 1 dies after its data is written and is never run again; batch 2 publishes the same files."""
    site = R.Site("north", str(tmp_path / "north"))
    src, dst = topology(spark)
    put(site.root, "beacon", "k", "f0", ["a", "b"])
    monkeypatch.setattr(W, "write_catalog", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        R.run_local(spark, site, "2024-03-01 07:00:00", 1, src, dst)
    monkeypatch.undo()
    left = f"{site.base(LOCAL_BASE)}/stream=beacon/hour=2024-03-01-07/minute_key=2024-03-01-07-00/batch_id=1"
    assert os.path.exists(left) and values(spark, site) == []
    R.run_local(spark, site, "2024-03-01 07:05:00", 2, src, dst)
    assert [v for *_, v in values(spark, site)] == ["a", "b"]
    assert R.published_catalog(spark, site, LOCAL_BASE).count() == 1
    os.makedirs(f"{site.base(LOCAL_BASE)}/stream=old/hour=2024-01-01-00")  # A7
    R.run_purge(spark, site, "2024-03-01 08:00:00", spark.createDataFrame([], "cluster string, stream string, retention_hours int"))
    assert not os.path.exists(left) and not os.path.exists(f"{site.base(LOCAL_BASE)}/stream=old")
    assert [v for *_, v in values(spark, site)] == ["a", "b"]


def test_a_mirror_never_shows_a_minute_before_an_earlier_one(spark, tmp_path, monkeypatch):
    """O1: a crash between two parts of a backlog leaves the earlier minutes of each stream, empty ones included."""
    north, south = R.Site("north", str(tmp_path / "north")), R.Site("south", str(tmp_path / "south"))
    src, dst = topology(spark, ("beacon", "pulse"))
    for n, (minute, streams) in enumerate([("07:00", ("beacon", "pulse")), ("07:03", ("beacon",)), ("07:05", ("pulse",))]):
        for s in streams:
            put(north.root, s, "k", f"f{n}", [f"{s}{n}"], T0 + dt.timedelta(minutes=n))
        R.run_local(spark, north, f"2024-03-01 {minute}:00", 2 * n + 1, src, dst)
        R.run_merge(spark, [north], north, f"2024-03-01 {minute}:30", 2 * n + 2, src, dst)
    real, done = commitlog.commit, []

    def crash(*a, **k):
        if len(done) == 2:
            raise RuntimeError("crash")
        done.append(1)
        return real(*a, **k)

    monkeypatch.setattr(commitlog, "commit", crash)
    with pytest.raises(RuntimeError, match="crash"):
        R.run_mirror(spark, north, south, "2024-03-01 07:10:00", 9, minutes_per_commit=2)
    monkeypatch.undo()

    def seen():
        rows = commitlog.committed(spark, south.base(MERGED_BASE))
        marks = {r["stream"]: r["watermark"].minute for r in commitlog.watermarks(rows).collect()}
        records = sorted((r.stream, int(r.minute_key[-2:])) for r in read_published(spark, south.base(MERGED_BASE)).collect())
        assert commitlog.in_order(rows).count() == 0
        return marks, records

    marks, records = seen()
    assert marks == {"beacon": 3, "pulse": 3}  # four minutes of each
    assert records == [("beacon", 0), ("beacon", 3), ("pulse", 0)]
    assert R.run_mirror(spark, north, south, "2024-03-01 07:11:00", 9, minutes_per_commit=2)["mirrored_files"] == 4
    marks, records = seen()
    assert marks["pulse"] == 5 and records == [("beacon", 0), ("beacon", 3), ("pulse", 0), ("pulse", 5)]
    m = R.published_catalog(spark, north, MERGED_BASE)
    assert audit.audit_mirror(audit.stream_entries(m, W.read_ledger(spark, north.ledger())),
                              audit.stream_entries(R.published_catalog(spark, south, MERGED_BASE), W.read_ledger(spark, south.ledger()))).count() == 0


def test_a_read_of_some_minutes_lists_their_folders_only(spark, tmp_path):
    """After many commits a read of one minute names one folder, and the log has few files."""
    table = str(tmp_path / "north" / "streams_local")
    records = spark.createDataFrame([("north", "k-f.gz", "k", "f", "v", 0, 0)], "cluster string, file_name string, collector string, src_file string, value string, block_start long, line_pos long")
    for n in range(4):
        minute = F.lit(f"2024-03-01 07:0{n}:00").cast("timestamp_ntz")
        W.write_published(records.withColumn("stream", F.lit("s")).withColumn("minute", minute).withColumn("committed_at", minute), table, n)
        rows = spark.range(1).select(F.lit("s").alias("stream"), minute.alias("minute"), F.lit("data").alias("state"), F.lit(1).alias("n_files"), F.lit(1).alias("n_records"))
        if n != 2:
            commitlog.commit(spark, table, "local", n, rows, minute)
    one = read_published(spark, table, minutes=["2024-03-01-07-01"])
    assert [f.split("/streams_local/")[1].rsplit("/", 1)[0] for f in one.inputFiles()] == ["stream=s/hour=2024-03-01-07/minute_key=2024-03-01-07-01/batch_id=1"]
    assert sorted(r.batch_id for r in read_published(spark, table).collect()) == [0, 1, 3]
    assert read_published(spark, table, minutes=["2024-03-01-07-02"]).count() == 0


def test_a_small_table_stays_small(spark, tmp_path, monkeypatch):
    """Snapshots and deltas: a constant number of files, every row once, a batch is never taken twice."""
    monkeypatch.setattr(snapshots, "COMPACT_AFTER", 3)
    path = str(tmp_path / "t")
    table = snapshots.SnapshotTable(spark, path, "n bigint, name string")
    most = 0
    for n in range(16):
        assert table.append(f"b{n}", spark.createDataFrame([(n, "x")], "n bigint, name string"))
        most = max(most, sum(len(f) for _, _, f in os.walk(path)))
    assert not table.append("b15", spark.createDataFrame([(99, "x")], "n bigint, name string"))
    assert sorted(r.n for r in table.read().collect()) == list(range(16))
    assert len(table.snapshots()) <= snapshots.SNAPSHOTS_KEPT and len(table.deltas()) <= 6 and most < 60
    table.compact(lambda rows: rows.filter("n >= 10"))
    assert sorted(r.n for r in table.read().collect()) == list(range(10, 16))
    # a snapshot cut off by a crash doesn't count
    os.makedirs(f"{path}/snapshots/999999999-dead/rows")
    assert sorted(r.n for r in table.read().collect()) == list(range(10, 16))


def test_ranges_are_exactly_their_minutes(spark):
    """Adjoining minutes become one range where that loses nothing, and turn back."""
    def at(m, s=0):
        return dt.datetime(2024, 3, 1, 6, 0) + dt.timedelta(minutes=m, seconds=s)

    rows = [("c", "b", "idle", at(m), "empty", at(m + 1)) for m in range(3000)]  # two days, each minute in its turn
    rows += [("c", "b", "gap", at(m), "empty", at(50)) for m in range(10)]  # filled by one run
    rows += [("c", "b", "mixed", at(m), "data" if m % 3 else "empty", at(m, 30)) for m in range(9)]
    rows += [("c", "b", "holes", at(m), "data", at(m)) for m in (0, 1, 2, 5, 6, 9, 2000)]
    rows += [("c", "b", "twice", at(0), "empty", at(9)), ("c", "b", "twice", at(0), "data", at(4)), ("c", "b", "twice", at(0), "data", at(5))]
    kinds = "cluster string, base string, stream string, minute timestamp_ntz, state string, created_at timestamp_ntz"
    minutes = spark.createDataFrame(rows, kinds)
    merged = ranges.merged(ranges.of_minutes(minutes)).checkpoint(eager=True)
    count = {r["stream"]: r["count"] for r in merged.groupBy("stream").count().collect()}
    assert count == {"idle": 1, "gap": 10, "mixed": 6, "holes": 4, "twice": 1}
    again = ranges.merged(merged)
    back = sorted(tuple(r) for r in ranges.minutes_of(again).collect())
    assert back == sorted([r for r in rows if r[2] != "twice"] + [("c", "b", "twice", at(0), "data", at(4))])
    found = {(r.stream, r.gap_start, r.n_minutes) for r in ranges.missing_between(merged).collect()}
    assert found == {("holes", at(3), 2), ("holes", at(7), 2), ("holes", at(10), 1990)}
    gaps = ranges.gap_ranges(merged, F.lit(at(2990)).cast("timestamp_ntz")).collect()
    assert {(r.stream, r.minute, r.last_minute) for r in gaps} == {("gap", at(10), at(2989)), ("mixed", at(9), at(2989)), ("holes", at(2001), at(2989)), ("twice", at(1), at(2989))}
    cut = ranges.without_purged(merged.filter("stream = 'idle'"), spark.createDataFrame([("b", "idle", at(0)), ("b", "idle", at(60))], "base string, stream string, hour timestamp_ntz"))
    (left,) = cut.collect()
    assert (left.minute, left.last_minute, left.created_at) == (at(120), at(2999), at(121))


def test_parts_keep_the_order_of_each_stream(spark):
    rows = [(s, dt.datetime(2024, 3, 1, 6, m)) for s, ms in (("a", (1, 2, 5, 9)), ("b", (7,))) for m in ms] + [("a", dt.datetime(2024, 3, 1, 6, 2))]
    parts = publish.commit_parts(spark.createDataFrame(rows, "stream string, minute timestamp_ntz"), 2)
    assert sorted((r.stream, r.minute.minute, r.part) for r in parts.collect()) == [("a", 1, 0), ("a", 2, 0), ("a", 2, 0), ("a", 5, 1), ("a", 9, 1), ("b", 7, 0)]
