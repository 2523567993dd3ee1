"""Folders listed by the executors: odd names, empty files and folders; the collector stream against the batch rules."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from minutelake.constants import IN_FLIGHT_SUFFIX, STATS_FILE_NAME
from minutelake.operators import ingest
from minutelake.plans import audits
from minutelake.sources import catalog, listing

T0 = dt.datetime(2024, 3, 1, 6, 0, tzinfo=dt.timezone.utc)


def put(top, path, text="x\n", at=T0):
    os.makedirs(os.path.dirname(f"{top}/{path}"), exist_ok=True)
    with open(f"{top}/{path}", "w") as f:
        f.write(text)
    os.utime(f"{top}/{path}", (at.timestamp(), at.timestamp()))


@pytest.mark.parametrize("depth", [0, 1, 2, 3])
def test_every_file_and_folder_is_listed_once(spark, tmp_path, depth):
    top = str(tmp_path)
    for p in ("a/k1/f1", "a/_k2/_f", "b/.k/x", "b/k/e"):
        put(top, p, "" if p.endswith("e") else "xy")
    os.makedirs(f"{top}/c/empty")
    got = sorted((r.path.removeprefix(f"file:{top}/"), -1 if r.is_dir else r.length) for r in listing.file_tree(spark, f"file:{top}", split_depth=depth).collect())
    assert got == [("a", -1), ("a/_k2", -1), ("a/_k2/_f", 2), ("a/k1", -1), ("a/k1/f1", 2), ("b", -1), ("b/.k", -1), ("b/.k/x", 2), ("b/k", -1), ("b/k/e", 0), ("c", -1), ("c/empty", -1)]
    assert listing.file_tree(spark, f"file:{top}", ["a", "gone"], depth).count() == 4
    assert listing.file_tree(spark, f"file:{top}", [], depth).count() == 0
    assert listing.file_tree(spark, f"file:{top}/gone", split_depth=depth).count() == 0


def test_closed_files_as_the_batch_rules_say(spark):
    """F1, W1/F2 and F3 of the stream's planner equal ``ingest.closed_files``."""
    rng = random.Random(5)
    names = ["a", "b", "B", "s_current", "scribe_stats", "SCRIBE_stats", "_h", "c", "C_current"]
    rows, wanted = [], set()
    now, timeout = int(T0.timestamp() * 1_000_000), 300_000_000
    for k in range(60):
        found = [(n, now - rng.choice([0, 299_999_999, 300_000_000, 900_000_000]), rng.choice([0, 3]), False) for n in rng.sample(names, rng.randrange(0, 6))]
        closed, _ = listing.closed_names(found, now, timeout, IN_FLIGHT_SUFFIX, STATS_FILE_NAME)
        wanted |= {(f"k{k}", e[0]) for e in closed}
        rows += [("c", "s", f"k{k}", n, f"/{k}/{n}", at, size) for n, at, size, _ in found]
    df = spark.createDataFrame(rows, "cluster string, stream string, collector string, file_name string, path string, us long, length long")
    df = df.withColumn("mtime", F.timestamp_micros("us").cast("timestamp_ntz"))
    got = {(r.collector, r.file_name) for r in ingest.closed_files(df, F.lit("2024-03-01 06:00:00").cast("timestamp_ntz")).collect()}
    assert got == wanted


def batches_of(spark, df, folder, got):
    def batch(rows, number):
        got.append(sorted((r.stream, r.collector, r.file_name) for r in rows.filter("fresh").collect()))

    q = df.writeStream.foreachBatch(batch).option("checkpointLocation", folder).trigger(availableNow=True).start()
    assert q.awaitTermination(120) and q.exception() is None


def test_the_collector_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    """In-flight files wait, names below the mark don't come again, a restart goes on from the offsets."""
    top, got = str(tmp_path / "data"), []
    now = T0 + dt.timedelta(hours=1)

    def stream(marks=None, clock=now):
        return listing.collector_stream(spark, f"file:{top}", "name", 300_000, IN_FLIGHT_SUFFIX, STATS_FILE_NAME, marks, clock=lambda t=clock.timestamp(): t)

    for p in ("s/_k/f1", "s/_k/f2", "s/k/_a", "s/k/s_current", "s/k/Scribe_Stats"):
        put(top, p)
    put(top, "s/_k/f3", at=now - dt.timedelta(seconds=10))  # in flight
    put(top, "s/k/empty", "")
    folder = str(tmp_path / "ck")
    batches_of(spark, stream(), folder, got)
    assert got == [[("s", "_k", "f1"), ("s", "_k", "f2"), ("s", "k", "_a")]]
    put(top, "s/_k/f0")  # late: below the mark
    put(top, "s/k/b")
    later = now + dt.timedelta(minutes=10)
    batches_of(spark, stream({"s/_k": "f2", "s/k": "_a"}, later), folder, got)
    assert got[1:] == [[("s", "_k", "f3"), ("s", "k", "b")]]
    batches_of(spark, stream({"s/_k": "f3", "s/k": "b"}, later + dt.timedelta(minutes=1)), folder, got)
    assert got[2:] == [[]]  # a tick without files
    # a new query starts from the checkpoint it is given
    batches_of(spark, stream({"s/_k": "f3", "s/k": "_a"}, later), str(tmp_path / "ck2"), got)
    assert got[3:] == [[("s", "k", "b")]]


def test_audits_see_every_name(spark, tmp_path):
    """A hidden file that is missing is reported, and one that is there isn't."""
    root = str(tmp_path / "north")
    local, merged = "streams_local/s/2024/03/01/06/00", "streams/s/2024/03/01/06/01"
    put(root, f"{local}/_k1-a.gz")
    put(root, f"{local}/k2-b.gz")
    put(root, f"{merged}/k2-b.gz")
    diffs = audits.merge_stream_consistency(spark, [root], root)
    assert [(r["key"], r["kind"]) for r in diffs.select("key", "kind").collect()] == [("_k1-a.gz", "missing")]
    put(root, f"{merged}/_k1-a.gz")
    assert audits.merge_stream_consistency(spark, [root], root).count() == 0
    put(root, "data/s/_k1/a")
    put(root, "system/trash/2024-3-1/6/k2-b")
    assert audits.local_stream_consistency(spark, [root]).count() == 0
    os.makedirs(f"{root}/streams/s/2024/03/01/06/02")
    minutes = {(r.minute.minute, r.state) for r in audits.minute_dirs_on_disk(spark, root, "streams", root).collect()}
    assert minutes == {(1, "data"), (2, "empty")}
    assert catalog.list_files(spark, f"{root}/system/trash", "c").count() == 1


def test_a_verdict_for_every_group(spark, tmp_path, capsys):
    """Consistent streams get their line."""
    root = str(tmp_path / "north")
    for s in ("good", "bad"):
        put(root, f"streams_local/{s}/2024/03/01/06/00/k-a.gz")
    put(root, "streams/good/2024/03/01/06/01/k-a.gz")
    os.makedirs(f"{root}/streams/bad")
    assert audits.main(["mergestreamdataconsistency", root, root]) == 2
    lines = capsys.readouterr().out.splitlines()
    assert any("stream=good" in x and "verdict=consistent" in x for x in lines) and any("stream=bad" in x and "verdict=inconsistent" in x for x in lines)
