"""Structured Streaming: ingest with availableNow, restart from the checkpoint, rollup, dedupe."""

import datetime as dt
import os

from pyspark.sql import functions as F

from minutelake.sinks import writers as W
from minutelake.sources.records import read_published
from minutelake.streaming import stream


def _landing(root, stream_name, collector, name, lines):
    d = os.path.join(root, stream_name, collector)
    os.makedirs(d, exist_ok=True)
    tmp = os.path.join(root, "." + name)
    with open(tmp, "w") as f:
        f.write("".join(x + "\n" for x in lines))
    os.rename(tmp, os.path.join(d, name))  # atomic arrival of a closed file (C16)


def test_ingest_stream_restart(spark, tmp_path):
    land, out, led, ck = (str(tmp_path / x) for x in ("land", "out", "ledger", "ck"))
    os.makedirs(land)
    _landing(land, "s1", "k1", "s1-2024-01-01-00-00_00000", ["a", "b"])
    _landing(land, "s2", "k1", "s2-2024-01-01-00-00_00000", ["c"])
    q = stream.ingest(spark, land, "c1", out, led, ck, trigger={"availableNow": True},
                      clock=lambda: "2024-01-01 00:01:00")
    q.awaitTermination(120)
    assert read_published(spark, out).count() == 3
    # restart: already processed files are not read again, new ones are
    _landing(land, "s1", "k1", "s1-2024-01-01-00-01_00000", ["d"])
    q = stream.ingest(spark, land, "c1", out, led, ck, trigger={"availableNow": True},
                      clock=lambda: "2024-01-01 00:02:00")
    q.awaitTermination(120)
    df = read_published(spark, out)
    assert df.count() == 4
    assert sorted(r.value for r in df.collect()) == ["a", "b", "c", "d"]
    assert {r.file_name for r in df.filter("value = 'd'").collect()} == {"k1-s1-2024-01-01-00-01_00000.gz"}
    ledger = W.read_ledger(spark, led)
    assert ledger.filter("state = 'data'").count() == 3
    # a third batch four minutes later records the idle minute in between as empty
    _landing(land, "s2", "k1", "s2-2024-01-01-00-05_00000", ["e"])
    stream.ingest(spark, land, "c1", out, led, ck, trigger={"availableNow": True},
                  clock=lambda: "2024-01-01 00:04:00").awaitTermination(120)
    empty = W.read_ledger(spark, led).filter("state = 'empty'").collect()
    assert sorted((r.stream, r.minute.minute) for r in empty) == [("s1", 3), ("s2", 2), ("s2", 3)]


def test_ingest_stream_writes_manifests(spark, tmp_path):
    land, out, led, ck, man = (str(tmp_path / x) for x in ("land", "out", "ledger", "ck", "man"))
    os.makedirs(land)
    _landing(land, "s1", "k1", "s1-2024-01-01-00-00_00000", ["a"])
    _landing(land, "s2", "k1", "s2-2024-01-01-00-00_00000", ["b"])
    src = spark.createDataFrame([("s1", "c1", 1)], "stream string, cluster string, retention_hours int")
    dst = spark.createDataFrame([("s1", "c9", True, 1)], "stream string, cluster string, is_primary boolean, "
                                                        "retention_hours int")
    stream.ingest(spark, land, "c1", out, led, ck, trigger={"availableNow": True}, clock=lambda: "2024-01-01 00:01:00",
                  manifest_dir=man, sources=src, destinations=dst, root="/c1").awaitTermination(120)
    m = spark.read.parquet(man).collect()
    assert [(r.dest_cluster, r.stream, r.path) for r in m] == [
        ("c9", "s1", "/c1/streams_local/s1/2024/01/01/00/01/k1-s1-2024-01-01-00-00_00000.gz")]


def _until(query, runs, n, seconds=150):
    import time
    end = time.time() + seconds
    while len(runs) < n and time.time() < end and query.exception() is None:
        time.sleep(0.2)
    query.stop()
    assert query.exception() is None and len(runs) >= n


def test_services_run_every_minute(spark, tmp_path):
    """Local, merge and mirror services on their own clocks: routing, ledger, gaps, mirror manifests, order."""
    from minutelake.plans import run as R
    from minutelake.sinks import writers as W
    c1, c3 = R.Site("c1", str(tmp_path / "c1")), R.Site("c3", str(tmp_path / "c3"))
    src = spark.createDataFrame([("s1", "c1", 48), ("s2", "c1", 48)], "stream string, cluster string, retention_hours int")
    dst = spark.createDataFrame([("s1", "c1", True, 48), ("s1", "c3", False, 48)],
                                "stream string, cluster string, is_primary boolean, retention_hours int")
    for s in ("s1", "s2"):
        d = tmp_path / "c1" / "data" / s / "k1"
        os.makedirs(d)
        for i in range(2):
            (d / f"{s}-2024-01-01-00-0{i}_00000").write_text(f"{s}{i}a\n{s}{i}b\n")
            os.utime(d / f"{s}-2024-01-01-00-0{i}_00000", (1704067200 + i, 1704067200 + i))
    minutes = iter(f"2024-01-01 0{m // 60}:{m % 60:02d}:00" for m in range(60, 600, 3))
    clock = lambda: next(minutes)
    each = {"processingTime": "1 second"}
    runs = []
    _until(stream.local(spark, c1, src, dst, str(tmp_path / "ck1"), each, clock, runs.append, timeout_ms=0), runs, 2)
    assert [r["new_files"] for r in runs][:2] == [4, 0]
    merged = []
    _until(stream.merge(spark, [c1], c1, src, dst, str(tmp_path / "ck2"), each, clock, merged.append), merged, 2)
    assert merged[0]["merged_files"] == 2 and merged[1]["merged_files"] == 0  # s2 has no primary
    mirrored = []
    _until(stream.mirror(spark, c1, c3, str(tmp_path / "ck3"), each, clock, mirrored.append), mirrored, 1)
    there = read_published(spark, c3.base("streams")).collect()
    assert sorted(r.value for r in there) == ["s10a", "s10b", "s11a", "s11b"]
    here = {(r.stream, r.minute_key) for r in read_published(spark, c1.base("streams")).collect()}
    assert {(r.stream, r.minute_key) for r in there} == here
    # the merge's idle minutes are in both ledgers
    idle = lambda s: {r.minute for r in W.read_ledger(spark, s.ledger()).filter("state = 'empty' AND base = 'streams'").collect()}
    assert idle(c1) and idle(c3) <= idle(c1)
    # a service with a new checkpoint takes batch ids above those that the site has
    assert stream._first_batch(spark, c1, "merge", "streams", str(tmp_path / "ck9")) >= 1


def test_a_replayed_batch_keeps_its_minute(spark, tmp_path):
    """A crash after the publish, replayed at a later minute, rewrites the same records."""
    land, out, led, ck = (str(tmp_path / x) for x in ("land", "out", "ledger", "ck"))
    os.makedirs(land)
    _landing(land, "007", "k 1", "a%b +c", ["x", "y"])
    minutes = iter(["2024-01-01 00:01:00", "2024-01-01 00:02:00"])

    def crash(*_):
        raise RuntimeError("after the publish")

    q = stream.ingest(spark, land, "c1", out, led, ck, trigger={"availableNow": True}, clock=lambda: next(minutes), on_batch=crash)
    try:
        q.awaitTermination(120)
    except Exception:  # the crash, as the query reports it
        pass
    stream.ingest(spark, land, "c1", out, led, ck, trigger={"availableNow": True},
                  clock=lambda: next(minutes)).awaitTermination(120)
    got = read_published(spark, out).collect()
    assert sorted((r.stream, r.collector, r.src_file, r.value, r.minute_key) for r in got) == [
        ("007", "k 1", "a%b +c", "x", "2024-01-01-00-01"), ("007", "k 1", "a%b +c", "y", "2024-01-01-00-01")]


def test_minute_rollup_stream(spark):
    ev = (spark.readStream.schema("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                                 "value double, props string").option("pathGlobFilter", "events.parquet")
          .parquet("/root/testdata/sf0.001"))
    q = (stream.minute_rollup(ev).writeStream.outputMode("append").format("memory").queryName("rollup_t")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {(r.stream, r.minute, r.n_records, r.n_bytes) for r in spark.sql("SELECT * FROM rollup_t").collect()}
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    batch = (ev.groupBy(F.col("event_type").alias("stream"), F.date_trunc("minute", "ts").alias("minute"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("props")).alias("b")).collect())
    # exactly the windows that the watermark (two minutes behind the newest event) has passed
    end = ev.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=2)
    want = {(r.stream, r.minute.replace(tzinfo=None), r.n, r.b) for r in batch if r.minute.replace(tzinfo=None) + dt.timedelta(minutes=1) <= end}
    assert got == want and len(want) > 900


def test_dedupe_stream(spark, tmp_path):
    d = str(tmp_path / "recs")
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:30"), (2, "2024-01-01 00:01:00")],
                               "record_no long, ts string").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(d)
    s = spark.readStream.schema("record_no long, ts timestamp").parquet(d)
    q = (stream.dedupe(s, ["record_no"]).writeStream.format("memory").queryName("dd_t")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.sql("SELECT * FROM dd_t").count() == 2


def test_late_files_as_keyed_state(spark, tmp_path):
    """A name at or below what its collector delivered before is late, over batches and a restart."""
    src, ck, got = str(tmp_path / "files"), str(tmp_path / "ck"), []
    rows = lambda names: spark.createDataFrame([("s", k, n) for k, n in names], "stream string, collector string, file_name string").coalesce(1)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for names in ([("k", "b"), ("k", "a"), ("_k", "z")], [("k", "a"), ("k", "c"), ("_k", "y")], [("k", "b2"), ("_k", "zz")]):
            rows(names).write.mode("append").parquet(src)
            files = spark.readStream.schema("stream string, collector string, file_name string").parquet(src)
            q = stream.late_files(files).writeStream.foreachBatch(lambda df, _: got.extend(tuple(r) for r in df.collect())).option(
                "checkpointLocation", ck).trigger(availableNow=True).start()
            assert q.awaitTermination(200) and q.exception() is None
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert sorted(got) == [("s", "_k", "y", "z"), ("s", "k", "a", "b"), ("s", "k", "b2", "c")]


def test_landing_names_and_filter(spark, tmp_path):
    """F1 and hidden names on the landing stream; archived files leave the folder."""
    land, out, led, ck, done = (str(tmp_path / x) for x in ("land", "out", "ledger", "ck", "done"))
    os.makedirs(land)
    for c, n in (("_k1", "f1"), ("k2", "_f2"), ("k2", "f5"), ("k2", "s1_current"), ("k2", "Scribe_Stats")):
        _landing(land, "s1", c, n, [f"{c}/{n}"])
    q = stream.ingest(spark, land, "c1", out, led, ck, archive_dir=done, trigger={"availableNow": True}, clock=lambda: "2024-01-01 00:01:00")
    q.awaitTermination(200)
    assert q.exception() is None
    assert sorted(r.value for r in read_published(spark, out).collect()) == ["_k1/f1", "k2/_f2", "k2/f5"]
    left = sorted(f for _, _, fs in os.walk(land) for f in fs)
    assert left == ["Scribe_Stats", "s1_current"] and os.path.exists(f"{done}/s1/_k1/f1")
