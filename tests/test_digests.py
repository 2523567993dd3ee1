"""Audits by digests: the same differences as by key, and only differing hours are read; collapsed manifests."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from minutelake.operators import audit, digests, route
from minutelake.plans import audits
from minutelake.plans import run as R
from minutelake.schemas import MERGED_BASE
from minutelake.sinks import commitlog
from minutelake.sinks import files as fsops
from minutelake.sinks import writers as W

from conftest import rows
from test_lossless import T0, put, topology

SIDE = "stream string, key string, path string"


def sides(spark, seed):
    """Two listings that differ in few hours; with copies, null paths, names without an hour and a stream on one side only."""
    r = random.Random(seed)
    src = [("a", f"k-a-2024-03-0{1 + i % 3}-{i % 24:02d}-{i % 60:02d}_{i:05d}.gz", f"/s/{i}") for i in range(200)]
    src += [("b", f"plain{i}", None if i % 3 == 0 else f"/s/b{i}") for i in range(20)]
    dst = [(s, k, p and p.replace("/s", "/d")) for s, k, p in src]
    dst = [x for x in dst if r.random() > 0.03] + r.sample(dst, 5)
    dst += [("a", "k-a-2024-03-09-01-01_9.gz", "/d/x"), ("c", "k-c-2024-03-09-01-01_9.gz", "/d/y"), ("a", "zz", "/d/z")]
    src += r.sample(src, 3)
    return spark.createDataFrame(src, SIDE), spark.createDataFrame(dst, SIDE)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_digests_find_what_keys_find(spark, seed):
    src, dst = sides(spark, seed)
    for by in (digests.name_hour, digests.path_hour):
        assert rows(digests.compare(by)(src, dst, ["stream"], with_copies=True)) == rows(audit.classify(src, dst, ["stream"], with_copies=True))


def test_equal_and_empty_sides(spark):
    src, _ = sides(spark, 4)
    none = spark.createDataFrame([], SIDE)
    compare = digests.compare(digests.name_hour)
    assert compare(src, src.unionByName(src), ["stream"]).count() == 0  # copies alone are no difference
    assert compare(none, none, ["stream"]).count() == 0
    for a, b in ((src, none), (none, src)):
        assert rows(compare(a, b, ["stream"])) == rows(audit.classify(a, b, ["stream"]))
    odd = spark.createDataFrame([("a", None, "/x"), ("a", "k", "/y")], SIDE)  # a null key is a key
    assert rows(compare(odd.filter("key is not null"), odd, ["stream"]).fillna("?")) == \
        rows(audit.classify(odd.filter("key is not null"), odd, ["stream"]).fillna("?"))


def test_digests_add_up_over_parts(spark):
    src, _ = sides(spark, 5)
    s = src.withColumn("bucket", digests.name_hour("key"))
    by = ["stream", "bucket"]
    parts = None
    for third in range(3):
        d = digests.of_keys(s.filter(F.pmod(F.xxhash64("key"), F.lit(3)) == third), by)
        parts = d if parts is None else parts.unionByName(d)
    whole = digests.of_keys(s, by)
    cols = [*by, "n", *digests.PARTS]
    assert rows(digests.merged(parts, by).select(*cols)) == rows(whole.select(*cols))


def test_a_mirror_audit_reads_differing_hours_only(spark, tmp_path, monkeypatch):
    north, south = R.Site("north", str(tmp_path / "north")), R.Site("south", str(tmp_path / "south"))
    src, dst = topology(spark, ("beacon", "pulse"))
    for n in range(2):  # an hour each; a batch of both streams
        for s in ("beacon", "pulse"):
            put(north.root, s, "k", f"f{n}", [f"{s}{n}"], T0 + dt.timedelta(hours=n))
        now = T0 + dt.timedelta(hours=n, minutes=20)
        R.run_local(spark, north, str(now), 2 * n + 1, src, dst)
        R.run_merge(spark, [north], north, str(now), 2 * n + 2, src, dst)
    R.run_mirror(spark, north, south, str(now), 1, minutes_per_commit=500)
    # manifests come again, as from a backlog that was collapsed meanwhile
    files = R.published_catalog(spark, north, MERGED_BASE).select("stream", "path", "minute")
    W.append_manifests(files.select(*[F.lit(north.name).alias(c) for c in ("src_cluster", "via_cluster")], "stream", "path", "minute",
                                    F.lit("mirror").alias("kind"), F.lit(south.name).alias("dest_cluster"),
                                    F.lit(90).cast("long").alias("batch_id")), north.manifests())
    assert R.run_mirror(spark, north, south, str(now), 2)["mirrored_files"] == 0
    assert R.published_catalog(spark, south, MERGED_BASE).count() == 4
    assert W.read_table(spark, north.manifests(), W.MANIFEST_SCHEMA).filter("kind = 'mirror'").isEmpty()
    kept = audits.kept_digests(spark, north.root, MERGED_BASE, ["beacon", "pulse"])
    merged = audit.stream_entries(R.published_catalog(spark, north, MERGED_BASE), W.read_ledger(spark, north.ledger()).filter(F.col("base") == MERGED_BASE))
    again = digests.of_keys(merged.withColumn("bucket", digests.path_hour("relpath")), ["stream", "bucket"], "relpath")
    assert rows(kept) == rows(again)  # what was kept is what the keys give
    # a file of the first hour is lost from the mirror's catalog and log
    lost = ((F.col("stream") == "beacon") & (F.hour("minute") == T0.hour) & (F.col("file_name") == "k-f0.gz"))
    W.catalog_table(spark, f"{south.root}/system/catalog").compact(lambda r: r.filter(~lost))
    gone = (F.col("stream") == "beacon") & (F.hour("minute") == T0.hour) & (F.col("state") == "data")
    commitlog.of(spark, south.base(MERGED_BASE)).compact(lambda r: r.filter(~gone))
    plans = []
    real = audit.audit_mirror
    monkeypatch.setattr(audit, "audit_mirror", lambda *a, **k: plans.append(a) or real(*a, **k))
    got = rows(audits.mirror_stream_consistency(spark, north.root, [south.root]), "stream", "key", "kind")
    assert [(s, key[:13], kind) for s, key, kind in got] == [("beacon", f"{T0:%Y/%m/%d/%H}", "missing")]
    plan = plans[0][0]._jdf.queryExecution().executedPlan().toString()
    assert f"{T0:%Y-%m-%d-%H}" in plan and f"{T0:%Y-%m-%d}-{T0.hour + 1:02d}" not in plan
    # logs without digests are audited by key, with the same result
    for site in (north, south):
        commitlog.of(spark, site.base(MERGED_BASE)).compact(lambda r: r.withColumn("d0", F.lit(None).cast("long")))
    assert audits.kept_digests(spark, north.root, MERGED_BASE, ["beacon", "pulse"]) is None
    assert rows(audits.mirror_stream_consistency(spark, north.root, [south.root]), "stream", "key", "kind") == got


def test_the_manifests_of_a_consumer_that_stays_away_are_collapsed(spark, tmp_path):
    place, acks = str(tmp_path / "manifests"), str(tmp_path / "acks")

    def batch(n):
        at = T0 + dt.timedelta(minutes=n)
        row = [("c1", "c1", s, f"/c1/streams_local/{s}/f{n}.gz", at, "merge", d, n) for s in ("beacon", "pulse") for d in ("c2", "c3")]
        W.append_manifests(spark.createDataFrame(row, W.MANIFEST_SCHEMA), place)

    for n in range(12):
        batch(n)
        W.collapse_manifests(spark, place, most=4)
        assert len(fsops.subfolders(spark, f"{place}/kind=merge/dest_cluster=c2")) <= 5
    batch(11)  # the newest batch is run again after its backlog was collapsed: nothing is lost
    pending = route.pending_manifests(W.read_table(spark, place, W.MANIFEST_SCHEMA), W.read_table(spark, acks, W.ACK_SCHEMA))
    assert pending.filter("dest_cluster = 'c2'").select("path").distinct().count() == 24 == pending.filter("dest_cluster = 'c2'").count()
    W.append_acks(route.pending_batches(W.read_table(spark, place, W.MANIFEST_SCHEMA), W.read_table(spark, acks, W.ACK_SCHEMA))
                  .filter("dest_cluster = 'c2'"), acks)
    W.settle_acks(spark, place, acks)
    left = W.read_table(spark, place, W.MANIFEST_SCHEMA)
    assert {r[0] for r in left.select("dest_cluster").distinct().collect()} == {"c3"}
    assert left.select("path").distinct().count() == 24


def test_moves_and_deletes_run_in_tasks(spark, tmp_path):
    """Odd names, missing sources and folders; nothing goes through the driver's list of rows."""
    names = ["_hidden", "with blank", "per%cent", "plain"]
    for n in names:
        (tmp_path / n).write_text(n)
    moves = spark.createDataFrame([(str(tmp_path / n), str(tmp_path / "trash" / "1" / n)) for n in [*names, "absent"]], "src string, dst string")
    assert fsops.move_files(spark, moves, str(tmp_path)) == 4
    assert sorted(x.name for x in (tmp_path / "trash" / "1").iterdir()) == sorted(names)
    assert fsops.move_files(spark, moves, str(tmp_path)) == 0  # run again
    there = [f"file:{tmp_path}/trash/1/_hidden", str(tmp_path / "trash"), str(tmp_path / "none")]
    assert fsops.delete_paths(spark, spark.createDataFrame([(p,) for p in there], "path string"), str(tmp_path)) >= 1
    assert not (tmp_path / "trash").exists()
