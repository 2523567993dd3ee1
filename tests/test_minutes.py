"""Minute directories: gap publication, holes and out-of-order minutes."""

import datetime as dt

from pyspark.sql import functions as F

from minutelake.operators import audit, publish

SCHEMA = "cluster string, base string, stream string, minute timestamp_ntz, created_at timestamp_ntz"


def _m(h, m, d=1):
    return dt.datetime(2024, 1, d, h, m)


def test_gap_publication_two_hours_idempotent(spark):
    existing = spark.createDataFrame([("c", "streams", "s", _m(10, 0), _m(10, 1))], SCHEMA)
    now = F.lit("2024-01-01 12:00:30").cast("timestamp_ntz")
    gaps = publish.gap_minutes(existing, now)
    got = sorted(r.minute for r in gaps.collect())
    assert len(got) == 119 and got[0] == _m(10, 1) and got[-1] == _m(11, 59)
    # second call after publishing: nothing left
    ledger = existing.select("cluster", "base", "stream", "minute").unionByName(gaps.select(
        "cluster", "base", "stream", "minute"))
    assert publish.gap_minutes(ledger, now).count() == 0


def test_no_gap_without_history(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert publish.gap_minutes(empty, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).count() == 0


def test_holes_and_out_of_order_across_days(spark):
    rows = [("c", "b", "s", _m(23, 58), _m(23, 59)), ("c", "b", "s", _m(0, 2, d=2), _m(0, 3, d=2)),
            ("c", "b", "s", _m(0, 3, d=2), _m(0, 1, d=2)), ("c", "b", "s", _m(0, 5, d=4), _m(0, 6, d=4)),
            ("c", "b", "t", _m(1, 0), _m(1, 0))]
    m = spark.createDataFrame(rows, SCHEMA)
    holes = sorted(r.minute for r in audit.missing_minutes(m).collect())
    assert holes[:4] == [_m(23, 59), _m(0, 0, d=2), _m(0, 1, d=2), _m(0, 4, d=2)]
    assert len(holes) == 3 + (2 * 1440 + 1)  # 23:59,00:00,00:01 then 2-Jan 00:04 .. 4-Jan 00:04
    ooo = [(r.minute, r.next_minute) for r in audit.out_of_order(m).collect()]
    assert ooo == [(_m(0, 2, d=2), _m(0, 3, d=2))]


def test_equal_creation_times_are_in_order(spark):
    m = spark.createDataFrame([("c", "b", "s", _m(1, 0), _m(2, 0)), ("c", "b", "s", _m(1, 1), _m(2, 0))], SCHEMA)
    assert audit.out_of_order(m).count() == 0


def test_minute_dirs_with_empty_ledger(spark):
    files = spark.createDataFrame([("c", "b", "s", _m(1, 0), "f", "/p", _m(1, 0), 3)],
                                  "cluster string, base string, stream string, minute timestamp_ntz, file_name string, "
                                  "path string, mtime timestamp_ntz, length bigint")
    led = spark.createDataFrame([("c", "b", "s", _m(1, 1), "empty", _m(1, 2)), ("c", "b", "s", _m(1, 0), "empty", _m(1, 2))],
                                "cluster string, base string, stream string, minute timestamp_ntz, state string, "
                                "created_at timestamp_ntz")
    got = sorted((r.minute, r.state) for r in audit.minute_dirs(files, led).collect())
    assert got == [(_m(1, 0), "data"), (_m(1, 1), "empty")]


def test_mirror_positions_with_an_empty_minute(spark):
    """Files of one minute by name, an empty minute in between, the next hour counted anew."""
    rows = [("w1", "streams", "tides", _m(9, 41), "buoy-b.gz", "/x/1", _m(9, 50), 1),
            ("w1", "streams", "tides", _m(9, 12), "buoy-c.gz", "/x/2", _m(9, 13), 1),
            ("w1", "streams", "tides", _m(10, 0), "buoy-a.gz", "/x/3", _m(10, 1), 1),
            ("w1", "streams", "tides", _m(9, 12), "buoy-a.gz", "/x/4", _m(9, 14), 1),
            ("w1", "streams", "gusts", _m(9, 12), "mast-z.gz", "/x/5", _m(9, 14), 1)]
    files = spark.createDataFrame(rows, "cluster string, base string, stream string, minute timestamp_ntz, "
                                        "file_name string, path string, mtime timestamp_ntz, length bigint")
    led = spark.createDataFrame([("w1", "streams", "tides", _m(9, 30), "empty", _m(9, 31))],
                                "cluster string, base string, stream string, minute timestamp_ntz, state string, "
                                "created_at timestamp_ntz")
    got = publish.mirror_positions(audit.stream_entries(files, led)).filter("stream = 'tides'").collect()
    assert sorted((r.minute, r.position, r.relpath.split("/")[-1]) for r in got) == [
        (_m(9, 12), 1, "buoy-a.gz"), (_m(9, 12), 2, "buoy-c.gz"), (_m(9, 30), 3, "30"), (_m(9, 41), 4, "buoy-b.gz"),
        (_m(10, 0), 1, "buoy-a.gz")]


def _brute_holes(present):
    out = []
    for a, b in zip(present, present[1:]):
        m = a + dt.timedelta(minutes=1)
        while m < b:
            out.append(m)
            m += dt.timedelta(minutes=1)
    return out


def test_holes_and_gaps_match_brute_force(spark):
    import random
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows, want_holes, want_gaps = [], [], []
    now = base + dt.timedelta(days=3, minutes=7)
    for s in ("a", "b", "c"):
        present = sorted({base + dt.timedelta(minutes=rnd.randint(0, 3 * 1440)) for _ in range(rnd.randint(1, 40))})
        rows += [("c", "b", s, m, m) for m in present]
        want_holes += [(s, m) for m in _brute_holes(present)]
        m = present[-1]
        while m <= now - dt.timedelta(minutes=1):
            if m not in present:
                want_gaps.append((s, m))
            m += dt.timedelta(minutes=1)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.stream, r.minute) for r in audit.missing_minutes(df).collect())
    assert got == sorted(want_holes)
    got = sorted((r.stream, r.minute) for r in
                 publish.gap_minutes(df, F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")).collect())
    assert got == sorted(want_gaps)


def test_scoped_minute_checks(spark):
    rows = [("c", "b", "s", _m(1, 0), _m(1, 0)), ("c", "b", "s", _m(1, 3), _m(1, 3)),
            ("c", "b", "t", _m(1, 0), _m(1, 5)), ("c", "b", "t", _m(1, 2), _m(1, 2))]
    m = spark.createDataFrame(rows, SCHEMA)
    assert {r.stream for r in audit.missing_minutes(m).collect()} == {"s", "t"}
    assert {r.stream for r in audit.missing_minutes(m, streams=["t"]).collect()} == {"t"}
    assert audit.out_of_order(m, streams=["s"]).count() == 0
    assert audit.out_of_order(m, bases=["b"]).count() == 1
