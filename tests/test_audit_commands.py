"""The four audit commands on reference-layout directory trees."""

import datetime as dt
import os

from minutelake.plans import audits

T = dt.datetime(2012, 1, 13, 15, 0)


def _ts(d):
    return d.replace(tzinfo=dt.timezone.utc).timestamp()


def _file(path, mtime=T):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("x\n")
    os.utime(path, (_ts(mtime), _ts(mtime)))
    os.utime(os.path.dirname(path), (_ts(mtime), _ts(mtime)))  # the minute directory changed then


def _dir(path, mtime=T):
    os.makedirs(path, exist_ok=True)
    os.utime(path, (_ts(mtime), _ts(mtime)))


def test_merge_and_mirror_commands(spark, tmp_path):
    l1, l2, m, r = (str(tmp_path / x) for x in ("l1", "l2", "m", "r"))
    _file(f"{l1}/streams_local/s1/2012/01/13/15/04/a.gz")
    _file(f"{l1}/streams_local/s1/2012/01/13/15/04/b.gz")
    _file(f"{l2}/streams_local/s1/2012/01/13/15/05/c.gz")
    _file(f"{m}/streams/s1/2012/01/13/15/04/a.gz")
    _dir(f"{m}/streams/s1/2012/01/13/15/05")
    _file(f"{m}/streams/s1/2012/01/13/15/07/c.gz")
    merge = audits.merge_stream_consistency(spark, [l1, l2], m)
    assert sorted((x.stream, x.key, x.kind) for x in merge.collect()) == [("s1", "b.gz", "missing")]
    _file(f"{r}/streams/s1/2012/01/13/15/04/a.gz")
    _file(f"{r}/streams/s1/2012/01/13/15/07/c.gz")
    _file(f"{r}/streams/s1/2012/01/13/15/08/d.gz")
    mirror = audits.mirror_stream_consistency(spark, m, [r])
    got = sorted((x.key, x.kind) for x in mirror.collect())
    assert got == [("2012/01/13/15/05", "missing"), ("2012/01/13/15/08/d.gz", "extra")]


def test_local_command(spark, tmp_path):
    root = str(tmp_path / "c1")
    _file(f"{root}/data/s1/k/f1")
    _file(f"{root}/system/trash/2012-1-13/15/k-f0")
    _file(f"{root}/streams_local/s1/2012/01/13/15/04/k-f0.gz")
    _file(f"{root}/streams_local/s1/2012/01/13/15/04/k-f1.gz")
    _file(f"{root}/streams_local/s1/2012/01/13/15/05/k-f9.gz")
    got = sorted((x.key, x.kind) for x in audits.local_stream_consistency(spark, [root]).collect())
    assert got == [("k-f9.gz", "extra")]


def test_orderly_command(spark, tmp_path):
    root = str(tmp_path / "c1")
    base = f"{root}/streams/s1/2012/01/13/15"
    _file(f"{base}/04/a.gz", T + dt.timedelta(minutes=10))
    _dir(f"{base}/05", T + dt.timedelta(minutes=5))
    _file(f"{base}/07/b.gz", T + dt.timedelta(minutes=7))
    ooo, missing = audits.orderly_created(spark, [root], ["streams"])
    assert [(x.minute.minute, x.next_minute.minute) for x in ooo.collect()] == [(4, 5)]
    assert [x.minute.minute for x in missing.collect()] == [6]
