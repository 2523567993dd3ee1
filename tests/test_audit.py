"""Audits: classification against a from-scratch sorted merge walk, and scenarios."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from minutelake.operators import audit

SCHEMA = "g string, key string, path string"


def walk(src: list[str], dst: list[str]) -> dict[str, str]:
    """Reference behaviour re-derived: walk two sorted distinct lists; unmatched keys met
    while the other list still has keys are missing/replay, the tails are to_be_sent/extra."""
    a, b = sorted(set(src)), sorted(set(dst))
    i = j = 0
    out = {}
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            i += 1
            j += 1
        elif a[i] < b[j]:
            out[a[i]] = "missing"
            i += 1
        else:
            out[b[j]] = "replay"
            j += 1
    for k in a[i:]:
        out[k] = "to_be_sent"
    for k in b[j:]:
        out[k] = "extra"
    return out


def _classify(spark, groups):
    src = [(g, k, f"/s/{k}") for g, (s, _) in groups.items() for k in s]
    dst = [(g, k, f"/d/{k}") for g, (_, d) in groups.items() for k in d]
    res = audit.classify(spark.createDataFrame(src, SCHEMA), spark.createDataFrame(dst, SCHEMA), ["g"])
    return {(r.g, r.key): r.kind for r in res.collect()}


keys = st.lists(st.text(alphabet="abcde", min_size=1, max_size=3), max_size=12)


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.sampled_from(["g1", "g2", "g3"]), st.tuples(keys, keys), min_size=1, max_size=3))
def test_classify_equals_merge_walk(spark, groups):
    got = _classify(spark, groups)
    want = {(g, k): v for g, (s, d) in groups.items() for k, v in walk(s, d).items()}
    assert got == want


def test_classify_many_random_groups(spark):
    rnd = random.Random(7)
    groups = {}
    for g in range(40):
        universe = [f"f{n:03d}" for n in range(rnd.randint(0, 60))]
        groups[f"s{g}"] = ([k for k in universe if rnd.random() < 0.8], [k for k in universe if rnd.random() < 0.8])
    got = _classify(spark, groups)
    want = {(g, k): v for g, (s, d) in groups.items() for k, v in walk(s, d).items()}
    assert got == want


def test_merge_audit_scenarios(spark):
    """Named scenarios: consistent, missing, replay, extra, to be sent, empty sides, single file."""
    cols = "cluster string, base string, stream string, file_name string, path string"
    loc, mer = [], []

    def add(stream, local_names, merged_names):
        loc.extend(("c1", "streams_local", stream, n, f"/c1/{stream}/{n}") for n in local_names)
        mer.extend(("c1", "streams", stream, n, f"/m/{stream}/{n}") for n in merged_names)

    add("consistentData", ["a", "b", "c"], ["a", "b", "c"])
    add("missingFiles", ["a", "b", "c"], ["a", "c"])
    add("dataReplayFiles", ["a", "c"], ["a", "b", "c"])
    add("extraFiles", ["a", "b"], ["a", "b", "z"])
    add("inconsistencyAtEnd", ["a", "b", "y"], ["a", "b"])
    add("singleFile", ["a"], ["a"])
    add("missingSingleFile", ["a"], [])
    add("emptyDest", [], ["q"])
    res = audit.audit_merge(spark.createDataFrame(loc, cols), spark.createDataFrame(mer, cols))
    got = sorted((r.stream, r.key, r.kind) for r in res.collect())
    assert got == sorted([("missingFiles", "b", "missing"), ("dataReplayFiles", "b", "replay"),
                          ("extraFiles", "z", "extra"), ("inconsistencyAtEnd", "y", "to_be_sent"),
                          ("missingSingleFile", "a", "to_be_sent"), ("emptyDest", "q", "extra")])


def test_duplicate_names_collapse(spark):
    """A name in two clusters' local streams is one key."""
    cols = "cluster string, base string, stream string, file_name string, path string"
    loc = spark.createDataFrame([("c1", "l", "s", "a", "/1/a"), ("c2", "l", "s", "a", "/2/a")], cols)
    mer = spark.createDataFrame([("c1", "m", "s", "a", "/m/a")], cols)
    assert audit.audit_merge(loc, mer).count() == 0


def test_summary_has_consistent_groups(spark):
    diffs = spark.createDataFrame([("s1", "k", "missing", "/p")], "stream string, key string, kind string, path string")
    groups = spark.createDataFrame([("s1",), ("s2",)], "stream string")
    got = {r.stream: (r.n_missing, r.verdict) for r in audit.summary(diffs, groups, ["stream"]).collect()}
    assert got == {"s1": (1, "inconsistent"), "s2": (0, "consistent")}


def test_local_audit_data_and_trash(spark):
    cf = "cluster string, stream string, collector string, file_name string, path string"
    data = spark.createDataFrame([("r1", "s", "k", "f3", "/r1/data/s/k/f3"), ("r1", "s", "k", "f4", "/r1/data/s/k/f4")], cf)
    trash = spark.createDataFrame([("r1", "s", "k", "k-f1", "/r1/system/trash/k-f1"),
                                   ("r1", "s", "k", "k-f2", "/r1/system/trash/k-f2")], cf)
    loc = spark.createDataFrame([("r1", "s", "k-f1.gz", "/l/k-f1.gz"), ("r1", "s", "k-f3.gz", "/l/k-f3.gz"),
                                 ("r1", "s", "k-f9.gz", "/l/k-f9.gz"), ("r2", "s", "k-f1.gz", "/l2/k-f1.gz")],
                                "cluster string, stream string, file_name string, path string")
    got = sorted((r.cluster, r.key, r.kind) for r in audit.audit_local(data, trash, loc).collect())
    assert got == [("r1", "k-f2.gz", "missing"), ("r1", "k-f4.gz", "missing"), ("r1", "k-f9.gz", "extra"),
                   ("r2", "k-f1.gz", "extra")]


def test_duplicate_copies_reported(spark):
    cols = "cluster string, base string, stream string, file_name string, path string"
    loc = spark.createDataFrame([("c1", "l", "s", "x", "/1/x"), ("c2", "l", "s", "x", "/2/x"),
                                 ("c1", "l", "s", "y", "/1/y")], cols)
    mer = spark.createDataFrame([("c1", "m", "s", "y", "/m/y")], cols)
    got = [(r.key, r.kind, r.n_copies) for r in audit.audit_merge(loc, mer, with_copies=True).collect()]
    assert got == [("x", "missing", 2)]
