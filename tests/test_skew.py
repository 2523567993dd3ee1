"""Skew-safe helpers agree with the naive whole-group formulations."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from minutelake.functions import skew


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50)), max_size=60),
       st.integers(1, 7))
def test_kth_largest_matches_row_number(spark, rows, k):
    data = [(g, f"n{v:03d}") for g, v in rows]
    df = spark.createDataFrame(data or [("z", "x")], "g string, v string")
    if not data:
        df = df.limit(0)
    got = {(r.g, r.kth) for r in skew.kth_largest(df, ["g"], "v", k, "kth", salts=4).collect()}
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    want = {(r.g, r.v) for r in df.withColumn("r", F.row_number().over(w)).filter(F.col("r") == k).collect()}
    assert got == want


def test_latest_per_group_ties(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("g", t, "a"), ("g", t, "b"), ("g", t - dt.timedelta(1), "z"), ("h", t, "q")],
                               "g string, mtime timestamp_ntz, name string")
    got = {(r.g, r.name) for r in skew.latest_per_group(df, ["g"], ["mtime", "name"], ["name"]).collect()}
    assert got == {("g", "b"), ("h", "q")}


def test_next_in_order_matches_lead(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for g in ("s1", "s2", "hot"):
        n = 2000 if g == "hot" else 50
        minutes = sorted(rnd.sample(range(0, 60 * 24 * 9), n))
        rows += [(g, base + dt.timedelta(minutes=m), base + dt.timedelta(minutes=m, seconds=rnd.randint(0, 500)))
                 for m in minutes]
    df = spark.createDataFrame(rows, "g string, minute timestamp_ntz, created_at timestamp_ntz")
    got = skew.next_in_order(df, ["g"], "minute", ["created_at"], F.date_trunc("day", "minute"))
    w = Window.partitionBy("g").orderBy("minute")
    want = df.select("g", "minute", "created_at", F.lead("minute").over(w).alias("next_minute"),
                     F.lead("created_at").over(w).alias("next_created_at"))
    cols = ["g", "minute", "created_at", "next_minute", "next_created_at"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())


def test_bounded_broadcast_checks_size(spark, capsys):
    small = skew.bounded_broadcast(spark.range(10), max_bytes=800)
    big = skew.bounded_broadcast(spark.range(1000), max_bytes=800)
    small.explain(True)
    assert "broadcast" in capsys.readouterr().out.lower()
    big.explain(True)
    assert "broadcast" not in capsys.readouterr().out.lower()
    assert spark.range(100).join(big, "id").count() == 100


def test_bounded_broadcast_bound_from_session(spark, capsys):
    spark.conf.set(skew.BROADCAST_MAX_BYTES_CONF, "5")
    try:
        skew.bounded_broadcast(spark.range(10)).explain(True)
        assert "broadcast" not in capsys.readouterr().out.lower()
    finally:
        spark.conf.unset(skew.BROADCAST_MAX_BYTES_CONF)
    skew.bounded_broadcast(spark.range(10)).explain(True)
    assert "broadcast" in capsys.readouterr().out.lower()
