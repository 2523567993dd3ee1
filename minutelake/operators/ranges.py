"""The minute ledger as ranges.

A row says that each minute from ``minute`` to ``last_minute`` of a stream is there, with one state, and
when each was created: ``created_at`` is that of the first minute; it moves along with the minutes
(``moves``: a minute service, creating each in its turn) or is the same for all (one run that filled a gap).
A stream idle for a month, or one with data in each minute, is one row.  Ranges turn back into exactly
the minutes they were made from.

All steps look only at a range and its neighbour: ``next_in_order`` bounds their windows by the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import layout as L
from ..functions.skew import next_in_order

KEYS = ["cluster", "base", "stream"]
RANGES_SCHEMA = ("cluster string, base string, stream string, minute timestamp_ntz, last_minute timestamp_ntz, "
                 "state string, created_at timestamp_ntz, moves boolean")
COLS = [f.split(" ")[0] for f in RANGES_SCHEMA.split(", ")]


def _micros(ts) -> Column:
    return F.unix_micros(L.c(ts).cast("timestamp"))


def of_minutes(minutes: DataFrame) -> DataFrame:
    """Each minute (``KEYS, minute, state, created_at``) as a range of its own."""
    return minutes.select(*KEYS, "minute", F.col("minute").alias("last_minute"), "state", "created_at", F.lit(True).alias("moves"))


def _movable() -> Column:
    """A range whose minutes are created each in its turn; one minute alone always is."""
    return F.col("moves") | (F.col("minute") == F.col("last_minute"))


def merged(ranges: DataFrame) -> DataFrame:
    """Adjoining ranges as one where that loses nothing: same state, and created each in its turn (gaps and islands).

    A minute that is there more than once counts once: data before empty, the earliest creation first.
    """
    shift = _micros("created_at") - _micros("minute")
    once = ranges.groupBy(*KEYS, "minute").agg(F.min(F.struct("state", F.negate(_micros("last_minute")).alias("o"), "created_at", "moves", "last_minute")).alias("r"))
    once = once.select(*KEYS, "minute", "r.last_minute", "r.state", "r.created_at", "r.moves")
    once = once.withColumn("kind", F.struct("state", F.when(_movable(), shift).alias("shift"), _movable().alias("movable")))
    day = L.ntz(F.date_trunc("day", "minute"))
    rows = next_in_order(once, KEYS, "minute", ["kind"], day)
    adjoins = (F.col("next_minute") == L.plus_minutes("last_minute", 1)) & F.col("kind.movable") & F.col("kind").eqNullSafe(F.col("next_kind"))
    rows = rows.withColumn("goes_on", F.coalesce(adjoins, F.lit(False)))
    # a range begins where the one before doesn't go on to it, and ends where it doesn't go on itself
    ends = rows.filter(~F.col("goes_on")).select(*KEYS, F.col("minute").alias("at"), F.lit(1).alias("side"), "last_minute")
    into = rows.filter("goes_on").select(*KEYS, F.col("next_minute").alias("minute"), F.lit(True).alias("continued"))
    begins = rows.join(into, [*KEYS, "minute"], "left").filter(F.col("continued").isNull())
    begins = begins.select(*KEYS, "minute", "last_minute", "state", "created_at", "moves")
    # the end of a range is the first end at or after its begin
    marks = begins.select(*KEYS, F.col("minute").alias("at"), F.lit(0).alias("side"), F.lit(None).cast("timestamp_ntz").alias("last_minute")).unionByName(ends)
    marks = marks.withColumn("place", F.struct("at", "side"))
    pairs = next_in_order(marks, KEYS, "place", ["last_minute"], L.ntz(F.date_trunc("day", "at"))).filter(F.col("side") == 0)
    pairs = pairs.select(*KEYS, F.col("at").alias("minute"), F.col("next_last_minute").alias("end"))
    out = begins.join(pairs, [*KEYS, "minute"])
    grown = F.col("end") > F.col("last_minute")
    return out.select(*KEYS, "minute", F.col("end").alias("last_minute"), "state", "created_at", (F.col("moves") | grown).alias("moves"))


def minutes_of(ranges: DataFrame) -> DataFrame:
    """The minutes of ranges: ``KEYS, minute, state, created_at`` (a minute in two ranges: data before empty)."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
    each = ranges.select(*KEYS, "state", "moves", F.col("minute").alias("first"), F.col("created_at").alias("first_created"),
                         F.explode(F.sequence("minute", "last_minute", step)).alias("minute"))
    created = F.when(F.col("moves"), F.col("first_created") + (F.col("minute") - F.col("first"))).otherwise(F.col("first_created"))
    out = each.select(*KEYS, "minute", F.struct("state", L.ntz(created).alias("created_at")).alias("r"))
    return out.groupBy(*KEYS, "minute").agg(F.min("r").alias("r")).select(*KEYS, "minute", "r.state", "r.created_at")


def latest(ranges: DataFrame) -> DataFrame:
    """A3: the latest minute of each stream."""
    return ranges.groupBy(*KEYS).agg(F.max("last_minute").alias("latest_minute"))


def gap_ranges(ranges: DataFrame, now) -> DataFrame:
    """T5/J10 as ranges: one row for each stream that was idle up to the minute before ``now``.

    Nothing but the latest minute of each stream is looked at, however long it was idle.
    """
    end = L.plus_minutes(L.minute_of(now), -1)
    rows = latest(ranges).withColumn("minute", L.plus_minutes("latest_minute", 1)).filter(F.col("minute") <= end)
    return rows.select(*KEYS, "minute", end.alias("last_minute"), F.lit("empty").alias("state"),
                       L.minute_of(now).alias("created_at"), F.lit(False).alias("moves"))


def missing_between(ranges: DataFrame) -> DataFrame:
    """W4 from ranges: the gaps between a stream's ranges (which don't overlap)."""
    rows = next_in_order(ranges.select(*KEYS, "minute", "last_minute"), KEYS, "minute", [], L.ntz(F.date_trunc("day", "minute")))
    rows = rows.filter(F.col("next_minute") > L.plus_minutes("last_minute", 1))
    span = _micros("next_minute") - _micros("last_minute")
    return rows.select(*KEYS, L.plus_minutes("last_minute", 1).alias("gap_start"), L.plus_minutes("next_minute", -1).alias("gap_end"),
                       (F.floor(span / F.lit(60_000_000)) - 1).cast("long").alias("n_minutes"))


def hours_of(ranges: DataFrame) -> DataFrame:
    """``base, stream, hour_key`` of every hour that ranges touch."""
    step = F.make_dt_interval(F.lit(0), F.lit(1))
    hours = F.sequence(L.hour_of("minute"), L.hour_of("last_minute"), step)
    return ranges.select("base", "stream", F.explode(hours).alias("hour")).select(
        "base", "stream", F.date_format("hour", "yyyy-MM-dd-HH").alias("hour_key")).distinct()


def without_purged(ranges: DataFrame, purged: DataFrame) -> DataFrame:
    """R3 for ranges: what is left when the oldest hours (``base, stream, hour``) go; a range may lose its beginning."""
    cut = purged.groupBy("base", "stream").agg((F.max("hour") + F.make_dt_interval(F.lit(0), F.lit(1))).alias("cut"))
    rows = ranges.join(cut, ["base", "stream"], "left")
    rows = rows.filter(F.col("cut").isNull() | (F.col("last_minute") >= F.col("cut")))
    moved = F.col("cut") > F.col("minute")
    created = F.when(moved & F.col("moves"), F.col("created_at") + (F.col("cut") - F.col("minute"))).otherwise(F.col("created_at"))
    return rows.withColumn("created_at", L.ntz(created)).withColumn("minute", F.when(moved, F.col("cut")).otherwise(F.col("minute"))).select(*COLS)
