"""Column expressions for the path layout and the minute/hour/trash formats.

All are built-in Spark expressions (JVM side, inside whole-stage codegen); no UDFs.
Timestamps are kept as ``TIMESTAMP_NTZ`` with the session time zone pinned to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (  # noqa: E402
    COLLECTOR_FILE_SUFFIX, FILE_TIME_FORMAT, HOUR_DIR_FORMAT, MINUTE_DIR_FORMAT, PUBLISHED_SUFFIX, TRASH_DAY_FORMAT,
    TRASH_HOUR_FORMAT,
)

_MINUTE_IN_PATH = r"/(\d{4}/\d\d/\d\d/\d\d/\d\d)(/.*)?$"
_TIME_IN_FILE_NAME = r"-(\d{4}-\d\d-\d\d-\d\d-\d\d)_\d+$"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ntz(col) -> Column:
    return c(col).cast("timestamp_ntz")


def minute_of(ts) -> Column:
    """Truncation to the minute (NTZ in, NTZ out)."""
    return ntz(F.date_trunc("minute", c(ts)))


def hour_of(ts) -> Column:
    return ntz(F.date_trunc("hour", c(ts)))


def plus_minutes(ts, n: int) -> Column:
    return c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def minute_path(ts) -> Column:
    """``yyyy/MM/dd/HH/mm/`` (trailing separator as in the reference)."""
    return F.concat(F.date_format(c(ts), MINUTE_DIR_FORMAT), F.lit("/"))


def hour_path(ts) -> Column:
    """``yyyy/MM/dd/HH/``."""
    return F.concat(F.date_format(c(ts), HOUR_DIR_FORMAT), F.lit("/"))


def dest_dir(root, base: str, stream, ts) -> Column:
    """``<root>/<base>/<stream>/yyyy/MM/dd/HH/mm/``."""
    return F.concat(c(root), F.lit(f"/{base}/"), c(stream), F.lit("/"), minute_path(ts))


def dest_dir_till_hour(root, base: str, stream, ts) -> Column:
    return F.concat(c(root), F.lit(f"/{base}/"), c(stream), F.lit("/"), hour_path(ts))


def relative_dest_dir(stream, ts) -> Column:
    """F5 ``getDateTimeDestDir``: ``<stream>/yyyy/MM/dd/HH/mm/``."""
    return F.concat(c(stream), F.lit("/"), minute_path(ts))


def collector_path(root, stream, collector, file_name) -> Column:
    return F.concat_ws("/", c(root), F.lit("data"), c(stream), c(collector), c(file_name))


def parse_minute(path) -> Column:
    """minute of a stream path ``.../yyyy/MM/dd/HH/mm[/file]``; unparseable -> null."""
    s = F.regexp_extract(c(path), _MINUTE_IN_PATH, 1)
    return ntz(F.try_to_timestamp(s, F.lit(MINUTE_DIR_FORMAT)))


def published_name(collector, file_name) -> Column:
    """``<collector>-<file>.gz``."""
    return F.concat(c(collector), F.lit("-"), c(file_name), F.lit(PUBLISHED_SUFFIX))


def stream_from_name(name) -> Column:
    """second ``-`` token of a copied file name (repeated ``-`` collapse); null if absent."""
    tokens = F.filter(F.split(c(name), "-"), lambda t: t != F.lit(""))
    ok = c(name).contains("-") & (F.length(c(name)) > 1)
    return F.when(ok, F.get(tokens, 1))


def stream_from_collector_path(path) -> Column:
    """grandparent directory of ``.../data/<stream>/<collector>/<file>``."""
    return F.element_at(F.split(c(path), "/"), -3)


def collector_file_name(stream, minute) -> Column:
    """``<stream>-yyyy-MM-dd-HH-mm_00000``."""
    return F.concat(c(stream), F.lit("-"), F.date_format(c(minute), FILE_TIME_FORMAT),
                    F.lit(COLLECTOR_FILE_SUFFIX))


def event_minute(file_name) -> Column:
    """The minute encoded in a collector file name; null if absent."""
    s = F.regexp_extract(c(file_name), _TIME_IN_FILE_NAME, 1)
    return ntz(F.try_to_timestamp(s, F.lit(FILE_TIME_FORMAT)))


def file_time_string(ts) -> Column:
    """Timestamp -> ``yyyy-MM-dd-HH-mm``."""
    return F.date_format(c(ts), FILE_TIME_FORMAT)


def trash_day(ts) -> Column:
    """Unpadded ``y-M-d``."""
    return F.date_format(c(ts), TRASH_DAY_FORMAT)


def trash_hour_string(ts) -> Column:
    return F.date_format(c(ts), TRASH_HOUR_FORMAT)


def trash_dir(ts) -> Column:
    """``y-M-d/H``."""
    return F.concat(trash_day(ts), F.lit("/"), trash_hour_string(ts))


def trash_name(collector, file_name) -> Column:
    """K7: trash file name ``<collector>-<file>``."""
    return F.concat(c(collector), F.lit("-"), c(file_name))


def parse_trash_hour(day, hour) -> Column:
    """``y-M-d`` + ``H`` directory names -> hour; unparseable -> null."""
    return ntz(F.try_to_timestamp(F.concat_ws(" ", c(day), c(hour)), F.lit("y-M-d H")))


def age_hours(ts, now) -> Column:
    """absolute whole hours between ``ts`` and ``now``.

    The reference truncates the millisecond difference toward zero and takes the
    absolute value, which equals ``floor(|diff| / 1 h)``.
    """
    diff_us = F.unix_micros(ntz(now).cast("timestamp")) - F.unix_micros(ntz(ts).cast("timestamp"))
    return F.floor(F.abs(diff_us) / F.lit(3_600_000_000)).cast("long")


def make_time(year, month, day, hour=0, minute=0) -> Column:
    """Year, month, day[, hour[, minute]] (columns of numbers or strings, or numbers) -> timestamp.

    Impossible parts give null (the reference's lenient calendar would roll them over).
    """
    parts = [F.lit(x) if isinstance(x, int) else c(x).try_cast("int") for x in (year, month, day, hour, minute)]
    return ntz(F.try_make_timestamp_ntz(*parts, F.lit(0)))


def day_hour_string(ts) -> Column:
    """Unpadded ``y-M-d-H``."""
    return F.date_format(c(ts), "y-M-d-H")


def plain_path(path) -> Column:
    """A file path in one form: percent escapes undone (``_metadata.file_path`` has them) and ``file:/x``.

    Only for escaped paths; listings carry plain ones (see :func:`one_slash`).
    """
    return one_slash(F.url_decode(F.replace(c(path), F.lit("+"), F.lit("%2B"))))


def one_slash(path) -> Column:
    """``scheme:///x`` as ``scheme:/x``; hosts (``scheme://host/x``) stay."""
    return F.regexp_replace(c(path), r"^([A-Za-z][A-Za-z0-9+.-]*):/{2,3}(?=/|$)", "$1:")


# characters that Spark escapes in the folder name of a partition value (fixed by its file layout)
_ESCAPED = '"#%\'*/:=?\\{[]^' + "\x7f" + "".join(chr(i) for i in range(1, 32))


def partition_folder(name: str, value) -> Column:
    """``name=value`` as Spark writes it for a partition column (special characters percent-escaped)."""
    v = F.replace(c(value), F.lit("%"), F.lit("%25"))
    for ch in _ESCAPED:
        if ch != "%":
            v = F.replace(v, F.lit(ch), F.lit(f"%{ord(ch):02X}"))
    return F.concat(F.lit(f"{name}="), v)
