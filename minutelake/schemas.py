"""Declared once: the tables of the file catalog, ledgers and topology."""

from pyspark.sql import types as T

S, TS, L, I, B = T.StringType(), T.TimestampNTZType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


COLLECTOR_FILES = _struct(("cluster", S), ("stream", S), ("collector", S), ("file_name", S),
                          ("path", S), ("mtime", TS), ("length", L))
STREAM_FILES = _struct(("cluster", S), ("base", S), ("stream", S), ("minute", TS), ("file_name", S),
                       ("path", S), ("mtime", TS), ("length", L))
MINUTES = _struct(("cluster", S), ("base", S), ("stream", S), ("minute", TS), ("state", S),
                  ("created_at", TS))
RECORDS = _struct(("cluster", S), ("stream", S), ("collector", S), ("src_file", S), ("minute", TS),
                  ("value", S))
CHECKPOINTS = _struct(("cluster", S), ("stream", S), ("collector", S), ("file_name", S))
MANIFESTS = _struct(("kind", S), ("src_cluster", S), ("via_cluster", S), ("dest_cluster", S),
                    ("stream", S), ("path", S), ("minute", TS), ("batch_id", L))
MANIFEST_ACKS = _struct(("kind", S), ("dest_cluster", S), ("batch_id", L))
TRASH = _struct(("cluster", S), ("trash_hour", TS), ("stream", S), ("collector", S),
                ("file_name", S), ("path", S))
CLUSTERS = _struct(("name", S), ("hdfsurl", S), ("jturl", S), ("jobqueuename", S), ("rootdir", S))
SOURCES = _struct(("stream", S), ("cluster", S), ("retention_hours", I))
DESTINATIONS = _struct(("stream", S), ("cluster", S), ("is_primary", B), ("retention_hours", I))
DEFAULTS = _struct(("rootdir", S), ("retention_hours", I), ("trash_retention_hours", I))

from .constants import (  # noqa: E402,F401  re-exported for callers
    DATA_BASE, DEFAULT_RETENTION_HOURS, DEFAULT_TRASH_RETENTION_HOURS, FILES_TO_KEEP, IN_FLIGHT_SUFFIX,
    LAST_FILE_TIMEOUT_MS, LOCAL_BASE, MERGED_BASE, STATS_FILE_NAME,
)
