"""These must equal the reference's for results to match.

Defaults, file-name rules and on-disk formats, in one place.
"""

# ---- fixed values (as the reference defines them) -----------------------------------------
DEFAULT_RETENTION_HOURS = 48            # stream retention when none is configured
DEFAULT_TRASH_RETENTION_HOURS = 24      # trash retention when none is configured
LAST_FILE_TIMEOUT_MS = 300_000          # the newest collector file counts as closed after this idle time
FILES_TO_KEEP = 6                       # closed files left in a collector folder; older ones go to trash
IN_FLIGHT_SUFFIX = "current"            # collector file names ending so are skipped (case-sensitive)
STATS_FILE_NAME = "scribe_stats"        # collector file name skipped in any letter case
DATA_BASE = "data"                      # <root>/data/<stream>/<collector>/<file>
LOCAL_BASE = "streams_local"            # <root>/streams_local/<stream>/yyyy/MM/dd/HH/mm/<file>
MERGED_BASE = "streams"                 # <root>/streams/<stream>/yyyy/MM/dd/HH/mm/<file>
MINUTE_DIR_FORMAT = "yyyy/MM/dd/HH/mm"  # minute directory levels
HOUR_DIR_FORMAT = "yyyy/MM/dd/HH"       # hour directory levels
FILE_TIME_FORMAT = "yyyy-MM-dd-HH-mm"   # time inside a collector file name <stream>-<time>_NNNNN
COLLECTOR_FILE_SUFFIX = "_00000"        # sequence suffix of a collector file name
PUBLISHED_SUFFIX = ".gz"                # published file: <collector>-<file>.gz
TRASH_DAY_FORMAT = "y-M-d"              # trash day directory, unpadded
TRASH_HOUR_FORMAT = "H"                 # trash hour directory, unpadded
