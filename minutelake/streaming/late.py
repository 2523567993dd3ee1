"""T6 as keyed state of a stream.  The class travels to the workers by value."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StringType, StructField, StructType

LATE = "stream string, collector string, file_name string, last_name string"
COLUMNS = [f.split(" ")[0] for f in LATE.split(", ")]


class LateFiles(StatefulProcessor):
    """Per collector the greatest name delivered so far; a name at or below it came late."""

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", StructType([StructField("name", StringType())]))

    def handleInputRows(self, key, rows, timer) -> Iterator[pd.DataFrame]:  # noqa: N802  (the interface's name)
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        # a batch's files are judged by what was delivered before it, and then all of them are
        found = sorted(str(n) for part in rows for n in part["file_name"])
        for name in found:
            if last is not None and name <= last:
                out.append((key[0], key[1], name, last))
        if found:
            self.last.update((found[-1] if last is None else max(last, found[-1]),))
        yield pd.DataFrame(out, columns=COLUMNS)

    def close(self) -> None:
        pass


cloudpickle.register_pickle_by_value(sys.modules[__name__])
