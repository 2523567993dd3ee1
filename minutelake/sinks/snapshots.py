"""Small tables that grow by one file a batch, kept as snapshot plus deltas (A4, A5).

* ``<path>/deltas/<name>.parquet`` -- the rows of one append: one file, written aside and renamed, so
  it is there as a whole or not at all; a name that is there already is not written again
* ``<path>/snapshots/<n>/rows`` -- all rows up to some deltas, ``.../names`` -- those deltas (written
  last: a snapshot without it doesn't count)

Every ``COMPACT_AFTER`` deltas a new snapshot is written, through the table's own ``compacted``
(merging what belongs together).  Deltas go one snapshot later than they were taken up, so a reader
that chose the snapshot before still finds them.  So a table has at most ``SNAPSHOTS_KEPT`` snapshots
and about twice ``COMPACT_AFTER`` deltas, however many batches it has seen, and a read lists two folders.
Snapshots are named by number and a random suffix: two compactions at once do no harm.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import files as fsops

NAMES_SCHEMA = "name string"
COMPACT_AFTER = 32
SNAPSHOTS_KEPT = 2


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: str, compacted: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.columns = [f.strip().split(" ")[0] for f in schema.split(",")]
        self.compacted = compacted or (lambda rows: rows)

    def exists(self) -> bool:
        return fsops.exists(self.spark, f"{self.path}/deltas")

    def open(self) -> None:
        """Make the (empty) table."""
        fsops.make_folder(self.spark, f"{self.path}/deltas")

    def snapshots(self) -> list[str]:
        """Complete snapshots, oldest first."""
        found = [f"{self.path}/snapshots/{n}" for n in fsops.subfolders(self.spark, f"{self.path}/snapshots")]
        return [s for s in found if fsops.exists(self.spark, f"{s}/names/_SUCCESS")]

    def deltas(self) -> list[str]:
        return fsops.names(self.spark, f"{self.path}/deltas")

    def _state(self) -> tuple[str | None, set[str], list[str]]:
        """The latest snapshot, the deltas it took up, and those beyond it (listed after it was chosen)."""
        complete = self.snapshots()
        latest, held = (complete[-1] if complete else None), set()
        if latest is not None:  # the deltas that were there at the time: a bounded list
            held = {r[0] for r in self.spark.read.schema(NAMES_SCHEMA).parquet(f"{latest}/names").collect()}
        return latest, held, [d for d in self.deltas() if d not in held]

    def _rows(self, latest: str | None, deltas: list[str]) -> DataFrame:
        paths = [f"{latest}/rows"] * (latest is not None) + [f"{self.path}/deltas/{d}" for d in deltas]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        latest, _, deltas = self._state()
        return self._rows(latest, deltas)

    def has(self, name: str) -> bool:
        return fsops.exists(self.spark, f"{self.path}/deltas/{name}.parquet")

    def append(self, name: str, rows: DataFrame) -> bool:
        """The rows of one batch as one file; False if the batch is there already."""
        if self.has(name):
            return False
        aside = f"{self.path}/aside/{uuid.uuid4().hex}"
        # a few rows for each stream of one batch; one file is what makes it atomic
        rows.select(*self.columns).repartition(1).write.parquet(aside)
        part = next(n for n in fsops.names(self.spark, aside) if n.startswith("part-"))
        self.open()
        done = fsops.rename(self.spark, f"{aside}/{part}", f"{self.path}/deltas/{name}.parquet")
        fsops.delete_path(self.spark, aside)
        if len(self.deltas()) >= 2 * COMPACT_AFTER or (not self.snapshots() and len(self.deltas()) >= COMPACT_AFTER):
            self.compact()
        return done

    def compact(self, keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """A new snapshot; ``keep`` says which rows stay (a purge)."""
        latest, held, deltas = self._state()
        if latest is None and not deltas:
            return
        rows = self._rows(latest, deltas)
        number = 1 + int(latest.rsplit("/", 1)[1].split("-")[0] if latest else 0)
        new = f"{self.path}/snapshots/{number:09d}-{uuid.uuid4().hex[:8]}"
        self.compacted(rows if keep is None else keep(rows)).select(*self.columns).write.parquet(f"{new}/rows")
        self.spark.createDataFrame([(n,) for n in deltas], NAMES_SCHEMA).repartition(1).write.parquet(f"{new}/names")
        for name in held:  # the snapshot before has them, and so has this one
            fsops.delete_path(self.spark, f"{self.path}/deltas/{name}")
        for old in self.snapshots()[:-SNAPSHOTS_KEPT]:
            fsops.delete_path(self.spark, old)
