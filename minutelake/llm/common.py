"""Shared helpers: staged tables, grouped tasks and tables by name."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from minutelake.llm.words import slices

#: characters that separate words: blank and 0x09 to 0x0D
WORD = r"[^\x20\x09-\x0D]+"

#: rows of one Arrow batch: bounds a Python worker's memory when texts are long
BATCH_ROWS = 500


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    found = "file://" + tempfile.mkdtemp(prefix="minutelake-llm-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; Spark's driver deletes it when it ends."""
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
    top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(top)
    return path


#: Spark's setting by which the shuffle files of a finished query go at once
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: bytes of a row group of a staged table: what a writing task buffers
ROW_GROUP_BYTES = 16 << 20


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors, frees shuffle files."""
    path, before = new_folder(spark, name), spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def forget(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, unless the session asks for fewer already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower case of A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_group(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """``fn`` on each group of ``keys`` (non-null); groups must be bounded. Many small groups share a task and a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def done(frame: pd.DataFrame) -> pd.DataFrame | None:
            found = [x for x in (fn(part) for _, part in frame.groupby(keys, sort=False)) if x is not None and len(x)]
            return pd.concat(found, ignore_index=True) if found else None

        for batch in batches:
            if not len(batch):
                continue
            last = tuple(batch[keys].iloc[-1])
            same = (batch[keys] == last).all(axis=1)
            if held and tuple(held[0][keys].iloc[0]) == last:  # sorted: all of the batch continues the held group
                held.append(batch)
                continue
            whole = pd.concat([*held, batch[~same]], ignore_index=True)
            held = [batch[same]]
            if len(whole) and (out := done(whole)) is not None:
                yield out
        if held and (out := done(pd.concat(held, ignore_index=True))) is not None:
            yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def small_side(df: DataFrame, most: int) -> DataFrame:
    """``df``, to be broadcast if it has at most ``most`` rows; else it is joined by a shuffle."""
    return F.broadcast(df) if count_up_to(df, most) <= most else df


def guarded(docs: DataFrame, *uses: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with every column but those in ``uses`` under a name that no operator has, and the way back.

    So the caller's columns never clash with an operator's own ones, whatever their names.
    """
    names = {c: f"kept {i}" for i, c in enumerate(docs.columns) if c not in uses}
    return docs.withColumnsRenamed(names), lambda out: out.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns])


def count_up_to(df: DataFrame, most: int) -> int:
    """Rows of ``df``, counted no further than ``most`` + 1: the size check before a broadcast."""
    return df.limit(most + 1).count()


def with_text_columns(df: DataFrame, text_col: str, fn: Callable[[list[bytes | None]], dict], schema: str, keep_text: bool = True) -> DataFrame:
    """``df`` with the columns of ``schema`` that ``fn`` makes from slices of texts; its other columns pass unchanged."""
    small_batches(df.sparkSession)
    made = T.StructType.fromDDL(schema)
    kinds = {f.name: to_arrow_type(f.dataType) for f in made}
    kept = [f for f in df.schema if keep_text or f.name != text_col]
    place = df.columns.index(text_col)
    places = [i for i, f in enumerate(df.schema) if keep_text or f.name != text_col]
    names = [f.name for f in kept] + list(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            for a, b in slices(texts):
                part, out = batch.slice(a, b - a), fn(texts[a:b])
                yield pa.RecordBatch.from_arrays([part.column(i) for i in places] + [pa.array(out[k], kind) for k, kind in kinds.items()], names=names)

    return df.mapInArrow(run, T.StructType([*kept, *made]))
