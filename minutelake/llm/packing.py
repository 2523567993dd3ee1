"""Best-fit packing: hierarchical residual packing of token pieces into sequences of fixed length.

Documents are cut only where they are longer than a sequence. Partitions pack their pieces best-fit from the longest
down; bins that are nearly full are done. The others are items of the next round, over a fraction of the partitions,
until one is left or a round saves less than one bin in a hundred, so no task ever gets more items than ``TASK_ITEMS``
or so. What ending early can cost is at most that share of the bins that are open by then.

Edge cases: a null or empty text is the closing id alone. Repeated rows are packed each. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm.common import stage, table, with_text_columns
from minutelake.llm.tokens import WordEncoder

CAPACITY = 4096
END_ID = 1
#: items that a task packs, about; each is some dozen bytes
TASK_ITEMS = 40_000
#: free places of a nearly full bin
SLACK = 24
#: partitions of a round that become one in the next
FAN_IN = 4

MEMBER = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])


def cut_pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    """The pieces of each text: (piece, start, length, ids_crc32[, ids])."""

    def run(texts: list[bytes | None]) -> dict:
        nonlocal encoder
        if encoder is None:
            encoder = WordEncoder(path)
        out = []
        for ids in encoder.encode([(x or b"").decode() for x in texts]):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            held = []
            for piece, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start : start + capacity].tobytes()
                held.append({"piece": piece, "start": start, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)} | ({"ids": part} if with_ids else {}))
            out.append(held)
        return {"pieces": out}

    encoder: WordEncoder | None = None
    return run


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids: little-endian]) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "pieces array<struct<piece:int,start:long,length:long,ids_crc32:long" + (",ids:binary" if with_ids else "") + ">>"
    return with_text_columns(rows, "text", cut_pieces(path, capacity, end_id, with_ids), kind, keep_text=False).select("doc_id", F.inline("pieces"))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items of each bin: the longest first, each into the fullest bin that still holds it."""
    bins: list[list[int]] = []
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free places
    mask = 0  # free places that some open bin has
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fitting = mask >> n
        if fitting:
            free = n + (fitting & -fitting).bit_length() - 1
            b = open_[free].pop()
            if not open_[free]:
                mask &= ~(1 << free)
            bins[b].append(i)
        else:
            b, free = len(bins), capacity
            bins.append([i])
        if left := free - n:
            open_[left].append(b)
            mask |= 1 << left
    return bins


def pack_partition(capacity: int):
    """Bins (fill, members) of a partition packed into fewer bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fills, members = [], []
        for batch in batches:
            fills += batch.column(0).to_pylist()
            members += batch.column(1).to_pylist()
        made, bins = best_fit(fills, capacity), []
        for held in made:
            at, out = 0, []
            for i in held:
                for m in members[i]:
                    out.append(m | {"offset": at})
                    at += m["length"]
            bins.append((at, out))
        for a in range(0, len(bins), 2000):
            part = bins[a : a + 2000]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.int64()), pa.array([y for _, y in part], pa.list_(MEMBER))], names=["fill", "members"])

    return run


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of the pieces, each of at most ``capacity``."""
    kind = "fill long, members array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>>"
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    pieces = stage(spark, pieces.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces")
    bins = pieces.select(F.col("length").alias("fill"), F.array(member).alias("members"))
    done = [bins.where(F.col("fill") >= capacity - SLACK)]
    rest = bins.where(F.col("fill") < capacity - SLACK)
    left = rest.count()
    parts = max(1, -(-left // TASK_ITEMS))
    while left:
        packed = stage(spark, rest.repartition(parts).mapInArrow(pack_partition(capacity), kind), "bins")
        done.append(packed.where(F.col("fill") >= capacity - SLACK))
        rest = packed.where(F.col("fill") < capacity - SLACK)
        before, left = left, rest.count()
        if parts == 1 or left > 0.99 * before:
            done.append(rest)
            break
        parts = max(-(-parts // FAN_IN), -(-left // TASK_ITEMS))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    out = out.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    return out.select("sequence_id", F.inline("members")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(pieces_with_ids: DataFrame, packed: DataFrame) -> DataFrame:
    """(sequence_id, ids: little-endian, spans) of each sequence, for pieces with distinct (doc_id, piece)."""
    rows = pieces_with_ids.select("doc_id", "piece", "ids").join(packed, ["doc_id", "piece"])
    held = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    out = rows.groupBy("sequence_id").agg(held.alias("held"))
    empty = F.lit(b"")
    return out.select("sequence_id", F.aggregate("held", empty, lambda a, x: F.concat(a, x["ids"])).alias("ids"), F.transform("held", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"], x["length"])).alias("spans"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, pieces_of(table(spark, sf_dir, "documents"), tokenizer_path()))
