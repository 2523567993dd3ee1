"""Suffix-array dedup: removes every byte covered by a long string (400 bytes) that also starts anywhere else.

* *Windows and shards.* Each window of 400 bytes is given to the least of its 100-byte grams by hash (the leftmost such
  place). That depends on the window's content alone, so equal windows, wherever they are, have equal keys and the same
  place in them. The windows of one place are a run; a run's text is a segment. Shards of segments are dealt by key.
* *Copies first.* Segments of equal content are counted (combined before the shuffle): all windows of a content seen twice
  are repeated, and one of its copies stands for all. Keys of one content need no more work.
* *Suffix arrays.* Keys with several contents go, many to a block, through ``suffixes``: a suffix array by induced sorting
  and permuted common prefixes. A window is repeated if its suffix shares 400 bytes with a neighbour in the array.
* *Hot keys.* A key whose segments don't fit a block (a passage shared by very many documents, each with a different
  sequel) is split: its segments are cut into cells of 32 windows, later of one, and the new key is what all windows of the
  cell have in common. Cells go the same way; cells of one window are settled by counting. So no task holds more than
  a block of segments and no text is dropped.

Joins on content or key treat keys that hold a good share of all rows apart (there are fewer than ``SHARES`` of them, so
they are broadcast). Hashes: 128 bits of content.

Edge cases: a null text counts as empty; shorter texts than a window lose nothing. Matches never cross documents; a
repeat within a document counts, and overlapping ones count. Rows with null or repeated ids are documents of their own,
equal texts repeat each other in full. Texts of any length are read whole, a piece of ``PIECE`` bytes at a time. An empty
table gives no row. Only the id and text columns are read, others may have any name and don't come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm.common import forget, small_batches, stage, table
from minutelake.llm.suffixes import permuted_common_prefixes, suffix_array
from minutelake.llm.words import BYTE_VALUE, U, mix, slices

#: bytes of a string that must not repeat, and of the grams that windows are dealt by
WINDOW, GRAM = 400, 100
#: bytes of a text that are handled at once
PIECE = 1 << 20
#: bytes of segments of one suffix array; keys with more are split
BLOCK = 1 << 19
HOT = 8 * BLOCK
#: windows of a cell, for the keys that are split once, and twice
CELLS = (32, 1)
#: a key with more than this part of all rows is joined by a broadcast
SHARES = 2000

#: what the hash of a gram multiplies by, and its inverse
STEP = 0x9E3779B97F4A7C15 | 1
BACK = pow(STEP, -1, 1 << 64)

RUNS = "key long, hi long, lo long, rid long, s long, e long, q long"


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U).view(np.int64)


def content_hashes(parts: list) -> tuple[np.ndarray, np.ndarray]:
    import xxhash

    found = np.frombuffer(b"".join([xxhash.xxh3_128_digest(x) for x in parts]), "<i8").reshape(len(parts), 2)
    return found[:, 0], found[:, 1]


def runs_of(texts: list[bytes], window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, place of the gram, its hash, content hashes) of each run of windows."""
    size = np.array([len(x) for x in texts], np.int64)
    start = np.cumsum(size) - size
    joined = b"".join(texts)
    many = np.maximum(size - window + 1, 0)  # windows of each text
    if not many.sum():
        none = np.empty(0, np.int64)
        return (none,) * 7
    buf = np.frombuffer(joined, np.uint8)
    n = len(buf)
    step = np.multiply.accumulate(np.append(U(1), np.full(n, STEP, U)))
    back = np.multiply.accumulate(np.append(U(1), np.full(n - gram, BACK, U)))
    summed = np.append(U(0), np.cumsum(BYTE_VALUE[buf] * step[:n], dtype=U))
    grams = mix((summed[gram:] - summed[:-gram]) * back)
    # the least hash among the places of a window, the leftmost of equal ones
    least = (grams >> U(32) << U(32)) | np.arange(len(grams), dtype=U)
    places, wide = window - gram + 1, 1
    while 2 * wide <= places:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < places:
        least = np.minimum(least[: wide - places], least[places - wide :])
    at = np.arange(many.sum()) + np.repeat(start - (np.cumsum(many) - many), many)
    of = np.repeat(np.arange(len(texts)), many)
    q = (least[at] & U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, (q[1:] != q[:-1]) | (of[1:] != of[:-1])))
    last = np.append(first[1:], len(q)) - 1
    view = memoryview(joined)
    hi, lo = content_hashes([view[a : b + window] for a, b in zip(at[first].tolist(), at[last].tolist())])
    of, begin = of[first], start[of[first]]
    return of, at[first] - begin, at[last] - begin, q[first] - begin, signed(grams[q[first]]), hi, lo


def pieces(texts: list[bytes], window: int) -> Iterator[tuple[int, int, bytes]]:
    """(text, offset, bytes): texts cut so that each window is in one piece."""
    for i, x in enumerate(texts):
        for at in range(0, max(1, len(x) - window + 1), PIECE):
            yield i, at, x[at : at + PIECE + window - 1] if len(x) > PIECE + window - 1 else x


def all_runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """The runs of windows of all texts (rid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, texts = np.array(batch.column(0).to_pylist(), np.int64), batch.column(1).cast(pa.binary()).to_pylist()
            cut = list(pieces([x or b"" for x in texts], window))
            for a, b in slices([x for _, _, x in cut]):
                of, s, e, q, key, hi, lo = runs_of([x for _, _, x in cut[a:b]], window, gram)
                if len(of):
                    row, off = np.array([i for i, _, _ in cut[a:b]])[of], np.array([o for _, o, _ in cut[a:b]])[of]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (key, hi, lo, rids[row], s + off, e + off, q + off)], names=NAMES)

    small_batches(docs.sparkSession)
    return docs.select("rid", "text").mapInArrow(run, RUNS)


NAMES = [f.split(" ")[0] for f in RUNS.split(", ")]
SEGMENT = "key long, rid long, s long, single boolean, bytes binary"


def for_each_part(docs: DataFrame, wanted: DataFrame, fn, kinds: str) -> DataFrame:
    """``fn`` of each wanted part (key, s, e, q, single) and its document's text; parts meet texts by a shuffle."""
    lists = wanted.groupBy("rid").agg(F.collect_list(F.struct("key", "s", "e", "q", "single")).alias("parts"))  # of one document
    names = [f.split(" ")[0] for f in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rid, text, parts = batch.column(0)[i].as_py(), memoryview(batch.column(1)[i].as_buffer()), batch.column(2)[i].as_py()
                for at in range(0, len(parts), 5000):
                    columns = fn(rid, text, parts[at : at + 5000])
                    yield pa.RecordBatch.from_arrays([pa.array(columns[n], kind) for n, kind in zip(names, ARROW[kinds], strict=True)], names=names)

    return docs.select("rid", F.col("text").cast("binary").alias("text")).join(lists, "rid").mapInArrow(run, kinds)


ARROW = {RUNS: [pa.int64()] * 7, SEGMENT: [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]}


def segments(window: int):
    def fn(rid: int, text: memoryview, parts: list[dict]) -> dict:
        return {"key": [p["key"] for p in parts], "rid": [rid] * len(parts), "s": [p["s"] for p in parts], "single": [p["single"] for p in parts], "bytes": [bytes(text[p["s"] : p["e"] + window]) for p in parts]}

    return fn


def cells(window: int, many: int):
    """Segments cut into cells of ``many`` windows, counted from the gram; the key is what a cell's windows have in common."""
    import xxhash

    def fn(rid: int, text: memoryview, parts: list[dict]) -> dict:
        rows = {n: [] for n in NAMES}
        for p in parts:
            at = p["s"]
            while at <= p["e"]:
                cell = (p["q"] - at) // many  # windows start cell * many .. (cell + 1) * many - 1 before the gram
                end = min(p["e"], p["q"] - cell * many)
                core = text[p["q"] - cell * many : p["q"] - (cell + 1) * many + 1 + window]
                rows["key"].append(xxhash.xxh3_64_intdigest(core, seed=(p["key"] ^ cell * STEP) & 0xFFFFFFFFFFFFFFFF))
                for name, value in (("rid", rid), ("s", at), ("e", end), ("q", p["q"])):
                    rows[name].append(value)
                at = end + 1
        rows["key"] = np.array(rows["key"], U).view(np.int64)
        rows["hi"], rows["lo"] = content_hashes([text[a : b + window] for a, b in zip(rows["s"], rows["e"])])
        return rows

    return fn


def repeated_windows(rows: list[bytes], window: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of the segments of a block, those with repeated windows, and which of their windows these are."""
    size = np.array([len(x) for x in rows], np.int64)
    start = np.cumsum(size + 1) - size - 1
    # bytes from 2 on, 1 after each segment, 0 at the end
    text = np.append((np.frombuffer(b"\xff".join([*rows, b""]), np.uint8).astype(np.uint16) + 2), 0).astype(np.uint16)
    text[start + size] = 1
    near, shared = permuted_common_prefixes(text, suffix_array(text))
    left = np.repeat(size, size + 1) - (np.arange(len(text) - 1) - np.repeat(start, size + 1))  # bytes to the segment's end
    found = np.flatnonzero((shared[:-1] >= window) & (left >= window))
    flags = np.zeros(len(text), bool)
    flags[found] = flags[near[found]] = True
    hits = np.flatnonzero(flags)
    of = np.searchsorted(start, hits, "right") - 1
    for i in np.unique(of).tolist():
        yield i, hits[of == i] - start[i]


def by_suffix_arrays(parts: DataFrame, window: int) -> DataFrame:
    """(rid, s, e): first and last of the repeated windows of segments that stand for themselves alone."""

    def solved(held: list[tuple]) -> pa.RecordBatch:
        out = []
        for i, at in repeated_windows([x for _, _, _, x in held], window):
            _, rid, s, _ = held[i]
            first = np.flatnonzero(np.append(True, np.diff(at) > 1))
            last = np.append(first[1:], len(at)) - 1
            if held[i][2] is not None:
                out += [(rid, s + a, s + b) for a, b in zip(at[first].tolist(), at[last].tolist())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["rid", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, total = [], [], 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for key, rid, s, single, x in zip(*columns):
                if group and group[0][0] != key:
                    if held and total + sum(len(g[3]) for g in group) > BLOCK:
                        yield solved(held)
                        held, total = [], 0
                    held, total, group = held + group, total + sum(len(g[3]) for g in group), []
                group.append((key, rid, s if single else None, x))
        if held or group:
            yield solved(held + group)

    return parts.repartition("key").sortWithinPartitions("key").mapInArrow(run, "rid long, s long, e long")


def skewed_join(rows: DataFrame, side: DataFrame, keys: list[str], many: str, total: int) -> DataFrame:
    """Inner join with ``side`` (a row for each key, with the number of its rows): fewer than ``SHARES`` keys are broadcast."""
    hot = side.where(F.col(many) * SHARES > total)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(side.where(F.col(many) * SHARES <= total), keys))


def repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(rid, s, e): first and last windows of runs of repeated windows, of all ``docs`` (rid, text)."""
    rows, found = all_runs(docs, window, gram), []
    for level in (*CELLS, None):
        rows = stage(spark, rows, "runs")
        contents = rows.groupBy("key", "hi", "lo").agg(F.count("*").alias("n"), F.min(F.struct("rid", "s", "e", "q")).alias("one"))
        contents = stage(spark, contents, "contents")
        copies = contents.where("n > 1").select("key", "hi", "lo", "n")
        found.append(stage(spark, skewed_join(rows, copies, ["key", "hi", "lo"], "n", rows.count()).select("rid", "s", "e"), "copies"))
        width = (F.col("one.e") - F.col("one.s") + window).alias("width")
        keys = contents.groupBy("key").agg(F.count("*").alias("many"), F.sum(width).alias("bytes"), F.sum((F.col("n") == 1).cast("long")).alias("singles"))
        open_ = skewed_join(contents, keys.where("many > 1 AND singles > 0"), ["key"], "many", contents.count())
        open_ = stage(spark, open_.select("key", "one.*", (F.col("n") == 1).alias("single"), (F.col("bytes") > HOT).alias("hot")), "open")
        found.append(stage(spark, by_suffix_arrays(for_each_part(docs, open_.where("NOT hot"), segments(window), SEGMENT), window), "repeats"))
        forget(spark, rows, contents)
        hot = open_.where("hot")
        if level is None or hot.isEmpty():
            break
        rows = for_each_part(docs, hot, cells(window, level), RUNS)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


KEPT = "spans array<struct<start: long, end: long>>, kept binary"


def without_repeats(spark: SparkSession, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the bytes that are removed from each document, as maximal runs, and those that stay."""
    docs = documents.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = stage(spark, docs, "documents")
    windows = repeats(spark, docs, window, gram)
    lists = windows.groupBy("rid").agg(F.collect_list(F.struct("s", "e")).alias("windows"))  # of one document

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            for i in range(batch.num_rows):
                text, found = memoryview(batch.column(2)[i].as_buffer()), sorted((w["s"], w["e"] + window) for w in batch.column(3)[i].as_py() or [])
                merged: list[list[int]] = []
                for a, b in found:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                spans.append([{"start": a, "end": b} for a, b in merged])
                edges = [0, *[x for span in merged for x in span], len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            size = pa.array([len(x.as_buffer()) for x in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(1), size, pa.array(spans, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    small_batches(spark)
    whole = docs.select("rid", "doc_id", F.col("text").cast("binary").alias("text")).join(lists, "rid", "left")
    return whole.mapInArrow(run, f"doc_id long, n_bytes long, {KEPT}")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
