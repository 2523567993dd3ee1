"""Exact top-k search by inner product over a bit-sliced index.

Vectors are whole numbers. The index holds, for each block of rows and each dimension, the leading bits of its values as
bitmaps over the rows (slices). For a query, slices are added up by bitmap arithmetic, weighted by the bits of the
query's own values (slices of a dimension with a negative weight are complemented), which gives the slices of every
row's score but for what the cut bits add, and that has known bounds. The rows with the k largest sums are selected from
the most significant slice downward; every row that the bounds let into the first k is then scored exactly.

Queries and rows meet in blocks: a group of queries and a block of the index in each task.

Edge cases: rows without a number, and vectors that are null or hold a null or non-finite component, take no part; any
finite one does, whole numbers of any size are added exactly. A score of the answer that leaves 64 bits is an error
naming its rows. Vectors of other lengths count as filled up with zeros. A repeated row is a candidate for its twins, and as a query answered each time. Fewer rows than k: all of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm.common import stage, table

#: leading bits of a dimension that are kept as slices
SLICES = 7
#: rows of a block and queries of a group, about
BLOCK_ROWS, GROUP_QUERIES = 16_384, 1024
#: components below this are held in 64 bits, in blocks that have others in Python's whole numbers
IN_64_BITS = 1 << 62
#: least and largest score that can be returned
LEAST_SCORE, MOST_SCORE = -(1 << 63), (1 << 63) - 1


class Block:
    """The index of a block of whole-number vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors  # int64, or object where components are larger
        rows, dims = vectors.shape
        self.low = self.vectors.min(axis=0) if rows else np.zeros(dims, np.int64)
        reach = int((self.vectors - self.low).max()) if rows and dims else 0
        self.largest = int(abs(self.vectors).max()) if rows and dims else 0
        self.shift = max(0, reach.bit_length() - SLICES)
        leading = ((self.vectors - self.low) >> self.shift).astype(np.uint8)
        padded = np.zeros((-(-max(rows, 1) // 64) * 64, dims), np.uint8)
        padded[:rows] = leading
        bits = np.stack([(padded >> w) & 1 for w in range(SLICES)]) if dims else np.zeros((SLICES, len(padded), 0), np.uint8)
        #: dimension, slice, words of a bitmap
        self.slices = np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view(np.uint64)
        self.there = np.packbits(np.arange(len(padded)) < rows, bitorder="little").view(np.uint64)
        self.complements = self.there & ~self.slices

    def sums(self, weights: np.ndarray) -> list[np.ndarray]:
        """Slices, least first, of each row's sum of |weight| times leading bits (complemented for weights below 0)."""
        sizes = np.abs(weights)
        total: list[np.ndarray] = []
        for bit in range(int(sizes.max(initial=0)).bit_length() - 1, -1, -1):
            if total:
                total.insert(0, np.zeros_like(self.there))
            for d in np.flatnonzero((sizes >> bit) & 1).tolist():
                add(total, self.slices[d] if weights[d] > 0 else self.complements[d])
        return total

    def best(self, weights: np.ndarray, k: int) -> np.ndarray:
        """Rows among which the k largest scores are."""
        total = self.sums(weights)
        if not total:
            return np.arange(len(self.vectors))
        # from the most significant slice downward: the k-th largest sum
        sure, open_, least = np.zeros_like(self.there), self.there, 0
        for at in range(len(total) - 1, -1, -1):
            have = open_ & total[at]
            if count(sure) + count(have) >= k:
                open_, least = have, least | 1 << at
            else:
                sure, open_ = sure | have, open_ & ~total[at]
        cut = (1 << self.shift) - 1
        spread = sum(abs(w) for w in weights.tolist()) * cut  # between the largest and least that cut bits add
        least = max(0, least - -(-spread // (1 << self.shift)))
        return np.flatnonzero(np.unpackbits(at_least(total, least, self.there).view(np.uint8), bitorder="little"))


    def scores(self, rows: np.ndarray, weights: np.ndarray) -> list[int]:
        """Exact scores; in 64 bits where no sum can leave them."""
        if self.largest * sum(abs(w) for w in weights.tolist()) <= MOST_SCORE:
            return (self.vectors[rows].astype(np.int64) @ weights.astype(np.int64)).tolist()
        return [sum(a * b for a, b in zip(x, weights.tolist())) for x in self.vectors[rows].tolist()]


def add(total: list[np.ndarray], more: np.ndarray) -> None:
    """``total`` += ``more``, slice by slice with a carry."""
    carry = None
    for at in range(max(len(more), len(total))):
        if at >= len(total):
            total.append(np.zeros_like(more[0]))
        a = total[at]
        if at < len(more):
            b = more[at]
            half = a ^ b
            if carry is None:
                total[at], carry = half, a & b
            else:
                total[at], carry = half ^ carry, (a & b) | (half & carry)
        else:
            total[at], carry = a ^ carry, a & carry
    if carry is not None and carry.any():
        total.append(carry)


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def at_least(total: list[np.ndarray], least: int, there: np.ndarray) -> np.ndarray:
    """Rows whose sum is ``least`` or more."""
    above, equal = np.zeros_like(there), there
    for at in range(len(total) - 1, -1, -1):
        if least >> at & 1:
            equal = equal & total[at]
        else:
            above, equal = above | (equal & total[at]), equal & ~total[at]
    return above | equal


def to_matrix(vectors: list, dims: int) -> np.ndarray:
    """Whole numbers (given as doubles that are whole), a row for each vector, filled up with zeros."""
    out = np.zeros((len(vectors), dims))
    for i, x in enumerate(vectors):
        out[i, : len(x)] = x
    if not out.size or np.abs(out).max() < IN_64_BITS:
        return out.astype(np.int64)
    return np.array([[int(v) for v in x] for x in out.tolist()], object).reshape(out.shape)


def search_block(k: int, dims: int):
    """A group of queries against a block of rows: each query's k best rows of the block."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            ids, rids = rows["vec_id"].to_numpy(), rows["rid"].to_numpy()
            block = Block(to_matrix(rows["q"].tolist(), dims))
            for query, rid, weights in zip(queries["vec_id"], queries["rid"], to_matrix(queries["q"].tolist(), dims), strict=True):
                near = block.best(weights, k + 1)  # one more: the query's own row may be among them
                near = near[rids[near] != rid]
                first = sorted(zip([-x for x in block.scores(near, weights)], ids[near].tolist()))[:k]
                for score, vec in ((-x, i) for x, i in first):
                    if score > MOST_SCORE:
                        raise OverflowError(f"the score of rows {query} and {vec} leaves 64 bits")
                    out.append((query, rid, vec, max(score, LEAST_SCORE)))
        return pd.DataFrame(out, columns=["query_id", "rid", "vec_id", "score"])

    return run


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(rid, vec_id, q): floor(scale * x) of each component, as whole doubles, for rows that take part."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(F.coalesce(good, F.lit(False)))

    def whole(v):  # doubles from 2 ** 53 on are whole; a product beyond all doubles isn't a number we can hold
        scaled = v * F.lit(float(scale))
        floor = F.when(F.abs(scaled) < float(1 << 53), F.floor(scaled).cast("double")).otherwise(scaled)
        return F.when(F.abs(scaled) < float("inf"), floor).otherwise(F.raise_error(F.concat(F.lit("a component is too large: "), v.cast("string"))).cast("double"))

    return rows.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, whole).alias("q"))


def top_k(spark: SparkSession, rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``queries``, some of ``rows`` (rid, vec_id, q), by inner product."""
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("dims")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ROWS))
    groups = max(1, -(-queries.count() // GROUP_QUERIES))

    def dealt(of: int):
        return F.pmod(F.xxhash64("rid"), F.lit(of)).cast("int")

    left = queries.select("rid", "vec_id", "q", dealt(groups).alias("of"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = rows.select("rid", "vec_id", "q", dealt(blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("of"))
    kinds = "query_id long, rid long, vec_id long, score long"
    near = left.groupBy("block", "of").cogroup(right.groupBy("block", "of")).applyInPandas(search_block(k, size["dims"] or 0), kinds)
    ranked = near.withColumn("rank", F.expr("row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)"))
    names = F.concat_ws(" and ", F.col("query_id").cast("string"), F.col("vec_id").cast("string"))
    too_low = F.raise_error(F.concat(F.lit("the score of rows "), names, F.lit(" leaves 64 bits"))).cast("long")
    score = F.when(F.col("score") > LEAST_SCORE, F.col("score")).otherwise(too_low)
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(spark, whole_numbers(table(spark, sf_dir, "embeddings")), "vectors")
    return top_k(spark, rows, rows.where("vec_id % 50 = 0"), 5)


OP9_SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid, a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
