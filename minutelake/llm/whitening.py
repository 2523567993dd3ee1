"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries are turned into whole numbers first, so that centring is exact: n * x - S, with S the sum over all n rows, is
computed in whole numbers and divided once. The covariance is never formed. A pass over the rows adds up Yt (Y Q) for a
narrow block Q of directions (Y: centred rows), per task and then by a grouped sum, so the driver holds dims x directions
numbers whatever the number of rows. Each round

* filters the block: a Chebyshev polynomial of the covariance, by its three-term recurrence (one pass a degree), damps
  the spectrum from 0 to the smallest Ritz value of the guards, and lifts what is above it;
* makes it orthonormal by QR and rotates it to Ritz vectors (Rayleigh-Ritz; its one pass also gives the next round's
  first degree).

The block has guard directions beyond those asked for, and a few that are drawn anew in each round, so that a direction
the start missed comes in. It ends when the residuals |V q - e q| of all wanted directions are certified: at rounding
error, or below ``CERTIFIED`` of the largest eigenvalue and no longer falling. Rounds that don't get there are an error.

Edge cases: rows whose vector is null or holds a null or non-finite entry are left out. A shorter vector counts as filled
up with entries of 0. A null id stays, repeated rows come back as often as they came (and count as often), other columns
don't come back, whatever their names. Components of an eigenvalue that is zero at working precision can't be whitened
and are left out, so a table of one row, or of equal rows, gives no row; an empty table neither. An entry, or a row's
deviation, that leaves 64 bits is an error, never a wrapped number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm.common import stage, table

#: whole numbers an entry is cut into, and what is added to each
SCALE, SHIFT = 64, 1_000_000
#: directions beyond those asked for, and directions drawn anew in each round
GUARD, FRESH = 20, 2
#: degrees of a round's polynomial; how far it may lift one direction above another (QR must tell them apart)
DEGREES, LIFT = 12, 1e10
#: residuals, as a share of the largest eigenvalue, at which directions count as certified once they fall no more
CERTIFIED = 1e-11
ROUNDS = 200
EPS = float(np.finfo(float).eps)


class NotCertified(ArithmeticError):
    """The rounds ended before the residuals were small enough."""


@dataclass
class Fit:
    """What the rows have in common: their number, sums by dimension, the trace, eigenvalues and eigenvectors of their covariance."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    passes: int = 0


def matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    """The whole numbers of each batch (column ``x``), a row each."""
    for batch in batches:
        if batch.num_rows:
            yield batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(batch.num_rows, dims)


def summed(rows: DataFrame, dims: int, shape: tuple[int, ...], fn: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of ``fn`` (an array of ``shape``) over all rows: added up in each task, then by a grouped sum."""
    size, arrow = int(np.prod(shape)), pa.float64() if kind == "double" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in matrices(batches, dims):
            total = fn(x) if total is None else total + fn(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total.ravel(), arrow)], names=["place", "part"])

    parts = rows.select("x").mapInArrow(run, f"place int, part {kind}").groupBy("place").agg(F.sum("part").alias("total"))
    out = np.zeros(size, np.float64 if kind == "double" else np.int64)
    for place, total in parts.collect():  # one row for each number of the block
        out[place] = total
    return out.reshape(shape)


def whole_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): whole numbers of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.coalesce(good, F.lit(False))).select(F.col(id_col).alias("vec_id"), v.alias("v"))
    least, most = float(-(2**62)), float(2**62)

    def whole(c):
        scaled = F.floor(c * F.lit(float(SCALE)))
        return F.when((c * SCALE > least) & (c * SCALE < most), scaled + F.lit(SHIFT)).otherwise(F.raise_error(F.concat(F.lit("an entry leaves 64 bits: "), c.cast("string"))).cast("long"))

    return rows.select("vec_id", F.transform("v", whole).alias("x"))


def same_length(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """The rows filled up to the longest, their number and length."""
    found = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dims")).first()
    n, dims = found["n"], found["dims"] or 0
    filled = F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(dims) - F.size("x")))
    return rows.select("vec_id", F.when(F.size("x") < dims, filled).otherwise(F.col("x")).alias("x")), n, dims


def centred(n: int, sums: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """x - S / n, rounded once."""
    return lambda x: (n * x - sums) / n


def orthonormal(block: np.ndarray) -> np.ndarray:
    """QR twice: columns of very different lengths come out orthogonal to rounding."""
    block = block / np.maximum(np.linalg.norm(block, axis=0), np.finfo(float).tiny)
    return np.linalg.qr(np.linalg.qr(block)[0])[0]


def degrees(top: float, bound: float) -> int:
    """How many degrees a round may have: the lift of the largest eigenvalue stays within ``LIFT``."""
    reach = np.arccosh(max(1 + 1e-9, 2 * top / bound - 1))
    return int(np.clip(np.log(LIFT) / reach, 1, DEGREES))


def chebyshev(times: Callable[[np.ndarray], np.ndarray], block: np.ndarray, first: np.ndarray, many: int, bound: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of degree ``many`` over [0, bound] of the covariance, scaled at ``top``; ``first`` is V block."""
    half = bound / 2
    sigma = sigma_1 = half / (top - half)
    before, now = block, (first - half * block) * (sigma_1 / half)
    for _ in range(many - 1):
        following = 1 / (2 / sigma_1 - sigma)
        before, now = now, (times(now) - half * now) * (2 * following / half) - sigma * following * before
        sigma = following
    return now


def fit(rows: DataFrame, n: int, dims: int, components: int, trace: float, sums: np.ndarray) -> Fit:
    """The ``components`` largest eigenvalues of the rows' covariance and their eigenvectors."""
    wanted, width, passes = min(components, dims), min(dims, components + GUARD + FRESH), 0
    middle, rng = centred(n, sums), np.random.default_rng(20)

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x: np.ndarray) -> np.ndarray:
            y = middle(x)
            return y.T @ (y @ block)

        return summed(rows, dims, block.shape, part) / n

    block, best = orthonormal(rng.standard_normal((dims, width))), np.inf
    for _ in range(ROUNDS):
        image = times(block)
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = max(float(values[0]), 0.0)
        held = int((values[:wanted] > 4 * dims * EPS * top).sum())  # the others are zero at working precision
        residuals = np.linalg.norm(image - block * values, axis=0)[:held]
        worst = float(residuals.max(initial=0.0))
        if worst <= 2 * EPS * top or (worst <= CERTIFIED * top and worst > best / 2) or width == dims:
            return Fit(n, sums, trace, values[:held], block[:, :held], residuals, passes)
        best = min(best, worst)
        bound = max(float(values[-1 - FRESH]), 1e-3 * float(values[held - 1]))  # of the unwanted part of the spectrum
        lifted = chebyshev(times, block, image, degrees(top, bound), bound, top)
        lifted[:, width - FRESH :] = rng.standard_normal((dims, FRESH))
        block = orthonormal(lifted)
    raise NotCertified(f"residual {worst / top:.1e} of the largest eigenvalue after {ROUNDS} rounds")


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Sum over the dimensions of (n x - S)^2 of each row, in whole numbers."""
    y = n * x - sums
    most = int(np.abs(y).max(initial=0))
    if most * most * max(1, x.shape[1]) < 2**63:
        return (y * y).sum(axis=1).tolist()
    return [sum(v * v for v in row) for row in y.tolist()]


def projected(found: Fit) -> Callable[[np.ndarray], np.ndarray]:
    """The whitened components of rows."""
    middle, turn = centred(found.n, found.sums), found.vectors / np.sqrt(found.values)
    return lambda x: middle(x) @ turn


def identity_error(rows: DataFrame, found: Fit) -> float:
    """How far the covariance of the whitened rows is from the identity, at its worst entry (one pass over all rows)."""
    many, white = len(found.values), projected(found)

    def part(x: np.ndarray) -> np.ndarray:
        z = white(x)
        return np.vstack([z.T @ z, z.sum(axis=0)])

    total = summed(rows, len(found.sums), (many + 1, many), part) / found.n
    return float(np.abs(total[:many] - np.outer(total[many], total[many]) - np.eye(many)).max(initial=0.0))


KINDS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(spark: SparkSession, vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each row of ``vectors`` that takes part and each of its first ``components`` whitened components."""
    rows, n, dims = same_length(stage(spark, whole_rows(vectors, id_col, vector_col), "whole_rows"))
    if not n or not dims:
        return spark.createDataFrame([], KINDS)
    rows = stage(spark, rows, "rows")
    sums = summed(rows, dims, (dims,), lambda x: x.sum(axis=0), "long")
    middle = centred(n, sums)
    trace = float(summed(rows, dims, (dims,), lambda x: np.square(middle(x)).sum(axis=0)).sum() / n)
    found = fit(rows, n, dims, components, trace, sums)
    if not len(found.values):
        return spark.createDataFrame([], KINDS)
    error, white = identity_error(rows, found), projected(found)
    many, explained = len(found.values), found.values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                (x,) = matrices([part], dims)
                apart, size = deviations(x, n, sums), part.num_rows
                if max(apart) >= 2**63:
                    raise OverflowError(f"the deviation of row {part.column(0)[int(np.argmax(apart))]} leaves 64 bits")
                columns = [
                    part.column(0).take(pa.array(np.repeat(np.arange(size), many))),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * many, n, np.int64)),
                    pa.array(np.repeat(np.array(apart, np.int64), many)),
                    pa.array(white(x).ravel()),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * many, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, KINDS)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark, table(spark, sf_dir, "embeddings"))
