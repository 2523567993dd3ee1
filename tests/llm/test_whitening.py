import numpy as np
import pytest

from minutelake.llm import whitening
from minutelake.llm.registry import QUERIES


def whole(v):
    return np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) + 1_000_000


def held_against_numpy(found, rows, components=32):
    """rows: (vec_id, whole numbers of equal length)."""
    x = np.array([r[1] for r in rows])
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    held = int((values[:components] > 1e-10 * values[0]).sum())
    assert len(found) == n * held
    of = {}
    for r in found:
        of.setdefault(r["component"], []).append(r)
    assert sorted(of) == list(range(1, held + 1))
    for k, part in of.items():
        e = values[k - 1]
        assert {r["n"] for r in part} == {n}
        np.testing.assert_allclose([r["explained"] for r in part], e / values.sum(), rtol=1e-9)
        z = y @ vectors[:, k - 1] / np.sqrt(e)
        wanted = sorted((str(i), sum(int(n * a - s) ** 2 for a, s in zip(v, sums.tolist()))) for i, v in zip([r[0] for r in rows], x.tolist()))
        assert sorted((str(r["vec_id"]), r["deviation"]) for r in part) == wanted
        apart = min(abs(e - v) for j, v in enumerate(values) if j != k - 1) / values[0] if len(values) > 1 else 1
        if apart > 1e-4 and len({r[0] for r in rows}) == n:  # an eigenvector of its own
            mine = np.array([{r["vec_id"]: r["whitened"] for r in part}[i] for i, _ in rows])
            sign = np.sign(mine @ z)
            np.testing.assert_allclose(mine * sign, z, atol=1e-8)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], whole(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    held_against_numpy(QUERIES["op12_embedding_whitening"](spark, sf).collect(), rows)


@pytest.mark.parametrize(("n", "dims", "spread"), [(300, 70, 3.0), (200, 100, 0.2), (40, 90, 1.0), (500, 3, 1.0)])
def test_shapes(spark, n, dims, spread):
    rng = np.random.default_rng(n)
    v = rng.normal(0, 1, (n, dims)) * np.exp(-spread * np.arange(dims) / dims) + 5
    v[: n // 3] = v[0]  # a vector held by a third of all rows
    v = v.astype(np.float32)
    df = spark.createDataFrame([(i, [float(c) for c in r], "x") for i, r in enumerate(v)], "vec_id long, embedding array<float>, component string").repartition(5)
    held_against_numpy(whitening.whitened(spark, df).collect(), [(i, whole(r)) for i, r in enumerate(v)])


def test_directions_need_filtering():
    """The filter damps what is below its bound and lifts the rest."""
    values = np.array([100.0, 20.0, 11.0, 9.0, 4.0, 0.0])
    v = np.diag(values)
    start = np.eye(6)
    out = np.diag(whitening.chebyshev(lambda q: v @ q, start, v @ start, 8, 10.0, 100.0))
    out = np.abs(out) / np.abs(out[3:]).max()
    assert (out[:3] > 10).all() and (np.diff(out[:3]) < 0).all()


def test_edge_cases(spark):
    kinds = "vec_id long, embedding array<double>"
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [2.0, -1.0]), (4, [3.0]), (5, [-0.001, 7.0]), (6, None), (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [1.0, float("inf")])]
    found = whitening.whitened(spark, spark.createDataFrame(rows, kinds)).collect()
    held_against_numpy(found, [(1, whole([0.5, 1])), (1, whole([0.5, 1])), (None, whole([2, -1])), (4, whole([3, 0])), (5, whole([-0.001, 7]))])
    assert whitening.whitened(spark, spark.createDataFrame([], kinds)).count() == 0
    assert whitening.whitened(spark, spark.createDataFrame([(1, [1.0])] * 3, kinds)).count() == 0
    assert whitening.whitened(spark, spark.createDataFrame([(1, []), (2, [])], kinds)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        whitening.whitened(spark, spark.createDataFrame([(1, [1e300]), (2, [1.0])], kinds)).count()
    with pytest.raises(Exception, match="64 bits"):
        whitening.whitened(spark, spark.createDataFrame([(1, [1e12]), (2, [1.0])], kinds)).count()
