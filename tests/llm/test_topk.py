import numpy as np
import pytest

from minutelake.llm import topk


def brute(rows, k):
    """rows: (rid, vec_id, whole numbers)."""
    out = []
    for rid, query, a in rows:
        if query % 50 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), vec) for other, vec, b in rows if other != rid]
            out += [(query, n, vec, -s) for n, (s, vec) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("rows", "dims", "scale"), [(1, 3, 5), (70, 1, 3), (200, 8, 2), (500, 16, 300), (130, 4, 10**6), (64, 5, 0)])
def test_best_rows_are_among_those_let_in(rows, dims, scale):
    rng = np.random.default_rng(rows)
    vectors = rng.integers(-scale, scale + 1, (rows, dims))
    block = topk.Block(vectors)
    for i in range(min(rows, 25)):
        for k in (1, 6, rows + 3):
            near, scores = set(block.best(vectors[i], k).tolist()), vectors @ vectors[i]
            least = np.sort(scores)[::-1][:k].min()
            assert {j for j in range(rows) if scores[j] >= least} <= near


def test_sums_of_slices_are_whole_sums():
    rng = np.random.default_rng(1)
    vectors, weights = rng.integers(-15, 16, (100, 6)), np.array([3, -7, 0, 1, -1, 12])
    block = topk.Block(vectors)
    assert block.shift == 0
    sums = sum(np.unpackbits(x.view(np.uint8), bitorder="little")[:100].astype(np.int64) << i for i, x in enumerate(block.sums(weights)))
    top = (1 << topk.SLICES) - 1
    wanted = sum(abs(w) * ((vectors[:, d] - block.low[d]) if w > 0 else top - (vectors[:, d] - block.low[d])) for d, w in enumerate(weights))
    assert (sums == wanted).all()


def test_the_query_against_all_pairs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 3)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 6)]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(8)] + [(0, rows[0][1]), (1000, [0.5]), (1001, []), (1050, [1.0, -1.0] * 4)]
    bad = [(None, rows[1][1]), (2000, None), (2050, [0.1, None, 0.2]), (2100, [float("nan")] * 6), (2150, [float("inf")] * 6)]
    spark.createDataFrame([(*r, 3) for r in rows + bad], "vec_id long, embedding array<float>, rid int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = topk.op9_exact_topk(spark, str(tmp_path))
    whole = [(n, i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int).tolist()) for n, (i, v) in enumerate(rows)]
    assert sorted(tuple(r) for r in found.collect()) == brute(whole, 5)


def test_few_rows_and_none(spark, tmp_path):
    kinds = "vec_id long, embedding array<float>"
    spark.createDataFrame([(50, [0.5]), (51, [0.25])], kinds).write.parquet(f"{tmp_path}/two/embeddings.parquet")
    assert [tuple(r) for r in topk.op9_exact_topk(spark, f"{tmp_path}/two").collect()] == [(50, 1, 51, 128 * 64)]
    spark.createDataFrame([], kinds).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert topk.op9_exact_topk(spark, f"{tmp_path}/none").count() == 0


def search(spark, folder, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{folder}/embeddings.parquet")
    return [tuple(r) for r in topk.op9_exact_topk(spark, str(folder)).collect()]


def test_large_components_take_part(spark, tmp_path):
    """Every score that fits 64 bits is exact, whatever the components."""
    rows = [(0, [3e6, 1.0]), (1, [1.0, 2.0]), (50, [1.0, 1.0]), (7, [1.5e6, 5.0]), (8, [-3e7, 0.25]), (9, [1e30, -1e30])]
    whole = [(n, i, [int(256 * x) for x in v]) for n, (i, v) in enumerate(rows[:5])]
    assert sorted(search(spark, tmp_path / "a", rows[:5])) == brute(whole, 5)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 10.0 ** rng.integers(0, 7), 4)]) for i in range(120)]
    whole = [(n, i, [int(np.floor(256 * x)) for x in v]) for n, (i, v) in enumerate(rows)]
    assert sorted(search(spark, tmp_path / "b", rows)) == brute(whole, 5)
    # scores beyond 64 bits that no answer needs do no harm
    many = [(i, [1.0, float(i)]) for i in range(1, 9)]
    rows = [*many, (50, [2.0, 1.0]), (60, [-1e30, 0.0])]
    whole = [(n, i, [256 * int(x) for x in v]) for n, (i, v) in enumerate(rows)]
    assert sorted(search(spark, tmp_path / "c", rows)) == brute(whole, 5)


@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_a_score_beyond_64_bits_is_an_error(spark, tmp_path, sign):
    with pytest.raises(Exception, match="rows 50 and 60 leaves 64 bits"):
        search(spark, tmp_path, [(50, [2.0, 1.0]), (60, [sign * 1e30, 0.0])])
