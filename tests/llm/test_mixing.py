import numpy as np
import pytest

from minutelake.llm import mixing

from . import helpers


def test_targets_share_by_weight_below_three_times_the_size():
    assert mixing.targets([80, 80, 80]) == pytest.approx([150, 60, 30])
    sizes = [10, 1000, 1000, 5, 0, 300]
    found = mixing.targets(sizes)
    assert sum(found) == pytest.approx(sum(sizes)) and found[0] == 30 and found[3] == 15 and found[4] == 0
    free = [i for i in (1, 2, 5)]
    units = {round(found[i] / mixing.WEIGHTS[i % 3], 6) for i in free}
    assert len(units) == 1 and all(found[i] <= 3 * sizes[i] for i in range(6))
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]


def test_draws_add_up_and_follow_the_shares():
    quotas = np.array([50_000, 0, 30_000, 7, 1000], np.int64)
    shards, slots = -(-int(quotas.sum()) // 500), 500
    total, last, first = np.zeros_like(quotas), np.zeros_like(quotas), []
    for s in range(shards):
        before, counts = mixing.shard_counts(3, quotas, shards, slots, s, {})
        assert (before == total).all() and counts.sum() == min(slots, quotas.sum() - s * slots)
        total, last = total + counts, counts
        first.append(counts[0])
    assert (total == quotas).all() and last.sum()
    assert 3 < np.std(first[:-1]) < 30


def test_draws_of_large_numbers():
    counts = np.array([4 * 10**12, 10**12, 3, 0], np.int64)
    got = mixing.draw((1,), counts, 2 * 10**12)
    assert got.sum() == 2 * 10**12 and (got <= counts).all() and abs(got[0] / got[1] - 4) < 0.01


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutations_are_bijections_that_differ(n):
    for seed in (1, 2**63):
        found = mixing.permuted(np.arange(n), n, np.full(n, seed, np.uint64))
        assert sorted(found.tolist()) == list(range(n))
    if n > 50:
        assert (mixing.permuted(np.arange(n), n, np.full(n, 1, np.uint64)) != mixing.permuted(np.arange(n), n, np.full(n, 2, np.uint64))).mean() > 0.9


def brute(rows):
    """(source, size, target) of each source."""
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(helpers.words_of(text))
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    return {x: (sizes[x], t) for x, t in zip(names, mixing.targets([sizes[x] for x in names]), strict=True)}


def test_taken_words_come_near_the_targets(spark, tmp_path):
    rows = helpers.documents(11, families=30)
    docs = spark.createDataFrame([(*r, 1) for r in rows], helpers.DOCS + ", uses long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = mixing.op7_mixing(spark, str(tmp_path)).collect()
    again = mixing.op7_mixing(spark, str(tmp_path)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"], r["source"] or "")
    assert sorted(map(key, found)) == sorted(map(key, again)) and len(found) == len(rows)
    wanted, taken = brute(rows), {}
    for r in found:
        assert (r["source_size"], round(r["target"], 6)) == (wanted[r["source"]][0], round(wanted[r["source"]][1], 6))
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for source, (size, target) in wanted.items():
        assert abs(taken[source] - target) <= 2 * mixing.BLOCK_WORDS + 0.02 * target
        assert target < 3 * size or taken[source] == 3 * size


def test_mixed_documents_hold_the_words_taken(spark):
    rows = helpers.documents(12)
    docs = spark.createDataFrame([(*r, "k") for r in rows], helpers.DOCS + ", __low string")
    mixed = mixing.mixed_documents(spark, docs)
    assert mixed.columns == docs.columns
    out = mixed.collect()
    words = {}
    for r in out:
        assert len(r["text"]) == r["n_chars"] and helpers.words_of(r["text"])
        words[r["source"]] = words.get(r["source"], 0) + len(helpers.words_of(r["text"]))
    for source, (_, target) in brute(rows).items():
        assert abs(words.get(source, 0) - target) <= 2 * mixing.BLOCK_WORDS + 0.02 * target
    assert mixing.mixed_documents(spark, docs.limit(0)).count() == 0


def test_cut_words_keeps_what_is_between():
    text = b" a  b\tc d e\nf "
    parts = [{"low": 2, "high": 4, "uses": 2}, {"low": 0, "high": 2, "uses": 1}, {"low": 5, "high": 6, "uses": 2}]
    assert mixing.cut_words(text, parts) == ["a  b\tc d f", "c d f"]
