import random
from fractions import Fraction

import numpy as np
import pytest

from minutelake.llm import ngram_jaccard as nj

from . import helpers

THETA = Fraction(17, 20)


@pytest.mark.parametrize("theta", [THETA, Fraction(4, 5), Fraction(9, 10)])
def test_linked_sets_always_share_a_signature(theta):
    rng = np.random.default_rng(4)
    for below in (2, 7, 14, 18):
        signs = nj.Signatures(theta, below)
        for _ in range(250):
            n = int(rng.choice([2, 5, 9, 12, 13, 14, 15, 17, 18, 20, 30, 70, 200, 900]))
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            drop = rng.random(len(a)) < rng.uniform(0, 0.16)
            more = rng.integers(0, 2**64, int(rng.integers(0, max(2, n // 6))), dtype=np.uint64)
            b = np.unique(np.concatenate([a[~drop], more]))
            if not len(b) or len(b) == len(a) and (a == b).all():
                continue
            common = len(np.intersect1d(a, b))
            if common >= theta * (len(a) + len(b) - common):
                (one, need), (other, needed) = signs.of(a), signs.of(b)
                shared = len(set(one.tolist()) & set(other.tolist()))
                assert shared >= max(1, need, needed), (below, len(a), len(b), shared, need, needed)


def test_linked_sets_share_enough_of_one_kind():
    """Also sets whose hashes lie close together, so that most cells are empty, or all lists of a band are."""
    rng, kinds = np.random.default_rng(5), set()
    for below in (2, 14):
        signs = nj.Signatures(THETA, below)
        for _ in range(500):
            n, narrow = int(rng.choice([3, 9, 13, 14, 20, 40, 200, 900])), np.uint64(rng.choice([0, 0, 3, 9]))
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64) >> narrow)
            more = rng.integers(0, 2**64, int(rng.integers(0, max(2, n // 8))), dtype=np.uint64) >> narrow
            b = np.unique(np.concatenate([a[rng.random(n) >= rng.uniform(0, 0.12)], more]))
            common = len(np.intersect1d(a, b))
            if not len(b) or common < THETA * (len(a) + len(b) - common):
                continue
            small, large = sorted((len(a), len(b)))
            kind = 0 if large < below else next(i for i, (low, _, _, _) in reversed(list(enumerate(nj.bands(THETA, below, small), 1))) if low <= small)
            (one, need), (other, needed) = ({int(x[0]) & 63: (set(x.tolist()), need) for x, need in signs.by_kind(s)}[kind] for s in (a, b))
            assert all(x & 63 == kind for x in one | other) and len(one & other) >= max(1, need, needed), (below, len(a), len(b), narrow)
            kinds.add((kind, need > 1))
    assert len(kinds) > 10


def test_unrelated_sets_share_no_list():
    """Nearly all of them have an empty cell in common; that is no list, else it would hold a share of the whole table."""
    rng, seen = np.random.default_rng(7), {}
    signs = nj.Signatures(Fraction(4, 5), 14)
    for i in range(600):
        for x in signs.of(np.unique(rng.integers(0, 2**64, int(rng.integers(32, 1200)), dtype=np.uint64)))[0].tolist():
            seen.setdefault(x, set()).add(i)
    assert max(map(len, seen.values())) == 1


@pytest.fixture
def staged(monkeypatch):
    """Rows of the tables that the join stages, by name."""
    rows, stage = {}, nj.stage

    def counted(spark, df, name):
        out = stage(spark, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(nj, "stage", counted)
    return rows


def test_unrelated_documents_never_meet(spark, staged):
    """Else pairs to check grow with the square of the table."""
    rng = random.Random(9)
    texts = [helpers.sentence(rng, rng.randint(60, 250), 10**6) for _ in range(150)]
    texts += [helpers.edited(rng, texts[i], 0.01) for i in range(3)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], helpers.DOCS)
    nj.ngram_jaccard_join(spark, docs, 5, Fraction(4, 5))
    assert 1 <= staged["star"] <= 3


def test_a_band_is_left_by_its_own_count(spark, staged):
    """Two fifths in common: more lists in both bands together than one of them asks for, but less than each asks for."""
    signed = nj.Signatures(Fraction(4, 5), 2).by_kind(np.sort(np.random.default_rng(1).integers(0, 2**64, 400, dtype=np.uint64)))
    assert len(signed) == 2 and 3 * min(need for _, need in signed) < max(need for _, need in signed)
    passage = " ".join(f"p{i}" for i in range(164))
    rows = [(i, f"{passage} " + " ".join(f"d{i}x{j}" for j in range(240)), "en", "s", 1) for i in range(12)]
    found = nj.ngram_jaccard_join(spark, spark.createDataFrame(rows, helpers.DOCS), 5, Fraction(4, 5))
    assert sorted(tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()) == [(i, 400, i) for i in range(12)]
    assert staged["met"] == 0 and staged["star"] == 0


def test_sketches_never_rule_out_linked_sets():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (1, 2, 9, 31, 33, 40, 400, 3000)]
    for a in list(sets):
        for share in (0.02, 0.1, 0.15, 0.3):
            more = rng.integers(0, 2**64, int(len(a) * share / 2) + 1, dtype=np.uint64)
            sets.append(np.unique(np.concatenate([a[rng.random(len(a)) > share / 2], more])))
    held = nj.Sketches(np.array([len(x) for x in sets]), [nj.sketch(x) for x in sets], THETA)
    ruled_out = 0
    for a in sets:
        near = set(held.near(len(a), nj.sketch(a)).tolist())
        for i, b in enumerate(sets):
            common = len(np.intersect1d(a, b))
            if common >= THETA * (len(a) + len(b) - common):
                assert i in near
        ruled_out += len(sets) - len(near)
    assert ruled_out > len(sets) ** 2 / 2


def test_overlap_is_the_least_intersection_of_linked_sets():
    for s in range(1, 60):
        for t in range(1, 60):
            least = min((o for o in range(min(s, t) + 1) if o >= THETA * (s + t - o)), default=None)
            assert (t in nj.partners(s, THETA)) == (least is not None)
            assert least is None or nj.overlap(s, t, THETA) == least


def test_the_boundary_follows_the_cost():
    assert nj.boundary({}, THETA) == 2
    spread = {s: 100 for s in range(1, 60)}
    assert 8 <= nj.boundary(spread, THETA) < 20 and nj.boundary({20: 10**6}, THETA) <= 20


@pytest.mark.parametrize(("words", "theta", "seed"), [(4, THETA, 1), (5, Fraction(4, 5), 2)])
def test_components_are_those_of_all_pairs(spark, words, theta, seed):
    rows = helpers.documents(seed)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], helpers.DOCS + ", node long, component_id long")
    found = nj.ngram_jaccard_join(spark, docs, words, theta)
    assert helpers.got(found, "doc_id", "n_shingles", "component_id") == helpers.ordered(helpers.component_rows(rows, words, theta))


def test_a_large_family_is_compared_in_blocks(spark, monkeypatch):
    """Copies around a base that isn't there: most pairs are no links, so members meet in blocks of other members."""
    monkeypatch.setattr(nj, "BLOCK", 8)
    monkeypatch.setattr(nj, "SKETCH_BLOCK", 20)
    monkeypatch.setattr(nj, "BROADCAST_IDS", 10)
    rng = random.Random(8)
    base = helpers.sentence(rng, 90, 10**6)
    rows = [(i, helpers.edited(rng, base, 0.025), "en", "s", 1) for i in range(70)]
    docs = spark.createDataFrame(rows, helpers.DOCS)
    wanted = helpers.component_rows(rows, 4, THETA)
    assert 1 < len({c for _, _, c in wanted}) < 70
    assert helpers.got(nj.ngram_jaccard_join(spark, docs, 4, THETA), "doc_id", "n_shingles", "component_id") == helpers.ordered(wanted)


def test_no_documents_and_no_words(spark):
    assert nj.ngram_jaccard_join(spark, spark.createDataFrame([], helpers.DOCS)).count() == 0
    rows = [(1, None, None, None, None), (2, "", None, None, None), (2, "", None, None, None)]
    assert helpers.got(nj.ngram_jaccard_join(spark, spark.createDataFrame(rows, helpers.DOCS)), "doc_id", "n_shingles", "component_id") == [(1, 0, 1), (2, 0, 2), (2, 0, 2)]


def test_one_of_each_group_stays(spark):
    rows = [r for r in helpers.documents(5)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], helpers.DOCS + ", tkey string")
    left = nj.one_of_each_group(spark, docs)
    assert left.columns == docs.columns
    kept = [tuple(r)[:5] for r in left.collect()]
    assert all(r in rows for r in kept)
    groups = helpers.component_rows(rows, 5, Fraction(4, 5))
    filled = {c for (_, n, c) in groups if n}
    with_words = [r for r in kept if helpers.words_of(r[1])]
    assert len([r for r in with_words if r[0] is not None]) == len(filled - {None}) and {r[0] for r in with_words} == filled
    assert len([r for r in kept if not helpers.words_of(r[1])]) == len([r for r in rows if not helpers.words_of(r[1])])


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 299), (299, 298), (300, 300)]
    rng.shuffle(edges)
    found = dict(tuple(r) for r in nj.components(spark, spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {300: 298, 299: 298}
    assert nj.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0
