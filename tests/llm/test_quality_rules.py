from collections import Counter

import numpy as np
import pandas as pd

from minutelake.llm import quality_rules as q

from . import helpers


def brute(text):
    text = text or ""
    w = helpers.words_of(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) for j in range(3) if windows[tuple(w[i : i + 3])] >= 2}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if helpers.words_of(line):
            dups += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


TEXTS = [None, "", " \n", "a b c a b c", "x\nx\n x\nx \n\n\nx", "a a a a", "a a a", "<é#> | $ %&*", "un\x1cdeux \x85 trois", "l1\r\nl1\r\nl1\n", "w " * 200, "é" * 70_000, " ".join(f"w{i}" for i in range(60))]


def test_counts_are_those_of_a_plain_reading():
    found = q.count_texts([None if x is None else x.encode() for x in TEXTS])
    assert [tuple(r) for r in found[q.BASE].to_numpy().tolist()] == [brute(x) for x in TEXTS]


def test_rules_are_grown_pruned_and_ordered():
    rng = np.random.default_rng(5)
    x = pd.DataFrame({k: rng.random(3000) for k in ("a", "b", "c")})
    bad = ((x["a"] > 0.8) & (x["b"] < 0.5) | (x["c"] > 0.95)).to_numpy()
    rules = q.learn(x, bad)
    rejected = np.zeros(len(x), bool)
    for r in rules:
        rejected |= r.holds(x)
    assert rules and len(rules[0].terms) >= 1
    assert (rejected & bad).sum() > 0.7 * bad.sum() and (rejected & ~bad).sum() < 0.03 * rejected.sum()
    assert q.learn(x, np.zeros(len(x), bool)) == [] and q.learn(x.iloc[:0], bad[:0]) == []
    noise = q.learn(x, rng.random(len(x)) < 0.3)
    assert all(r.holds(x).mean() < 0.05 for r in noise)


def test_few_bad_rows_teach_a_rule():
    """11 bad rows of 200 are enough, as is a kind of 0.1% of the labels; good rows stay."""
    rng = np.random.default_rng(6)
    for size, kind in ((200, 11), (10_000, 10)):
        x = pd.DataFrame({k: rng.random(size) for k in ("a", "b")})
        bad = np.zeros(size, bool)
        bad[rng.permutation(size)[:kind]] = True
        x.loc[bad, "a"] += 2
        rules = q.learn(x, bad)
        rejected = np.any([r.holds(x) for r in rules], axis=0)
        assert rules and rejected[bad].mean() > 0.8 and not rejected[~bad].any()
    assert q.learn(x, np.arange(len(x)) < 4) == []


def labelled(spark, tmp_path):
    rows, marks = [], []
    for i in range(600):
        junk = i % 3 == 0
        text = " ".join((f"#w{j}|" if junk else f"word{(i * 31 + j * 7) % 997}") for j in range(60 + i % 40))
        rows.append((i, text, "en", "s", len(text)))
        marks += [(i, 0 if junk else 1, 0)] if i % 2 == 0 else []
    rows += [(1000 + i, t, None, None, None) for i, t in enumerate(TEXTS)] + [(None, rows[1][1], None, None, None), rows[5], rows[5]]
    marks += [(None, 0, 0), (3, None, 0), (4, 0, 1), (77_777, 0, 0), (1000, 0, 0), (0, 0, 0)]
    spark.createDataFrame([(*r, 4) for r in rows], helpers.DOCS + ", kept int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return rows


def test_the_query_holds_every_document(spark, tmp_path):
    rows = labelled(spark, tmp_path)
    found = q.op10_quality_rules(spark, str(tmp_path))
    assert found.columns[:8] == ["doc_id", *q.BASE, "base_failed", "kept"]
    out = found.collect()
    assert helpers.ordered((r["doc_id"], *[r[c] for c in q.BASE]) for r in out) == helpers.ordered((r[0], *brute(r[1])) for r in rows)
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"]) and r["kept"] == (not r["base_failed"] and r["rule"] is None)
    good = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 600 and r["doc_id"] % 3]
    junk = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 600 and r["doc_id"] % 3 == 0]
    assert np.mean([r["kept"] for r in good]) == 1 and np.mean([r["kept"] for r in junk]) == 0


def test_kept_documents_come_back_unchanged(spark, tmp_path):
    labelled(spark, tmp_path)
    docs, labels = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")
    left = q.keep_good(docs, labels)
    assert left.schema == docs.schema and left.count() == q.op10_quality_rules(spark, str(tmp_path)).where("kept").count()
    assert left.exceptAll(docs).count() == 0
    assert q.keep_good(docs.limit(0), labels).count() == 0
    assert q.decision_list(docs, labels.limit(0)) == []
