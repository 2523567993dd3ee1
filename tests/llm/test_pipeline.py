"""The pipeline, stage by stage, against plain versions of each stage on its own input."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from minutelake.llm import language_id, mixing, quality_rules
from minutelake.llm.tokens import WordEncoder

from . import helpers
from .test_language_id import text

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng, rows, marks = random.Random(21), [], []
    for i in range(260):
        lang = ("en", "fr", "de")[i % 3]
        body = text(rng, lang, rng.randint(60, 160))
        if i % 5 == 0:
            body = " ".join(f"#{w}|" for w in body.split())
            marks.append((i, 0, 0))
        elif i % 2:
            marks.append((i, 1, 0))
        rows.append((i, body, lang, f"s{i % 7}"))
    for i in range(40):  # exact and near copies of clean documents
        base = rows[[1, 2, 4, 7][i % 4]]
        words = base[1].split()
        words[i] = "x" * (i % 3 + 1)
        rows.append((300 + i, base[1] if i % 3 == 0 else " ".join(words), base[2], "copies"))
    rows += [(400, None, "en", "s1"), (401, "", "en", None), (402, "too short", "en", "s1"), (403, "12 " * 80, None, None), (404, rows[3][1], None, None), rows[6], rows[6]]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows], marks


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("corpus"))
    rows, marks = corpus()
    spark.createDataFrame(rows, helpers.DOCS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if i < 4:
            assert out.columns == COLUMNS
        out.write.parquet(f"{sf}/{i}")
        seen.append((docs.collect(), spark.read.parquet(f"{sf}/{i}").collect()))
        docs = spark.read.parquet(f"{sf}/{i}")
    return sf, seen


def rows_of(rows):
    return Counter(tuple(r) for r in rows)


def test_quality_rules_decide(spark, stages):
    sf, seen = stages
    before, after = seen[0]
    rules = quality_rules.decision_list(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    counts = quality_rules.count_texts([None if r["text"] is None else r["text"].encode() for r in before])
    bad = (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
    for rule in rules:
        bad |= rule.holds(quality_rules.ratios(counts))
    assert rules and rows_of(after) == rows_of(r for r, b in zip(before, bad, strict=True) if not b)
    assert {r["doc_id"] for r in after} >= {i for i in range(260) if i % 5}


def test_language_id_by_a_plain_fusion(spark, stages):
    before, after = stages[1][1]
    model = language_id.fit(spark.createDataFrame([tuple(r) for r in before], helpers.DOCS))
    made = model.columns([(r["text"] or "").encode() for r in before])
    likely, share, some = np.array(made["__likely"]), np.array(made["__share"]), np.array(made["__trigrams"]) > 0
    n = len(model.languages)

    def sums(key):
        out = {}
        for r, s, x in zip(before, share, some, strict=True):
            if x and r[key]:
                out[r[key]] = out.get(r[key], 0) + s
        return out

    hosts, said = sums("source"), sums("lang")
    overall = (share[some].sum(axis=0) + 1) / (share[some].sum() + n)
    kept = []
    for r, a, s, x in zip(before, likely, share, some, strict=True):
        own = s * x
        logs = a.copy()
        if r["source"] in hosts:
            held = np.maximum(hosts[r["source"]] - own, 0)
            logs += np.log((held + language_id.LEAN * overall) / (max(hosts[r["source"]].sum() - x, 0) + language_id.LEAN))
        else:
            logs += np.log(overall)
        if r["lang"] in said:
            logs += np.log((np.maximum(said[r["lang"]] - own, 0) + 0.5) / (np.maximum(sum(said.values()) - own, 0) + 0.5 * len(said)))
        best = int(np.argmax(logs))
        kept.append(bool(x) and best < n - 1 and 1 / np.exp(logs - logs[best]).sum() >= language_id.CONFIDENT)
    assert rows_of(after) == rows_of(r for r, k in zip(before, kept, strict=True) if k)


def test_one_of_each_group_stays(stages):
    before, after = stages[1][2]
    groups = {}
    for row, (doc_id, _, component) in zip(before, helpers.component_rows([tuple(r) for r in before], 5, Fraction(4, 5)), strict=True):
        groups.setdefault(component, []).append(row)
    assert len(groups) < len(before) and len(after) == len(groups)
    assert {r["doc_id"] for r in after} == set(groups) and not rows_of(after) - rows_of(before)


def test_the_mix_comes_near_its_targets(stages):
    before, after = stages[1][3]
    sizes, words = Counter(), Counter()
    for r in before:
        sizes[r["source"]] += len(helpers.words_of(r["text"]))
    originals = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        words[r["source"]] += len(helpers.words_of(r["text"]))
        rest = iter(helpers.words_of(originals[r["doc_id"]]))
        assert all(w in rest for w in helpers.words_of(r["text"]))  # in their order
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    for name, target in zip(names, mixing.targets([sizes[x] for x in names]), strict=True):
        assert abs(words[name] - target) <= 2 * mixing.BLOCK_WORDS + 0.02 * target


def test_all_that_is_left_is_packed(stages):
    before, after = stages[1][4]
    encoder = WordEncoder(corpus_pipeline.packing.tokenizer_path())
    whole = Counter()
    for r in before:
        whole[r["doc_id"]] += len(encoder.tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
    packed = Counter()
    for r in after:
        packed[r["doc_id"]] += r["length"]
    assert packed == whole
    bins = Counter()
    for r in after:
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 4096 and len(bins) <= -(-sum(whole.values()) // 4096) + 1


def test_run_is_the_stages_in_a_row(spark, stages):
    sf, seen = stages
    got = corpus_pipeline.run(spark, sf).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert rows_of(got) == rows_of((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in seen[4][1])
    assert corpus_pipeline.ORACLE_SQL is None and [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "n-gram Jaccard join", "mixing sources", "best-fit packing"]
