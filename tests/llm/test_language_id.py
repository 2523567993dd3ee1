import random

import numpy as np
from pyspark.sql import functions as F

from minutelake.llm import language_id as li

from . import helpers

PARTS = {"en": ["th", "ing", "er", "and", "ou"], "fr": ["eau", "é", "que", "oi", "ment"], "de": ["sch", "ung", "ei", "ü", "ver"]}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def rows(n=360, seed=3):
    rng = random.Random(seed)
    langs = list(PARTS)
    return [(i, text(rng, langs[i % 3], rng.randint(4, 80)), langs[i % 3], f"{langs[i % 3]}{i % 4}.example.{langs[i % 3]}", i) for i in range(n)]


def test_held_out_accuracy(spark):
    train, test = rows(), rows(300, 4)
    model = li.fit(spark.createDataFrame(train, helpers.DOCS))
    assert model.languages == ["de", "en", "fr", "und"]
    docs = spark.createDataFrame([(*r, 1.0) for r in test], helpers.DOCS + ", __likely double")
    found = li.language_id(spark, docs.drop("__likely"), model, "text", F.lit(None).cast("string"), F.lit(None).cast("string")).collect()
    assert len(found) == 300 and np.mean([r["language"] == r["lang"] for r in found]) > 0.98


def test_rare_languages_stay(spark):
    """A language of 5 documents and one of 15 among thousands; copies take no place in the sample, and it has a bound for each label."""
    rng = random.Random(5)
    many = [(i, text(rng, "en", rng.randint(20, 60)), "en", None, i) for i in range(3000)]
    few = [(5000 + i, text(rng, "fr", 40), "fr", None, i) for i in range(15)] + [(6000 + i, text(rng, "de", 40), "de", None, i) for i in range(5)]
    blank = [(7000, "-- !", "signs", None, 1)]
    docs = spark.createDataFrame(many + few + [many[0]] * 500 + blank, helpers.DOCS)
    for sample_rows in (20_000, 200):
        model = li.fit(docs, sample_rows=sample_rows)
        assert model.languages == ["de", "en", "fr", "und"]
        found = li.language_id(spark, docs, model, "text", F.col("lang"), F.col("source")).where("kept").groupBy("lang", "language").count().collect()
        assert {tuple(r) for r in found} == {("en", "en", 3500), ("fr", "fr", 15), ("de", "de", 5)}


def test_the_quota_leaves_small_groups_whole():
    assert li.quota([5, 15, 9000, 70_000], 20_000) == 10_980
    assert li.quota([5, 15, 30_000, 70_000], 20_000) == 9990
    assert li.quota([5, 15, 100], 20_000) == 100 and li.quota([], 20_000) == li.LABEL_ROWS
    assert li.quota([1000] * 5000, 20_000) == li.LABEL_ROWS


def test_the_trigrams_are_those_of_each_text_alone():
    texts = [b"abc", None, b"", "é à".encode(), b"ab 12", b"ABC"]
    alone = [li.trigrams([x]) for x in texts]
    code, start = li.trigrams(texts)
    for part, (own, _) in zip(np.split(code, start[1:]), alone, strict=True):
        assert part.tolist() == own.tolist()
    assert alone[0][0].tolist() == alone[5][0].tolist() and (alone[2][0] == li.BUCKETS).all()


def test_evidence_settles_what_the_text_leaves_open(spark):
    """A text without a language of its own follows the declaration, the host, then the suffix."""
    model = li.fit(spark.createDataFrame(rows(), helpers.DOCS))
    odd = [(10_000, "xx", "fr", None, 1), (10_001, "xx", None, "de2.example.de", 1), (10_002, "xx", None, "new.example.en", 1), (10_003, "xx", "", "", 1)]
    docs = spark.createDataFrame(rows() + odd, helpers.DOCS)
    found = {r["doc_id"]: r for r in li.language_id(spark, docs, model, "text", F.col("lang"), F.col("source")).collect()}
    assert [found[10_000 + i]["language"] for i in range(3)] == ["fr", "de", "en"]
    assert found[10_003]["confidence"] < found[10_001]["confidence"]
    assert all(0 < r["confidence"] <= 1.0000001 for r in found.values())


def test_edge_cases(spark):
    docs = spark.createDataFrame([(*r, True, "x") for r in helpers.documents(3)], helpers.DOCS + ", kept boolean, language string")
    model = li.fit(spark.createDataFrame(rows(), helpers.DOCS))
    found = li.language_id(spark, docs.drop("kept", "language"), model, "text", F.col("lang"), F.col("source"))
    assert found.count() == docs.count()
    assert all(not r["kept"] for r in found.where("text IS NULL OR trim(text) = ''").collect())
    left = li.keep_identified(spark, docs, spark.createDataFrame(rows(), helpers.DOCS))
    assert left.schema == docs.schema and left.exceptAll(docs).count() == 0
    none = docs.limit(0)
    assert li.keep_identified(spark, none, none).count() == 0 and li.fit(none).languages == ["und"]
    assert li.keep_identified(spark, docs, none).count() == 0


def test_clean_documents_are_kept(spark):
    docs = spark.createDataFrame(rows(), helpers.DOCS)
    assert li.keep_identified(spark, docs, docs).count() == docs.count()


def test_pages_by_markup_and_address(spark, tmp_path):
    train = rows()
    spark.createDataFrame(train, helpers.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    pages = [(i, f"http://A{lang}.example.{lang}:80/x?y", f"<html lang='{lang}'><script>the ing and</script><p>{t}</p></html>") for i, t, lang, *_ in train[:90]]
    pages += [(900, None, None), (901, "nonsense", ""), (902, "http://x/", "<p>12 34</p>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r["page_id"]: r for r in li.pages_language_id(spark, str(tmp_path)).collect()}
    assert len(found) == 93 and all(found[i]["language"] == train[i][2] for i in range(90))
    assert not found[900]["kept"] and found[900]["host"] == "" and found[0]["host"] == f"a{train[0][2]}.example.{train[0][2]}"
