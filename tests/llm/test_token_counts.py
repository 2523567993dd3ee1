import random

import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from minutelake.llm import token_counts as tc

from . import helpers

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
FIND = regex.compile(PATTERN)
TEXT = st.text(alphabet=" \n\t'resl a1.é漢", max_size=80)


@pytest.fixture(scope="module")
def count():
    return tc.piece_counter(PATH, PATTERN)


def plain(text, count):
    return sum(count(m.group()) for m in FIND.finditer(text))


@settings(max_examples=400, deadline=None)
@given(text=TEXT, edits=st.lists(st.tuples(st.integers(-2, 90), st.integers(-1, 30), TEXT), max_size=5))
def test_edits_count_as_the_edited_text_does(count, text, edits):
    tree = tc.TokenTree(text, FIND.finditer, count)
    for place, removed, inserted in edits:
        again = tc.TokenTree(tree.text(), FIND.finditer, count, tree.kept())
        tree.edit(place, removed, inserted)
        again.edit(place, removed, inserted)
        place = max(0, min(place, len(text)))
        text = text[:place] + inserted + text[place + max(0, removed) :]
        for t in (tree, again):
            assert t.text() == text and t.n_chars == len(text) and t.n_tokens == plain(text, count)


def test_long_texts_over_many_blocks(count):
    rng = random.Random(6)
    text = "".join(rng.choice(["word ", "it's", "  ", "\n", "12", "!?"]) for _ in range(6000)) + " " * 700 + "x" * 900
    tree = tc.TokenTree(text, FIND.finditer, count)
    for _ in range(150):
        place, removed = rng.randint(0, len(text)), rng.choice([0, 1, 7, 400])
        inserted = rng.choice(["", " ", "ab", "new words " * 80, "\n" * 5])
        before = tree.recounted
        tree.edit(place, removed, inserted)
        text = text[:place] + inserted + text[place + removed :]
        assert tree.recounted - before < len(inserted) + 2500
    assert tree.text() == text and tree.n_tokens == plain(text, count)


def test_all_documents_with_edits(spark, count):
    rows = helpers.documents(2)
    edits = [[(0, 3, "new [text] ")], None, [], [(5, 0, None), (1_000_000, 5, "end"), None, (2, 10**6, "")]]
    kinds = helpers.DOCS + ", edits array<struct<place:long,removed:long,inserted:string>>, n_chars_before struct<a:long>"
    docs = spark.createDataFrame([(*r, edits[i % 4], (i,)) for i, r in enumerate(rows)], kinds)
    found = tc.token_counts(docs, PATH, PATTERN)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "n_chars_before", *tc.MADE]
    for r in found.collect():
        i = r["n_chars_before"]["a"]
        text = rows[i][1] or ""
        assert r["doc_id"] == rows[i][0] and r["n_tokens"] == plain(text, count)
        for e in edits[i % 4] or []:
            if e:
                place = min(e[0], len(text))
                text = text[:place] + (e[2] or "") + text[place + e[1] :]
        assert (r["n_tokens_after"], r["n_chars_after"]) == (plain(text, count), len(text))
    assert tc.token_counts(docs.limit(0), PATH, PATTERN).count() == 0


def test_derived_edits_are_inside(spark):
    docs = spark.createDataFrame(helpers.documents(4), helpers.DOCS).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for r in docs.withColumn("edits", tc.derived_edits(F.col("text"), F.col("doc_id"))).collect():
        assert len(r["edits"]) == 4
        for e in r["edits"]:
            assert 0 <= e["place"] <= len(r["text"]) and e["inserted"] in r["text"] and len(e["inserted"]) < 60


def test_a_large_insertion_splits_blocks_and_counts_little(count):
    """The sums of untouched blocks stay when an edit outgrows its block."""
    text, counted = "word " * 100_000, []

    def counting(piece):
        counted.append(piece)
        return count(piece)

    tree = tc.TokenTree(text, FIND.finditer, counting)
    counted.clear()
    tree.edit(250_003, 4, "some new words " * 200)
    text = text[:250_003] + "some new words " * 200 + text[250_007:]
    assert len(counted) < 1500 and tree.text() == text and tree.n_tokens == plain(text, count)
    tree.edit(10, 3, "x")
    assert tree.text() == text[:10] + "x" + text[13:] and tree.n_tokens == plain(tree.text(), count)


def test_kept_trees_take_edits_without_a_new_encoding(count):
    """A tree read again counts and edits as the one that was kept; only touched pre-tokens are encoded."""
    text, counted = "some words, it's " * 5000, []

    def counting(piece):
        counted.append(piece)
        return count(piece)

    kept = tc.TokenTree(text, FIND.finditer, count).kept()
    tree = tc.TokenTree(text, FIND.finditer, counting, kept)
    assert not counted and tree.n_tokens == plain(text, count) and tree.text() == text
    for place in (0, 40_001, len(text) - 3):
        tree.edit(place, 2, "new 12")
        text = text[:place] + "new 12" + text[place + 2 :]
    assert len(counted) < 40 and tree.text() == text and tree.n_tokens == plain(text, count)
    assert sum(isinstance(b, int) for b in tree.blocks) >= len(tree.blocks) - 8  # all others stay unopened
    tree.edit(9, 1, "many new words " * 200)
    text = text[:9] + "many new words " * 200 + text[10:]
    tree.edit(len(text) // 2, 5, "")
    text = text[: len(text) // 2] + text[len(text) // 2 + 5 :]
    assert tree.text() == text and tree.n_tokens == plain(text, count)
    counted.clear()
    again = tc.TokenTree(text, FIND.finditer, counting, tree.kept())
    assert (again.n_tokens, again.n_chars, len(counted) < 40) == (tree.n_tokens, len(text), True)


def test_rounds_of_edits_over_a_kept_table(spark, count, tmp_path):
    """Two rounds, the trees written between them, against texts edited plainly; nulls, empty texts and clashing columns too."""
    rows = helpers.documents(3)
    docs = spark.createDataFrame([(*r, i, "own") for i, r in enumerate(rows)], helpers.DOCS + ", n_tokens_before int, token_tree string")
    trees, texts = tc.token_trees(docs, PATH, PATTERN), [r[1] or "" for r in rows]
    assert trees.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens_before", "n_tokens", "token_tree"]
    for turn in range(2):
        trees.write.parquet(str(tmp_path / f"trees{turn}"))
        trees = spark.read.parquet(str(tmp_path / f"trees{turn}"))
        change = F.expr("CASE WHEN n_tokens_before % 5 = 4 THEN NULL ELSE array(named_struct('place', 3L, 'removed', 2L, 'inserted', ' new é'), NULL, named_struct('place', 1000000L, 'removed', 1L, 'inserted', 'end')) END")
        trees = tc.edited_trees(trees.withColumn("edits", change), PATH, PATTERN)
        found = trees.collect()
        assert len(found) == len(rows)
        for r in found:
            i = r["n_tokens_before"]
            assert r["n_tokens"] == plain(texts[i], count)
            if i % 5 != 4:
                texts[i] = texts[i][:3] + " new é" + texts[i][5:] + "end"
            assert (r["n_tokens_after"], r["n_chars_after"], r["token_tree"]["text"]) == (plain(texts[i], count), len(texts[i]), texts[i])
            assert sum(r["token_tree"]["counts"]) == r["n_tokens_after"] and sum(r["token_tree"]["lengths"]) == len(texts[i])
    nothing = trees.select("doc_id", F.lit(None).cast(tc.KEPT).alias("token_tree"), F.lit(None).cast("array<struct<place:long,removed:long,inserted:string>>").alias("edits"))
    assert {tuple(r[1:5]) for r in tc.edited_trees(nothing, PATH, PATTERN).collect()} == {(0, 0, 0, 0)}
    assert tc.token_trees(docs.limit(0), PATH, PATTERN).count() == 0
