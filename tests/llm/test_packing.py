import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from minutelake.llm import packing
from minutelake.llm.tokens import WordEncoder

from . import helpers


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(packing.tokenizer_path())


@settings(max_examples=120, deadline=None)
@given(texts=st.lists(st.text(alphabet="abZ '\"s9²½ßÉİª_- \u0085\x1c­\n%ΣŒ漢", max_size=40), min_size=1, max_size=6))
def test_ids_are_those_of_the_tokenizer(encoder, texts):
    for ids, text in zip(encoder.encode(texts), texts, strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings_and_long_words(encoder):
    for text in ["a<|endoftext|>b", "<|startoftext|>", "<|", "x" * 3000, "", "don't we'll  '", "l’été"]:
        assert encoder.encode([text, "other words"])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_beyond_the_cache(encoder, monkeypatch):
    monkeypatch.setattr("minutelake.llm.tokens.CACHE_WORDS", 30)
    rng = random.Random(1)
    for _ in range(10):
        text = helpers.sentence(rng, 25, 10**6)
        assert encoder.encode([text])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    encoder.clear()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_best_fit_fills_bins_without_loss(lengths):
    bins = packing.best_fit(lengths, 64)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 64 for b in bins)
    assert len(bins) <= max(1, -(-sum(lengths) // 64)) * 1.5 + 1


def check_packed(rows, packed, encoder, capacity=4096):
    by_doc = {}
    for r in packed:
        by_doc.setdefault(r["doc_id"], []).append(r)
    wanted = {}
    for doc_id, text, *_ in rows:
        ids = np.array([*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            wanted.setdefault(doc_id, []).append((piece, a, len(part), zlib.crc32(part.tobytes())))
    assert {k: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in wanted.items()}
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r["length"] for r in packed)


def test_every_piece_is_packed_once(spark, encoder):
    rows = helpers.documents(7)
    docs = spark.createDataFrame([(*r, 5) for r in rows], helpers.DOCS + ", piece long")
    packed = packing.pack(spark, packing.pieces_of(docs, packing.tokenizer_path())).collect()
    bins, total = check_packed(rows, packed, encoder)
    assert bins <= -(-total // 4096) + 1
    assert packing.pack(spark, packing.pieces_of(docs.limit(0), packing.tokenizer_path())).count() == 0


def test_rounds_over_fewer_partitions(spark, encoder, monkeypatch):
    monkeypatch.setattr(packing, "TASK_ITEMS", 40)
    rng = random.Random(9)
    rows = [(i, helpers.sentence(rng, rng.randint(1, 700), 90), "en", "s", 1) for i in range(200)]
    packed = packing.pack(spark, packing.pieces_of(spark.createDataFrame(rows, helpers.DOCS), packing.tokenizer_path())).collect()
    bins, total = check_packed(rows, packed, encoder)
    assert bins <= -(-total // 4096) * 1.05 + 1


def test_sequences_hold_the_ids(spark, encoder):
    rows = [(i, "some words " * (i + 1), "en", "s", 1) for i in range(6)] + [(9, "word " * 5000, "en", "s", 1)]
    pieces = packing.pieces_of(spark.createDataFrame(rows, helpers.DOCS), packing.tokenizer_path(), with_ids=True)
    found = packing.sequences(pieces, packing.pack(spark, pieces)).collect()
    texts = {r[0]: [*encoder.tokenizer.encode(r[1], add_special_tokens=False).ids, 1] for r in rows}
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        for s in r["spans"]:
            assert ids[s["offset"] : s["offset"] + s["length"]] == texts[s["doc_id"]][s["piece"] * 4096 :][: s["length"]]
