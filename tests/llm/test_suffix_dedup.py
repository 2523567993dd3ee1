import hashlib
import random

import numpy as np
import pytest

from minutelake.llm import suffix_dedup, suffixes
from minutelake.llm.registry import QUERIES

KINDS = "doc_id long, text string"


def brute(rows, window):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by a table of all windows."""
    texts, starts = [(t or "").encode() for _, t in rows], {}
    for i, x in enumerate(texts):
        for at in range(len(x) - window + 1):
            starts.setdefault(x[at : at + window], []).append((i, at))
    gone = [bytearray(len(x)) for x in texts]
    for found in starts.values():
        if len(found) > 1:
            for i, at in found:
                gone[i][at : at + window] = b"\1" * window
    out = []
    for (doc, _), x, g in zip(rows, texts, gone):
        kept = bytes(b for b, removed in zip(x, g) if not removed)
        spans = sum(g[i] and not (i and g[i - 1]) for i in range(len(g)))
        out.append((doc, len(x), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def digest(found):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in found.collect()), key=repr)


@pytest.mark.parametrize("letters", [1, 2, 4, 40])
def test_suffix_arrays_and_common_prefixes(letters):
    rng = random.Random(letters)
    for k in range(120):
        t = [rng.randrange(1, letters + 1) for _ in range(rng.randrange(0, 70))]
        text = np.array((t[: rng.randrange(1, 9)] * 9 if k % 3 == 0 else t) + [0], np.uint16)
        array = suffixes.suffix_array(text)
        wanted = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert array.tolist() == wanted
        near, shared = suffixes.permuted_common_prefixes(text, array)
        for x, y in zip(wanted, wanted[1:]):
            n = 0
            while text[x + n] == text[y + n]:
                n += 1
            assert (near[y], shared[y]) == (x, n)


def texts_of(seed, window):
    """Passages of about a window, whole copies, edited copies, repeats within a text, odd bytes and short texts."""
    rng = random.Random(seed)

    def words(n):
        return "".join(rng.choice("abcdé ") for _ in range(n))

    shared = [words(window + k) for k in (-3, -1, 0, 1, 7, 60)]
    texts = [words(rng.randrange(0, 300)) + rng.choice(shared) + words(rng.randrange(0, 300)) + rng.choice(["", rng.choice(shared)]) for _ in range(60)]
    base = words(1500)
    for _ in range(25):
        cut = rng.randrange(len(base))
        texts.append(base[:cut] + rng.choice(["", "X", "yy"]) + base[cut + rng.randrange(3) :])
    texts += [base, base, "z" * 700, "z" * (window + 1), "zy" * 400, "\x00" * 500, "日本" * 300, None, "", "a", "b" * window, "\xffÿ" * 250]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, words(50)), (None, texts[0])]


@pytest.mark.parametrize(("window", "gram"), [(60, 15), (60, 60), (40, 1), (400, 100)])
def test_against_a_table_of_all_windows(spark, window, gram):
    rows = texts_of(window, window)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], KINDS + ", rid int, kept string").repartition(3)
    assert digest(suffix_dedup.without_repeats(spark, df, window=window, gram=gram)) == brute(rows, window)


def test_hot_keys_and_pieces(spark, monkeypatch):
    """With small blocks most keys are split, twice; with small pieces a text is read in many."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", 300)
    monkeypatch.setattr(suffix_dedup, "HOT", 250)
    monkeypatch.setattr(suffix_dedup, "PIECE", 170)
    monkeypatch.setattr(suffix_dedup, "SHARES", 20)
    rows = texts_of(5, 60)
    assert digest(suffix_dedup.without_repeats(spark, spark.createDataFrame(rows, KINDS).repartition(3), window=60, gram=20)) == brute(rows, 60)


def test_whole_table_and_empty_ones(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op13_suffix_dedup"](spark, sf)) == brute(rows, 400)
    spark.createDataFrame([], KINDS).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op13_suffix_dedup"](spark, str(tmp_path)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "short")], KINDS)
    assert [r["kept"] for r in suffix_dedup.without_repeats(spark, nothing).orderBy("doc_id").collect()] == [b"", b"short"]
