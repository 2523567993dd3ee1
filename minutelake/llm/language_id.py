"""Language ID by Bayesian evidence fusion.

Evidence: the likelihood of the text under a character trigram model of each language (tempered, as trigrams overlap);
the declared markup language, by how often documents of a language declare it; and the host, by a prior that is
smoothed hierarchically: counts of a host lean on those of its address suffix, these on those of all documents. The
counts are grouped sums of the text's own posteriors over all documents; a document's own share is taken out again
before it is judged. Besides the languages there is an undetermined one, in which all trigrams are as likely.

The trigram model is fitted on a bounded sample of the distinct texts of each label: labels are counted over all rows, rare
ones are taken whole and common ones share what is left. Every label with a trigram is a language, however rare, as counts
are smoothed. Everything else covers all rows. The model and the evidence of a row grow with the number of labels.

Edge cases: a null or empty text, or one without letters, has no text evidence and is rejected. A null or empty
declaration or host gives no evidence of its own (a null host leans on all documents). Repeated rows are judged each.
Without labelled rows there are no languages and every row is rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm.common import ascii_lower, guarded, small_batches, small_side, stage, table, with_text_columns
from minutelake.llm.words import slices

#: labelled rows to fit the trigram model on (a bounded sample, the same in each run)
SAMPLE_ROWS = 20_000
#: texts that each label may have in the sample, however many labels there are
LABEL_ROWS = 20
BUCKETS = 1 << 14
#: a trigram counts as so much evidence, and no text as more than so many trigrams
TEMPER, MOST_TRIGRAMS = 0.25, 400
#: documents that a smoothed prior of a suffix or host leans on
LEAN = 10.0
#: least posterior of a document that is kept
CONFIDENT = 0.6
#: rows of a table of hosts or declarations that is broadcast (a few numbers each)
BROADCAST_ROWS = 100_000
UNDETERMINED = "und"

#: lower case; digits as one; everything else below 128 that is no letter as a blank
FOLD = np.arange(256, dtype=np.uint32)
FOLD[:128] = [ord("0") if chr(c).isdigit() else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(128)]


def trigrams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the trigram at each byte, BUCKETS where there is none; first byte of each text)."""
    size = np.array([len(x or b"") + 3 for x in texts], np.int64)
    buf = FOLD[np.frombuffer(b"".join(b" " + (x or b"") + b"  " for x in texts) + b"  ", np.uint8)]
    a, b, c = buf[:-2], buf[1:-1], buf[2:]
    code = (((a << np.uint32(16)) | (b << np.uint32(8)) | c) * np.uint32(2654435761)) >> np.uint32(18)
    start = np.cumsum(size) - size
    blank = (b == 32) & ((a == 32) | (c == 32))
    return np.where(blank, BUCKETS, code).astype(np.int32), start


class TrigramModel:
    """Log likelihood of each bucket in each language; the last language is the undetermined one."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = [*languages, UNDETERMINED]
        logs = np.log((counts + 0.05) / (counts.sum(axis=1, keepdims=True) + 0.05 * BUCKETS)) if languages else np.empty((0, BUCKETS))
        self.logs = np.zeros((len(self.languages), BUCKETS + 1))
        self.logs[:, :-1] = np.vstack([logs, np.full((1, BUCKETS), -math.log(BUCKETS))])

    def columns(self, texts: list[bytes | None]) -> dict:
        """Tempered log likelihoods, the posteriors that they give alone, and the number of trigrams."""
        code, start = trigrams(texts)
        many = np.add.reduceat(code < BUCKETS, start)
        scale = TEMPER * np.minimum(1, MOST_TRIGRAMS / np.maximum(many, 1))
        likely = np.stack([np.add.reduceat(x[code], start) for x in self.logs], axis=1) * scale[:, None]
        likely -= likely.max(axis=1, keepdims=True)
        share = np.exp(likely)
        share /= share.sum(axis=1, keepdims=True)
        return {"__likely": list(likely), "__share": list(share), "__trigrams": many}


def quota(sizes: list[int], most: int) -> int:
    """Rows of each group so that all together have about ``most``: small groups stay whole, the others share the rest."""
    for at, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - at) > most:
            return max(most // (len(sizes) - at), LABEL_ROWS)
        most -= size
    return max([*sizes, LABEL_ROWS])


def fit(docs: DataFrame, label_col: str = "lang", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> TrigramModel:
    """The trigram model of all labels, on about ``sample_rows`` distinct texts, chosen for each label by a hash of the text."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))
    keyed = rows.withColumn("key", F.xxhash64("text"))
    found = keyed.groupBy("label").agg(F.approx_count_distinct("key", 0.02).alias("n"), F.min("key").alias("least")).orderBy("label").collect()
    labels, most = [r["label"] for r in found], quota([r["n"] for r in found], sample_rows)
    # hashes are spread evenly, so those up to a bound are a share of a label's texts, and its first is always one
    last = [(r["label"], 2**63 - 1 if r["n"] <= most else max(r["least"], int(2**64 * (most / r["n"])) - 2**63)) for r in found]
    bounds = small_side(spark.createDataFrame(last, "label string, last long"), BROADCAST_ROWS)
    chosen = keyed.join(bounds, "label").where("key <= last").dropDuplicates(["label", "key"]).select("label", "text")
    number = {label: i for i, label in enumerate(labels)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            of, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in slices(texts):
                code, start = trigrams(texts[a:b])
                for label, part in zip(of[a:b], np.split(code, start[1:]), strict=True):
                    held = sums.setdefault(number[label], np.zeros(BUCKETS + 1))
                    held += np.bincount(part, minlength=BUCKETS + 1)
        for at, held in sums.items():
            bucket = np.flatnonzero(held[:BUCKETS])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), at), pa.int32()), pa.array(bucket, pa.int32()), pa.array(held[bucket])], names=["language", "bucket", "n"])

    counts = np.zeros((len(labels), BUCKETS))
    if labels:  # at most a number for each language and bucket
        sums = chosen.mapInArrow(count, "language int, bucket int, n double").groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
        counts[sums["language"], sums["bucket"]] = sums["n"]
    some = np.flatnonzero(counts.any(axis=1))  # texts without a trigram tell nothing of a language
    return TrigramModel([labels[i] for i in some], counts[some])


def suffix_of(host: Column) -> Column:
    """The last label of a host with a dot; null for others."""
    return F.when(host.contains("."), F.substring_index(host, ".", -1))


def language_id(spark: SparkSession, docs: DataFrame, model: TrigramModel, text: str, declared: Column, host: Column) -> DataFrame:
    """``docs`` with language, confidence and kept; ``declared`` and ``host`` are expressions over them.

    Columns of these three names are replaced, others may have any name.
    """
    names, n = model.languages, len(model.languages)
    kept_as = {c: f"kept {i}" for i, c in enumerate(docs.columns)}
    kinds = "__likely array<double>, __share array<double>, __trigrams long"
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in kept_as.items()], F.when(declared.cast("string") != "", declared.cast("string")).alias("__declared"), F.when(host != "", host).alias("__host"))
    # scored twice, as a copy of all texts would weigh more than to read them again
    rows = with_text_columns(rows.withColumn("__suffix", suffix_of(F.col("__host"))), kept_as[text], model.columns, kinds)
    evidence = ["__declared", "__host", "__suffix", "__share", "__trigrams"]
    scored = stage(spark, rows.select(*evidence), "scored")

    def sums(df: DataFrame) -> DataFrame:
        return F.array(*[F.sum(F.col("__share")[i]) for i in range(n)])

    seen = scored.where("__trigrams > 0")
    total = seen.agg(sums(seen).alias("c")).first()["c"]
    total = [x or 0.0 for x in total]
    overall = [(x + 1) / (sum(total) + n) for x in total]
    by_suffix = seen.where("__suffix IS NOT NULL").groupBy("__suffix").agg(sums(seen).alias("__by_suffix"))
    by_host = seen.where("__host IS NOT NULL").groupBy("__host").agg(sums(seen).alias("__by_host"))
    by_declared = seen.where("__declared IS NOT NULL").groupBy("__declared").agg(sums(seen).alias("__by_declared"))
    by_suffix, by_host, by_declared = stage(spark, by_suffix, "suffixes"), stage(spark, by_host, "hosts"), stage(spark, by_declared, "declared")
    kinds_declared = max(1, by_declared.count())
    in_language = by_declared.agg(F.array(*[F.coalesce(F.sum(F.col("__by_declared")[i]), F.lit(0.0)) for i in range(n)]).alias("c")).first()["c"]
    rows = rows.join(small_side(by_suffix, BROADCAST_ROWS), "__suffix", "left").join(small_side(by_host, BROADCAST_ROWS), "__host", "left").join(small_side(by_declared, BROADCAST_ROWS), "__declared", "left")

    rows = rows.withColumns({f"{c}_all": F.aggregate(c, F.lit(0.0), lambda a, x: a + x) for c in ("__by_host", "__by_suffix")})

    own = [F.when(F.col("__trigrams") > 0, F.col("__share")[i]).otherwise(0.0) for i in range(n)]
    one = F.when(F.col("__trigrams") > 0, 1.0).otherwise(0.0)

    def leaning(counts: str, i: int, on: Column) -> Column:
        """The share of language i in ``counts``, without this document, smoothed by ``on``."""
        whole = F.col(f"{counts}_all") - one
        held = F.greatest(F.col(counts)[i] - own[i], F.lit(0.0))
        return F.when(F.col(counts).isNull(), on).otherwise((held + LEAN * on) / (F.greatest(whole, F.lit(0.0)) + LEAN))

    def log_of(i: int) -> Column:
        prior = leaning("__by_host", i, leaning("__by_suffix", i, F.lit(overall[i])))
        held = F.greatest(F.col("__by_declared")[i] - own[i], F.lit(0.0))
        said = F.when(F.col("__by_declared").isNull(), F.lit(0.0)).otherwise(F.log((held + 0.5) / (F.greatest(F.lit(in_language[i]) - own[i], F.lit(0.0)) + 0.5 * kinds_declared)))
        return F.col("__likely")[i] + F.log(prior) + said

    rows = rows.withColumn("__logs", F.array(*[log_of(i) for i in range(n)]))
    best = F.array_max("__logs")
    rows = rows.withColumn("language", F.element_at(F.array(*[F.lit(x) for x in names]), F.array_position("__logs", best).cast("int")))
    rows = rows.withColumn("confidence", 1 / F.aggregate("__logs", F.lit(0.0), lambda a, x: a + F.exp(x - best)))
    kept = (F.col("__trigrams") > 0) & (F.col("language") != UNDETERMINED) & (F.col("confidence") >= CONFIDENT)
    made = ("language", "confidence", "kept")
    return rows.withColumn("kept", kept).select(*[F.col(f"`{k}`").alias(c) for c, k in kept_as.items() if c not in made], *made)


def identified(spark: SparkSession, docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Documents whose ``lang`` is declared and whose ``source`` is their host."""
    return language_id(spark, docs, fit(labelled), "text", F.col("lang"), F.col("source"))


def keep_identified(spark: SparkSession, docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``docs`` without rows whose language can't be told; their other columns may have any name."""
    docs, back = guarded(docs, "text", "lang", "source")
    return back(identified(spark, docs, labelled).where("kept"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text", "lang", "source")
    return identified(spark, rows, docs).select("doc_id", "language", "confidence", "kept")


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by its text, ``<html lang>``, host and suffix; the trigram model is that of the documents."""
    html = F.coalesce("html", F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<!--.*?-->|<[^>]*>", " ")
    declared = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*\blang\s*=\s*["']?([a-z]{2,3})""", 1))
    host = ascii_lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^.*?://([^/?#:]*)", 1))
    rows = table(spark, sf_dir, "pages").select("page_id", text.alias("text"), declared.alias("declared"), host.alias("host"))
    found = language_id(spark, rows, fit(table(spark, sf_dir, "documents")), "text", F.col("declared"), F.col("host"))
    return found.select("page_id", "host", "declared", "language", "confidence", "kept")
