"""Mixing sources to target weights by fixed-length blocks of words.

The words of a source, document after document, are cut into blocks of ``BLOCK_WORDS``. The mix is a sequence of slots
in output shards; how many slots of a shard each source fills is drawn: multinomial counts given the total that each
source has to reach. The draw halves the range of shards again and again, so each shard finds its own counts, and how
many slots went before, from seeded draws along one path, on any executor. A source's j-th slot takes block
``permutation(j mod n)`` of its n blocks, with another pseudorandom permutation for each pass over the source.
Documents meet the blocks they lie in by (source, block number).

Draws among 10^9 slots or more (the top of the halving tree of a mix of 64 * 10^9 words) take the rounded normal law with
the exact mean and variance, as the exact sampler ends there; a distribution function is off by less than 1 in its
standard deviation, some 10^-4. Counts add up to what each source has to reach either way.

Edge cases: a null text has size 0; documents of size 0 are never taken; sources of size 0 have target 0. A null source
is a source of its own, last in order. Repeated rows count each. An empty table gives an empty result. The driver holds
one row per source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm.common import WORD, guarded, small_batches, stage, table
from minutelake.llm.words import U, Words, mix

#: weights of the sources in order, repeated
WEIGHTS = (5, 2, 1)
#: a source, and so a document, is used this many times at most
MOST_USES = 3
BLOCK_WORDS = 64
#: slots of an output shard
SHARD_SLOTS = 16_384
#: documents of a source that one task numbers, about
BUCKET_ROWS = 50_000


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_USES) -> list[float]:
    """All sizes shared by weight; what is above ``most`` times a source's size is shared again among the others."""
    rest, free, out = float(sum(sizes)), list(range(len(sizes))), [0.0] * len(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    while free:
        unit = rest / sum(weight[i] for i in free)
        over = [i for i in free if unit * weight[i] > most * sizes[i]]
        for i in over or free:
            out[i] = float(most * sizes[i]) if over else unit * weight[i]
        if not over:
            break
        rest -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def draw(seed: tuple[int, ...], counts: np.ndarray, taken: int) -> np.ndarray:
    """How many of ``taken`` items, drawn without replacement, are of each kind."""
    rng, out, left, total = np.random.default_rng(seed), np.zeros_like(counts), taken, int(counts.sum())
    for i, n in enumerate(counts.tolist()):
        if left <= 0:
            break
        rest = total - n
        if total < 1_000_000_000:
            got = int(rng.hypergeometric(n, rest, left)) if n and rest else min(n, left)
        else:  # see the module's docstring
            share = n / total
            got = round(rng.normal(left * share, (left * share * (1 - share) * (total - left) / (total - 1)) ** 0.5))
        out[i] = got = min(max(got, left - rest), n, left)
        left, total = left - got, rest
    return out


def shard_counts(seed: int, quotas: np.ndarray, shards: int, slots: int, shard: int, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """(slots of each source before the shard, in the shard); ``known`` keeps draws near the top of the path."""
    low, high, before, counts = 0, shards, np.zeros_like(quotas), quotas
    while high - low > 1:
        middle = (low + high) // 2
        if (low, high) not in known:
            if len(known) > 1000:
                known.clear()
            known[low, high] = draw((seed, low, high), counts, min(int(counts.sum()), (middle - low) * slots))
        left = known[low, high]
        if shard < middle:
            high, counts = middle, left
        else:
            low, before, counts = middle, before + left, counts - left
    return before, counts


def permuted(x: np.ndarray, n: int, seed: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1, one for each seed: a Feistel network, walked until it is in range."""
    half = U(max(1, (int(n - 1).bit_length() + 1) // 2))
    mask = (U(1) << half) - U(1)
    x = x.astype(U)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> half, x[todo] & mask
        for turn in range(4):
            left, right = right, left ^ (mix(right + seed[todo] + U((turn + 1) * 0x9E3779B97F4A7C15 % 2**64)) & mask)
        x[todo] = (left << half) | right
        todo = todo[x[todo] >= U(n)]
    return x.astype(np.int64)


def drawn_blocks(spark: SparkSession, blocks: list[int], quotas: list[int], seed: int) -> DataFrame:
    """(source_no, block) of each slot of the mix."""
    total = sum(quotas)
    shards = max(1, -(-total // SHARD_SLOTS))
    held = np.array(quotas, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                before, counts = shard_counts(seed, held, shards, SHARD_SLOTS, shard, known)
                for i in np.flatnonzero(counts).tolist():
                    j = np.arange(before[i], before[i] + counts[i])
                    turn = mix((j // blocks[i]).astype(U) + U(((i * 8191 + 1) * 0xD1B54A32D192ED03 + seed) % 2**64))
                    block = permuted(j % blocks[i], blocks[i], turn)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), i, np.int32)), pa.array(block)], names=["source_no", "block"])

    parts = min(shards, max(spark.sparkContext.defaultParallelism, shards // 64))
    return spark.range(0, shards if total else 0, 1, parts).mapInArrow(run, "source_no int, block long")


def sized(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` with __rid (a number for each row) and __size (words of the whole text)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias("__rid"), size.alias("__size"), F.xxhash64("text").alias("__key"))


def mix_sources(spark: SparkSession, rows: DataFrame, seed: int = 17, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """For ``sized`` and staged rows with doc_id and source: (sources, uses).

    sources: source, source_no, source_size, target. uses: __rid, low, high, uses: words low to high (without) of a
    document, and how often the mix takes them.
    """
    found = rows.groupBy("source").agg(F.sum("__size").alias("n"), F.count("*").alias("docs")).collect()
    found = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["n"] for r in found]
    wanted = targets(sizes)
    blocks = [-(-n // block_words) for n in sizes]
    quotas = [min(MOST_USES * b, round(t * b / n)) if n else 0 for n, t, b in zip(sizes, wanted, blocks, strict=True)]
    kinds = "source string, source_no int, source_size long, target double"
    sources = spark.createDataFrame([(r["source"], i, n, t) for i, (r, n, t) in enumerate(zip(found, sizes, wanted, strict=True))], kinds)

    # where each document starts among the words of its source: within a bucket of documents, and the buckets before
    buckets = max(16, -(-sum(r["docs"] for r in found) // BUCKET_ROWS))
    named = rows.where("__size > 0").join(F.broadcast(sources), rows["source"].eqNullSafe(sources["source"])).select("__rid", "doc_id", "__key", "__size", "source_no", F.pmod(F.xxhash64("doc_id", "__key"), F.lit(buckets)).alias("bucket"))
    sums = named.groupBy("source_no", "bucket").agg(F.sum("__size").alias("n"))
    before = sums.select("source_no", "bucket", F.expr("coalesce(sum(n) OVER (PARTITION BY source_no ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("before"))
    inside = named.select("__rid", "source_no", "bucket", "__size", F.expr("sum(__size) OVER (PARTITION BY source_no, bucket ORDER BY doc_id, __key, __rid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - __size").alias("inside"))
    placed = inside.join(before, ["source_no", "bucket"]).select("__rid", "source_no", "__size", (F.col("before") + F.col("inside")).alias("start"))

    def div(col: Column) -> Column:
        return F.floor(col / F.lit(block_words)).cast("long")

    # long division by way of doubles is exact below 2 ** 53 words of a source
    lying = placed.withColumn("block", F.explode(F.sequence(div(F.col("start")), div(F.col("start") + F.col("__size") - 1))))
    low = F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0))
    high = F.least((F.col("block") + 1) * block_words - F.col("start"), F.col("__size"))
    used = drawn_blocks(spark, blocks, quotas, seed).groupBy("source_no", "block").agg(F.count("*").cast("int").alias("uses"))
    used = used.hint("merge")  # its size can't be guessed from the shards that it is drawn for; it grows with the mix
    uses = lying.select("__rid", "source_no", "block", low.alias("low"), high.alias("high")).join(used, ["source_no", "block"]).select("__rid", "low", "high", "uses")
    return sources, uses


def cut_words(text: bytes, parts: list[dict]) -> list[str]:
    """The text's words that are used at least once, at least twice and so on; adjoining parts keep what is between them."""
    w, out = Words([text]), []
    parts = sorted(parts, key=lambda p: p["low"])
    for level in range(1, max(p["uses"] for p in parts) + 1):
        runs: list[list[int]] = []
        for p in parts:
            if p["uses"] >= level:
                if runs and runs[-1][1] == p["low"]:
                    runs[-1][1] = p["high"]
                else:
                    runs.append([p["low"], p["high"]])
        out.append(b" ".join(text[w.start[a] : w.start[b - 1] + w.length[b - 1]] for a, b in runs).decode())
    return out


def mixed_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mix as documents: each row of ``docs`` once for each time that words of it are taken, with those words.

    Its other columns may have any name.
    """
    small_batches(spark)
    docs, back = guarded(docs, "doc_id", "source", "text", "n_chars")
    rows = stage(spark, sized(docs, docs.columns), "sized")
    _, uses = mix_sources(spark, rows.select("doc_id", "source", "__rid", "__size", "__key"))
    parts = uses.groupBy("__rid").agg(F.collect_list(F.struct("low", "high", "uses")).alias("__parts"))

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series, held: pd.Series) -> pd.Series:
        return pd.Series([cut_words(x.encode(), list(p)) for x, p in zip(texts, held, strict=True)])

    taken = rows.join(parts, "__rid").withColumn("__text", F.explode(cut("text", "__parts")))
    put = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return back(taken.select(*[put[c].alias(c) if c in put else F.col(f"`{c}`") for c in docs.columns]))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(spark, sized(table(spark, sf_dir, "documents"), ["doc_id", "source"]), "sized")
    sources, uses = mix_sources(spark, rows)
    taken = uses.groupBy("__rid").agg(F.sum((F.col("high") - F.col("low")) * F.col("uses")).alias("taken"))
    out = rows.join(taken, "__rid", "left").join(F.broadcast(sources.withColumnRenamed("source", "name")), F.col("source").eqNullSafe(F.col("name")))
    return out.select("doc_id", F.col("__size").alias("size"), "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")
