"""N-gram Jaccard join: which documents are linked by a high Jaccard similarity of their word shingles.

A size-aware heavy-light join over the distinct shingle sets (equal sets are one node):

* *Small* sets list fixed-size subsets: sets of s and t shingles are linked only if they share o(s, t) of them, so each
  lists its o(s, t)-subsets for every partner size t, and linked sets meet under one subset.
* *Large* sets meet in inverted lists. The range of shingle hashes is cut into k cells, with k above the largest
  possible symmetric difference (k depends on a band of sizes alone), so linked sets agree on a whole non-empty cell;
  a list is kept for each (cell, content). A list of a whole cell stays short where many documents share a passage.
* The boundary between both is the size that costs least by the numbers of sets of each size.

A set that shares fewer lists of a band with others than any linked pair of the band must share is linked with nothing
there; it leaves these lists before they are read. So documents that only have a passage in common don't meet. A cell
that is empty is listed only by a set whose other cells may all differ from a linked one's: nearly all unrelated sets
have some empty cell in common, and their list would grow with the table.

No pairs of a list are emitted. Each list elects a pivot (the set with the most copies) and every other member is
checked against it; only members that the pivot doesn't link are then compared with the members of the pivot's lists,
block by block, by scanning inverted lists of single shingles and counting. The links found span every component.
Before texts are gathered for a check, parity sketches (two bits a shingle) rule out pairs: sketches never differ in
more bits than sets differ in shingles.

Edge cases: a null or empty text, or one without words, has an empty set and is linked with nothing, each row its own
component. Rows with equal sets are linked. A null id takes part but is never the smallest id of a component; a
component of null ids has a null id. Repeated rows come back as often as they came. Sets hold 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm.common import ascii_lower, by_group, forget, guarded, small_batches, small_side, stage, table, with_text_columns
from minutelake.llm.words import U, Words, mix, slices

#: sets of this many shingles or more are never small: their subsets are too many
SMALL_BELOW = 32
#: cost of a list entry (indexed, scanned and checked) against one of a subset (indexed)
LIST_COST = 3
#: sizes of a band grow by this factor
BAND = 1.6
#: cells beyond those that a list needs at least, as a share: so many lists more are shared by all linked sets
EXTRA = 0.12
#: times that sets which share too few lists leave
ROUNDS = 2
#: low bits of a signature that hold its kind: 0 for a subset, then the band's number
KIND_BITS = 6
#: members of a block whose sketches, and whose texts, one task compares
SKETCH_BLOCK, BLOCK = 4096, 256
#: ids below which the texts to compare are found by a broadcast of the ids (8 bytes each)
BROADCAST_IDS = 500_000


def overlap(s: int, t: int, theta: Fraction) -> int:
    """Least intersection of linked sets of s and t shingles."""
    return math.ceil(theta * (s + t) / (1 + theta))


def partners(s: int, theta: Fraction) -> range:
    return range(math.ceil(theta * s), math.floor(s / theta) + 1)


def subsets(s: int, theta: Fraction, below: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, shingles left out) of the subsets that a set of s < below shingles lists."""
    return [(min(s, t), max(s, t), s - overlap(s, t, theta)) for t in partners(s, theta) if t < below]


def bands(theta: Fraction, below: int, largest: int) -> list[tuple[int, int, int, int]]:
    """(first, last member size, cells, empty cells allowed for); a band holds the pairs whose smaller set is in its range.

    Linked sets of a band agree on all cells but those that hold one of the ``apart`` shingles at most by which they
    differ. Sets of any size of the band are to have more cells filled than that, for which the cells are enough even if
    that many stay empty.
    """
    found, low = [], max(1, math.ceil(theta * below))
    while low <= largest:
        high = max(low + 1, math.ceil(low * BAND))
        larger = math.floor((high - 1) / theta)
        apart = math.floor((1 - theta) * (high - 1 + larger) / (1 + theta))
        spare = math.ceil(0.04 * apart + 3 * math.sqrt(0.04 * apart))
        found.append((low, larger, apart + 1 + spare + math.ceil(EXTRA * apart), spare))
        low = high
    return found


def boundary(sizes: dict[int, int], theta: Fraction) -> int:
    """The size from which sets count as large: least cost of the subsets of smaller sets and the lists of the rest."""

    def cost(below: int) -> float:
        light = sum(n * sum(math.comb(s, out) for _, _, out in subsets(s, theta, below)) for s, n in sizes.items() if s < below)
        kinds = bands(theta, below, max(sizes, default=1))
        return light + LIST_COST * sum(n * sum(k for low, last, k, _ in kinds if low <= s <= last) for s, n in sizes.items())

    return min(range(2, SMALL_BELOW + 1), key=cost)


class Signatures:
    """Under which subsets and cells a set is listed."""

    def __init__(self, theta: Fraction, below: int):
        self.theta, self.below, self.known, self.cut = theta, below, [], {}

    def by_kind(self, found: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """Signatures of a set by kind, and how many of them at least it shares with a set that it is linked with under
        this kind. A linked pair has one kind: subsets if both are small, else the band of the smaller."""
        out, n = [], len(found)
        if n < self.below:
            mixed, held = mix(found + U(0x632BE59BD9B4E019)), []
            for s, t, left in subsets(n, self.theta, self.below):
                if (n, left) not in self.cut:
                    self.cut[n, left] = np.array(list(combinations(range(n), left)), np.int64).reshape(math.comb(n, left), left)
                whole = mixed.sum(dtype=U) - mixed[self.cut[n, left]].sum(axis=1, dtype=U)
                held.append(mix(whole + U(((s << 20) + t << 20) + 1)))
            out.append((of_kind(np.concatenate(held), 0), 1))
        if not self.known or self.known[-1][0] <= n:
            self.known = bands(self.theta, self.below, 2 * n + 2)
        for b, (low, last, cells, _) in enumerate(self.known):
            if low <= n <= last:
                cell = (found >> U(32)) * U(cells) >> U(32)
                first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
                held = np.add.reduceat(mix(found + U(0x8CB92BA72F3D8DD7)), first)
                place = (U(b + 1) << U(40)) + cell[first]
                held = mix(held + mix(place))
                # a shingle by which a linked set differs changes one cell; empty ones are needed if all others may change
                apart = math.floor((1 - self.theta) * (n + min(math.floor(n / self.theta), last)) / (1 + self.theta))
                if len(first) <= apart:
                    empty = np.setdiff1d(np.arange(cells, dtype=U), cell[first])
                    held = np.append(held, mix(mix((U(b + 1) << U(40)) + empty) + U(0xD6E8FEB86659FD93)))
                out.append((of_kind(held, b + 1), max(1, len(first) - apart)))
        return out

    def of(self, found: np.ndarray) -> tuple[np.ndarray, int]:
        """Signatures of a set, and how many of them at least it shares with any set that it is linked with."""
        out = self.by_kind(found)
        return (np.concatenate([x for x, _ in out]) if out else np.empty(0, np.int64)), min((need for _, need in out), default=1)


def of_kind(held: np.ndarray, kind: int) -> np.ndarray:
    return (held >> U(KIND_BITS) << U(KIND_BITS) | U(kind)).view(np.int64)


def kind_of(col: Column) -> Column:
    return col.bitwiseAND(F.lit((1 << KIND_BITS) - 1))


def sketch(found: np.ndarray) -> bytes:
    """The parity of the shingles that fall on each bit; at least two bits a shingle, a power of two in all."""
    bits = max(64, 1 << (2 * len(found) - 1).bit_length())
    place = mix(found + U(0x2545F4914F6CDD1D)) & U(bits - 1)
    return np.packbits((np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Rows of sketches brought to fewer words: a shorter sketch is the parity of a longer one's parts."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), axis=1)


class Sketches:
    """Sets by size and sketch, to be held against one of them."""

    def __init__(self, sizes: np.ndarray, sketches: list[bytes], theta: Fraction):
        self.sizes, self.theta = sizes, theta
        lengths = np.array([len(x) for x in sketches])
        self.classes = {n // 8: (at := np.flatnonzero(lengths == n), np.frombuffer(b"".join(sketches[i] for i in at), np.uint64).reshape(len(at), -1)) for n in np.unique(lengths).tolist()}

    def near(self, size: int, one: bytes) -> np.ndarray:
        """Places of the sets that sizes and sketches don't rule out as linked with a set."""
        out, own = [], np.frombuffer(one, np.uint64)[None, :]
        p, q = self.theta.numerator, self.theta.denominator
        for words, (at, rows) in self.classes.items():
            sizes = self.sizes[at]
            fits = (q * np.minimum(sizes, size) >= p * np.maximum(sizes, size)).nonzero()[0]
            if len(fits):
                least = min(words, own.shape[1])
                apart = np.bitwise_count(folded(rows[fits], least) ^ folded(own, least)).sum(axis=1, dtype=np.int64)
                out.append(at[fits[(q + p) * apart <= (q - p) * (sizes[fits] + size)]])
        return np.concatenate(out) if out else np.empty(0, np.int64)


def read_sets(n: int, theta: Fraction, below: int):
    """Size, digest, sketch and signatures of the set of each text; of each kind of these how many a linked set shares,
    shifted left by KIND_BITS, with the kind in the low bits."""

    def run(texts: list[bytes | None]) -> dict:
        lists, sizes, digests, sketches, signs, needs = Signatures(theta, below), [], [], [], [], []
        for found in Words(texts).shingles(n):
            sizes.append(len(found))
            digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            sketches.append(sketch(found) if len(found) else b"")
            signed = lists.by_kind(found) if len(found) else []
            signs.append(np.concatenate([x for x, _ in signed]) if signed else [])
            needs.append([need << KIND_BITS | int(x[0]) & (1 << KIND_BITS) - 1 for x, need in signed])
        pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return {"n_shingles": sizes, "d1": pair[:, 0], "d2": pair[:, 1], "sketch": sketches, "needs": needs, "signatures": signs}

    return run


def sets_of(texts: pd.Series, n: int) -> list[np.ndarray]:
    coded = [x.encode() for x in texts]
    return [found for a, b in slices(coded) for found in Words(coded[a:b]).shingles(n)]


def linked(common: np.ndarray, size: int, sizes: np.ndarray, theta: Fraction) -> np.ndarray:
    return theta.denominator * common >= theta.numerator * (size + sizes - common)


def near_star(theta: Fraction):
    """A pivot and a block of its members: which of them may be linked with it."""

    def run(group: pd.DataFrame) -> pd.DataFrame | None:
        pivot = group["pivot"].iloc[0]
        group = group.drop_duplicates("node").reset_index(drop=True)
        at = np.flatnonzero(group["node"].to_numpy() == pivot)
        if not len(at) or len(group) < 2:
            return None
        held = Sketches(group["n_shingles"].to_numpy(), group["sketch"].tolist(), theta)
        near = np.zeros(len(group), bool)
        near[held.near(int(group["n_shingles"][at[0]]), group["sketch"][at[0]])] = True
        out = pd.DataFrame({"pivot": pivot, "node": group["node"], "near": near})
        return out[out["node"] != pivot]

    return run


def near_members(theta: Fraction):
    """Members that their pivot doesn't link (side 0) and a block of members (side 1): those that some probe may be
    linked with, and these probes. Members that the pivot links are one component already."""

    def run(group: pd.DataFrame) -> pd.DataFrame | None:
        probes, members = group[group["side"] == 0], group[group["side"] == 1]
        if not len(probes) or not len(members):
            return None
        held = Sketches(members["n_shingles"].to_numpy(), members["sketch"].tolist(), theta)
        nodes, met, used = members["node"].to_numpy(), np.zeros(len(members), bool), []
        for node, size, one in zip(probes["node"], probes["n_shingles"], probes["sketch"], strict=True):
            found = held.near(size, one)
            found = found[nodes[found] != node]
            met[found] = True
            used.append(len(found) > 0)
        return pd.concat([probes[np.array(used)], members[met]])[["pivot", "node", "linked", "side"]]

    return run


def check_star(n: int, theta: Fraction):
    """A pivot and a block of its members: those that it links."""

    def run(group: pd.DataFrame) -> pd.DataFrame | None:
        pivot = group["pivot"].iloc[0]
        group = group.drop_duplicates("node")
        nodes = group["node"].to_numpy()
        sets = sets_of(group["text"], n)
        at = np.flatnonzero(nodes == pivot)
        if not len(at) or len(sets) < 2:
            return None
        sizes = np.array([len(x) for x in sets])
        common = np.array([np.isin(x, sets[at[0]], assume_unique=True).sum() for x in sets])
        out = pd.DataFrame({"pivot": pivot, "node": nodes[linked(common, sizes[at[0]], sizes, theta)]})
        return out[out["node"] != pivot]

    return run


def scan_lists(n: int, theta: Fraction):
    """Members that their pivot doesn't link (side 0) against a block of members (side 1): links that span components."""

    def run(group: pd.DataFrame) -> pd.DataFrame | None:
        probes, members = group[group["side"] == 0], group[group["side"] == 1]
        if not len(probes) or not len(members):
            return None
        sets = sets_of(members["text"], n)
        sizes, nodes = np.array([len(x) for x in sets]), members["node"].to_numpy()
        tokens, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        root = {x: x for x in [*nodes.tolist(), *probes["node"].tolist()]}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        joined = nodes[members["linked"].to_numpy(bool)].tolist()
        for x in joined[1:]:
            root[find(x)] = find(joined[0])
        out = []
        for node, found in zip(probes["node"].tolist(), sets_of(probes["text"], n), strict=True):
            first, end = np.searchsorted(tokens, found, "left"), np.searchsorted(tokens, found, "right")
            many = end - first
            held = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
            common = np.bincount(owners[held], minlength=len(sets))
            for other in nodes[linked(common, len(found), sizes, theta)].tolist():
                if other != node and (a := find(node)) != (b := find(other)):
                    root[a] = b
                    out.append((min(node, other), max(node, other)))
        return pd.DataFrame(out, columns=["a", "b"]) if out else None

    return run


def blocks(many: Column, size: int) -> Column:
    return F.ceil(many / size).cast("int")


def block_of(many: str) -> Column:
    return F.pmod(F.xxhash64("node"), F.col(many)).cast("int")


def each_block(many: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(many) - 1))


def with_heads(pairs: DataFrame, size: int) -> DataFrame:
    """(pivot, block, node): the members of each pivot in blocks, with the pivot itself in every block."""
    clusters = pairs.groupBy("pivot").agg(blocks(F.count("*"), size).alias("many"))
    heads = clusters.select("pivot", each_block("many").alias("block"), F.col("pivot").alias("node"))
    return pairs.join(clusters, "pivot").select("pivot", block_of("many").alias("block"), "node").unionByName(heads)


def block_pairs(sides: DataFrame, key: str, size: int, least: int = 1) -> DataFrame:
    """Rows of side 0 and of side 1 (``least`` or more) under each ``key``, in blocks i and j that all meet each other."""
    probes = F.sum(F.when(F.col("side") == 0, 1).otherwise(0))
    members = F.sum(F.when(F.col("side") == 1, 1).otherwise(0))
    many = sides.groupBy(key).agg(blocks(probes, size).alias("na"), blocks(members, size).alias("nb"), members.alias("members"))
    held = sides.join(many.where((F.col("na") > 0) & (F.col("members") >= least)).drop("members"), key)
    left = held.where("side = 0").withColumn("i", block_of("na")).withColumn("j", each_block("nb"))
    right = held.where("side = 1").withColumn("j", block_of("nb")).withColumn("i", each_block("na"))
    return left.unionByName(right).drop("na", "nb")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of each node of ``edges`` (a, b): root is the smallest node of its component.

    Alternating large-star and small-star steps over staged edge tables until they stay the same.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    pairs, before = stage(spark, pairs, "edges"), None

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    while (now := mark(pairs)) != before:
        before = now
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(spark, large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        pairs = stage(spark, small.where("a > b").distinct(), "small")
    return pairs.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, words: int = 5, theta: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, class_copies, tkey) for each row of ``docs``.

    class_id: smallest id with the same set; class_copies: rows with it; tkey: ``text_key`` of the row's text.
    """
    small_batches(spark)
    text = ascii_lower(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("tkey"), text.alias("text"))

    # the boundary: a cost by the sizes of the sets of short texts; longer ones are large anyway
    guess = F.greatest(F.lit(1), F.size(F.split(F.trim("text"), r"[\x20\x09-\x0D]+")) - words + 1)
    sizes = rows.where(F.octet_length("text") <= 1024).groupBy(guess.alias("s")).count().where(F.col("s") < 2 * SMALL_BELOW)
    below = boundary({r["s"]: r["count"] for r in sizes.collect()}, theta)

    read = rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "tkey", "text")
    made = with_text_columns(read, "text", read_sets(words, theta, below), "n_shingles long, d1 long, d2 long, sketch binary, needs array<long>, signatures array<long>", keep_text=False)
    made = stage(spark, made, "signed")
    sets = stage(spark, made.drop("signatures"), "sets")
    filled = sets.where("n_shingles > 0")

    # a node for each distinct set; nodes with more copies come first
    nodes = filled.groupBy("d1", "d2").agg(F.min("rid").alias("rid"), F.min("doc_id").alias("class_id"), F.min("tkey").alias("tkey"), F.count("*").alias("class_copies"))
    first = F.least(F.lit(62), F.floor(F.log2("class_copies"))).cast("long")
    nodes = stage(spark, nodes.withColumn("node", F.shiftleft(F.lit(62) - first, 57) + F.monotonically_increasing_id()), "nodes")

    # lists with more than one node; counting them first keeps what is shuffled small
    signed = stage(spark, made.select("rid", "signatures").join(nodes.select("rid", "node"), "rid").select("node", "signatures"), "lists")
    forget(spark, made)
    listed = signed.select(F.explode("signatures").alias("signature"), "node")
    shared = listed.groupBy("signature").count().where("count > 1").select("signature")
    met = listed.join(shared.hint("shuffle_hash"), "signature")  # the few shared ones as a table, nothing is sorted
    met = stage(spark, met, "met")
    forget(spark, signed)
    # sets that share too few lists of a kind to be linked leave these, and lists that are left with one set
    needs = nodes.select("node", "rid").join(sets.select("rid", "needs"), "rid").select("node", F.explode("needs").alias("need"))
    needs = needs.select("node", kind_of(F.col("need")).alias("kind"), F.shiftright("need", KIND_BITS).alias("need"))
    for _ in range(ROUNDS):
        met_kinds = met.withColumn("kind", kind_of(F.col("signature")))
        enough = met_kinds.groupBy("node", "kind").count().join(needs, ["node", "kind"]).where(F.col("count") >= F.col("need")).select("node", "kind")
        left = met_kinds.join(enough, ["node", "kind"])
        left = left.join(left.groupBy("signature").count().where("count > 1").select("signature"), "signature")
        left = stage(spark, left.select("signature", "node"), "met")
        forget(spark, met)
        met = left
    pivots = met.groupBy("signature").agg(F.min("node").alias("pivot"))
    star = met.join(pivots, "signature").where("node > pivot").select("pivot", "node").distinct()
    star = stage(spark, star, "star")

    sketches = nodes.select("node", "rid").join(sets.select("rid", "n_shingles", "sketch"), "rid").drop("rid")

    def texts_of(wanted: DataFrame) -> DataFrame:
        """(node, text) of the nodes in ``wanted``, once each."""
        wanted = stage(spark, nodes.select("node", "tkey").join(wanted.select("node").distinct(), "node"), "wanted")
        texts = rows.select("tkey", "text").join(small_side(wanted, BROADCAST_IDS), "tkey")
        return stage(spark, texts.groupBy("node").agg(F.first("text").alias("text")), "texts")

    # members that a pivot may link by their sketches, then those that it does link
    near = by_group(with_heads(star, SKETCH_BLOCK).join(sketches, "node"), ["pivot", "block"], near_star(theta), "pivot long, node long, near boolean")
    near = stage(spark, near, "near")
    pairs = near.where("near").select("pivot", "node")
    texts = texts_of(pairs.select(F.col("pivot").alias("node")).union(pairs.select("node")))
    links = stage(spark, by_group(with_heads(pairs, BLOCK).join(texts, "node"), ["pivot", "block"], check_star(words, theta), "pivot long, node long"), "links")
    checked = near.select("pivot", "node").join(links.withColumn("linked", F.lit(True)), ["pivot", "node"], "left")
    checked = stage(spark, checked.withColumn("linked", F.coalesce("linked", F.lit(False))), "checked")

    # members that the pivot doesn't link, against the other members of its lists: by sketches, then by texts
    sides = checked.where("not linked").withColumn("side", F.lit(0)).unionByName(checked.withColumn("side", F.lit(1)))
    met = block_pairs(sides, "pivot", SKETCH_BLOCK, least=2).join(sketches, "node")
    met = by_group(met, ["pivot", "i", "j"], near_members(theta), "pivot long, node long, linked boolean, side int")
    met = stage(spark, met.distinct(), "near_members")
    more = block_pairs(met, "pivot", BLOCK).join(texts_of(met), "node")
    more = by_group(more, ["pivot", "i", "j"], scan_lists(words, theta), "a long, b long")

    edges = links.select(F.col("pivot").alias("a"), F.col("node").alias("b")).unionByName(more)
    roots = stage(spark, components(spark, edges), "roots")
    named = nodes.join(roots, "node", "left").select("node", "d1", "d2", "class_id", "class_copies", F.coalesce("root", "node").alias("root"))
    least = roots.join(nodes.select("node", "class_id"), "node").unionByName(roots.select(F.col("root").alias("node"), "root").distinct().join(nodes.select("node", "class_id"), "node"))
    least = least.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = named.join(least, "root", "left").select("d1", "d2", "class_id", "class_copies", F.coalesce("component_id", "class_id").alias("component_id"))
    out = filled.join(named, ["d1", "d2"]).select("doc_id", "n_shingles", "component_id", "class_id", "class_copies", "tkey")
    alone = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_copies"), "tkey")
    return out.unionByName(alone)


def text_key(text: Column) -> Column:
    """Finds a text again: the same for equal texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, words: int = 5, theta: Fraction = Fraction(4, 5)) -> DataFrame:
    """``docs`` with one row of each group of linked documents: the one with the smallest id (null ids last).

    Their other columns may have any name.
    """
    docs, back = guarded(docs, "doc_id", "text")
    groups = ngram_jaccard_join(spark, docs, words, theta).where("n_shingles > 0")
    # of a group's rows with the smallest id the smallest text key; documents without words each stand for themselves
    groups = groups.groupBy("component_id", "doc_id", "tkey", F.when(F.col("component_id").isNull(), F.col("class_id")).alias("own")).agg(F.count("*").alias("rows"))
    best = groups.groupBy("component_id", "own").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tkey", "rows")).alias("first"))
    best = stage(spark, best.select(F.col("first.doc_id").alias("__id"), F.col("first.tkey").alias("__key"), F.col("first.rows").alias("__rows")).distinct(), "best")
    keyed = docs.withColumns({"__row_id": F.col("doc_id").cast("long"), "__row_key": text_key(F.col("text"))})
    keyed = keyed.withColumn("__words", F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    found = keyed.where("__words").join(small_side(best, BROADCAST_IDS), F.col("__row_id").eqNullSafe(F.col("__id")) & (F.col("__row_key") == F.col("__key")))
    # rows repeated with the same id and text: one of them stays
    values = [F.col(f"`{c}`") for c in docs.columns]
    again = found.where("__rows > 1").groupBy("__row_id", "__row_key").agg(F.min_by(F.struct(*values), F.xxhash64(*values)).alias("__row")).select("__row.*")
    return back(found.where("__rows = 1").select(*values).unionByName(again).unionByName(keyed.where("not __words").select(*values)))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(spark, table(spark, sf_dir, "documents"), 4, Fraction(17, 20)).drop("tkey")


#: the same by counting common shingles of all pairs that share one
OP1_SQL = r"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
worded AS (SELECT r, doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
shingled AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s FROM worded),
sets AS (SELECT list_sort(s) AS s, min(doc_id) AS node FROM shingled WHERE len(s) > 0 GROUP BY 1),
items AS MATERIALIZED (SELECT node, len(s) AS n, unnest(s) AS x FROM sets),
links AS MATERIALIZED (SELECT a.node AS a, b.node AS b FROM items a JOIN items b ON a.x = b.x AND a.node <> b.node AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE least(g.node, coalesce(l.b, g.node)) END AS component_id,
  CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE g.node END AS class_id, CASE WHEN len(s.s) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY list_sort(s.s)) END AS class_copies
FROM shingled s LEFT JOIN sets g ON g.s = list_sort(s.s) LEFT JOIN least_of l ON l.a = g.node
"""
