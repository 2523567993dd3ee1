"""Token counts that follow edits.

A document is kept as the pre-tokens of its tokenizer in small blocks, with a segment tree of characters and tokens
over the blocks. Pre-tokens are encoded on their own, so an edit changes only those that it touches and those whose
end the pattern finds by looking at touched characters. From the first of these on, the text is split again until a
boundary falls on one that was there before; only the new pre-tokens are counted, and the sums above their blocks
updated.

Trees are kept as a column between rounds of edits: ``token_trees`` encodes each text once, ``edited_trees`` takes its
table (written and read again as the caller likes), applies edits and gives the next table. A kept tree is the text with
the length and the token count of each pre-token; the sums of blocks are added up again when it is read, but only blocks
that an edit touches are opened, and nothing else is split or encoded.

Edge cases: a null or empty text has no tokens and can be edited like others; so is a null tree. Positions beyond the end
mean the end; a null insertion is empty; null edits are none. Repeated rows are counted each. An empty table gives no
rows. Texts of any length are counted whole, by a task that holds the text and its pre-tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutelake.llm.common import small_batches, stage, table

#: pre-tokens of a block
BLOCK = 64
#: pre-tokens whose counts a task remembers
CACHE = 200_000
#: characters after a pre-token that the pattern may look at to find its end
LOOK_AHEAD = 2

MADE = ("n_tokens", "n_tokens_after", "n_chars_after", "recounted_chars")


#: column of a kept tree, and its type
TREE = "token_tree"
KEPT = T.StructType([T.StructField("text", T.StringType()), T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])
KEPT_ARROW = pa.struct([("text", pa.string()), ("lengths", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])


def in_blocks(pieces: list[str], counts: list[int]) -> list[tuple[list[str], list[int], int, int]]:
    """Blocks of pre-tokens: (pieces, tokens of each, characters, tokens)."""
    out = []
    for a in range(0, max(len(pieces), 1), BLOCK):
        held, numbers = pieces[a : a + BLOCK], counts[a : a + BLOCK]
        out.append((held, numbers, sum(map(len, held)), sum(numbers)))
    return out


class TokenTree:
    """Pre-tokens of a text in blocks, with the sums of characters and tokens of each subtree.

    ``kept`` are the lengths and token counts of the pre-tokens of a tree that was kept: then nothing is split or counted,
    and a block is its number there until it is opened.
    """

    def __init__(self, text: str, split: Callable, count: Callable[[str], int], kept: tuple[np.ndarray, np.ndarray] | None = None):
        self.split, self.count, self.recounted = split, count, 0
        if kept is None or not len(kept[0]):
            pieces = [m.group() for m in split(text, 0)]
            self.lay(in_blocks(pieces, list(map(count, pieces))))
            return
        lengths, counts = map(np.asarray, kept)
        first = np.arange(0, len(lengths), BLOCK)
        chars, tokens = np.add.reduceat(lengths, first), np.add.reduceat(counts, first)
        #: text, lengths and counts as kept, and the first character of each block
        self.source = text, lengths, counts, [0, *np.cumsum(chars, dtype=np.int64).tolist()]
        self.lay(list(zip(range(len(first)), [[]] * len(first), chars.tolist(), tokens.tolist())))

    def open(self, i: int) -> list[str]:
        """The pre-tokens of block ``i``."""
        if isinstance(block := self.blocks[i], int):
            text, lengths, counts, start = self.source
            at, own = start[block], slice(block * BLOCK, (block + 1) * BLOCK)
            self.blocks[i], self.counts[i] = [], counts[own].tolist()
            for n in lengths[own].tolist():
                self.blocks[i].append(text[at : at + n])
                at += n
        return self.blocks[i]

    def lay(self, blocks: list[tuple[list[str] | int, list[int], int, int]]) -> None:
        """A tree over blocks whose sums are known."""
        self.blocks, self.counts = [b[0] for b in blocks], [b[1] for b in blocks]
        self.leaves = 1 << (len(blocks) - 1).bit_length()
        spare = [0] * (self.leaves - len(blocks))
        self.chars = [0] * self.leaves + [b[2] for b in blocks] + spare
        self.tokens = [0] * self.leaves + [b[3] for b in blocks] + spare
        for at in range(self.leaves - 1, 0, -1):
            self.sum_node(at)

    def sum_block(self, i: int) -> None:
        self.chars[self.leaves + i], self.tokens[self.leaves + i] = sum(map(len, self.blocks[i])), sum(self.counts[i])

    def sum_node(self, at: int) -> None:
        self.chars[at] = self.chars[2 * at] + self.chars[2 * at + 1]
        self.tokens[at] = self.tokens[2 * at] + self.tokens[2 * at + 1]

    def kept(self) -> tuple[list[int], list[int]]:
        """Lengths and token counts of the pre-tokens."""
        lengths, counts = [], []
        for block, numbers in zip(self.blocks, self.counts, strict=True):
            if isinstance(block, int):
                own = slice(block * BLOCK, (block + 1) * BLOCK)
                lengths += self.source[1][own].tolist()
                counts += self.source[2][own].tolist()
            else:
                lengths += map(len, block)
                counts += numbers
        return lengths, counts

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.source[0][self.source[3][b] : self.source[3][b + 1]] if isinstance(b, int) else "".join(b) for b in self.blocks)

    def locate(self, place: int) -> tuple[int, int]:
        """(block that holds the character at ``place``, characters before the block); the last one for the end."""
        place, at, before = max(0, min(place, self.n_chars - 1)), 1, 0
        while at < self.leaves:
            at *= 2
            if place - before >= self.chars[at]:
                before += self.chars[at]
                at += 1
        return min(at - self.leaves, len(self.blocks) - 1), before

    def edit(self, place: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters from ``place`` on by ``inserted``."""
        place = max(0, min(place, self.n_chars))
        end = min(place + max(0, removed), self.n_chars)
        first, before = self.locate(place - LOOK_AHEAD)
        last, _ = self.locate(end)
        # pre-tokens that end so early that the pattern has not seen what is edited
        kept, start, block = 0, before, self.open(first)
        while kept < len(block) and start + len(block[kept]) + LOOK_AHEAD <= place:
            start += len(block[kept])
            kept += 1
        while True:
            pieces = [x for i in range(first, last + 1) for x in self.open(i)]
            more = last + 1 < len(self.blocks)
            ahead, nxt = "", last + 1
            while len(ahead) < LOOK_AHEAD and nxt < len(self.blocks):
                ahead += "".join(self.open(nxt))
                nxt += 1
            old = "".join(pieces)
            new = old[: place - before] + inserted + old[end - before :]
            shift = len(inserted) - (end - place)
            bounds, at = {}, before
            for i, x in enumerate(pieces):
                at += len(x)
                bounds[at] = i + 1
            found, rest, done = [], len(pieces), False
            for m in self.split(new + ahead, start - before):
                if m.end() > len(new) or more and m.end() + LOOK_AHEAD > len(new) + len(ahead) and nxt < len(self.blocks):
                    break
                found.append(m.group())
                was = m.end() + before - shift
                if was >= end and m.end() + before >= place + len(inserted) and was in bounds:
                    rest, done = bounds[was], True
                    break
            if done or not more and sum(map(len, found)) == len(new) - (start - before):
                break
            last = min(last + 1, len(self.blocks) - 1)
        self.recounted += sum(map(len, found))
        numbers = [n for block in self.counts[first : last + 1] for n in block]
        held = pieces[:kept] + found + (pieces[rest:] if done else [])
        numbers = numbers[:kept] + list(map(self.count, found)) + (numbers[rest:] if done else [])
        if len(held) > 8 * BLOCK:  # split what was edited; the sums of all other blocks stay
            known = list(zip(self.blocks, self.counts, self.chars[self.leaves :], self.tokens[self.leaves :]))
            self.lay([*known[:first], *in_blocks(held, numbers), *known[last + 1 :]])
            return
        self.blocks[first : last + 1] = [held] + [[] for _ in range(last - first)]
        self.counts[first : last + 1] = [numbers] + [[] for _ in range(last - first)]
        nodes = set()
        for i in range(first, last + 1):
            self.sum_block(i)
            nodes.add((self.leaves + i) // 2)
        while nodes and 0 not in nodes:
            for at in nodes:
                self.sum_node(at)
            nodes = {at // 2 for at in nodes}


def piece_counter(path: str, pattern: str) -> Callable[[str], int]:
    """Tokens of a pre-token, by the merge ranks in ``path``."""
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    known: dict[str, int] = {}

    def count(piece: str) -> int:
        n = known.get(piece)
        if n is None:
            if len(known) >= CACHE:
                known.clear()
            n = known[piece] = len(encode(piece))
        return n

    return count


def lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column of whole numbers; null lists are empty."""
    at, values = column.offsets.to_pylist(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(at, at[1:])]


def over_trees(rows: DataFrame, path: str, pattern: str, from_col: str, edits_col: str | None, keep: bool) -> DataFrame:
    """``rows`` with a tree for each, of its text or a kept one, edited and counted; kept again if ``keep``.

    Without the columns of text and edits; columns of the names that are made are replaced.
    """
    small_batches(rows.sparkSession)
    made = list(MADE if edits_col else MADE[:1])
    names = [c for c in rows.columns if c not in (from_col, edits_col, TREE, *made)]
    of_text = isinstance(rows.schema[from_col].dataType, T.StringType)
    kinds = [f for f in rows.schema if f.name in names] + [T.StructField(x, T.LongType()) for x in made]
    kinds = T.StructType(kinds + ([T.StructField(TREE, KEPT)] if keep else []))
    from_at, edits_at = rows.columns.index(from_col), rows.columns.index(edits_col) if edits_col else None
    kept_at = [i for i, c in enumerate(rows.columns) if c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        count, split = piece_counter(path, pattern), regex.compile(pattern).finditer
        for batch in batches:
            held = batch.column(from_at)
            texts = (held if of_text else held.field("text")).to_pylist()
            known = [None] * len(texts) if of_text else list(zip(lists(held.field("lengths")), lists(held.field("counts")), strict=True))
            edits = batch.column(edits_at).to_pylist() if edits_at is not None else [None] * len(texts)
            out, trees = [], []
            for text, tree, changes in zip(texts, known, edits, strict=True):
                tree = TokenTree(text or "", split, count, tree)
                before = tree.n_tokens
                for e in changes or []:
                    if e is not None:
                        tree.edit(e["place"] or 0, e["removed"] or 0, e["inserted"] or "")
                out.append((before, tree.n_tokens, tree.n_chars, tree.recounted))
                if keep:
                    trees.append((tree.text(), *tree.kept()))
            columns = [batch.column(i) for i in kept_at] + [pa.array([x[i] for x in out], pa.int64()) for i in range(len(made))]
            if keep:
                parts = [pa.array([x[i] for x in trees], f.type) for i, f in enumerate(KEPT_ARROW)]
                columns.append(pa.StructArray.from_arrays(parts, fields=list(KEPT_ARROW)))
            yield pa.RecordBatch.from_arrays(columns, names=kinds.names)

    return rows.mapInArrow(run, kinds)


def token_trees(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with n_tokens and token_tree: the trees to keep.  Columns of these names are replaced."""
    return over_trees(docs, path, pattern, text_col, None, keep=True)


def edited_trees(trees: DataFrame, path: str, pattern: str, edits_col: str = "edits", keep: bool = True) -> DataFrame:
    """The trees after ``edits_col`` (see :func:`token_counts`), with the counts of before and after; other columns pass.

    Path and pattern are those that the trees were made with.  ``keep=False`` leaves the trees out.
    """
    return over_trees(trees, path, pattern, TREE, edits_col, keep)


def token_counts(docs: DataFrame, path: str, pattern: str, text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """``docs`` without text and edits, with n_tokens, n_tokens_after (all edits, in order), n_chars_after, recounted_chars.

    edits: array<struct<place, removed, inserted>>; places count characters of the text as edited so far.  Columns of the
    names that are made are replaced.  No tree is kept.
    """
    return over_trees(docs, path, pattern, text_col, edits_col, keep=False)


def derived_edits(text: Column, key: Column, many: int = 4) -> Column:
    """Edits by a hash of the document: a passage of its own put elsewhere, in place of some characters."""
    n = F.length(text)

    def one(i: Column) -> Column:
        place = F.pmod(F.xxhash64(key, i), n + 1)
        passage = F.substr(text, (F.pmod(F.xxhash64(i, key), n + 1) + 1).cast("int"), F.pmod(F.hash(key, i), F.lit(60)))
        return F.struct(place.alias("place"), F.pmod(F.hash(i, key), F.lit(40)).cast("long").alias("removed"), passage.alias("inserted"))

    return F.transform(F.sequence(F.lit(1), F.lit(many)), one)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    trees = stage(spark, token_trees(docs, path, pattern), "trees")
    edits = derived_edits(F.col(f"{TREE}.text"), F.col("doc_id"))
    return edited_trees(trees.withColumn("edits", edits), path, pattern, keep=False)
