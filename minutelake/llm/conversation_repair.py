"""Conversation structure repair: the cheapest edits that make every conversation an optional system turn and pairs of
user's and assistant's turns, with an audit of what was found and done (``audit_dp`` holds the dynamic program).

Rows are put in order by a range partitioning on (conversation, turn, role, text), so a conversation that holds a third of
all rows is spread over many tasks. Each task cuts its rows into stretches of at most ``STRETCH`` rows; the dynamic
program sums every stretch up as a table of best ways from state to state, the tables of a conversation are put together
in order, and the letters of each stretch are read along its rows again. Equal rows (one turn said many times) are counted
before anything is shuffled. Only the digest of a repaired conversation, and its audit string, pass through one task,
row by row: both are defined over a whole conversation.

Edge cases: a null role or text counts as one space; a null conversation is a conversation; null turns come first. Rows of
one turn are ordered by role and text. An empty role has no initial. Repeated rows are duplicates. Very long texts pass
through whole, never more than one batch of rows at a time. An empty table gives no row. Other columns of the table don't
matter, whatever their names; none comes back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm import audit_dp
from minutelake.llm.common import by_group, small_batches, stage, table

#: rows of a conversation that one dynamic program covers
STRETCH_BITS = 12
#: blank characters
BLANK = " \t\n\x0b\x0c\r"
ENDS = ".!?"


def stripped(text: Column) -> Column:
    """``text`` without blanks at its ends."""
    return F.call_function("btrim", text, F.lit(BLANK))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the faults of the trial planted, one row in five or so (see ``op11``)."""

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), F.pmod(F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")), F.lit(20)).alias("fault"))
    fault = F.col("fault")
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    rows = rows.where(fault != 0).select("conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1).cast("int"))))
    return rows.select("conv_id", "turn", "role", "text")


def key(conv_id: str) -> Column:
    """A conversation's key, never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies, seen): rows of a conversation once, and whether an earlier turn said the same."""
    rows = rows.select(key("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    once = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    once = once.withColumn("said", F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256))
    more = once.groupBy("conv", "said").agg(F.min(F.struct(F.col("turn").isNotNull().alias("later"), "turn")).alias("first"), F.count("*").alias("turns"))
    more = more.where("turns > 1").select("conv", "said", F.col("first.turn").alias("first_turn"))
    found = once.join(more.withColumn("there", F.lit(True)), ["conv", "said"], "left")
    return found.select("conv", "turn", "role", "text", "copies", (F.coalesce("there", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first_turn"))).alias("seen"))


ROW = "conv string, at long, starts int, turn long, role string, text string, initial string, blank boolean, duplicate boolean, truncated boolean"


def in_order(rows: DataFrame) -> DataFrame:
    """A row for each turn with its place (``at``, rising within a conversation), its fault, and where a conversation starts.

    starts: 1 where a conversation starts, 2 where it may have started in an earlier task, else 0. Turns that are copies
    of one before have no text, they go anyway.
    """
    body = stripped(F.col("text"))
    copies = rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    order = ["conv", "turn", "role", "text", "copy"]  # nulls come first
    copies = copies.withColumn("blank", body == "").withColumn("duplicate", (body != "") & (F.col("seen") | (F.col("copy") > 1)))
    copies = copies.withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & (F.instr(F.lit(ENDS), F.right(body, F.lit(1))) == 0))
    placed = copies.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = placed.select("conv", "at", "turn", "role", F.when(~F.col("blank") & ~F.col("duplicate"), F.col("text")).alias("text"), F.substring("role", 1, 1).alias("initial"), "blank", "duplicate", "truncated")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            starts = []
            for conv in batch.column(0).to_pylist():
                starts.append(2 if before is None else int(conv != before))
                before = conv
            columns = batch.columns
            yield pa.RecordBatch.from_arrays([*columns[:2], pa.array(starts, pa.int32()), *columns[2:]], names=[f.split(" ")[0] for f in ROW.split(", ")])

    small_batches(rows.sparkSession)
    return placed.mapInArrow(run, ROW)


LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
WAYS = "array<struct<begin: int, end: int, cost: long, letters: string>>"
TABLES = f"conv string, stretch long, first {WAYS}, later {WAYS}, opens string, closes string, illegal long, blank long, duplicate long, truncated long"


def tables(placed: DataFrame) -> DataFrame:
    """Each stretch of a conversation, summed up."""
    rows = placed.select("conv", F.shiftright("at", STRETCH_BITS).alias("stretch"), "at", "starts", "initial", "blank", "duplicate", "truncated")

    def listed(found: audit_dp.Table) -> list[dict]:
        return [{"begin": a, "end": b, "cost": cost, "letters": letters} for (a, b), (cost, letters) in found.items()]

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("at")
        initials = part["initial"].tolist()
        read = list(zip(initials, (part["blank"] | part["duplicate"]).tolist(), part["truncated"].tolist()))
        start = int(part["starts"].max())
        row = {
            "conv": part["conv"].iloc[0],
            "stretch": int(part["stretch"].iloc[0]),
            "first": listed(audit_dp.table_of(read, True)) if start else None,
            "later": listed(audit_dp.table_of(read, False)) if start != 1 else None,
            "opens": initials[0],
            "closes": initials[-1],
            "illegal": sum(pair not in LEGAL for pair in zip(initials, initials[1:])),
        }
        return pd.DataFrame([row | {c: int(part[c].sum()) for c in ("blank", "duplicate", "truncated")}])

    return by_group(rows, ["conv", "stretch"], one, TABLES)


JOINED = "conv string, stretch long, letters string, state int, opening boolean, cost long, illegal long, blank long, duplicate long, truncated long, audit string"


def put_together(summed: DataFrame) -> DataFrame:
    """The audit of each conversation (stretch null), and for each of its stretches the letters and the state it begins in."""
    names = [f.split(" ")[0] for f in JOINED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, ways, numbers, counts, closes = None, None, [], {}, None

        def done() -> Iterator[pa.RecordBatch]:
            cost, found = ways.end()
            rows = [dict.fromkeys(names) | {"conv": conv, "stretch": n, "letters": letters, "state": state, "opening": i == 0} for i, (n, (letters, state)) in enumerate(zip(numbers, found, strict=True))]
            rows.append(dict.fromkeys(names) | counts | {"conv": conv, "cost": cost, "audit": "".join(letters for letters, _ in found)})
            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                if row["conv"] != conv:
                    if conv is not None:
                        yield from done()
                    conv, ways, numbers, closes = row["conv"], audit_dp.Stretches(), [], None
                    counts = dict.fromkeys(("illegal", "blank", "duplicate", "truncated"), 0)
                table = row["first"] if not numbers else row["later"]
                ways.add({(w["begin"], w["end"]): (w["cost"], w["letters"]) for w in table})
                for c in counts:
                    counts[c] += row[c]
                if numbers:
                    counts["illegal"] += (closes, row["opens"]) not in LEGAL
                closes = row["closes"]
                numbers.append(row["stretch"])
        if conv is not None:
            yield from done()

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    SCHEMA = pa.schema([(f.split(" ")[0], kinds[f.split(" ")[1]]) for f in JOINED.split(", ")])
    return summed.repartition("conv").sortWithinPartitions("conv", "stretch").mapInArrow(run, JOINED)


TURNS = "conv string, at long, role string, text string, edit string"


def repaired_turns(placed: DataFrame, joined: DataFrame) -> DataFrame:
    """The turns of each repaired conversation, in order within a task, with the edit that made them (K, R or I)."""
    letters = joined.where("stretch IS NOT NULL").select("conv", "stretch", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("initial"), "letters", "state", "opening")
    rows = placed.select("conv", F.shiftright("at", STRETCH_BITS).alias("stretch"), "at", "role", "text", "initial", F.lit(None).cast("string").alias("letters"), F.lit(None).cast("int").alias("state"), F.lit(None).cast("boolean").alias("opening"))
    # a stretch's letters come before its rows
    both = letters.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "stretch", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = None
        schema = pa.schema([("conv", pa.string()), ("at", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
        for batch in batches:
            made = []

            def insert(row: dict) -> None:
                made.extend({"conv": row["conv"], "at": row["at"], "role": audit_dp.ROLE[x], "text": "", "edit": audit_dp.INSERT} for x in replay.inserted())

            for row in batch.to_pylist():
                if row["letters"] is not None:
                    replay = audit_dp.Replay(row["letters"], row["state"])
                    if row["opening"]:
                        insert(row)
                    continue
                edit, new = replay.row(row["initial"])
                if edit != audit_dp.DELETE:
                    made.append({"conv": row["conv"], "at": row["at"], "role": audit_dp.ROLE.get(new, row["role"]), "text": row["text"], "edit": edit})
                insert(row)
            yield pa.RecordBatch.from_pylist(made, schema=schema)

    small_batches(placed.sparkSession)
    return both.mapInArrow(run, TURNS)


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of ``repaired_turns``, read as they come: one row of a conversation after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held = None, None
        for batch in batches:
            out = []
            for row in batch.select(["conv", "role", "text"]).to_pylist():
                if row["conv"] != conv:
                    if conv is not None:
                        out.append((conv, held.hexdigest()))
                    conv, held = row["conv"], hashlib.sha256()
                else:
                    held.update(b"\n")
                held.update(f"{row['role']}:{row['text']}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.string())], names=["conv", "repaired_sha256"])
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([held.hexdigest()])], names=["conv", "repaired_sha256"])

    return turns.mapInArrow(run, "conv string, repaired_sha256 string")


def repair(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(audits, turns, gaps) of ``rows`` (conv_id, turn, role, text): an audit for each conversation, its repaired turns, its gaps."""
    once = stage(spark, distinct_rows(rows), "distinct_rows")
    turns = once.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    placed = stage(spark, in_order(once), "placed")
    joined = stage(spark, put_together(tables(placed)), "audits")
    audits = joined.where("stretch IS NULL").select("conv", "illegal", "blank", "duplicate", "truncated", "cost", "audit")
    return audits, repaired_turns(placed, joined), turns


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    audits, turns, gaps = repair(spark, damaged(conversations))
    found = conversations.select("conv_id").distinct().withColumn("conv", key("conv_id")).join(audits, "conv", "left").join(gaps, "conv", "left").join(digests(turns), "conv", "left")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
