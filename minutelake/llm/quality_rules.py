"""Quality rules: an ordered decision list learned by sequential covering, applied as a Spark expression.

Statistics of every whole text come from one pass. A bounded sample of labelled rows then teaches rules: a rule is a
conjunction of thresholds, grown on two thirds of the sample by the gain in information, pruned on the rest, and kept
if precise enough there; rows that it covers are set aside and the next rule is grown. The rules become one ordered
``CASE WHEN``: the first rule that holds rejects a document.

Edge cases: a null or empty text has no words and fails the base rules. Repeated rows are judged each. Without labels
the list is empty and only the base rules reject. Labels that contradict each other count each; null labels are left
out. Ratios of texts without words are 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm.common import guarded, table, with_text_columns
from minutelake.llm.words import Words

#: labelled rows to learn from (a bounded sample, the same in each run)
SAMPLE_ROWS = 20_000
#: precision that a rule needs on rows held back
PRECISION = 0.97
#: bad rows that a rule has to cover while it grows: a share of them, so many at least; and among rows held back
COVER_SHARE, LEAST_COVER, LEAST_HELD_BACK = 0.0025, 3, 2
MOST_RULES, MOST_TERMS = 12, 3
#: thresholds tried for each statistic
CUTS = 24

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_lines", "n_digits", "n_upper", "n_stops", "n_distinct_words", "n_chars_all"]

#: what rules are made of: name to expression over COUNTS (SQL and pandas agree on it)
FEATURES = {
    "n_words": ("n_words", None),
    "mean_word": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "digit_ratio": ("n_digits", "n_chars_all"),
    "upper_ratio": ("n_upper", "n_chars_all"),
    "stop_ratio": ("n_stops", "n_words"),
    "distinct_ratio": ("n_distinct_words", "n_words"),
}

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
IS_STOP = np.zeros(256, bool)
IS_STOP[list(b".!?")] = True


def count_texts(texts: list[bytes | None]) -> pd.DataFrame:
    """COUNTS of each text."""
    w = Words(texts)
    buf, many = w.buf, w.count

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.astype(np.int64), w.text_start)

    first_byte = (buf & 0xC0) != 0x80
    hashes = w.hashes()
    text_of = np.repeat(np.arange(len(texts)), many)
    repeated, distinct = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    if len(hashes):
        order = np.lexsort((hashes, text_of))
        new = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (text_of[order][1:] != text_of[order][:-1]))
        distinct = np.bincount(text_of[order], weights=new, minlength=len(texts)).astype(np.int64)
    if len(hashes) >= 3:
        at = np.flatnonzero(text_of[:-2] == text_of[2:])
        keys, of = w.grams(hashes, 3)[at], text_of[at]
        order = np.lexsort((keys, of))
        same = (keys[order][1:] == keys[order][:-1]) & (of[order][1:] == of[order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(len(hashes), bool)
        for j in range(3):
            covered[at[twice] + j] = True
        repeated = np.bincount(text_of[covered], minlength=len(texts))
    lines, dups = [], []
    for x in texts:
        held = [y for y in (x or b"").split(b"\n") if y.strip()]
        lines.append(len(held))
        dups.append(len(held) - len(set(held)))
    ends = np.zeros(len(buf), bool)
    ends[w.start + w.length - 1] = True
    return pd.DataFrame({
        "n_words": many, "word_chars": per_text(first_byte & ~w.sep), "n_symbols": per_text(IS_SYMBOL[buf]), "n_dup_lines": dups, "n_repeat_words": repeated,
        "n_lines": lines, "n_digits": per_text((buf >= 48) & (buf <= 57)), "n_upper": per_text((buf >= 65) & (buf <= 90)), "n_stops": per_text(ends & IS_STOP[buf]), "n_distinct_words": distinct,
        "n_chars_all": per_text(first_byte) - 1,
    })


@dataclass(frozen=True)
class Rule:
    """Rejects where every (statistic, at least or at most, threshold) holds."""

    terms: tuple[tuple[str, str, float], ...]

    def holds(self, x: pd.DataFrame) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, side, cut in self.terms:
            out &= (x[name] >= cut if side == ">=" else x[name] <= cut).to_numpy()
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, side, cut in self.terms:
            over, by = FEATURES[name]
            value = F.col(f"{over}__").cast("double")
            if by is not None:
                value = F.when(F.col(f"{by}__") > 0, value / F.col(f"{by}__")).otherwise(0.0)
            out &= value >= cut if side == ">=" else value <= cut
        return out


def ratios(counts: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({k: counts[a].astype(float) if b is None else np.where(counts[b] > 0, counts[a] / counts[b].clip(lower=1), 0.0) for k, (a, b) in FEATURES.items()})


def grow(x: pd.DataFrame, bad: np.ndarray) -> Rule | None:
    """Adds the term with the largest gain of information until the rule covers no good row or nothing gains."""
    inside, terms = np.ones(len(x), bool), []
    least = max(LEAST_COVER, math.ceil(COVER_SHARE * bad.sum()))
    while len(terms) < MOST_TERMS and (~bad[inside]).any():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best, held = 0.0, None
        for name in x.columns:
            values = x[name].to_numpy()[inside]
            marks = bad[inside]
            for cut in np.unique(np.quantile(values[marks], np.linspace(0, 1, CUTS))) if marks.any() else []:
                for side in (">=", "<="):
                    covers = values >= cut if side == ">=" else values <= cut
                    p1 = int(marks[covers].sum())
                    n1 = int(covers.sum()) - p1
                    if p1 < least:
                        continue
                    gain = p1 * (math.log2((p1 + 1) / (p1 + n1 + 1)) - math.log2((p + 1) / (p + n + 1)))
                    if gain > best + 1e-9:
                        best, held = gain, (name, side, float(cut))
        if held is None:
            break
        terms.append(held)
        inside = Rule(tuple(terms)).holds(x)
    return Rule(tuple(terms)) if terms else None


def worth(rule: Rule, x: pd.DataFrame, bad: np.ndarray) -> float:
    """(bad - good) / covered, with a prior of one good row."""
    covers = rule.holds(x)
    return (bad[covers].sum() - (~bad[covers]).sum() - 1) / (covers.sum() + 1)


def prune(rule: Rule, x: pd.DataFrame, bad: np.ndarray) -> Rule:
    """Drops last terms as long as the rule isn't worse on rows held back."""
    best = rule
    for end in range(len(rule.terms) - 1, 0, -1):
        shorter = Rule(rule.terms[:end])
        if worth(shorter, x, bad) >= worth(best, x, bad):
            best = shorter
    return best


def learn(x: pd.DataFrame, bad: np.ndarray, precision: float = PRECISION) -> list[Rule]:
    """Sequential covering: the ordered rules that reject."""
    rules, left = [], np.ones(len(x), bool)
    held_back = np.arange(len(x)) % 3 == 2
    while len(rules) < MOST_RULES:
        growing, testing = left & ~held_back, left & held_back
        if bad[growing].sum() < LEAST_COVER:
            break
        rule = grow(x[growing], bad[growing])
        if rule is None:
            break
        rule = prune(rule, x[testing], bad[testing])
        covers = rule.holds(x)
        seen = covers & testing
        if bad[seen].sum() < LEAST_HELD_BACK or bad[seen].mean() < precision or bad[covers & left].mean() < precision:
            break
        rules.append(rule)
        left &= ~covers
    return rules


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with COUNTS of each whole text, as ``<name>__``."""
    return with_text_columns(docs, "text", lambda texts: count_texts(texts).add_suffix("__").to_dict("series"), ", ".join(f"{c}__ long" for c in COUNTS))


def decision_list(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules learned from up to ``sample_rows`` labelled rows (quality 0: to reject), chosen by a hash of the id."""
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marks), "doc_id")
    rows = with_counts(rows).drop("text")
    rows = rows.orderBy(F.xxhash64(*rows.columns), *rows.columns).limit(sample_rows).toPandas()
    rows.columns = [c.removesuffix("__") for c in rows.columns]
    return learn(ratios(rows), rows["quality"].to_numpy() == 0) if len(rows) else []


def verdicts(rules: list[Rule]) -> dict[str, Column]:
    """base_failed, rule (number of the first rule that holds, from 1; else null) and kept, over ``with_counts``."""
    failed = (F.col("n_words__") < 50) | (100 * F.col("n_repeat_words__") > 50 * F.col("n_words__"))
    chosen = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        chosen = F.when(rule.column(), number).otherwise(chosen)
    return {"base_failed": failed, "kept": ~failed & chosen.isNull(), "rule": chosen}


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the rules reject; their other columns may have any name."""
    docs, back = guarded(docs, "doc_id", "text")
    return back(with_counts(docs).where(verdicts(decision_list(docs, labels))["kept"]))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return judged.select("doc_id", *[F.col(f"{c}__").alias(c) for c in BASE], *[v.alias(k) for k, v in verdicts(decision_list(docs, labels)).items()])
