"""Quality rules as a ledger of failure bits.

``rule_ledger`` evaluates every rule once per document and stores the measurements and one
integer whose bit i says that rule i failed; ``stored_ledger`` writes that table to the shared
folder. A policy is a named set of rules with a version; ``apply_policy`` is a bitwise test on the
ledger, ``ablation`` tells from the distinct bit patterns alone how many documents each rule of a
policy rejects, and how many it alone rejects, and ``with_sole_rule`` puts that beside the documents.
On a stored ledger none of them reads texts again.

NULL and empty texts have no words: all measurements are 0. A very long text is measured whole, in
the task that reads it, in memory proportional to it. Rows are independent, so repeated
rows, NULL ids and empty tables need no rule. Measurement columns replace input columns of the
same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import materialise
from .common import bounded_batches, utf8

SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``.

    words: runs without ASCII white space; symbols: characters of ``SYMBOLS``; duplicate lines:
    lines with a word that equal an earlier line; repeated words: words inside a three-word
    window that occurs at least twice, the first occurrence included; lines: lines with a word.
    """
    words = text.split()
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, 0
    ink = text.translate(None, _SPACES)
    chars = len(ink) if ink.isascii() else len(ink.decode())
    symbols = len(ink) - len(ink.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    repeats = 0
    if n > 3:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
        if len(numbers) < n:
            pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
            _, window, times = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
            at = np.flatnonzero(times[window] > 1)
            covered = np.zeros(n + 1, np.int32)
            np.add.at(covered, at, 1)
            np.add.at(covered, np.minimum(at + 3, n), -1)
            repeats = int((np.cumsum(covered)[:n] > 0).sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeats, len(lines)


@dataclass(frozen=True)
class Rule:
    """A named test; ``fails`` is a SQL condition over the measurements."""

    name: str
    fails: str


# The place of a rule is its bit and never changes; new rules are appended. At most 63.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * word_chars"),
    Rule("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    Rule("long_words", "word_chars > 40 * n_words"),
    Rule("short_words", "10 * word_chars < 15 * n_words"),
    Rule("no_lines", "n_lines = 0"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    def mask(self) -> int:
        bits = {r.name: 1 << i for i, r in enumerate(RULES)}
        return sum(bits[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
CURRENT = Policy("2", (*BASE.rules, "symbols", "duplicate_lines", "long_words", "short_words"))


def rule_ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the measurements and ``failed_bits`` (long)."""
    bounded_batches(docs.sparkSession)

    @arrow_udf("struct<" + ",".join(f"{m}:long" for m in MEASURES) + ">")
    def measures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            columns = np.array([measure(t) for t in utf8(texts)], np.int64).reshape(-1, len(MEASURES)).T
            yield pa.StructArray.from_arrays([pa.array(c) for c in columns], list(MEASURES))

    kept = [c for c in docs.columns if c != text and c not in (*MEASURES, "failed_bits")]
    measured = docs.select(*kept, measures(F.col(text)).alias("__m")).select(*kept, "__m.*")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed_bits", bits)


def stored_ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``rule_ledger`` written once, for any number of policies; ``session.release`` frees it."""
    return materialise(rule_ledger(docs, text), "ledger")


def fails(policy: Policy, bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask()).cast("long")) != 0


def apply_policy(ledger: DataFrame, policy: Policy, kept: str = "kept") -> DataFrame:
    """The ledger with a boolean column that says whether a document passes the policy."""
    return ledger.withColumn(kept, ~fails(policy))


def ablation(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, and documents that only it rejects.

    Documents are first counted per bit pattern, so only patterns are shuffled.
    """
    patterns = (
        ledger.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy.mask()).cast("long")).alias("bits"))
        .agg(F.count("*").alias("n"))
        .where("bits <> 0")
    )
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(r.name for r in RULES) if r in policy.rules])
    return (
        patterns.withColumn("r", F.explode(rules))
        .where(F.col("bits").bitwiseAND(F.col("r.bit")) != 0)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(F.sum("n").alias("n_failed"), F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_alone"))
    )


def with_sole_rule(ledger: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``sole_rule``, the policy's only rule that a document fails, and ``n_alone``, how many it alone rejects.

    Both are NULL for documents that fail no rule of the policy, or several. The broadcast table has a row per rule.
    """
    masked = F.col("failed_bits").bitwiseAND(F.lit(policy.mask()).cast("long"))
    sole = F.lit(None).cast("string")
    for i, rule in enumerate(RULES):
        sole = F.when(masked == F.lit(1 << i), F.lit(rule.name)).otherwise(sole)
    figures = ablation(ledger, policy).select(F.col("rule").alias("sole_rule"), "n_alone")
    kept = ledger.drop("sole_rule", "n_alone").withColumn("sole_rule", sole)
    return kept.join(F.broadcast(figures), "sole_rule", "left").select(*kept.columns, "n_alone")
