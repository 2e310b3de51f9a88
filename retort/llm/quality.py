"""Quality rules with a bitmask ledger: each rule is evaluated once, policies and ablations only read bits.

``ledger`` measures every text and stores, beside the measurements, one long whose bit i says that rule i
failed. A policy is a named, versioned set of rules, that is a mask; a row is kept if ``failed & mask`` is
zero. Another policy, or the same without some rule, needs no second look at the texts: ``ablations`` counts
rows by their failure bits, of which there are at most 2^rules, and reads everything from those counts.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retort.llm.common import bytes_of, per_text

BLANKS = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
LETTERS = CAPITALS + bytes(range(97, 123))
#: Letters of any script become "a": ASCII letters and every byte of a longer code point.
LETTER_OR_NOT = bytes(97 if c in LETTERS or c > 127 else c if c in BLANKS else 46 for c in range(256))

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_letters", "n_capitals")

#: Rules by bit, in this order; a new rule takes the next bit, so that stored ledgers stay readable. Each is
#: written as Spark SQL over the measurements, in whole numbers.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "few_letter_words": "100 * n_letter_words < 80 * n_words",
    "capitals": "100 * n_capitals > 50 * n_letters",
    "many_words": "n_words > 100000",
}
BITS = {rule: 1 << i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A versioned set of rules; a row that fails any of them is rejected."""
    name: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in set(self.rules))


BASE = Policy("base-1", ("few_words", "repeated_words"))
#: Long documents pass: only what speaks against the text itself counts.
PROSE = Policy("prose-2", tuple(r for r in RULES if r != "many_words"))
EVERY = Policy("every-1", tuple(RULES))
POLICIES = (BASE, PROSE, EVERY)


def repeated(words: list[bytes], size: int = 3) -> int:
    """How many of the words lie in a window of ``size`` words that occurs twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    gram, different = ids[:n], len(number)
    for j in range(1, size):  # numbered anew after each word, so the key never outgrows 64 bits
        gram, times = np.unique(gram * len(number) + ids[j : j + n], return_inverse=True, return_counts=True)[1:]
        different = len(times)
    if different == n:
        return 0
    twice = np.zeros(n + size, np.int64)
    at = np.flatnonzero(times[gram] > 1)
    np.add.at(twice, at, 1)
    np.add.at(twice, at + size, -1)
    return int((np.cumsum(twice) > 0).sum())


def measure(text: bytes) -> tuple[int, ...]:
    """MEASURES of one text in UTF-8."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    chars = len(text) - sum(text.count(b) for b in BLANKS_ONE) - (0 if text.isascii() else followers(text))
    without = lambda drop: len(text) - len(text.translate(None, drop))
    letterless = sum(b"a" not in w for w in text.translate(LETTER_OR_NOT).split())
    return (len(words), chars, without(SYMBOLS), len(lines), len(lines) - len(set(lines)), repeated(words),
            len(words) - letterless, without(LETTERS), without(CAPITALS))


BLANKS_ONE = [bytes([b]) for b in BLANKS]
FOLLOWERS = bytes(range(0x80, 0xC0))


def followers(text: bytes) -> int:
    """Bytes of UTF-8 that continue a code point."""
    return len(text) - len(text.translate(None, FOLLOWERS))


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, MEASURES, failed) of every row: all rules, each evaluated once on the whole text.

    Words are separated by ASCII blanks; lines are split at line feeds and count if they hold a word. A null
    text has no words, like an empty one; null ids and repeated rows have a row each; an empty table gives
    none; other columns are not read."""
    def run(batch):
        found = [measure(t) for t in bytes_of(batch)]
        cols = [pa.array(list(c), pa.int64()) for c in (zip(*found) if found else [[]] * len(MEASURES))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *cols], names=["doc_id", *MEASURES])

    measured = per_text(docs, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES), run)
    bits = [F.when(F.expr(rule), F.lit(bit)).otherwise(0).cast("long") for rule, bit in zip(RULES.values(), BITS.values())]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed)


def rejected(policy: Policy) -> Column:
    """The failure bits that count under ``policy``; zero means kept."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long"))


def judge(rows: DataFrame, policy: Policy = PROSE) -> DataFrame:
    """The ledger with the policy's verdict: ``policy``, ``kept``, and in ``sole_rule`` the one rule without
    which a rejected row would be kept (null where there are none or several)."""
    sole = F.lit(None).cast("string")
    for rule in policy.rules:
        sole = F.when(rejected(policy) == BITS[rule], F.lit(rule)).otherwise(sole)
    return rows.withColumn("policy", F.lit(policy.name)).withColumn("kept", rejected(policy) == 0).withColumn("sole_rule", sole)


def ablations(rows: DataFrame, policies: Iterable[Policy] = POLICIES) -> DataFrame:
    """For each policy and each of its rules: (policy, rule, n_docs, n_failed, n_sole, n_kept, n_kept_without).

    Counts of rows that fail the rule, that fail no other rule of the policy, that the policy keeps, and that
    it would keep without the rule. One aggregate by failure bits, partial in each task, then sums over at
    most 2^rules rows. An empty ledger gives counts of zero."""
    spark = rows.sparkSession
    table = [(p.name, r, p.mask, BITS[r]) for p in policies for r in p.rules]
    wanted = spark.createDataFrame(table, "policy string, rule string, mask long, bit long")
    masks = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    # every row of bits meets every rule: both tables are bounded by the number of rules
    each = masks.select("failed", "n", F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(wanted.columns, row)]) for row in table])).alias("w")).select("failed", "n", "w.*")
    counted = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    sums = each.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"), counted(F.expr("failed & bit != 0")).alias("n_failed"), counted(F.expr("failed & mask = bit")).alias("n_sole"),
        counted(F.expr("failed & mask = 0")).alias("n_kept"), counted(F.expr("failed & (mask & ~bit) = 0")).alias("n_kept_without"))
    return wanted.select("policy", "rule").join(sums, ["policy", "rule"], "left").na.fill(0)


def digest(rows: DataFrame) -> DataFrame:
    """The contract's columns from ``judge``: ``kept`` is false for rows that the base policy rejects."""
    base = rejected(BASE) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
                       (F.col("kept") & ~base).alias("kept"), "policy", "failed", "sole_rule")
