"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one long in which
bit i says that rule i failed. A policy is a versioned mask over the rules: it is applied, changed or
ablated on the ledger with bitwise operations and never reads a text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
# Rules by bit; each says when a document fails. All numbers are whole, so any engine agrees.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "very_long": "n_words > 1000000",
}
_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Policy:
    """The rules that decide, and how many of them a document may fail."""

    name: str
    version: int
    rules: tuple[str, ...]
    may_fail: int = 0

    @property
    def mask(self) -> int:
        return sum(1 << i for i, rule in enumerate(RULES) if rule in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
CORPUS = Policy("corpus", 1, ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words"))


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that the text has twice or more, the first time included."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    _, pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
    _, back, counts = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[back] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACE)),
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def ledger(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`doc_id`, the measurements and `failed`, the bits of the rules that fail; one row per row.

    A null text measures like an empty one: no words, which fails `few_words`. Texts are measured whole, one at
    a time; a row stands for itself, so repeated rows, ties and null ids each give a row, and no rows give none.
    Other columns are not read, whatever their names."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measure(t.as_py()) for t in batch.column("text")], np.int64).reshape(-1, len(MEASURES))
            columns = [pa.array(np.ascontiguousarray(found[:, i])) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *MEASURES])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    measured = rows.mapInArrow(each, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = [F.when(F.expr(fails), F.lit(1 << i)).otherwise(0).cast("long") for i, fails in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed)


def passes(policy: Policy, failed: Column | None = None) -> Column:
    failed = F.col("failed") if failed is None else failed
    return F.bit_count(failed.bitwiseAND(F.lit(policy.mask).cast("long"))) <= policy.may_fail


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with `kept`, `policy` and `policy_version`."""
    return rows.withColumns(
        {"kept": passes(policy), "policy": F.lit(policy.name), "policy_version": F.lit(policy.version)}
    )


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that the policy keeps with
    and without it. Documents are first counted by their bits: at most 2^rules counts leave a task."""
    counts = rows.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(RULES) if r in policy.rules]))
    at = counts.select("bits", "n", each.alias("r")).select("bits", "n", "r.*")
    has = F.col("bits").bitwiseAND(F.col("bit")) != 0
    without = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not("bit"))) <= policy.may_fail
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    return at.groupBy("rule").agg(
        total(has).alias("n_failed"),
        total(F.col("bits") == F.col("bit")).alias("n_failed_alone"),
        total(F.bit_count("bits") <= policy.may_fail).alias("n_kept"),
        total(without).alias("n_kept_without"),
    )
