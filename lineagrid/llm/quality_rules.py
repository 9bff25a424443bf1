"""Quality rules as a ledger of failure bits.

``measure`` reads each text once. ``ledger`` evaluates every rule once over the
measurements and stores one bit for each that failed. Policies are versions of
"which rules count": masks, applied by bitwise and, so a new version needs no
text. ``ablations`` groups the ledger by its bits, reduced map-side to at most
2 ** len(RULES) rows, and derives what each rule does in each policy from those.

Defined cases: a null or empty text has no word and so fails ``few_words``;
rules on shares hold for a text without words; a repeated row gets a repeated
result; an empty table gives an empty ledger and no ablation counts; columns
other than id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineagrid.llm.common import begin, pieces, stored

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
MEASURED = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_same_word",
]
_STEP = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in windows of ``window`` words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        sums = np.zeros(n, np.uint64)
        for k in range(window):
            sums = sums * _STEP + (numbers[k : k + n] + np.uint64(1)) * _STEP
    # equal windows have equal sums: no equal sums, no repeated window
    if len(np.unique(sums)) == n:
        return 0
    rows = np.lib.stride_tricks.sliding_window_view(numbers, window)
    _, which, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[which.reshape(-1)] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _numbers(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        repeated_lines(text),
        repeated_words(words),
        sum(map(eq, words, words[1:])),
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begin("quality")
    for batch in pieces(batches):
        rows = [_numbers(text or "") for text in batch.column("_llm_text").to_pylist()]
        columns = np.array(rows, np.int64).reshape(-1, len(MEASURED)).T
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *[pa.array(c) for c in columns]], [*batch.schema.names, *MEASURED]
        )


def measure(rows: DataFrame) -> DataFrame:
    """Add the measurements of every whole ``_llm_text``."""
    added = [T.StructField(name, T.LongType()) for name in MEASURED]
    return rows.mapInArrow(_measure, T.StructType([*rows.schema.fields, *added]))


#: name of each rule, in the order of the bits, and when it fails. Whole numbers only.
FAILS = {
    "few_words": lambda c: c("n_words") < 20,
    "repeats": lambda c: 100 * c("n_repeat_words") > 30 * c("n_words"),
    "symbols": lambda c: 10 * c("n_symbols") > 3 * c("n_words"),
    "short_words": lambda c: c("word_chars") < 2 * c("n_words"),
    "long_words": lambda c: c("word_chars") > 20 * c("n_words"),
    "dup_lines": lambda c: 20 * c("n_dup_lines") > c("n_words"),
    "same_words": lambda c: 10 * c("n_same_word") > 3 * c("n_words"),
}
RULES = list(FAILS)
BASE = ("few_words", "repeats")
POLICIES = {"base": BASE, "v1": (*BASE, "symbols", "same_words"), "v2": tuple(RULES)}


def mask(names: tuple[str, ...]) -> int:
    return sum(1 << RULES.index(name) for name in names)


def failed_bits() -> Column:
    bits = [F.when(fails(F.col), F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(FAILS.values())]
    return reduce(Column.bitwiseOR, bits).cast("long")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, measurements, and ``failed``: the bits of the rules that failed."""
    rows = docs.select(docs["doc_id"], docs["text"].alias("_llm_text"))
    return measure(rows).drop("_llm_text").withColumn("failed", failed_bits())


def stored_ledger(docs: DataFrame) -> DataFrame:
    """The ledger, written once; policies and ablations read it and no text again."""
    return stored(ledger(docs), "ledger")


def fails_policy(version: str, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask(POLICIES[version]))) != 0


def apply_policy(entries: DataFrame, version: str) -> DataFrame:
    """Add ``base_failed`` and ``kept`` under a policy; what fails the base is never kept."""
    return entries.withColumn("base_failed", fails_policy("base")).withColumn(
        "kept", ~(F.col("base_failed") | fails_policy(version))
    )


def ablations(entries: DataFrame) -> DataFrame:
    """For each policy and rule of it: rows rejected by the policy, rows the rule
    fails, rows that only this rule rejects (kept without it)."""
    pairs = F.array(*[
        F.struct(
            F.lit(version).alias("policy"), F.lit(name).alias("rule"),
            F.lit(mask(names)).alias("mask"), F.lit(mask((name,))).alias("bit"),
        )
        for version, names in POLICIES.items() for name in names
    ])
    hit = F.col("failed").bitwiseAND(F.col("p.mask"))
    rows = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return (
        entries.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("p", F.explode(pairs))
        .groupBy("p.policy", "p.rule").agg(
            rows(hit != 0).alias("n_rejected"),
            rows(hit.bitwiseAND(F.col("p.bit")) != 0).alias("n_failed"),
            rows(hit == F.col("p.bit")).alias("n_only_this"),
        )
    )


def keep_documents(docs: DataFrame, version: str = "v1") -> DataFrame:
    """The rows of ``docs`` that pass a policy, with all their columns, in one pass."""
    rows = docs.select(F.struct("*").alias("_llm_row"), docs["text"].alias("_llm_text"))
    judged = apply_policy(measure(rows).withColumn("failed", failed_bits()), version)
    return judged.filter("kept").select("_llm_row.*")
