"""Toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text are the hashes of its distinct lower-case words, pairs of
neighbouring words, pairs with one word between, and beginnings of longer words (for
languages that inflect and compound). The model is learnt one
document at a time with a rate of its own for each coordinate; L1 keeps most
weights at zero, so what is broadcast is a short list of (feature, weight),
never more than ``2 ** BITS`` of them.

Learning takes at most ``max_rows`` labelled rows, those with the smallest hash of
their id, and runs in one task over their features; scoring reads every text.

Defined cases: a null or empty text has no feature and scores by the intercept
alone; several labels of one id count as toxic if one does; a null label is no
label; without a labelled row every score is 0; a repeated row gets a repeated
score; language, source and id are no features; other columns play no part.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagrid.llm.common import mixed, pieces, texts, word_hashes

BITS = 20
MAX_ROWS = 20_000
EPOCHS = 3
#: rate and its offset, L1, L2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.1
STEM = 5
_WORD = re.compile(r"\w+")


def features(text: str) -> np.ndarray:
    """Sorted distinct feature numbers from 1; 0 is the intercept."""
    words = _WORD.findall(text.lower())
    stems = [w[:STEM] for w in words if len(w) > STEM]
    one, stem = (
        np.fromiter((word_hashes[w.encode()] for w in listed), np.uint64, len(listed))
        for listed in (words, stems)
    )
    two = mixed(one[:-1] * np.uint64(3) + one[1:])
    skip = mixed(one[:-2] * np.uint64(5) + one[2:])
    stem = mixed(stem * np.uint64(7))
    every = np.concatenate([one, two, skip, stem]) >> np.uint64(64 - BITS)
    return np.unique(np.maximum(every, 1)).astype(np.int32)


class Ftrl:
    """The learner: per coordinate the sum of adjusted gradients and of squares."""

    def __init__(self):
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        beyond = np.abs(z) - np.where(at == 0, 0.0, L1)
        scale = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(beyond > 0, -np.sign(z) * beyond / scale, 0.0)

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / ALPHA * w


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        found = [features(text).tobytes() for text in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.binary())],
            ["place", "toxic", "at"],
        )


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [
        (np.append(np.int32(0), np.frombuffer(at, np.int32)), float(toxic))
        for batch in batches
        for toxic, at in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
    ]
    if rows:
        model = Ftrl()
        for _ in range(EPOCHS):
            for at, label in rows:
                model.learn(at, label)
        weights = model.weights(np.arange(1 << BITS))
        at = np.union1d(np.flatnonzero(weights), [0]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(weights[at])], ["feature", "weight"]
        )


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> list[tuple[int, float]]:
    """(feature, weight) of the weights that are not zero, the intercept first; empty
    without labelled rows. ``labels``: doc_id, toxic (0 or 1 in any type of number, a
    boolean, or null for unknown)."""
    labelled = labels.select(
        labels["doc_id"].alias("_id"), labels["toxic"].cast("int").alias("toxic")
    ).filter(
        "toxic IS NOT NULL"
    ).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    place = F.xxhash64(F.lit("train"), "_id")
    sample = labelled.withColumn("place", place).orderBy("place", "_id").limit(max_rows)
    rows = texts(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select(
        "place", "toxic", "text"
    )
    found = rows.mapInArrow(_features, "place long, toxic int, at binary").repartition(1)
    model = found.sortWithinPartitions("place", "at").mapInArrow(_train, "feature int, weight double")
    return sorted((r["feature"], r["weight"]) for r in model.collect())


def score(docs: DataFrame, model: list[tuple[int, float]]) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text."""
    rows = texts(docs)
    sent = docs.sparkSession.sparkContext.broadcast(
        (np.array([f for f, _ in model], np.int32), np.array([w for _, w in model]))
    )

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values = sent.value
        weights = np.zeros(1 << BITS)
        weights[at] = values
        for batch in pieces(batches):
            found = [
                float(sigmoid(weights[0] + weights[features(text)].sum())) if len(at) else 0.0
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scores, f"doc_id {kind}, score double")


def held_out(doc_id: Column) -> Column:
    """One id in five, by checksum, is kept from learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
