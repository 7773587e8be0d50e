"""Operator 6: quality classifier, a hashed word n-gram logistic regression.

Weights are learned by follow-the-regularized-leader (one gradient step per example, with
a rate of its own for each slot and an L1 term that keeps most slots at zero), on at most
``TRAIN_ROWS`` labelled rows outside the held-out third. Scoring is a sparse dot product
of a text's slots with the weights, in Spark tasks.

Null and empty texts have no slots and get the score of the bias alone. Without any usable
label every score is 0.5. Repeated rows are scored alike; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalfed.llm.common import remainder
from tidalfed.llm.features import BITS, labelled_sample, ngrams

#: Bound of the sample that weights are fitted on.
TRAIN_ROWS = 6000
HOLD_OUT = (3, 1)


@dataclass
class Leader:
    """Weights kept as the leader's sums: ``z`` of gradients, ``n`` of squared gradients."""

    bits: int = BITS
    rate: float = 1.0
    smooth: float = 1.0
    l1: float = 0.3
    l2: float = 0.01

    def __post_init__(self):
        self.z = np.zeros((1 << self.bits) + 1)  # the last slot is the bias
        self.n = np.zeros((1 << self.bits) + 1)

    def weights(self, slots=slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        step = (self.smooth + np.sqrt(n)) / self.rate + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: float) -> None:
        w = self.weights(slots)
        gradient = (sigmoid(w @ values) - label) * values
        n = self.n[slots]
        grown = n + gradient * gradient
        self.z[slots] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.rate * w
        self.n[slots] = grown


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def example(slots: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and their values: counts over the root of their number, and the bias."""
    found, counts = np.unique(slots, return_counts=True)
    values = counts / max(np.sqrt(len(slots)), 1.0)
    return np.append(found, 1 << bits), np.append(values, 1.0)


def slots_of(sample: DataFrame, featurize, bits: int) -> list[tuple[np.ndarray, int]]:
    """Slots and label of each sampled text, computed in Spark tasks."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [featurize(t.as_py(), bits).astype("<i4").tobytes()
                     for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), batch.column(1)],
                                             names=["slots", "label"])

    rows = sample.select("_text", F.col("_label").cast("int").alias("_label")).mapInArrow(
        scan, "slots binary, label int").collect()  # bounded by the sample's rows
    examples = [(np.frombuffer(bytes(r["slots"]), "<i4").astype(np.int64), r["label"])
                for r in rows]
    return sorted(examples, key=lambda e: (len(e[0]), e[0].tobytes(), e[1]))


def fit(sample: DataFrame, bits: int = BITS, passes: int = 3, seed: int = 7) -> np.ndarray:
    """Weights by slot, the bias last."""
    leader = Leader(bits)
    examples = [(*example(slots, bits), label)
                for slots, label in slots_of(sample, ngrams, bits)]
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for i in order.permutation(len(examples)):
            leader.learn(*examples[i])
    return leader.weights().astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """doc_id and score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** bits numbers

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            margins = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(1)):
                slots = ngrams(text.as_py() or "", bits)
                margins[i] = w[slots].sum(dtype=np.float64) / max(np.sqrt(len(slots)), 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sigmoid(margins + float(w[-1])))],
                names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        scan, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    modulus, held = HOLD_OUT
    usable = F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), modulus) != held)
    sample = labelled_sample(docs, labels, F.col("quality"), usable, rows)
    scored = score(docs, fit(sample))
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), modulus) == held).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
