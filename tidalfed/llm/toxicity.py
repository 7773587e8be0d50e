"""Operator 3: toxicity as graded severity, by cumulative-link ordinal regression.

Grades come from the labels: 0 not toxic, 1 toxic, 2 toxic in a text of low quality. All
grades share one weight per word slot; ordered thresholds cut the score, and
P(grade <= k) = sigmoid(threshold_k - w.x). A text is the set of its distinct words, so a
few such words count the same in a long text as in a short one. The expected severity is
the sum over k of P(grade > k).

The model is fitted on at most ``TRAIN_ROWS`` labelled rows outside the held-out third, on
the words whose texts are toxic far more or less often than chance has it. Null and empty texts have no words and get the
severity of the thresholds alone; without any usable label nothing is flagged. Repeated
rows get equal results; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalfed.llm.common import remainder
from tidalfed.llm.features import BITS, distinct_words, labelled_sample
from tidalfed.llm.quality import sigmoid, slots_of

#: Bound of the sample that the model is fitted on.
TRAIN_ROWS = 8000
HOLD_OUT = (3, 1)
GRADES = 3
STEPS, RATE, FAR, RIDGE = 800, 0.1, 6.0, 0.02


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, slots: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return sigmoid(self.weights[slots].sum(dtype=np.float64) - self.thresholds)


def fit(sample: DataFrame, grades: int = GRADES, bits: int = BITS) -> Ordinal:
    return learn(slots_of(sample, distinct_words, bits), grades, bits)


def learn(examples: list[tuple[np.ndarray, int]], grades: int = GRADES, bits: int = BITS,
          steps: int = STEPS, rate: float = RATE, far: float = FAR) -> Ordinal:
    """Weights and ordered thresholds of least log-loss over all examples, by Adam steps.

    Only slots whose texts have a share of toxic ones that chance explains badly (``far``
    standard deviations from the share of all) get a weight.
    """
    grade = np.array([g for _, g in examples], dtype=np.int64)
    counts = np.bincount(grade, minlength=grades) + 0.5
    below = np.cumsum(counts)[:-1] / counts.sum()
    if not examples:
        return Ordinal(np.zeros(1 << bits, np.float32), np.full(grades - 1, 9.0))
    rows = np.repeat(np.arange(len(examples)), [len(s) for s, _ in examples])
    slots = np.concatenate([s for s, _ in examples])
    share = (grade > 0).mean()
    found = np.bincount(slots, minlength=1 << bits)
    toxic = np.bincount(slots, weights=(grade > 0)[rows], minlength=1 << bits)
    spread = np.sqrt(np.maximum(found * share * (1 - share), 1e-9))
    kept = (np.abs(toxic - found * share) >= far * spread)[slots] & (share * (1 - share) > 0)
    rows, (used, slots) = rows[kept], np.unique(slots[kept], return_inverse=True)
    model = np.concatenate([np.zeros(len(used)), np.log(below / (1 - below))])
    first, second, least = np.zeros_like(model), np.zeros_like(model), 1e-3
    for step in range(1, steps + 1):
        w, thresholds = model[:len(used)], model[len(used):]
        margin = np.bincount(rows, weights=w[slots], minlength=len(examples))
        # Likelihood of a grade: difference of two neighbouring cumulative curves.
        cuts = np.concatenate([[-np.inf], thresholds, [np.inf]])
        low, high = sigmoid(cuts[grade] - margin), sigmoid(cuts[grade + 1] - margin)
        mass = np.maximum(high - low, 1e-9)
        by_low, by_high = low * (1 - low) / mass, high * (1 - high) / mass
        pull = np.bincount(slots, weights=(by_high - by_low)[rows], minlength=len(used)) + RIDGE * w
        edges = [by_low[grade == k + 1].sum() - by_high[grade == k].sum()
                 for k in range(grades - 1)]
        gradient = np.concatenate([pull, edges]) / len(examples)
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient ** 2 - second)
        moved = model - rate * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        for k in range(1, grades - 1):
            moved[len(used) + k] = max(moved[len(used) + k], moved[len(used) + k - 1] + least)
        model = moved
    weights = np.zeros(1 << bits, np.float32)
    weights[used] = model[:len(used)]
    return Ordinal(weights, model[len(used):])


def grade_texts(docs: DataFrame, model: Ordinal, bits: int = BITS) -> DataFrame:
    """doc_id, severity (expected grade), score (P(grade > 0)) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** bits numbers

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            above = np.array([model.above(distinct_words(t.as_py() or "", bits))
                              for t in batch.column(1)]).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(axis=1)),
                 pa.array(np.ascontiguousarray(above[:, 0]))],
                names=["doc_id", "severity", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        scan, "doc_id long, severity double, score double")


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, severity, score, predicted (1: toxic) for every document."""
    modulus, held = HOLD_OUT
    grade = F.when(F.col("toxic") == 0, 0).when(
        F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1))
    usable = F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), modulus) != held)
    graded = grade_texts(docs, fit(labelled_sample(docs, labels, grade, usable, rows)))
    return graded.select(
        "doc_id", (remainder(F.col("doc_id"), modulus) == held).alias("held_out"), "severity",
        "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
