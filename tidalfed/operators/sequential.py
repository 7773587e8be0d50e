"""Row-by-row logistic SGD, for which order matters, as a grouped function.

Each entity trains on its rows in order, ``every`` rows at a time, and reports its model
after each batch. A chain of updates cannot be split: each entity's sorted rows are gone
through one Arrow batch at a time, so memory stays bounded, but a large entity is one long
task. Where that is too slow, the caller may ask for shards of ``shard_rows`` rows, whole
batches each: every entity, of whatever size, is then cut into consecutive runs that train
side by side from the zero model, as further nodes of the same entity would, and their
models are averaged by samples like any other nodes'.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.operators.batches import ORDER, shards


@dataclass
class Learner:
    """A node's model and counters, and the rows it has not trained on yet."""

    weights: np.ndarray
    bias: float = 0.0
    round: int = 0
    initialized: bool = False
    total_samples: int = 0
    anomalies: int = 0
    x: np.ndarray | None = None
    y: np.ndarray = field(default_factory=lambda: np.empty(0, int))

    def __post_init__(self) -> None:
        if self.x is None:
            self.x = np.empty((0, len(self.weights)))

    def feed(self, x: np.ndarray, y: np.ndarray, *, every: int, buffer_rows: int, rate: float,
             alpha: float, minimum: int = S.TRAIN_MINIMUM) -> Iterator[dict]:
        """Take readings in order; train and report whenever a batch is due."""
        at = 0
        while at < len(y):
            end = min(len(y), at + every - self.total_samples % every)
            self.total_samples += end - at
            self.anomalies += int((y[at:end] == 1).sum())
            self.x = np.concatenate([self.x, x[at:end]])[-buffer_rows:]
            self.y = np.concatenate([self.y, y[at:end]])[-buffer_rows:]
            at = end
            if self.total_samples % every or len(self.y) < minimum:
                continue
            if self.initialized or self.y.min() != self.y.max():
                yield self._train(rate, alpha)

    def _train(self, rate: float, alpha: float) -> dict:
        x, y = self.x, self.y.astype(float)
        w, b = self.weights.copy(), self.bias
        decay = 1.0 - rate * alpha
        for features, label in zip(x, y):
            z = min(max(float(features @ w) + b, -S.SIGMOID_CLIP), S.SIGMOID_CLIP)
            slope = rate * (1.0 / (1.0 + np.exp(-z)) - label)
            w = w * decay - slope * features
            b -= slope
        self.weights, self.bias, self.initialized = w, float(b), True
        accuracy = float(np.mean(((x @ w + b) > 0) == (y == 1)))
        report = {
            "round": self.round, "n_samples": len(y), "weights": w.tolist(), "bias": self.bias,
            "accuracy": accuracy, "total_samples": self.total_samples,
            "anomalies_detected": self.anomalies,
        }
        self.round += 1
        self.x, self.y = self.x[:0], self.y[:0]
        return report

    def adopt(self, weights: Sequence[float] | None, bias: float | None) -> None:
        """Continue from a global model; counters and waiting rows are kept."""
        if self.initialized:
            if weights is not None:
                self.weights = np.asarray(weights, dtype=float)
            if bias is not None:
                self.bias = float(bias)


REPORT = ("round int, n_samples bigint, weights array<double>, bias double, accuracy double, "
          "total_samples bigint, anomalies_detected bigint")


def train_sequential(readings: DataFrame, *, features: Sequence[Column],
                     keys: Sequence[str] = ("edge_id",), order: Sequence[str] = ORDER,
                     label: str = "label", every: int = S.TRAIN_EVERY,
                     buffer_rows: int = S.BUFFER_ROWS, rate: float = S.LEARNING_RATE,
                     alpha: float = S.L2_ALPHA, shard_rows: int | None = None,
                     group_rows: int = S.GROUP_ROWS) -> DataFrame:
    """One update per trained batch: ``keys, shard`` and the report of the batch.

    Readings without a feature are no samples; :func:`left_out` counts them.
    """
    keys, dim = list(keys), len(features)
    rows = readings.select(
        *dict.fromkeys([*keys, *order]),
        *[x.alias(f"_x{j}") for j, x in enumerate(features)],
        F.coalesce(label, F.lit(0)).alias("_y"),
    ).dropna(subset=[f"_x{j}" for j in range(dim)])
    if shard_rows is None:
        cut = rows.withColumn("shard", F.lit(0).cast("bigint"))
    elif shard_rows % every:
        raise ValueError(f"shard_rows must be a multiple of every ({every})")
    else:
        cut = shards(rows, keys, order, shard_rows, group_rows)
    apart = [*keys, "shard"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                      for f in cut.select(*apart).schema.fields)
    trainer = Trainer(apart, dim, {
        "every": every, "buffer_rows": buffer_rows, "rate": rate, "alpha": alpha})
    ordered = cut.repartition(*apart).sortWithinPartitions(*apart, *order)
    return ordered.mapInPandas(trainer.train_sorted, f"{types}, {REPORT}")


def left_out(readings: DataFrame, *, features: Sequence[Column],
             keys: Sequence[str] = ("edge_id",)) -> DataFrame:
    """Number of readings of each key that lack a feature, and of all its readings."""
    lacking = F.exists(F.array(*features), lambda v: v.isNull())
    return readings.groupBy(*keys).agg(F.count_if(lacking).alias("left_out"),
                                       F.count(F.lit(1)).alias("readings"))


@dataclass
class Trainer:
    """Runs learners over frames of rows and collects their reports."""

    keys: list[str]
    dim: int
    options: dict

    def train_sorted(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For rows sorted by key and order; a key may go on from one frame to the next."""
        current, learner = None, Learner(np.zeros(self.dim))
        for frame in frames:
            for key, rows in frame.groupby(self.keys, sort=False, dropna=False):
                name = tuple(None if pd.isna(part) else part for part in key)
                if name != current:
                    current, learner = name, Learner(np.zeros(self.dim))
                yield self._learn(learner, rows)

    def _learn(self, learner: Learner, rows: pd.DataFrame) -> pd.DataFrame:
        x = rows[[f"_x{j}" for j in range(self.dim)]].to_numpy(dtype=float)
        y = rows["_y"].to_numpy(dtype=int)
        reports = list(learner.feed(x, y, **self.options))
        result = pd.DataFrame(reports, columns=[part.split()[0] for part in REPORT.split(", ")])
        for at, name in enumerate(self.keys):
            result.insert(at, name, rows[name].iloc[0])
        return result


def last_models(updates: DataFrame, keys: Sequence[str] = ("edge_id",)) -> DataFrame:
    """The model each shard ended with and the samples it trained on, per entity."""
    newest = F.max_by(F.struct("weights", "bias", "accuracy"), "round")
    return updates.groupBy(*keys, "shard").agg(
        newest.alias("_m"), F.sum("n_samples").alias("n_samples"),
        F.max("total_samples").alias("total_samples"),
        F.max("anomalies_detected").alias("anomalies_detected"),
        (F.max("round") + 1).alias("rounds"),
    ).select(*keys, "shard", "n_samples", "_m.*", "total_samples", "anomalies_detected",
             "rounds")
