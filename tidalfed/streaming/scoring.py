"""Scoring a stream with the model that is newest when a micro-batch comes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidalfed import settings as S
from tidalfed.functions.scoring import is_anomaly, probability
from tidalfed.operators.joins import with_latest_model
from tidalfed.sources.topics import publish_to_all, table_sink


def scored(readings: DataFrame, models: DataFrame, features: Sequence[Column],
           threshold: float = S.DETECTION_THRESHOLD) -> DataFrame:
    """Readings with the probability and decision of the newest model of theirs."""
    joined = with_latest_model(readings, models)
    p = probability(features, F.col("weights"), F.col("bias"))
    return (joined.withColumn("probability", p)
            .withColumn("anomaly", is_anomaly(F.col("probability"), threshold))
            .drop("weights", "bias"))


def start_scoring(readings: DataFrame, read_models: Callable[[], DataFrame], folder: str,
                  features: Sequence[Column], trigger: dict | None = None) -> StreamingQuery:
    """Score every micro-batch with the model table as it is then, into ``folder/data``.

    ``read_models`` opens the table anew, so that models published meanwhile are seen.
    """
    sink = table_sink(f"{folder}/data")

    def score(batch: DataFrame, batch_id: int) -> None:
        sink(scored(batch, read_models(), features), batch_id)

    return publish_to_all(readings, f"{folder}/checkpoint", [score], trigger=trigger)
