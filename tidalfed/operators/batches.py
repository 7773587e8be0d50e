"""Count-based batches, buffers and counters over the readings of each entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.operators.ordered import position, running, top_per_key
from tidalfed.operators.sizing import key_counts, lookup, sized_broadcast
from tidalfed.session import settled

ORDER = ("event_time", "event_id")


def count_batches(readings: DataFrame, keys: Sequence[str] = ("edge_id",),
                  order: Sequence[str] = ORDER, size: int = S.TRAIN_EVERY,
                  group_rows: int = S.GROUP_ROWS) -> DataFrame:
    """Number each entity's batches of ``size`` rows from 0.

    ``complete`` is false for the rows of a last batch that is not full yet.
    """
    keys = list(keys)
    counts = settled(key_counts(readings, keys))
    numbered = position(readings, keys, order, "position", group_rows, counts)
    joined = lookup(numbered, sized_broadcast(counts), keys)
    full = F.expr(f"_rows div {size}") * size
    return joined.select(
        *numbered.columns,
        F.expr(f"(position - 1) div {size}").alias("batch"),
        (F.col("position") <= full).alias("complete"),
    )


def recent_buffer(readings: DataFrame, keys: Sequence[str] = ("edge_id",),
                  rows: int = S.BUFFER_ROWS) -> DataFrame:
    """The newest rows of each entity."""
    newest = [F.col(c).desc() for c in ORDER]
    return top_per_key(readings, list(keys), newest, rows)


def running_counters(readings: DataFrame, keys: Sequence[str] = ("edge_id",),
                     order: Sequence[str] = ORDER,
                     group_rows: int = S.GROUP_ROWS) -> DataFrame:
    """Rows seen and anomalies seen so far, at each reading."""
    anomaly = (F.coalesce("label", F.lit(0)) == 1).cast("bigint")
    return running(readings, list(keys), order, group_rows=group_rows,
                   sums={"total_samples": F.lit(1).cast("bigint"),
                         "anomalies_detected": anomaly})


def samples_trained(batches: DataFrame, keys: Sequence[str], order: Sequence[str],
                    samples: str = "n_samples", group_rows: int = S.GROUP_ROWS) -> DataFrame:
    """Samples a node has trained on so far, the weight of its next update."""
    return running(batches, list(keys), order, group_rows=group_rows,
                   sums={"num_samples_trained": F.col(samples).cast("bigint")})


def train_eligible(batches: DataFrame, keys: Sequence[str], minimum: int = S.TRAIN_MINIMUM,
                   both_classes: bool = True, label: str = "label") -> DataFrame:
    """Batches with enough rows and, for a first training, with both classes."""
    value = F.coalesce(label, F.lit(0))
    counted = batches.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.min(value).alias("_low"), F.max(value).alias("_high"))
    enough: Column = F.col("n_samples") >= minimum
    if both_classes:
        enough = enough & (F.col("_low") != F.col("_high"))
    return counted.filter(enough).drop("_low", "_high")


def shards(df: DataFrame, keys: Sequence[str], order: Sequence[str],
           shard_rows: int, group_rows: int = S.GROUP_ROWS) -> DataFrame:
    """Cut each key into consecutive runs of ``shard_rows`` rows; the last may be shorter."""
    numbered = position(df, list(keys), order, "_position", group_rows)
    return (numbered.withColumn("shard", F.expr(f"(_position - 1) div {shard_rows}"))
            .drop("_position"))
