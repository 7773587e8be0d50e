"""Monitoring: anomalies, node statistics, loss summaries, quality, traffic, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.operators.sizing import lookup, sized_broadcast


def anomaly_counts(readings: DataFrame, keys: Sequence[str] = ("edge_id",)) -> DataFrame:
    """Anomalous readings by entity."""
    return (readings.filter(F.col("label") == 1).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("anomalies")))


def anomaly_rollup(readings: DataFrame) -> DataFrame:
    """Anomalies by entity, by region and in all; a null marks the level summed over.

    Counted by entity first: the grouping sets then see one row per entity.
    """
    counted = readings.groupBy("region", "edge_id").agg(
        F.count_if(F.col("label") == 1).alias("_n"))
    return counted.rollup("region", "edge_id").agg(F.sum("_n").alias("anomalies"))


def zero_filled_counts(readings: DataFrame, dimension: DataFrame) -> DataFrame:
    """Anomalies of every known entity, 0 for those without any."""
    counts = anomaly_counts(readings)
    return dimension.join(counts, "edge_id", "left").withColumn(
        "anomalies", F.coalesce("anomalies", F.lit(0).cast("bigint")))


def node_stats(rounds: DataFrame, members: DataFrame, node: str = "node_id") -> DataFrame:
    """Rounds a node took part in, its equal share of the last one and that round's loss.

    ``rounds`` has one row per ``round`` with ``total_samples, weighted_loss``; ``members``
    one row per round and participant.
    """
    sizes = members.groupBy("round").agg(F.count(F.lit(1)).alias("_members"))
    shares = rounds.join(sizes, "round").select(
        "round", F.expr("total_samples div _members").alias("_share"),
        F.coalesce("weighted_loss", F.lit(0.0)).alias("_loss"))
    return members.join(sized_broadcast(shares, computed=True), "round").groupBy(node).agg(
        F.count(F.lit(1)).alias("contributions"),
        F.max_by("_share", "round").alias("total_samples"),
        F.max_by("_loss", "round").alias("last_loss"))


def log_summary(rounds: DataFrame, keys: Sequence[str] = ("model_id",)) -> DataFrame:
    """Rounds, first and last time and loss, and the improvement in percent."""
    first, last = F.min_by("weighted_loss", "round"), F.max_by("weighted_loss", "round")
    summary = rounds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rounds"),
        F.min_by("timestamp", "round").alias("first_timestamp"),
        F.max_by("timestamp", "round").alias("last_timestamp"),
        first.alias("first_loss"), last.alias("last_loss"))
    gain = F.try_divide(F.col("first_loss") - F.col("last_loss"), F.col("first_loss"))
    return summary.withColumn("improvement_pct", gain * 100)


def loss_minmax(rounds: DataFrame, keys: Sequence[str] = ("model_id",),
                loss: str = "weighted_loss") -> DataFrame:
    """Losses scaled to [0, 1] over all rounds of a model; 0 where all are equal.

    The bounds are one pre-aggregated row per model, joined back.
    """
    bounds = rounds.groupBy(*keys).agg(F.min(loss).alias("_low"), F.max(loss).alias("_high"))
    span = F.col("_high") - F.col("_low")
    scaled = F.coalesce(F.try_divide(F.col(loss) - F.col("_low"), span), F.lit(0.0))
    joined = lookup(rounds, sized_broadcast(bounds, computed=True), keys)
    return joined.withColumn("scaled_loss", scaled).drop("_low", "_high")


def batch_quality(scored: DataFrame, keys: Sequence[str], predicted: str = "predicted",
                  label: str = "label") -> DataFrame:
    """Samples and accuracy by key."""
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.avg((F.col(predicted) == F.col(label)).cast("double")).alias("accuracy"))


def classification_metrics(scored: DataFrame, keys: Sequence[str],
                           predicted: str = "predicted", label: str = "label") -> DataFrame:
    """Confusion counts, precision, recall, false positive and false negative rates."""
    p, y = F.col(predicted), F.col(label)
    cells = scored.groupBy(*keys).agg(
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 0)).alias("tn"),
        F.count_if((p == 0) & (y == 1)).alias("fn"))

    def rate(part: str, other: str) -> Column:
        return F.try_divide(F.col(part), F.col(part) + F.col(other))

    return cells.withColumns({
        "precision": rate("tp", "fp"), "recall": rate("tp", "fn"),
        "fpr": rate("fp", "tn"), "fnr": rate("fn", "tp")})


def bytes_by_topic(messages: DataFrame, base_topic: str) -> DataFrame:
    """Messages and bytes of each topic and its size relative to ``base_topic``."""
    sizes = messages.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.octet_length("value").cast("bigint")).alias("bytes"))
    # One row a topic is left here, so one window over all of them is small.
    base = F.max(F.when(F.col("topic") == base_topic, F.col("bytes"))).over(Window.partitionBy())
    return sizes.withColumn("ratio", F.try_divide(F.col("bytes"), base))


def anomaly_alerts(readings: DataFrame, duration: str = S.WINDOW, rate: float = S.ALERT_RATE,
                   high: float = 0.25, watermark: str | None = None) -> DataFrame:
    """Windows in which an entity's share of anomalies is above ``rate``."""
    if watermark:
        readings = readings.withWatermark("event_time", watermark)
    label = F.coalesce("label", F.lit(0)).cast("double")
    rates = readings.groupBy(F.window("event_time", duration), "edge_id").agg(
        F.avg(label).alias("anomaly_rate"), F.count(F.lit(1)).alias("n_samples"))
    severity = F.when(F.col("anomaly_rate") >= high, "HIGH").otherwise("MEDIUM")
    return rates.filter(F.col("anomaly_rate") > rate).select(
        "edge_id", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), "n_samples", "anomaly_rate",
        severity.alias("severity"))
