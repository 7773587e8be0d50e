"""Regional roll-up of model updates by event-time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.operators.ordered import position

KEYS = ["window", "region"]


def windowed(updates: DataFrame, duration: str = S.WINDOW,
             event_time: str = "event_time") -> DataFrame:
    """Add the tumbling window of each row."""
    return updates.withColumn("window", F.window(event_time, duration))


def _measures(accuracy: Column, anomalies: Column) -> list[Column]:
    return [
        F.sum("n_samples").alias("total_n_samples"),
        F.avg(accuracy).alias("avg_accuracy"),
        F.sum(anomalies).alias("total_anomalies"),
        F.count(F.lit(1)).alias("num_updates"),
    ]


def regional_totals(updates: DataFrame, duration: str = S.WINDOW,
                    watermark: str | None = None) -> DataFrame:
    """Samples, mean accuracy, anomalies and number of updates by window and region.

    State and shuffle stay at one small row per window and region.
    """
    if watermark:
        updates = updates.withWatermark("event_time", watermark)
    totals = windowed(updates, duration).groupBy(*KEYS).agg(
        *_measures(F.col("accuracy"), F.col("anomalies")))
    return _flatten(totals)


MEMBER = ["edge_id", "event_time", "weights", "n_samples", "accuracy", "anomalies"]


def regional_members(updates: DataFrame, duration: str = S.WINDOW) -> DataFrame:
    """The updates of each window and region, one row each: who took part, with its model.

    Beside :func:`regional_totals` this is the other half of the roll-up. It needs no state,
    on a stream as on a table, and means the same however large a group is.
    """
    return _flatten(windowed(updates, duration).select(*KEYS, *MEMBER))


def regional_pages(updates: DataFrame, duration: str = S.WINDOW, page_rows: int = S.LIST_ROWS,
                   group_rows: int = S.GROUP_ROWS) -> DataFrame:
    """The roll-up as messages: lists of edges and models, and the totals of just these.

    A message holds at most ``page_rows`` updates, in order of edge and time; a larger group
    is several messages, told apart by ``page``, whose totals add up to the group's.
    """
    rows = windowed(updates, duration).withColumn("_tie", F.xxhash64("weights", "n_samples"))
    placed = position(rows, KEYS, ["edge_id", "event_time", "_tie"], "_position", group_rows)
    member = F.struct("_position", "edge_id", "weights")
    ordered = F.array_sort(F.collect_list(member))
    pages = placed.withColumn(
        "page", F.expr(f"cast((_position - 1) div {page_rows} AS int)")).groupBy(
        *KEYS, "page").agg(
        F.transform(ordered, lambda m: m["edge_id"]).alias("contributing_edges"),
        F.transform(ordered, lambda m: m["weights"]).alias("all_weights"),
        *_measures(F.col("accuracy"), F.col("anomalies")))
    return _flatten(pages)


def corrected_anomalies(updates: DataFrame, duration: str = S.WINDOW) -> DataFrame:
    """Anomalies by window and region when each update reports a cumulative count.

    Summing cumulative counts over updates counts twice; the largest count of each edge,
    summed over edges, does not.
    """
    per_edge = windowed(updates, duration).groupBy(*KEYS, "edge_id").agg(
        F.max("anomalies").alias("anomalies"))
    return _flatten(per_edge.groupBy(*KEYS).agg(F.sum("anomalies").alias("total_anomalies")))


def _flatten(grouped: DataFrame) -> DataFrame:
    rest = [c for c in grouped.columns if c not in KEYS]
    return grouped.select(
        "region", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), *rest)


def readings_rollup(readings: DataFrame, duration: str = S.WINDOW,
                    watermark: str | None = None) -> DataFrame:
    """Readings, anomalies and mean voltage by window and region."""
    if watermark:
        readings = readings.withWatermark("event_time", watermark)
    return _flatten(windowed(readings, duration).groupBy(*KEYS).agg(*_reading_measures()))


def chained_rollup(readings: DataFrame, duration: str, outer: str,
                   watermark: str | None = None) -> DataFrame:
    """Regional windows, then windows over all regions on top of them, in one plan."""
    if watermark:
        readings = readings.withWatermark("event_time", watermark)
    regional = windowed(readings, duration).groupBy(*KEYS).agg(*_reading_measures())
    timed = regional.withColumn("closed_at", F.window_time("window"))
    merged = timed.groupBy(F.window("closed_at", outer).alias("outer")).agg(
        F.count(F.lit(1)).alias("regional_windows"),
        F.sum("n_samples").alias("n_samples"),
        F.sum("anomalies").alias("anomalies"))
    return merged.select(F.col("outer.start").alias("window_start"),
                         F.col("outer.end").alias("window_end"),
                         "regional_windows", "n_samples", "anomalies")


def _reading_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_samples"),
        F.sum("label").cast("bigint").alias("anomalies"),
        F.avg("voltage").alias("avg_voltage"),
    ]
