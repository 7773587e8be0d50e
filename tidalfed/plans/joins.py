"""Joins with the entity dimension, with models, and as of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.functions import features as X
from tidalfed.functions import scoring as P
from tidalfed.operators import joins as J
from tidalfed.operators import monitor
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.plans.registry import query, r6, sql6, views
from tidalfed.plans.windows import cutting_bound
from tidalfed.sources import tables


@query(f"""{views("readings")}
SELECT event_id, edge_id, CASE WHEN edge_id IN ('village_1', 'village_2') THEN 'north'
                               WHEN edge_id = 'village_3' THEN 'south'
                               ELSE 'unknown' END AS region
FROM readings""")
def join_region(spark: SparkSession, folder: str) -> DataFrame:
    """Regions looked up in a dimension that lacks one village."""
    known = {k: v for k, v in S.EDGE_REGIONS.items() if k != "village_4"}
    joined = J.with_region(tables.readings(spark, folder), J.region_dimension(spark, known))
    return joined.select("event_id", "edge_id", "region")


@query(f"""{views("readings")}
SELECT event_id, edge_id FROM readings WHERE edge_id <> 'village_4'""")
def known_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Readings of known entities only."""
    known = {k: v for k, v in S.EDGE_REGIONS.items() if k != "village_4"}
    kept = J.known_only(tables.readings(spark, folder), J.region_dimension(spark, known))
    return kept.select("event_id", "edge_id")


@query(f"""{views("readings")},
dimension AS (SELECT * FROM (VALUES ('village_1', 'north'), ('village_2', 'north'),
    ('village_3', 'south'), ('village_4', 'south'), ('village_9', 'east')) t(edge_id, region))
SELECT d.edge_id, d.region, count(*) FILTER (r.label = 1) AS anomalies
FROM dimension d LEFT JOIN readings r ON r.edge_id = d.edge_id GROUP BY d.edge_id, d.region""")
def anomaly_counts_zero_filled(spark: SparkSession, folder: str) -> DataFrame:
    """Anomalies of every known entity, also of one that never reported."""
    dimension = J.region_dimension(spark, {**S.EDGE_REGIONS, "village_9": "east"})
    return monitor.zero_filled_counts(tables.readings(spark, folder), dimension)


def _three_weights(updates: DataFrame) -> DataFrame:
    return updates.withColumn("weights", F.slice("weights", 1, 3))


LATEST_SCORES = f"""{views("readings", "cells")},
newest AS (
    SELECT model_id, pos, sum(n_samples * w) / sum(n_samples) AS w
    FROM cells JOIN (SELECT model_id, max(round) AS round FROM updates GROUP BY model_id)
        USING (model_id, round)
    WHERE pos IN (0, 1, 2, 64) GROUP BY model_id, pos),
model AS (SELECT model_id, max(w) FILTER (pos = 0) AS w0, max(w) FILTER (pos = 1) AS w1,
                 max(w) FILTER (pos = 2) AS w2, max(w) FILTER (pos = 64) AS b
          FROM newest GROUP BY model_id),
scored AS (
    SELECT event_id, edge_id,
           1e0 / (1e0 + exp(-greatest(-500e0, least(500e0,
               w0 * (voltage - 230e0) / 5e0 + w1 * (current - 10e0) / 2e0
               + w2 * (voltage * current - 2300e0) / 10e0 + b)))) AS p
    FROM readings JOIN model USING (model_id))
SELECT event_id, edge_id, {sql6("p")} AS probability, p > 0.5e0 AS anomaly FROM scored"""


def newest_global_models(updates: DataFrame) -> DataFrame:
    """Three-feature global models by round."""
    return fedavg_vector(_three_weights(updates), ["model_id", "round"])


def scored_readings(readings: DataFrame, models: DataFrame) -> DataFrame:
    """Readings with probability and decision of the newest model."""
    joined = J.with_latest_model(readings, models)
    p = P.probability(X.zscore("voltage", "current"), F.col("weights"), F.col("bias"))
    return joined.withColumn("_p", p).select(
        "event_id", "edge_id", r6("_p").alias("probability"),
        P.is_anomaly(F.col("_p")).alias("anomaly"))


@query(LATEST_SCORES)
def score_with_latest_model(spark: SparkSession, folder: str) -> DataFrame:
    """Readings scored with the newest global model."""
    models = newest_global_models(tables.updates(spark, folder))
    return scored_readings(tables.readings(spark, folder), models)


def published_models(updates: DataFrame) -> DataFrame:
    """One model an hour, each for one of the four entities."""
    return updates.select(
        F.concat(F.lit("village_"), (F.col("node_id") % 4 + 1).cast("string")).alias("edge_id"),
        F.expr("timestamp_seconds(1704067200 + node_id * 3600)").alias("published_at"),
        F.col("node_id").alias("model_node"), "weights", "bias")


ASOF = f"""{views("readings", "updates")},
models AS (SELECT 'village_' || (node_id % 4 + 1) AS edge_id, node_id AS model_node,
                  TIMESTAMP '2024-01-01' + to_seconds(node_id * 3600) AS published_at,
                  weights, bias FROM updates)
SELECT event_id, r.edge_id, model_node,
       {sql6("weights[1] * (voltage - 230e0) / 5e0 + weights[2] * (current - 10e0) / 2e0 + bias")}
           AS score
FROM readings r ASOF LEFT JOIN models m
    ON r.edge_id = m.edge_id AND r.event_time >= m.published_at"""


def _asof_scores(joined: DataFrame) -> DataFrame:
    v, i, _ = X.zscore("voltage", "current")
    score = v * F.col("weights")[0] + i * F.col("weights")[1] + F.col("bias")
    return joined.select("event_id", "edge_id", "model_node", r6(score).alias("score"))


def _asof(spark: SparkSession, folder: str, cut: bool) -> DataFrame:
    readings = tables.readings(spark, folder).drop("model_id")
    group_rows = cutting_bound(readings) if cut else S.GROUP_ROWS
    joined = J.with_model_in_force(readings, published_models(tables.updates(spark, folder)),
                                   model=("model_node", "weights", "bias"),
                                   group_rows=group_rows)
    return _asof_scores(joined)


@query(ASOF)
def asof_model(spark: SparkSession, folder: str) -> DataFrame:
    """Each reading with the model in force at its event time."""
    return _asof(spark, folder, cut=False)


@query(ASOF)
def asof_model_segmented(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every entity cut into segments, as large ones are."""
    return _asof(spark, folder, cut=True)
