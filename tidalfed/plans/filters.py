"""Filters: entities, eligibility, guards, staleness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed.operators import batches, rounds
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.operators.training import publishable as published
from tidalfed.plans.registry import long_model, plain_time, query, r6, sql6, views
from tidalfed.sources import tables


@query(f"""{views("readings")}
SELECT event_id, edge_id, {sql6("voltage")} AS voltage, label FROM readings
WHERE edge_id = 'village_3'""")
def filter_entity(spark: SparkSession, folder: str) -> DataFrame:
    """The readings of one entity."""
    return tables.readings(spark, folder).filter(F.col("edge_id") == "village_3").select(
        "event_id", "edge_id", r6("voltage").alias("voltage"), "label")


@query(f"""{views("readings")},
numbered AS (
    SELECT *, (row_number() OVER (PARTITION BY edge_id ORDER BY event_time, event_id) - 1) // 8
        AS batch
    FROM readings)
SELECT edge_id, batch, count(*) AS n_samples FROM numbered
GROUP BY edge_id, batch HAVING count(*) >= 8 AND count(DISTINCT label) > 1""")
def train_eligible(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of eight rows that are full and hold both classes."""
    numbered = batches.count_batches(tables.readings(spark, folder), size=8)
    return batches.train_eligible(numbered, ["edge_id", "batch"], minimum=8)


@query(f"""{views("updates")}
SELECT node_id, n_samples - 1 AS n_samples FROM updates WHERE n_samples - 1 > 0""")
def publishable(spark: SparkSession, folder: str) -> DataFrame:
    """Models trained on no sample are not published."""
    updates = tables.updates(spark, folder).withColumn("n_samples", F.col("n_samples") - 1)
    return published(updates).select("node_id", "n_samples")


@query(f"""{views("cells")}
SELECT region, CAST(sum(n) AS BIGINT) AS total_samples, count(*) AS updates,
       CAST(pos AS INTEGER) AS pos, {sql6("sum(n * w) / sum(n)")} AS value
FROM (SELECT *, CASE WHEN region < 'r5' THEN 0 ELSE n_samples END AS n FROM cells)
GROUP BY region, pos HAVING sum(n) > 0""")
def fedavg_zero_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Regions without samples give no model."""
    updates = tables.updates(spark, folder).withColumn(
        "n_samples", F.when(F.col("region") < "r5", 0).otherwise(F.col("n_samples")))
    return long_model(fedavg_vector(updates, ["region"]), "region")


@query(f"""{views("updates")}
SELECT node_id, region, event_time FROM updates
WHERE event_time >= TIMESTAMP '2024-01-01 00:06:00' - INTERVAL 90 SECOND""")
def drop_stale(spark: SparkSession, folder: str) -> DataFrame:
    """Updates not older than 90 seconds at a given time."""
    as_of = F.lit("2024-01-01 00:06:00").cast("timestamp")
    fresh = rounds.drop_stale(tables.updates(spark, folder), as_of, "90 seconds")
    return fresh.select("node_id", "region", plain_time("event_time").alias("event_time"))
