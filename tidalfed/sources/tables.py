"""The given tables seen as readings, machine readings and model updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_readings(events: DataFrame) -> DataFrame:
    """Electric readings of four entities in two regions; each region has its model."""
    lane = F.col("user_id") % 4
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id",
        F.when(lane.isin(0, 1), "grid_a").otherwise("grid_b").alias("model_id"),
        F.concat(F.lit("village_"), (lane + 1).cast("string")).alias("edge_id"),
        F.when(lane.isin(0, 1), "north").otherwise("south").alias("region"),
        "user_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        (F.lit(230.0) + (F.col("value") - 50.0) / 10.0).alias("voltage"),
        (F.lit(10.0) + (k - 50.0) / 15.0).alias("current"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label"),
    )


def as_updates(embeddings: DataFrame) -> DataFrame:
    """Updates of two models from ten regions, one per second, a hundred per round."""
    vec = F.col("vec_id")
    return embeddings.select(
        F.when(F.col("label") % 2 == 0, "grid_a").otherwise("grid_b").alias("model_id"),
        vec.alias("node_id"),
        F.concat(F.lit("edge_"), vec.cast("string")).alias("edge_id"),
        F.concat(F.lit("r"), F.col("label").cast("string")).alias("region"),
        F.expr("cast(vec_id div 100 AS int)").alias("round"),
        F.col("embedding").cast("array<double>").alias("weights"),
        ((vec % 11).cast("double") / 10.0).alias("bias"),
        (vec % 97 + 1).alias("n_samples"),
        (F.lit(1.0) / (F.lit(1.0) + vec % 7)).alias("loss"),
        ((vec % 50).cast("double") / 50.0).alias("accuracy"),
        (vec % 13).alias("anomalies"),
        F.timestamp_seconds(F.lit(1704067200) + vec).alias("event_time"),
    )


def as_machine(lineitem: DataFrame) -> DataFrame:
    """Five-feature readings of two machine nodes in each of two plants."""
    node = F.col("l_suppkey") % 2 + 1
    return lineitem.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("plant_"), (F.col("l_partkey") % 2 + 1).cast("string")).alias("model_id"),
        node.cast("int").alias("node_id"),
        F.concat_ws("_", F.lit("sensor"), node.cast("string"),
                    (F.col("l_partkey") % 5 + 1).cast("string")).alias("sensor_id"),
        F.col("l_quantity").alias("vibration_x"),
        F.col("l_discount").alias("vibration_y"),
        F.col("l_tax").alias("vibration_z"),
        (F.col("l_extendedprice") / 1000.0).alias("temperature"),
        F.col("l_linenumber").cast("double").alias("pressure"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return as_readings(table(spark, folder, "events"))


def updates(spark: SparkSession, folder: str) -> DataFrame:
    return as_updates(table(spark, folder, "embeddings"))


def machine(spark: SparkSession, folder: str) -> DataFrame:
    return as_machine(table(spark, folder, "lineitem"))
