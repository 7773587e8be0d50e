"""Collects queries and their oracle statements."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; without ``oracle`` only its rows are checked."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare(spark), folder)

        QUERIES[function.__name__] = run
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return run

    return register


def r6(column: str | Column) -> Column:
    """Six decimals, the precision results are compared at."""
    return F.round(column, 6)


def sql6(expression: str) -> str:
    """The same in the oracle; adding zero turns -0.0 into 0.0."""
    return f"(round({expression}, 6) + 0e0)"


def plain_time(column: str | Column) -> Column:
    """A timestamp without zone, as the oracle's are."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def long_model(models: DataFrame, *keys: str, parts: tuple[str, ...] = ("bias", "weighted_loss"),
               extra: tuple[str, ...] = ("total_samples", "updates")) -> DataFrame:
    """One row per vector position: the weights, then the named single values."""
    vector = F.concat("weights", F.array(*parts)) if parts else F.col("weights")
    return models.select(*keys, *extra, F.posexplode(vector).alias("pos", "value")).withColumn(
        "value", r6("value"))


# The views of tidalfed.sources.tables, in the oracle's dialect.
VIEWS = {
    "readings": """
        SELECT event_id,
               CASE WHEN user_id % 4 IN (0, 1) THEN 'grid_a' ELSE 'grid_b' END AS model_id,
               'village_' || (user_id % 4 + 1) AS edge_id,
               CASE WHEN user_id % 4 IN (0, 1) THEN 'north' ELSE 'south' END AS region,
               user_id, ts AS event_time,
               230e0 + (value - 50e0) / 10e0 AS voltage,
               10e0 + (CAST(json_extract_string(props, '$.k') AS INTEGER) - 50e0) / 15e0
                   AS current,
               CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label
        FROM events""",
    "updates": """
        SELECT CASE WHEN label % 2 = 0 THEN 'grid_a' ELSE 'grid_b' END AS model_id,
               vec_id AS node_id, 'edge_' || vec_id AS edge_id,
               'r' || label AS region, CAST(vec_id // 100 AS INTEGER) AS round,
               embedding::DOUBLE[] AS weights, (vec_id % 11)::DOUBLE / 10e0 AS bias,
               vec_id % 97 + 1 AS n_samples, 1e0 / (1e0 + vec_id % 7) AS loss,
               (vec_id % 50)::DOUBLE / 50e0 AS accuracy, vec_id % 13 AS anomalies,
               TIMESTAMP '2024-01-01' + to_seconds(vec_id) AS event_time
        FROM embeddings""",
    "machine": """
        SELECT l_orderkey, l_linenumber, 'plant_' || (l_partkey % 2 + 1) AS model_id,
               CAST(l_suppkey % 2 + 1 AS INTEGER) AS node_id,
               'sensor_' || (l_suppkey % 2 + 1) || '_' || (l_partkey % 5 + 1) AS sensor_id,
               l_quantity AS vibration_x, l_discount AS vibration_y, l_tax AS vibration_z,
               l_extendedprice / 1000e0 AS temperature, l_linenumber::DOUBLE AS pressure,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
               l_shipdate AS event_time
        FROM lineitem""",
    # Vector positions of the updates: weights, then bias, then loss.
    "cells": """
        SELECT u.* EXCLUDE (weights), unnest(list_concat(weights, [bias, loss])) AS w,
               generate_subscripts(list_concat(weights, [bias, loss]), 1) - 1 AS pos
        FROM updates u""",
}
NEEDS = {"cells": ["updates"]}


def views(*names: str) -> str:
    """``WITH`` clause defining the named views; end the statement with a SELECT or a comma."""
    wanted: list[str] = []
    for name in names:
        for needed in [*NEEDS.get(name, []), name]:
            if needed not in wanted:
                wanted.append(needed)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in wanted) + "\n"
