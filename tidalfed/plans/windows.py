"""Count batches, buffers, counters, histories, top rows, samples, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed.operators import batches, monitor, rollup, rounds
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.plans.registry import plain_time, query, r6, sql6, views
from tidalfed.session import settled
from tidalfed.sources import tables


def cutting_bound(rows: DataFrame) -> int:
    """A bound below the size of the given entities, so that they are cut like large ones.

    About sixty-four segments in all, however many rows there are.
    """
    return max(100, rows.count() // 64)


COUNT_BATCHES = f"""{views("readings")},
numbered AS (
    SELECT event_id, edge_id, label,
           row_number() OVER (PARTITION BY edge_id ORDER BY event_time, event_id) AS position,
           count(*) OVER (PARTITION BY edge_id) AS n
    FROM readings)
SELECT event_id, edge_id, position, (position - 1) // 50 AS batch,
       position <= (n // 50) * 50 AS complete
FROM numbered"""


@query(COUNT_BATCHES)
def count_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Training batches of fifty readings."""
    numbered = batches.count_batches(tables.readings(spark, folder))
    return numbered.select("event_id", "edge_id", "position", "batch", "complete")


@query(COUNT_BATCHES)
def count_batches_segmented(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every entity cut into segments, as large ones are."""
    readings = tables.readings(spark, folder)
    numbered = batches.count_batches(readings, group_rows=cutting_bound(readings))
    return numbered.select("event_id", "edge_id", "position", "batch", "complete")


@query(f"""{views("readings")}
SELECT event_id, edge_id FROM readings
QUALIFY row_number() OVER (PARTITION BY edge_id ORDER BY event_time DESC, event_id DESC) <= 1000""")
def recent_buffer(spark: SparkSession, folder: str) -> DataFrame:
    """The newest thousand readings of each entity."""
    return batches.recent_buffer(tables.readings(spark, folder)).select("event_id", "edge_id")


RUNNING = f"""{views("readings")}
SELECT event_id, edge_id, count(*) OVER w AS total_samples,
       CAST(sum(label) OVER w AS BIGINT) AS anomalies_detected
FROM readings WINDOW w AS (PARTITION BY edge_id ORDER BY event_time, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query(RUNNING)
def running_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Readings and anomalies seen so far by each entity."""
    counted = batches.running_counters(tables.readings(spark, folder))
    return counted.select("event_id", "edge_id", "total_samples", "anomalies_detected")


@query(RUNNING)
def running_counters_segmented(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every entity cut into segments, as large ones are."""
    readings = tables.readings(spark, folder)
    counted = batches.running_counters(readings, group_rows=cutting_bound(readings))
    return counted.select("event_id", "edge_id", "total_samples", "anomalies_detected")


@query(f"""{views("updates")}
SELECT region, node_id, CAST(sum(n_samples) OVER (PARTITION BY region ORDER BY event_time
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS num_samples_trained
FROM updates""")
def samples_trained(spark: SparkSession, folder: str) -> DataFrame:
    """Samples trained on so far, as each region's updates come in."""
    counted = batches.samples_trained(tables.updates(spark, folder), ["region"], ["event_time"])
    return counted.select("region", "node_id", "num_samples_trained")


MINUTES = f"""{views("updates")},
rounds AS (
    SELECT model_id, CAST(epoch(event_time) - 1704067200 AS BIGINT) // 20 AS round,
           sum(n_samples * loss) / sum(n_samples) AS loss,
           CAST(sum(n_samples) AS BIGINT) AS total_samples,
           CAST(sum(anomalies) AS BIGINT) AS anomalies
    FROM updates GROUP BY 1, 2)
"""


def short_rounds(updates: DataFrame) -> DataFrame:
    """A round every twenty seconds, for histories longer than the shown ones."""
    timed = updates.withColumn("round", F.expr("(unix_seconds(event_time) - 1704067200) div 20"))
    models = fedavg_vector(timed, ["model_id", "round"])
    counts = timed.groupBy("model_id", "round").agg(
        F.sum("anomalies").alias("anomalies_detected"))
    return models.join(counts, ["model_id", "round"])


@query(MINUTES + f"""
SELECT model_id, 0 AS page, min(round) AS first_round, max(round) AS last_round,
       count(*) AS rounds,
       string_agg(CAST(CAST(round(loss * 1000) AS BIGINT) AS VARCHAR), ',' ORDER BY round)
           AS losses
FROM rounds GROUP BY model_id""")
def loss_history(spark: SparkSession, folder: str) -> DataFrame:
    """All losses of a model, oldest first (in thousandths)."""
    history = rounds.loss_history(settled(short_rounds(tables.updates(spark, folder))))
    text = F.transform("losses", lambda x: F.round(x * 1000).cast("bigint").cast("string"))
    return history.select("model_id", "page", "first_round", "last_round",
                          F.size("losses").cast("bigint").alias("rounds"),
                          F.array_join(text, ",").alias("losses"))


@query(MINUTES + f"""
SELECT model_id,
       CAST(row_number() OVER (PARTITION BY model_id ORDER BY round) - 1 AS INTEGER) AS pos,
       {sql6("loss")} AS loss
FROM (SELECT * FROM rounds
      QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY round DESC) <= 10)""")
def loss_tail(spark: SparkSession, folder: str) -> DataFrame:
    """The last ten losses of a model."""
    tails = rounds.loss_tail(short_rounds(tables.updates(spark, folder)))
    return tails.select("model_id", F.posexplode("losses").alias("pos", "loss")).withColumn(
        "loss", r6("loss"))


@query(MINUTES + f"""
SELECT model_id, round, {sql6("loss")} AS weighted_loss,
       {sql6("""coalesce((loss - min(loss) OVER m)
             / nullif(max(loss) OVER m - min(loss) OVER m, 0), 0)""")} AS scaled_loss
FROM rounds WINDOW m AS (PARTITION BY model_id)""")
def loss_minmax(spark: SparkSession, folder: str) -> DataFrame:
    """Losses scaled over all rounds of a model."""
    scaled = monitor.loss_minmax(settled(short_rounds(tables.updates(spark, folder))))
    return scaled.select("model_id", "round", r6("weighted_loss").alias("weighted_loss"),
                         r6("scaled_loss").alias("scaled_loss"))


@query(MINUTES + f"""
SELECT model_id, round, total_samples, {sql6("loss")} AS weighted_loss
FROM rounds QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY round DESC) <= 20""")
def last_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """The newest twenty rounds."""
    shown = rounds.last_rounds(short_rounds(tables.updates(spark, folder)))
    return shown.select("model_id", "round", "total_samples",
                        r6("weighted_loss").alias("weighted_loss"))


@query(MINUTES + """
SELECT model_id, round, total_samples, anomalies AS anomalies_detected
FROM rounds QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY round DESC) <= 100""")
def metrics_history(spark: SparkSession, folder: str) -> DataFrame:
    """The newest hundred metric rows."""
    kept = rounds.metrics_history(short_rounds(tables.updates(spark, folder)))
    return kept.select("model_id", "round", "total_samples", "anomalies_detected")


@query(MINUTES + """
SELECT model_id, round, 'total_samples' AS series, total_samples AS value FROM rounds
UNION ALL SELECT model_id, round, 'anomalies_detected', anomalies FROM rounds""")
def rounds_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Samples and anomalies over the rounds."""
    return rounds.rounds_timeline(short_rounds(tables.updates(spark, folder)))


@query(f"""{views("updates")},
windows AS (SELECT region, time_bucket(INTERVAL 30 SECOND, event_time) AS window_start,
                   CAST(sum(n_samples) AS BIGINT) AS total_n_samples
            FROM updates GROUP BY ALL)
SELECT region, window_start, total_n_samples,
       dense_rank() OVER (PARTITION BY region ORDER BY window_start) AS round
FROM windows""")
def round_number(spark: SparkSession, folder: str) -> DataFrame:
    """The published windows of each region numbered in order."""
    numbered = rounds.round_numbers(
        settled(rollup.regional_totals(tables.updates(spark, folder))), ["region"])
    return numbered.select("region", plain_time("window_start").alias("window_start"),
                           "total_n_samples", "round")


@query(f"""{views("updates")}
SELECT round, node_id FROM updates
QUALIFY row_number() OVER (
    PARTITION BY round ORDER BY md5('7|' || round || '|' || node_id), node_id) <= 10""")
def sample_participants(spark: SparkSession, folder: str) -> DataFrame:
    """Ten nodes drawn for each round."""
    return rounds.sample_participants(tables.updates(spark, folder), ["round"], "node_id", 10,
                                      seed=7)


@query(f"""{views("readings")},
days AS (SELECT unnest(range(0, 30)) AS day),
seen AS (SELECT DISTINCT user_id, date_diff('day', DATE '2024-01-01', event_time::DATE) AS day
         FROM readings),
users AS (SELECT DISTINCT user_id FROM readings)
SELECT user_id, day FROM users, days
EXCEPT SELECT user_id, day FROM seen""")
def missing_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the month on which a known user sent nothing."""
    readings = tables.readings(spark, folder)
    seen = readings.select("user_id", F.datediff(
        "event_time", F.lit("2024-01-01").cast("date")).alias("day"))
    return rounds.missing_nodes(seen, readings.select("user_id"), "user_id", "day", 0, 29)
