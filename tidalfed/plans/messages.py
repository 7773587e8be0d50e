"""Topics, routing, encoding, round logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.functions import features as X
from tidalfed.operators import monitor
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.operators.rounds import participants, round_log as log_rows
from tidalfed.plans.registry import plain_time, query, r6, sql6, views
from tidalfed.schemas import READING_ELECTRIC, READING_MACHINE
from tidalfed.session import run_folder
from tidalfed.sources import tables, topics
from tidalfed.sources.roundlog import append_rounds, read_rounds
from tidalfed.streaming.run import run_to_table


def reading_messages(readings: DataFrame) -> DataFrame:
    """Electric readings as messages keyed by entity; normal ones carry no type."""
    rows = readings.select(
        "event_id", "edge_id", X.iso_text("event_time").alias("timestamp"), "voltage",
        "current", X.power("voltage", "current").alias("power"), "label",
        F.when(F.col("label") == 1, "anomaly").alias("type"), "event_time")
    payload = [c for c in rows.columns if c != "event_time"]
    return topics.encode(rows, topic=S.TOPICS["sensor_data"], key="edge_id",
                         time="event_time", payload=payload)


def machine_messages(machine: DataFrame) -> DataFrame:
    rows = machine.select(
        X.iso_text("event_time").alias("timestamp"), "node_id", "sensor_id",
        F.struct(*S.MACHINE_FEATURES).alias("features"), "label", "event_time")
    payload = [c for c in rows.columns if c != "event_time"]
    return topics.encode(rows, topic=X.machine_topic("node_id"),
                         key=X.prefixed_key("node", "node_id"), time="event_time",
                         payload=payload)


def round_models(updates: DataFrame) -> DataFrame:
    """Global model of each round with the time of its last update."""
    models = fedavg_vector(updates, ["model_id", "round"])
    times = updates.groupBy("model_id", "round").agg(F.max("event_time").alias("event_time"))
    return models.join(times, ["model_id", "round"])


def model_messages(updates: DataFrame) -> DataFrame:
    rows = round_models(updates).select(
        "round", X.iso_text("event_time").alias("timestamp"),
        F.struct(F.array("weights").alias("coef"), F.array("bias").alias("intercept"))
        .alias("global_weights"), "total_samples", "event_time")
    return topics.encode(rows, topic=S.TOPICS["global_model"],
                         key=X.prefixed_key("round", "round"), time="event_time",
                         payload=["round", "timestamp", "global_weights", "total_samples"])


def metric_messages(updates: DataFrame) -> DataFrame:
    regions = updates.groupBy("round").agg(
        F.sum("n_samples").alias("total_samples"), F.count(F.lit(1)).alias("num_updates"),
        F.array_sort(F.collect_set("region")).alias("participating_regions"),
        F.max("event_time").alias("event_time"))
    return topics.encode(
        regions, topic=S.TOPICS["global_metrics"], key=X.prefixed_key("round", "round"),
        time="event_time",
        payload=["round", "total_samples", "num_updates", "participating_regions"])


READING_ROWS = f"""{views("readings")}
SELECT event_id, edge_id, {sql6("voltage")} AS voltage, {sql6("current")} AS current, label,
       event_time
FROM readings"""


def _decoded_readings(messages: DataFrame) -> DataFrame:
    rows = topics.decode(messages, f"event_id bigint, {READING_ELECTRIC}")
    return rows.select("event_id", "edge_id", r6("voltage").alias("voltage"),
                       r6("current").alias("current"), "label",
                       plain_time("event_time").alias("event_time"))


@query(READING_ROWS)
def src_replay(spark: SparkSession, folder: str) -> DataFrame:
    """A recorded topic read as a stream and decoded."""
    run = run_folder(spark, "replay")
    reading_messages(tables.readings(spark, folder)).write.parquet(f"{run}/topic")
    stream = topics.subscribe(spark, [S.TOPICS["sensor_data"]], format="parquet",
                              path=f"{run}/topic")
    return run_to_table(_decoded_readings(stream), f"{run}/decoded")


@query(READING_ROWS)
def stream_sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Readings streamed into a topic, and the topic read back."""
    run = run_folder(spark, "sink")
    stream = tables.as_readings(topics.table_stream(spark, folder, "events"))
    topics.publish(reading_messages(stream), f"{run}/checkpoint", format="parquet",
                   path=f"{run}/topic").awaitTermination()
    return _decoded_readings(spark.read.schema(topics.MESSAGE).parquet(f"{run}/topic"))


@query(f"""{views("readings", "updates")}
SELECT 'model' AS kind, 'global_model' AS topic, count(DISTINCT model_id || round) AS messages
FROM updates
UNION ALL SELECT 'metrics', 'global_metrics', count(DISTINCT round) FROM updates
UNION ALL SELECT 'reading', 'sensor_data', count(*) FROM readings""")
def demux_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of three topics told apart by their shape."""
    updates = tables.updates(spark, folder)
    messages = (reading_messages(tables.readings(spark, folder))
                .unionByName(model_messages(updates)).unionByName(metric_messages(updates)))
    return topics.with_kind(messages).groupBy("kind", "topic").agg(
        F.count(F.lit(1)).alias("messages"))


@query(f"""{views("machine")}
SELECT CASE WHEN node_id = 1 THEN 'sensor-data-node-1' ELSE 'sensor-data-node-2' END AS topic,
       'node_' || node_id AS key, count(*) AS messages
FROM machine GROUP BY ALL""")
def route_topic(spark: SparkSession, folder: str) -> DataFrame:
    """Each machine node writes to its topic."""
    return tables.machine(spark, folder).groupBy(
        X.machine_topic("node_id").alias("topic"),
        X.prefixed_key("node", "node_id").alias("key")).agg(
        F.count(F.lit(1)).alias("messages"))


@query(f"""{views("machine")}
SELECT node_id, sensor_id, count(*) AS readings, CAST(sum(label) AS BIGINT) AS anomalies,
       {sql6("avg(vibration_x)")} AS vibration_x, {sql6("avg(temperature)")} AS temperature,
       min(event_time) AS first_time, max(event_time) AS last_time
FROM machine GROUP BY node_id, sensor_id""")
def decode_json(spark: SparkSession, folder: str) -> DataFrame:
    """Nested machine messages decoded and flattened."""
    rows = topics.decode(machine_messages(tables.machine(spark, folder)), READING_MACHINE)
    return rows.groupBy("node_id", "sensor_id").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("label").alias("anomalies"),
        r6(F.avg("features.vibration_x")).alias("vibration_x"),
        r6(F.avg("features.temperature")).alias("temperature"),
        plain_time(F.min(X.iso_time("timestamp"))).alias("first_time"),
        plain_time(F.max("event_time")).alias("last_time"))


@query(f"""{views("readings")}
SELECT event_id, edge_id AS key, 'sensor_data' AS topic, CAST(label AS VARCHAR) AS label_text,
       label = 1 AS has_type
FROM readings""")
def encode_json(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as keyed JSON texts; null fields are left out."""
    messages = reading_messages(tables.readings(spark, folder))
    return messages.select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "key",
        "topic", F.get_json_object("value", "$.label").alias("label_text"),
        F.contains("value", F.lit('"type":')).alias("has_type"))


@query(f"""{views("updates")}
SELECT node_id, 'round_' || round AS model_key, 'fog_node_' || node_id AS update_key,
       region AS region_key
FROM updates""")
def publish_key(spark: SparkSession, folder: str) -> DataFrame:
    """Keys under which models and updates are published."""
    return tables.updates(spark, folder).select(
        "node_id", X.prefixed_key("round", "round").alias("model_key"),
        X.prefixed_key("fog_node", "node_id").alias("update_key"),
        F.col("region").alias("region_key"))


LOG_ROWS = f"""{views("cells")},
means AS (SELECT round, pos, sum(n_samples * w) / sum(n_samples) AS w,
                 CAST(sum(n_samples) AS BIGINT) AS total_samples, count(*) AS participants
          FROM cells GROUP BY round, pos)
SELECT round, total_samples, participants,
       {sql6("max(w) FILTER (pos = 65)")} AS weighted_loss,
       {sql6("sqrt(sum(w * w) FILTER (pos < 64))")} AS weights_norm
FROM means GROUP BY round, total_samples, participants"""


def _log_lines(updates: DataFrame) -> DataFrame:
    nodes = updates.select("round", F.col("node_id").cast("string").alias("node_id"))
    members = participants(nodes, ["round"], "node_id")
    times = updates.groupBy("round").agg(F.max("event_time").alias("event_time"))
    models = fedavg_vector(updates, ["round"]).join(times, "round").join(members, "round")
    return log_rows(models.select(
        "round", X.iso_text("event_time").alias("timestamp"), "weighted_loss",
        "total_samples", F.col("participants").alias("participating_nodes"), "weights", "page"))


def _log_summary(log: DataFrame) -> DataFrame:
    pages = log.groupBy("round").agg(
        F.max("total_samples").alias("total_samples"),
        F.sum(F.size("participating_nodes")).cast("bigint").alias("participants"),
        r6(F.max("weighted_loss")).alias("weighted_loss"),
        r6(F.max("weights_norm")).alias("weights_norm"))
    return pages


@query(LOG_ROWS)
def round_log(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds appended to the log and read back."""
    path = run_folder(spark, "log")
    append_rounds(_log_lines(tables.updates(spark, folder)), path)
    return _log_summary(read_rounds(spark, path))


@query(LOG_ROWS)
def log_read_skip_bad(spark: SparkSession, folder: str) -> DataFrame:
    """A log with a damaged copy of every line: the damaged ones are skipped."""
    path = run_folder(spark, "badlog")
    lines = _log_lines(tables.updates(spark, folder)).select(
        F.to_json(F.struct("*")).alias("value"))
    damaged = lines.select(F.expr("left(value, length(value) div 2)").alias("value"))
    lines.unionByName(damaged).write.text(path)
    return _log_summary(read_rounds(spark, path))


@query(f"""{views("readings", "updates")},
good AS (SELECT edge_id FROM readings WHERE event_id % 7 <> 0 AND event_id % 11 <> 0),
bad AS (SELECT edge_id FROM readings WHERE event_id % 7 = 0 OR event_id % 11 = 0)
SELECT edge_id, 'good' AS outcome, count(*) AS messages FROM good GROUP BY edge_id
UNION ALL SELECT edge_id, 'rejected', count(*) FROM bad GROUP BY edge_id""")
def reject_bad(spark: SparkSession, folder: str) -> DataFrame:
    """Messages cut short or lacking their entity go to the side output."""
    readings = tables.readings(spark, folder)
    sent = readings.select(
        F.col("edge_id").alias("key"), F.lit(S.TOPICS["sensor_data"]).alias("topic"),
        F.col("event_time").alias("timestamp"),
        F.to_json(F.struct(
            F.when(F.col("event_id") % 11 != 0, F.col("edge_id")).alias("edge_id"),
            "label", "voltage")).alias("whole"), "event_id")
    messages = sent.select("key", "topic", "timestamp", F.when(
        F.col("event_id") % 7 == 0, F.expr("left(whole, length(whole) - 3)"))
        .otherwise(F.col("whole")).alias("value"))
    told = topics.checked(messages, READING_ELECTRIC, ["edge_id", "voltage", "label"])
    return told.groupBy(
        F.when(F.col("_sound"), F.col("data.edge_id")).otherwise(F.col("key")).alias("edge_id"),
        F.when(F.col("_sound"), "good").otherwise("rejected").alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"))


@query(f"""{views("updates")},
sent AS (
    SELECT 'sensor_data' AS topic, props AS value FROM events
    UNION ALL
    SELECT 'edge_weights', json_object('edge_id', edge_id, 'region', region, 'round', round,
                                       'n_samples', n_samples)::VARCHAR
    FROM updates),
sizes AS (SELECT topic, count(*) AS messages, CAST(sum(strlen(value)) AS BIGINT) AS bytes
          FROM sent GROUP BY topic)
SELECT topic, messages, bytes,
       {sql6("bytes::DOUBLE / (SELECT bytes FROM sizes WHERE topic = 'sensor_data')")} AS ratio
FROM sizes""")
def bytes_by_topic(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes carried by each topic, relative to the raw readings' topic."""
    raw = tables.table(spark, folder, "events").select(
        F.lit("sensor_data").alias("topic"), F.col("props").alias("value"))
    sent = tables.updates(spark, folder).select(
        F.lit("edge_weights").alias("topic"),
        F.to_json(F.struct("edge_id", "region", "round", "n_samples")).alias("value"))
    sizes = monitor.bytes_by_topic(raw.unionByName(sent), "sensor_data")
    return sizes.withColumn("ratio", r6("ratio"))


@query(f"""{views("readings", "updates")},
both_topics AS (
    SELECT edge_id, 'reading' AS kind, event_time, NULL AS n_samples FROM readings
    UNION ALL SELECT edge_id, 'update', event_time, n_samples FROM updates)
SELECT kind, count(*) AS messages, count(DISTINCT edge_id) AS entities,
       CAST(sum(n_samples) AS BIGINT) AS n_samples, min(event_time) AS first_time
FROM both_topics GROUP BY kind""")
def union_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Two topics read as one; fields only one of them has are null for the other."""
    read = tables.readings(spark, folder).select(
        "edge_id", F.lit("reading").alias("kind"), "event_time")
    sent = tables.updates(spark, folder).select(
        "edge_id", F.lit("update").alias("kind"), "event_time", "n_samples")
    return read.unionByName(sent, allowMissingColumns=True).groupBy("kind").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("edge_id").alias("entities"),
        F.sum("n_samples").alias("n_samples"),
        plain_time(F.min("event_time")).alias("first_time"))
