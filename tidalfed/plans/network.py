"""Networks of message jobs run over the given tables, three times round the cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.plans.aggregates import ALERTS
from tidalfed.plans.messages import machine_messages, reading_messages
from tidalfed.plans.registry import plain_time, query, r6, sql6, views
from tidalfed.session import run_folder, written
from tidalfed.sources import tables
from tidalfed.sources.replay import sliced
from tidalfed.streaming import network

CYCLES = 3
RATE = 0.01
DAYS = "10 days"


def _channel(spark: SparkSession, label: str) -> tuple[network.RecordedTopics, str]:
    run = run_folder(spark, label)
    return network.RecordedTopics(spark, f"{run}/topics"), run


def _feeder(channel: network.RecordedTopics, messages: DataFrame, names: list[str]):
    """Publish the messages of one slice of time, each to its topic.

    Messages are made and dealt to slices and topics once.
    """
    cut = written(sliced(messages, "timestamp", CYCLES).withColumn(
        "_topic", F.col("topic")), "feed", "_slice", "_topic")

    def feed(number: int) -> None:
        came = cut.filter(F.col("_slice") == number)
        for name in names:
            channel.put(came.filter(F.col("_topic") == name).drop("_slice", "_topic"), name,
                        f"gateway-{number}")

    return feed


def run_electric(spark: SparkSession, folder: str, label: str) -> network.RecordedTopics:
    """Readings to edges, edges to regions, regions to the global model, and back."""
    channel, run = _channel(spark, label)
    feed = _feeder(channel, reading_messages(tables.readings(spark, folder)),
                   [S.TOPICS["sensor_data"]])
    network.run_cycle(feed, [network.EdgeJob(channel, run, RATE),
                             network.RegionJob(channel, run, DAYS),
                             network.GlobalJob(channel, run)], CYCLES)
    return channel


def _long(rows: DataFrame, topic: str, key, number, samples, anomalies, vector) -> DataFrame:
    return rows.select(
        F.lit(topic).alias("topic"), key.alias("key"), number.cast("bigint").alias("number"),
        samples.cast("bigint").alias("samples"), anomalies.cast("bigint").alias("anomalies"),
        F.posexplode(vector).alias("pos", "value")).withColumn("value", r6("value"))


def _model(column: str):
    return F.concat(F.flatten(f"{column}.coef"), F.col(f"{column}.intercept"))


def sql_cut(source: str, time: str = "event_time") -> str:
    """The slice of each row, as in :func:`sliced`."""
    return f"""SELECT *, CAST(least({CYCLES - 1}, (epoch_us({time}) - lo) * {CYCLES}
        // greatest(1, hi - lo)) AS INTEGER) AS slice
    FROM {source}, (SELECT min(epoch_us({time})) AS lo, max(epoch_us({time})) AS hi FROM {source})"""


def sql_train(cycle: int, dim: int, key: str, before: str) -> str:
    """One step of each node on the rows of a cycle from the model row ``before``, evaluated."""
    dots = " + ".join(f"w{j} * x{j}" for j in range(dim)) + " + b"
    p = f"1e0 / (1e0 + exp(-greatest(-500e0, least(500e0, {dots}))))"
    q = "greatest(1e-15, least(1e0 - 1e-15, p))"
    moved = ", ".join(f"any_value(w{j}) - {RATE}e0 * avg(x{j} * e) AS w{j}" for j in range(dim))
    return f"""
step{cycle} AS (
    SELECT {key}, {moved}, any_value(b) - {RATE}e0 * avg(e) AS b
    FROM (SELECT *, {p} - y AS e FROM rows, {before} WHERE slice = {cycle}) GROUP BY {key}),
node{cycle} AS (
    SELECT {cycle} AS cycle, s.*, t.* EXCLUDE ({key}) FROM step{cycle} s JOIN (
        SELECT {key}, avg(CASE WHEN (p >= 0.5e0) = (y = 1) THEN 1e0 ELSE 0e0 END) AS accuracy,
               -avg(y * ln({q}) + (1 - y) * ln(1 - {q})) AS loss, count(*) AS n,
               CAST(sum(y) AS BIGINT) AS found, max(event_time) AS last
        FROM (SELECT *, {p} AS p FROM rows JOIN step{cycle} USING ({key}) WHERE slice = {cycle})
        GROUP BY {key}) t USING ({key}))"""


def sql_list(names: str, table: str, columns: str) -> str:
    return (f"SELECT {columns}, CAST(pos - 1 AS INTEGER) AS pos, {sql6(f'[{names}][pos]')} AS value "
            f"FROM {table}, range(1, len([{names}]) + 1) AS r(pos)")


X3 = "(voltage - 230e0) / 5e0 AS x0, (current - 10e0) / 2e0 AS x1, " \
     "(voltage * current - 2300e0) / 10e0 AS x2, label::DOUBLE AS y"

ELECTRIC = f"""{views("readings")},
rows AS ({sql_cut(f"(SELECT edge_id, region, event_time, {X3} FROM readings)")}),
global_0 AS (SELECT 0e0 AS w0, 0e0 AS w1, 0e0 AS w2, 0e0 AS b)""" + "".join(f""",
{sql_train(c, 3, "edge_id", f"global_{c}")},
edge{c} AS (
    SELECT n.*, r.region, epoch_us(last) // 864000000000 AS part
    FROM node{c} n JOIN (SELECT DISTINCT edge_id, region FROM readings) r USING (edge_id)),
sent{c} AS (
    SELECT region, part, sum(n) // count(*) AS share, count(*) AS models FROM edge{c} GROUP BY ALL),
global_{c + 1} AS (
    SELECT sum(share * w0) / sum(share) AS w0, sum(share * w1) / sum(share) AS w1,
           sum(share * w2) / sum(share) AS w2, sum(share * b) / sum(share) AS b
    FROM edge{c} JOIN sent{c} USING (region, part))""" for c in range(CYCLES)) + """,
edges AS (
    SELECT *, sum(n) OVER w AS total, CAST(sum(found) OVER w AS BIGINT) AS anomalies
    FROM (""" + " UNION ALL ".join(f"SELECT * FROM edge{c}" for c in range(CYCLES)) + """)
    WINDOW w AS (PARTITION BY edge_id ORDER BY cycle)),
regions AS (
    SELECT cycle, region, part, sum(n) // count(*) * count(*) AS counted, sum(n) AS samples,
           CAST(sum(anomalies) AS BIGINT) AS anomalies, avg(accuracy) AS accuracy,
           count(*) AS models
    FROM edges GROUP BY cycle, region, part),
rounds AS (
    SELECT cycle, 'north,south' AS key, CAST(sum(counted) AS BIGINT) AS samples,
           CAST(sum(anomalies) AS BIGINT) AS anomalies, CAST(sum(models) AS DOUBLE) AS models
    FROM regions GROUP BY cycle),
models AS (""" + " UNION ALL ".join(
    f"SELECT {c} AS cycle, * FROM global_{c + 1}" for c in range(CYCLES)) + """),
published AS (SELECT * FROM models JOIN rounds USING (cycle))
""" + sql_list("w0, w1, w2, b, accuracy, total::DOUBLE", "edges", """
    'edge_weights' AS topic, edge_id || '/' || region AS key, cycle::BIGINT AS number,
    n AS samples, anomalies""") + " UNION ALL " + sql_list(
    "accuracy, models::DOUBLE", "regions", """
    'fog_agg', region, part::BIGINT, samples::BIGINT, anomalies""") + " UNION ALL " + sql_list(
    "w0, w1, w2, b", "published", """
    'global_model', key, cycle::BIGINT, samples, CAST(0 AS BIGINT)""") + " UNION ALL " + sql_list(
    "models", "rounds", "'global_metrics', key, cycle::BIGINT, samples, anomalies")


@query(ELECTRIC)
def network_electric(spark: SparkSession, folder: str) -> DataFrame:
    """All messages of three cycles of the electric network: updates, roll-ups, models, metrics."""
    channel = run_electric(spark, folder, "electric")
    read = {t: channel.table(t, network.FORMATS[t]) for t in (
        S.TOPICS[n] for n in ("edge_weights", "fog_agg", "global_model", "global_metrics"))}
    updates, rolled, models, metrics = read.values()
    metric = lambda c: F.col(c).cast("double")
    part = F.expr("unix_micros(window_start) div 864000000000")
    members = lambda: F.array_join("participating_regions", ",")
    return (_long(updates.filter("timestamp IS NOT NULL"), "edge_weights",
                  F.concat_ws("/", "edge_id", "region"), F.col("round"), F.col("n_samples"),
                  F.col("metrics.anomalies_detected"),
                  F.concat(_model("weights"), F.array("metrics.local_accuracy",
                                                      metric("metrics.total_samples"))))
            .unionByName(_long(rolled.filter("fog_timestamp IS NOT NULL"), "fog_agg",
                               F.col("region"), part, F.col("total_n_samples"),
                               F.col("total_anomalies"),
                               F.array("avg_accuracy", F.size("all_weights").cast("double"))))
            .unionByName(_long(models, "global_model", members(), F.col("round"),
                               F.col("total_samples"), F.lit(0), _model("global_weights")))
            .unionByName(_long(metrics, "global_metrics", members(), F.col("round"),
                               F.col("total_samples"), F.col("anomalies_detected"),
                               F.array(metric("num_updates")))))


@query(f"{ALERTS} AND window_start + INTERVAL 1 DAY <= "
       "(SELECT max(event_time) - INTERVAL 1 HOUR FROM readings)")
def network_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alert messages about the readings of the electric network, decoded again."""
    channel, run = _channel(spark, "alertnet")
    feed = _feeder(channel, reading_messages(tables.readings(spark, folder)),
                   [S.TOPICS["sensor_data"]])
    for number in range(CYCLES):
        feed(number)
    network.publish_alerts(channel, run, "1 day", "1 hour")
    messages = spark.read.parquet(channel.path(S.TOPICS["alerts"]))
    raised = network.topics.decode(messages, network.ALERT + ", n_samples bigint")
    return raised.select(
        "edge_id", plain_time("window_start").alias("window_start"),
        plain_time("window_end").alias("window_end"), "n_samples",
        r6("anomaly_rate").alias("anomaly_rate"), "severity")


X5 = """vibration_x - 0.5e0 AS x0, vibration_y - 0.5e0 AS x1, vibration_z - 0.5e0 AS x2,
    (temperature - 65e0) / 20e0 AS x3, (pressure - 100e0) / 30e0 AS x4, label::DOUBLE AS y"""
W5 = ", ".join(f"sum(total * w{j}) / sum(total) AS w{j}" for j in range(5))

MACHINE = f"""{views("machine")},
rows AS ({sql_cut(f"(SELECT node_id, event_time, {X5} FROM machine)")}),
global_0 AS (SELECT 0e0 AS w0, 0e0 AS w1, 0e0 AS w2, 0e0 AS w3, 0e0 AS w4, 0e0 AS b)""" + "".join(f""",
{sql_train(c, 5, "node_id", f"global_{c}")},
life{c} AS (SELECT m.*, (SELECT count(*) FROM rows r WHERE r.node_id = m.node_id AND slice <= {c})
                   AS total FROM node{c} m),
global_{c + 1} AS (SELECT {W5}, sum(total * b) / sum(total) AS b FROM life{c})"""
                                                     for c in range(CYCLES)) + """,
nodes AS (""" + " UNION ALL ".join(f"SELECT * FROM life{c}" for c in range(CYCLES)) + """),
losses AS (SELECT cycle, sum(total * loss) / sum(total) AS loss, CAST(sum(total) AS BIGINT) AS total,
                  string_agg(node_id, ',' ORDER BY node_id) AS key
           FROM nodes GROUP BY cycle),
models AS (""" + " UNION ALL ".join(
    f"SELECT {c} AS cycle, * FROM global_{c + 1}" for c in range(CYCLES)) + """),
published AS (
    SELECT *, sum(loss) OVER (ORDER BY cycle) AS history FROM models JOIN losses USING (cycle))
""" + sql_list("w0, w1, w2, w3, w4, b, loss", "nodes", """
    'model-weights' AS topic, node_id::VARCHAR AS key, cycle::BIGINT AS number, total AS samples,
    CAST(0 AS BIGINT) AS anomalies""") + " UNION ALL " + sql_list(
    "w0, w1, w2, w3, w4, b, loss, history", "published", """
    'global-model', key, (cycle + 1)::BIGINT, total, CAST(0 AS BIGINT)""")


@query(MACHINE)
def network_machine(spark: SparkSession, folder: str) -> DataFrame:
    """All messages of three cycles of the machine network: node updates and global models."""
    channel, run = _channel(spark, "machines")
    feed = _feeder(channel, machine_messages(tables.machine(spark, folder)),
                   list(S.MACHINE_TOPICS.values()))
    network.run_cycle(feed, [network.NodeJob(channel, run, RATE),
                             network.AggregatorJob(channel, run)], CYCLES)
    sent = channel.table(S.MACHINE_WEIGHTS_TOPIC, network.NODE_UPDATE)
    # The wire carries no cycle: a node's updates are told apart by their order.
    number = sent.select("*", F.expr(
        "count(*) OVER (PARTITION BY node_id ORDER BY model_weights.num_samples) - 1").alias("_c"))
    models = channel.table(S.MACHINE_MODEL_TOPIC, network.GLOBAL_MODEL_MACHINE)
    history = F.aggregate("loss_history", F.lit(0.0), lambda s, x: s + x)
    return _long(number, "model-weights", F.col("node_id").cast("string"), F.col("_c"),
                 F.col("model_weights.num_samples"), F.lit(0),
                 F.concat("model_weights.weights", F.array("model_weights.bias", "loss"))
                 ).unionByName(_long(
                     models, "global-model", F.array_join(
                         F.col("participating_nodes").cast("array<string>"), ","),
                     F.col("round"), F.col("aggregation_info.total_samples"), F.lit(0),
                     F.concat("aggregated_weights.weights", F.array(
                         "aggregated_weights.bias", "aggregation_info.weighted_loss", history))))
