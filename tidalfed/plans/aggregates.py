"""Roll-ups, averaging, participation and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.operators import fedavg as A
from tidalfed.operators import joins as J
from tidalfed.operators import monitor, rollup, rounds
from tidalfed.plans.messages import round_models
from tidalfed.plans.projections import MACHINE_P, machine_probability
from tidalfed.functions import scoring as P
from tidalfed.functions.features import iso_text
from tidalfed.plans.registry import long_model, plain_time, query, r6, sql6, views
from tidalfed.session import settled
from tidalfed.sources import tables


@query(f"""{views("updates")},
placed AS (
    SELECT *, time_bucket(INTERVAL 30 SECOND, event_time) AS window_start,
           (row_number() OVER (PARTITION BY region, time_bucket(INTERVAL 30 SECOND, event_time)
                               ORDER BY edge_id, event_time) - 1) // 10000 AS page
    FROM updates)
SELECT region, window_start, window_start + INTERVAL 30 SECOND AS window_end,
       CAST(page AS INTEGER) AS page,
       string_agg(edge_id, ',' ORDER BY edge_id) AS contributing_edges,
       CAST(count(*) AS INTEGER) AS models,
       {sql6("list_sum(list(list_sum(weights) ORDER BY edge_id))")} AS sum_of_weights,
       CAST(sum(n_samples) AS BIGINT) AS total_n_samples,
       {sql6("avg(accuracy)")} AS avg_accuracy,
       CAST(sum(anomalies) AS BIGINT) AS total_anomalies, count(*) AS num_updates
FROM placed GROUP BY ALL""")
def regional_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Contributing edges, their models and totals by 30-second window and region."""
    return _pages(rollup.regional_pages(tables.updates(spark, folder)))


def _pages(rows: DataFrame) -> DataFrame:
    add = lambda a, b: a + b
    whole = F.aggregate("all_weights", F.lit(0.0), lambda s, w: s + F.aggregate(
        w, F.lit(0.0), add))
    return rows.select(
        "region", plain_time("window_start").alias("window_start"),
        plain_time("window_end").alias("window_end"), "page",
        F.array_join("contributing_edges", ",").alias("contributing_edges"),
        F.size("all_weights").alias("models"), r6(whole).alias("sum_of_weights"),
        "total_n_samples", r6("avg_accuracy").alias("avg_accuracy"), "total_anomalies",
        "num_updates")


@query(f"""{views("updates")},
placed AS (
    SELECT *, time_bucket(INTERVAL 30 SECOND, event_time) AS window_start,
           (row_number() OVER (PARTITION BY region, time_bucket(INTERVAL 30 SECOND, event_time)
                               ORDER BY edge_id, event_time) - 1) // 2 AS page
    FROM updates)
SELECT region, window_start, window_start + INTERVAL 30 SECOND AS window_end,
       CAST(page AS INTEGER) AS page,
       string_agg(edge_id, ',' ORDER BY edge_id) AS contributing_edges,
       CAST(count(*) AS INTEGER) AS models,
       {sql6("list_sum(list(list_sum(weights) ORDER BY edge_id))")} AS sum_of_weights,
       CAST(sum(n_samples) AS BIGINT) AS total_n_samples,
       {sql6("avg(accuracy)")} AS avg_accuracy,
       CAST(sum(anomalies) AS BIGINT) AS total_anomalies, count(*) AS num_updates
FROM placed GROUP BY ALL""")
def regional_rollup_paged(spark: SparkSession, folder: str) -> DataFrame:
    """The same in messages of two updates; each has the totals of its own."""
    return _pages(rollup.regional_pages(tables.updates(spark, folder), page_rows=2))


@query(f"""{views("cells")}
SELECT region, time_bucket(INTERVAL 30 SECOND, event_time) AS window_start, edge_id, n_samples,
       CAST(pos AS INTEGER) AS pos, {sql6("w")} AS value
FROM cells WHERE pos < 64""")
def regional_members(spark: SparkSession, folder: str) -> DataFrame:
    """Members of the roll-up with their whole models, one row per weight."""
    members = rollup.regional_members(tables.updates(spark, folder))
    return members.select(
        "region", plain_time("window_start").alias("window_start"), "edge_id", "n_samples",
        F.posexplode("weights").alias("pos", "value")).withColumn("value", r6("value"))


@query(f"""{views("updates")},
latest_counts AS (
    SELECT region, edge_id, time_bucket(INTERVAL 30 SECOND, event_time) AS window_start,
           max(anomalies) AS anomalies
    FROM updates GROUP BY ALL)
SELECT region, window_start, window_start + INTERVAL 30 SECOND AS window_end,
       CAST(sum(anomalies) AS BIGINT) AS total_anomalies
FROM latest_counts GROUP BY region, window_start""")
def regional_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Anomalies by window and region when updates report cumulative counts."""
    totals = rollup.corrected_anomalies(tables.updates(spark, folder))
    return totals.withColumns({c: plain_time(c) for c in ("window_start", "window_end")})


FEDAVG_BY = """SELECT {keys}, CAST(sum(n_samples) AS BIGINT) AS total_samples,
       count(*) AS updates, CAST(pos AS INTEGER) AS pos, {value} AS value
FROM cells GROUP BY {keys}, pos"""


@query(views("cells") + FEDAVG_BY.format(keys="region",
                                         value=sql6("sum(n_samples * w) / sum(n_samples)")))
def fedavg_vector(spark: SparkSession, folder: str) -> DataFrame:
    """Model of each region: weights, bias and loss averaged by samples."""
    return long_model(A.fedavg_vector(tables.updates(spark, folder), ["region"]), "region")


@query(f"""{views("updates")},
cells AS (
    SELECT region, node_id, n_samples, unnest(list_concat(weights, [bias, -bias, bias / 2, 1e0]))
               AS w,
           generate_subscripts(list_concat(weights, [bias, -bias, bias / 2, 1e0]), 1) - 1 AS pos
    FROM updates),
firsts AS (SELECT region, arg_min(node_id % 3, event_time) AS second_class
           FROM updates GROUP BY region)
SELECT region, CASE WHEN pos < 64 THEN 'coef' ELSE 'intercept' END AS part,
       CAST(CASE WHEN pos < 64 THEN pos // 16 ELSE 0 END AS INTEGER) AS i,
       CAST(CASE WHEN pos < 64 THEN pos % 16 ELSE pos - 64 END AS INTEGER) AS j,
       {sql6("sum(n_samples * w) / sum(n_samples)")} AS value,
       '0,' || any_value(second_class + 1) AS classes
FROM cells JOIN firsts USING (region) GROUP BY region, pos""")
def fedavg_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Models with a 4 x 16 coefficient matrix, four intercepts, classes of the first."""
    rows = [F.slice("weights", 16 * k + 1, 16) for k in range(4)]
    model = F.struct(
        F.array(*rows).alias("coef"),
        F.array(F.col("bias"), -F.col("bias"), F.col("bias") / 2, F.lit(1.0)).alias("intercept"),
        F.array(F.lit(0), (F.col("node_id") % 3 + 1).cast("int")).alias("classes"))
    updates = tables.updates(spark, folder).withColumn("weights", model)
    models = A.fedavg_matrix(updates, ["region"], "event_time").select(
        "region", "global_weights.*", F.array_join(
            F.col("global_weights.classes").cast("array<string>"), ",").alias("class_names"))
    coef = models.select("region", "class_names", F.posexplode("coef").alias("i", "row")).select(
        "region", F.lit("coef").alias("part"), "i", F.posexplode("row").alias("j", "value"),
        "class_names")
    intercept = models.select(
        "region", F.lit("intercept").alias("part"), F.lit(0).alias("i"),
        F.posexplode("intercept").alias("j", "value"), "class_names")
    return coef.unionByName(intercept).withColumn("value", r6("value")).withColumnRenamed(
        "class_names", "classes")


@query(f"""{views("cells")},
regional AS (
    SELECT model_id, round, region, pos, sum(n_samples * w) / sum(n_samples) AS w,
           sum(n_samples) AS n
    FROM cells GROUP BY model_id, round, region, pos)
SELECT model_id, round, CAST(sum(n) AS BIGINT) AS total_samples, count(*) AS updates,
       CAST(pos AS INTEGER) AS pos, {sql6("sum(n * w) / sum(n)")} AS value
FROM regional GROUP BY model_id, round, pos""")
def fedavg_hierarchical(spark: SparkSession, folder: str) -> DataFrame:
    """Global model of each round, averaged within regions and then over them."""
    models = A.fedavg_hierarchical(tables.updates(spark, folder), ["model_id", "round"])
    return long_model(models, "model_id", "round")


@query(f"""{views("cells")},
shares AS (SELECT round, region, sum(n_samples) // count(*) AS share FROM updates
           GROUP BY round, region)
SELECT round, CAST(sum(share) AS BIGINT) AS total_samples, count(*) AS updates,
       CAST(pos AS INTEGER) AS pos, {sql6("sum(share * w) / sum(share)")} AS value
FROM cells JOIN shares USING (round, region) WHERE pos < 65 GROUP BY round, pos""")
def fedavg_equal_split(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds in which a region's samples are split evenly over its updates."""
    models = A.fedavg_equal_split(tables.updates(spark, folder), ["round"])
    return long_model(models, "round", parts=("bias",))


@query(f"""{views("updates")}
SELECT round, node_id, n_samples AS samples,
       {sql6("n_samples / sum(n_samples) OVER (PARTITION BY round)")} AS weight_factor,
       {sql6("loss")} AS loss
FROM updates""")
def node_contribution(spark: SparkSession, folder: str) -> DataFrame:
    """Each update's share of its round."""
    shares = A.contributions(tables.updates(spark, folder), ["round"])
    return shares.withColumns({"weight_factor": r6("weight_factor"), "loss": r6("loss")})


@query(f"""{views("updates")}
SELECT round, count(DISTINCT region) AS participants, count(DISTINCT region) >= 2 AS ready,
       string_agg(DISTINCT region, ',' ORDER BY region) AS regions
FROM updates GROUP BY round""")
def round_ready(spark: SparkSession, folder: str) -> DataFrame:
    """Participants of each round and whether they are enough."""
    # Both operators only look at distinct participants: the updates are read once for these.
    seen = settled(tables.updates(spark, folder).select("round", "region").distinct())
    names = rounds.participants(seen, ["round"]).select(
        "round", F.array_join("participants", ",").alias("regions"))
    return rounds.round_ready(seen, ["round"]).join(names, "round")


@query(f"""{views("updates")}
SELECT region, arg_max(node_id, event_time) AS node_id, arg_max(n_samples, event_time)
           AS n_samples, {sql6("arg_max(weights[1], event_time)")} AS first_weight,
       max(event_time) AS event_time
FROM updates GROUP BY region""")
def latest_per_node(spark: SparkSession, folder: str) -> DataFrame:
    """The newest update of each region."""
    newest = J.latest(tables.updates(spark, folder), ["region"], ["event_time"])
    return newest.select("region", "node_id", "n_samples",
                         r6(F.col("weights")[0]).alias("first_weight"),
                         plain_time("event_time").alias("event_time"))


@query(f"""{views("updates")}
SELECT round, CAST(sum(n_samples) AS BIGINT) AS total_samples,
       count(DISTINCT region) AS participants, count(*) AS num_updates,
       CAST(sum(anomalies) AS BIGINT) AS anomalies_detected
FROM updates GROUP BY round""")
def global_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounds.global_metrics(tables.updates(spark, folder), ["round"])


@query(f"""{views("readings")}
SELECT region, edge_id, count(*) AS anomalies FROM readings WHERE label = 1
GROUP BY region, edge_id""")
def count_anomalies_by_edge(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.anomaly_counts(tables.readings(spark, folder), ["region", "edge_id"])


@query(f"""{views("readings")}
SELECT region, edge_id, count(*) FILTER (label = 1) AS anomalies FROM readings
GROUP BY ROLLUP (region, edge_id)""")
def anomaly_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Anomalies by entity, region and in all."""
    return monitor.anomaly_rollup(tables.readings(spark, folder))


@query(f"""{views("updates")},
rounds AS (SELECT round, CAST(sum(n_samples) // count(DISTINCT region) AS BIGINT) AS share,
                  sum(n_samples * loss) / sum(n_samples) AS loss
           FROM updates GROUP BY round),
members AS (SELECT DISTINCT round, region FROM updates)
SELECT region, count(*) AS contributions, arg_max(share, round) AS total_samples,
       {sql6("arg_max(loss, round)")} AS last_loss
FROM members JOIN rounds USING (round) GROUP BY region""")
def node_stats(spark: SparkSession, folder: str) -> DataFrame:
    """What a monitor shows per participant, in its order."""
    updates = tables.updates(spark, folder)
    totals = settled(A.fedavg_vector(updates, ["round"]))
    members = updates.select("round", "region").distinct()
    stats = monitor.node_stats(totals, members, node="region")
    return stats.withColumn("last_loss", r6("last_loss")).orderBy("region")


@query(f"""{views("machine")}
SELECT node_id, count(*) AS n_samples,
       {sql6(f"avg(CASE WHEN CAST({MACHINE_P} >= 0.5e0 AS INTEGER) = label THEN 1e0 ELSE 0e0 END)")}
           AS accuracy
FROM machine GROUP BY node_id""")
def batch_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    scored = tables.machine(spark, folder).withColumn(
        "predicted", P.predicted_class(machine_probability()))
    return monitor.batch_quality(scored, ["node_id"]).withColumn("accuracy", r6("accuracy"))


CLIPPED = f"greatest(1e-15, least(1e0 - 1e-15, {MACHINE_P}))"


@query(f"""{views("machine")}
SELECT node_id, {sql6(f"-avg(label * ln({CLIPPED}) + (1 - label) * ln(1e0 - {CLIPPED}))")} AS loss
FROM machine GROUP BY node_id""")
def bce_loss(spark: SparkSession, folder: str) -> DataFrame:
    """Mean cross-entropy of each node."""
    scored = tables.machine(spark, folder).withColumn("_p", machine_probability())
    return scored.groupBy("node_id").agg(
        r6(F.avg(P.cross_entropy(F.col("_p"), F.col("label")))).alias("loss"))


@query(f"""{views("machine")},
cells AS (
    SELECT sensor_id, count(*) FILTER (p AND label = 1) AS tp,
           count(*) FILTER (p AND label = 0) AS fp, count(*) FILTER (NOT p AND label = 0) AS tn,
           count(*) FILTER (NOT p AND label = 1) AS fn
    FROM (SELECT *, {MACHINE_P} >= 0.5e0 AS p FROM machine) GROUP BY sensor_id)
SELECT sensor_id, tp, fp, tn, fn, {sql6("tp / nullif(tp + fp, 0)")} AS precision,
       {sql6("tp / nullif(tp + fn, 0)")} AS recall, {sql6("fp / nullif(fp + tn, 0)")} AS fpr,
       {sql6("fn / nullif(fn + tp, 0)")} AS fnr
FROM cells""")
def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion counts and rates of each sensor."""
    scored = tables.machine(spark, folder).withColumn(
        "predicted", P.predicted_class(machine_probability()))
    cells = monitor.classification_metrics(scored, ["sensor_id"])
    return cells.withColumns({c: r6(c) for c in ("precision", "recall", "fpr", "fnr")})


@query(f"""{views("cells")},
rounds AS (SELECT model_id, round, sum(n_samples * loss) / sum(n_samples) AS loss,
                  max(event_time) AS event_time FROM updates GROUP BY model_id, round),
ends AS (SELECT model_id, count(*) AS rounds, arg_min(loss, round) AS first_loss,
                arg_max(loss, round) AS last_loss, min(event_time) AS first_time,
                max(event_time) AS last_time FROM rounds GROUP BY model_id)
SELECT model_id, rounds,
       strftime(first_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS first_timestamp,
       strftime(last_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS last_timestamp,
       {sql6("first_loss")} AS first_loss, {sql6("last_loss")} AS last_loss,
       {sql6("(first_loss - last_loss) / nullif(first_loss, 0) * 100")} AS improvement_pct
FROM ends""")
def log_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds, first and last loss and the improvement."""
    log = round_models(tables.updates(spark, folder)).withColumn(
        "timestamp", iso_text("event_time"))
    summary = monitor.log_summary(log)
    return summary.withColumns(
        {c: r6(c) for c in ("first_loss", "last_loss", "improvement_pct")})


ALERTS = f"""{views("readings")},
rates AS (SELECT edge_id, time_bucket(INTERVAL 1 DAY, event_time) AS window_start,
                 count(*) AS n_samples, avg(label) AS rate
          FROM readings GROUP BY ALL)
SELECT edge_id, window_start, window_start + INTERVAL 1 DAY AS window_end, n_samples,
       {sql6("rate")} AS anomaly_rate, CASE WHEN rate >= 0.25e0 THEN 'HIGH' ELSE 'MEDIUM' END
           AS severity
FROM rates WHERE rate > 0.15e0"""


@query(ALERTS)
def alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Entities and days with too many anomalies."""
    raised = monitor.anomaly_alerts(tables.readings(spark, folder), "1 day", S.ALERT_RATE)
    return raised.withColumns({
        "anomaly_rate": r6("anomaly_rate"), "window_start": plain_time("window_start"),
        "window_end": plain_time("window_end")})
