"""Streaming queries: the given tables replayed slice by slice; results are tables."""

from __future__ import annotations

from contextlib import suppress

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.functions import features as X
from tidalfed.operators import rollup
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.operators.joins import latest
from tidalfed.plans.joins import (
    ASOF, LATEST_SCORES, _asof_scores, newest_global_models, published_models, scored_readings)
from tidalfed.plans.aggregates import ALERTS
from tidalfed.operators.monitor import anomaly_alerts
from tidalfed.plans.registry import long_model, plain_time, query, r6, sql6, views
from tidalfed.plans.training import ALL_UPDATES, ROW_STEP, SEQUENCE, sql_long
from tidalfed.session import run_folder
from tidalfed.sources import tables
from tidalfed.sources.replay import SLICES, replayed
from tidalfed.sources.topics import table_stream
from tidalfed.streaming.asof import ModelsInForce, in_force
from tidalfed.streaming.rollup import rolled_up
from tidalfed.streaming.rounds import rounds_by_participants, rounds_by_trigger, rounds_by_window
from tidalfed.streaming.run import run_to_table, run_upserts
from tidalfed.streaming.training import (
    EntityTraining, entity_lines, publish_until, train_by_batch, train_by_entity)

DAY, DELAY = "1 day", "1 hour"


def _readings(spark: SparkSession, folder: str, late: Column | None = None) -> DataFrame:
    """The readings in order of time, a slice per trigger."""
    return replayed(tables.readings(spark, folder), run_folder(spark, "readings"), "event_time",
                    late=late)


def _updates(spark: SparkSession, folder: str) -> DataFrame:
    return replayed(tables.updates(spark, folder), run_folder(spark, "updates"), "event_time")


#: Readings that arrive two slices after their time.
LATE = "event_id % 23 = 5"


def sql_slices(source: str, time: str = "event_time", late: str = "FALSE") -> str:
    """Rows with the slice (trigger) each arrives in, as :func:`replayed` deals them."""
    return f"""SELECT r.*, least({SLICES - 1}, CAST(least({SLICES - 1},
            (epoch_us({time}) - lo) * {SLICES} // greatest(1, hi - lo)) AS INTEGER)
            + CASE WHEN {late} THEN 2 ELSE 0 END) AS slice
    FROM {source} r, (SELECT min(epoch_us({time})) AS lo, max(epoch_us({time})) AS hi
                      FROM {source})"""


def sql_watermarks(delay: str) -> str:
    """Folds the watermark trigger by trigger: a row is late in a trigger if its window ends
    no later than the watermark the trigger before worked with, which comes from the rows up
    to two triggers ago; ``closed`` is where the watermark ends."""
    return f"""
newest AS (SELECT slice, max(event_time) AS newest FROM arrived GROUP BY slice),
marks AS (
    SELECT b.slice, max(m.newest) FILTER (m.slice <= b.slice - 2) - INTERVAL {delay} AS mark
    FROM newest b, newest m GROUP BY b.slice),
kept AS (
    SELECT a.* FROM arrived a JOIN marks USING (slice)
    WHERE mark IS NULL OR window_start + INTERVAL 1 DAY > mark),
closing AS (SELECT max(newest) - INTERVAL {delay} AS closed FROM newest)"""


def _long_updates(updates: DataFrame) -> DataFrame:
    return long_model(updates, "edge_id", "lane", "round", parts=("bias",),
                      extra=("n_samples", "total_samples", "anomalies_detected"))


def _plain(windows: DataFrame) -> DataFrame:
    return windows.withColumns({c: plain_time(c) for c in ("window_start", "window_end")})


DAYS = f"""{views("readings")},
days AS (
    SELECT region, time_bucket(INTERVAL 1 DAY, event_time) AS window_start,
           time_bucket(INTERVAL 1 DAY, event_time) + INTERVAL 1 DAY AS window_end,
           count(*) AS n_samples, CAST(sum(label) AS BIGINT) AS anomalies,
           avg(voltage) AS avg_voltage
    FROM readings GROUP BY ALL),
cut AS (SELECT max(event_time) - INTERVAL 1 HOUR AS closed FROM readings)
"""
DAY_ROW = f"""SELECT region, window_start, window_end, n_samples, anomalies,
       {sql6("avg_voltage")} AS avg_voltage FROM days"""


ARRIVED = f"""{views("readings")},
arrived AS (
    SELECT *, time_bucket(INTERVAL 1 DAY, event_time) AS window_start
    FROM ({sql_slices("readings", late=LATE)})),{sql_watermarks("1 HOUR")},
rolled AS (
    SELECT region, window_start, window_start + INTERVAL 1 DAY AS window_end,
           count(*) AS n_samples, CAST(sum(label) AS BIGINT) AS anomalies,
           round(avg(voltage), 9) AS avg_voltage, count(DISTINCT slice) AS emissions
    FROM kept GROUP BY ALL)
"""


@query(f"""{ARRIVED}
SELECT * EXCLUDE (emissions) FROM rolled WHERE window_end <= (SELECT closed FROM closing)""")
def stream_rollup_append(spark: SparkSession, folder: str) -> DataFrame:
    """Regional days, each written once, when the watermark has closed it; rows that come
    later than that are dropped."""
    rows = rollup.readings_rollup(_readings(spark, folder, F.expr(LATE)), DAY, DELAY)
    result = run_to_table(rows, run_folder(spark, "append"))
    return _plain(result).withColumn("avg_voltage", F.round("avg_voltage", 9))


@query(f"""{ARRIVED}
SELECT * FROM rolled""")
def stream_rollup_update_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Regional days written whenever they change (``emissions`` times); the newest counts."""
    rows = rollup.readings_rollup(_readings(spark, folder, F.expr(LATE)), DAY, DELAY)
    run, keys = run_folder(spark, "update"), ["region", "window_start"]
    result = run_upserts(rows, run, keys)
    written = spark.read.schema(result.schema).parquet(f"{run}/data").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("emissions"))
    return _plain(result.join(written, keys)).withColumn(
        "avg_voltage", F.round("avg_voltage", 9))


@query(f"""{ARRIVED}
SELECT CAST((SELECT count(*) FROM arrived) AS BIGINT) AS arrived,
       CAST((SELECT count(*) FROM kept) AS BIGINT) AS kept,
       CAST(sum(emissions) AS BIGINT) AS emissions, max(emissions) AS most FROM rolled""")
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """How many readings came, how many were in time, and how often windows were written."""
    rows = rollup.readings_rollup(_readings(spark, folder, F.expr(LATE)), DAY, DELAY)
    run = run_folder(spark, "late")
    kept = run_upserts(rows, run, ["region", "window_start"]).agg(F.sum("n_samples").alias("kept"))
    written = spark.read.schema(rows.schema).parquet(f"{run}/data").groupBy(
        "region", "window_start").count().agg(
        F.sum("count").alias("emissions"), F.max("count").alias("most"))
    came = tables.readings(spark, folder).agg(F.count(F.lit(1)).alias("arrived"))
    one = F.lit(1).alias("_one")
    return came.select(one, "*").join(kept.select(one, "*"), "_one").join(
        written.select(one, "*"), "_one").drop("_one")


@query(f"""{DAYS} {DAY_ROW}""")
def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """The same without late rows, stopped between a batch's output and its commit, twice.

    The run starts again from its checkpoint each time and repeats the batch.
    """
    stream, run = _readings(spark, folder), run_folder(spark, "restart")
    rows = rollup.readings_rollup(stream, DAY, DELAY)
    for stop in (1, 3):
        with suppress(StreamingQueryException):
            run_upserts(rows, run, ["region", "window_start"], stop_after=stop)
    result = run_upserts(rows, run, ["region", "window_start"])
    return _plain(result).withColumn("avg_voltage", r6("avg_voltage"))


@query(f"""{views("updates")},
windows AS (
    SELECT region, time_bucket(INTERVAL 30 SECOND, event_time) AS window_start,
           time_bucket(INTERVAL 30 SECOND, event_time) + INTERVAL 30 SECOND AS window_end,
           string_agg(edge_id, ',' ORDER BY edge_id) AS contributing_edges,
           list_sum(list(list_sum(weights) ORDER BY edge_id)) AS w,
           CAST(sum(n_samples) AS BIGINT) AS total_n_samples, avg(accuracy) AS accuracy,
           CAST(sum(anomalies) AS BIGINT) AS total_anomalies, count(*) AS num_updates
    FROM updates GROUP BY ALL)
SELECT * EXCLUDE (accuracy, w), {sql6("accuracy")} AS avg_accuracy, {sql6("w")} AS sum_of_weights
FROM windows""")
def stream_regional_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Totals and members of the roll-up of updates, from one pass, by 30-second window."""
    totals, members = rolled_up(_updates(spark, folder), run_folder(spark, "regional"))
    keys = ["region", "window_start"]
    whole = F.aggregate("weights", F.lit(0.0), lambda s, x: s + x)
    listed = members.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list("edge_id")), ",").alias("contributing_edges"),
        r6(F.sum(whole)).alias("sum_of_weights"))
    return _plain(totals.join(listed, keys).select(
        *keys, "window_end", "contributing_edges", "total_n_samples",
        r6("avg_accuracy").alias("avg_accuracy"), "total_anomalies", "num_updates",
        "sum_of_weights"))


@query(LATEST_SCORES)
def stream_stateless_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of readings scored with the newest model of a table."""
    models = newest_global_models(tables.updates(spark, folder))
    return run_to_table(scored_readings(_readings(spark, folder), models),
                        run_folder(spark, "scores"))


@query(ASOF)
def stream_asof_model(spark: SparkSession, folder: str) -> DataFrame:
    """The model in force at each reading, from readings and models that come out of order."""
    run = run_folder(spark, "inforce")
    models = published_models(tables.updates(spark, folder))
    first, last = models.agg(F.min(F.unix_seconds("published_at")),
                             F.max(F.unix_seconds("published_at"))).first()
    late = replayed(models, f"{run}/sent", "published_at", late=F.col("model_node") % 7 == 3, by=1)
    job = ModelsInForce(run, 2.0 * (last - first) / SLICES, ["model_node", "weights", "bias"])
    readings = _readings(spark, folder, F.expr(LATE)).drop("model_id")
    return _asof_scores(in_force(readings, late, job))


@query(f"""{DAYS}
SELECT time_bucket(INTERVAL 2 DAY, window_start, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL 2 DAY, window_start, TIMESTAMP '1970-01-01') + INTERVAL 2 DAY
           AS window_end,
       count(*) AS regional_windows, CAST(sum(n_samples) AS BIGINT) AS n_samples,
       CAST(sum(anomalies) AS BIGINT) AS anomalies
FROM days WHERE window_end <= (SELECT closed FROM cut)
GROUP BY ALL HAVING max(time_bucket(INTERVAL 2 DAY, window_start, TIMESTAMP '1970-01-01'))
    + INTERVAL 2 DAY <= (SELECT closed FROM cut)""")
def stream_chained_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Regional days, and two-day windows over all regions on top of them."""
    rows = rollup.chained_rollup(_readings(spark, folder), DAY, "2 days", DELAY)
    return _plain(run_to_table(rows, run_folder(spark, "chained")))


@query(f"""{views("cells")}
SELECT model_id, time_bucket(INTERVAL 30 SECOND, event_time) AS window_start,
       time_bucket(INTERVAL 30 SECOND, event_time) + INTERVAL 30 SECOND AS window_end,
       CAST(sum(n_samples) AS BIGINT) AS total_samples, count(*) AS updates,
       CAST(pos AS INTEGER) AS pos, {sql6("sum(n_samples * w) / sum(n_samples)")} AS value
FROM cells GROUP BY ALL
HAVING max(time_bucket(INTERVAL 30 SECOND, event_time)) + INTERVAL 30 SECOND
    <= (SELECT max(event_time) - INTERVAL 10 SECOND FROM updates)""")
def stream_window_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """A round for each 30-second window, published when the watermark closes it."""
    models = run_to_table(rounds_by_window(_updates(spark, folder)),
                          run_folder(spark, "windowrounds"))
    return _plain(long_model(models, "model_id", "window_start", "window_end"))


@query(f"{ALERTS} AND window_start + INTERVAL 1 DAY <= "
       "(SELECT max(event_time) - INTERVAL 1 HOUR FROM readings)")
def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts on closed days."""
    rows = anomaly_alerts(_readings(spark, folder), DAY, watermark=DELAY)
    raised = run_to_table(rows, run_folder(spark, "alerts"))
    return _plain(raised).withColumn("anomaly_rate", r6("anomaly_rate"))


@query(f"""{views("cells")},
arrived AS ({sql_slices("cells")}),
numbered AS (
    SELECT * EXCLUDE (round), dense_rank() OVER (PARTITION BY model_id ORDER BY slice) AS number
    FROM arrived)
SELECT model_id, CAST(number AS INTEGER) AS round, CAST(sum(n_samples) AS BIGINT) AS total_samples,
       count(*) AS updates, CAST(pos AS INTEGER) AS pos,
       {sql6("sum(n_samples * w) / sum(n_samples)")} AS value
FROM numbered GROUP BY model_id, number, pos""")
def stream_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """A round for each non-empty trigger, from the newest update of each node."""
    models = rounds_by_trigger(_updates(spark, folder), run_folder(spark, "rounds"))
    return long_model(models, "model_id", "round")


# Rounds in order: from each message the fourth region or the last message within a minute is
# looked for; the true rounds follow one another from the first message.
ROUND_FOLD = f"""{views("cells")},
regional AS (
    SELECT model_id, region, pos, time_bucket(INTERVAL 30 SECOND, event_time)
               + INTERVAL 30 SECOND AS event_time,
           sum(n_samples * w) / sum(n_samples) AS w, sum(n_samples) AS n, count(*) AS updates,
           sum(anomalies) AS anomalies
    FROM cells WHERE pos < 65 GROUP BY ALL),
marked AS (SELECT max(event_time) - INTERVAL 10 SECOND AS mark FROM regional),
ready AS (
    SELECT model_id, region, event_time,
           row_number() OVER (PARTITION BY model_id ORDER BY event_time, region) AS place
    FROM regional WHERE pos = 0 AND event_time <= (SELECT mark FROM marked)),
spans AS (
    SELECT i.model_id, i.place, p.place AS upto, count(DISTINCT q.region) AS regions
    FROM ready i JOIN ready p ON p.model_id = i.model_id AND p.place >= i.place
              AND p.event_time <= i.event_time + INTERVAL 60 SECOND
         JOIN ready q ON q.model_id = i.model_id AND q.place BETWEEN i.place AND p.place GROUP BY ALL),
pointers AS (
    SELECT model_id, place, coalesce(min(upto) FILTER (regions >= 4), max(upto)) + 1 AS following,
           bool_or(regions >= 4) AS is_full
    FROM spans GROUP BY model_id, place),
starts AS (
    WITH RECURSIVE walk(model_id, place) AS (
        SELECT DISTINCT model_id, CAST(1 AS BIGINT) FROM ready
        UNION ALL SELECT w.model_id, p.following FROM walk w
            JOIN pointers p ON p.model_id = w.model_id AND p.place = w.place
            JOIN ready r ON r.model_id = w.model_id AND r.place = p.following)
    SELECT w.*, p.following, p.is_full, r.event_time,
           row_number() OVER (PARTITION BY w.model_id ORDER BY w.place) - 1 AS round,
           (SELECT max(place) FROM ready x WHERE x.model_id = w.model_id) AS total
    FROM walk w JOIN pointers p ON p.model_id = w.model_id AND p.place = w.place
         JOIN ready r ON r.model_id = w.model_id AND r.place = w.place),
closed AS (
    SELECT *, CASE WHEN is_full THEN 'regions' ELSE 'timeout' END AS reason FROM starts
    WHERE is_full OR following <= total
          OR event_time + INTERVAL 60 SECOND < (SELECT mark FROM marked)),
members AS (
    SELECT c.model_id, c.round, c.reason, r.region, r.event_time
    FROM closed c JOIN ready r ON r.model_id = c.model_id AND r.place >= c.place AND r.place < c.following)
SELECT m.model_id, CAST(round AS INTEGER) AS round, reason, CAST(sum(n) AS BIGINT) AS total_samples,
       CAST(sum(updates) AS BIGINT) AS updates,
       CAST(count(DISTINCT m.region) AS INTEGER) AS participants,
       CAST(sum(anomalies) AS BIGINT) AS anomalies, CAST(pos AS INTEGER) AS pos,
       {sql6("sum(n * w) / sum(n)")} AS value
FROM members m JOIN regional g ON g.model_id = m.model_id AND g.region = m.region
     AND g.event_time = m.event_time
GROUP BY m.model_id, round, reason, pos"""


@query(ROUND_FOLD)
def stream_round_timeout(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds closed by four regions or after a minute, over regional models."""
    run = run_folder(spark, "regions")
    updates = rollup.windowed(tables.updates(spark, folder))
    keys = ["window", "model_id", "region"]
    models = fedavg_vector(updates, keys)
    counts = updates.groupBy(*keys).agg(F.sum("anomalies").alias("anomalies"))
    regional = models.join(counts, keys).withColumn(
        "event_time", F.col("window.end")).drop("window")
    stream = replayed(regional, f"{run}/regional", "event_time")
    rounds = rounds_by_participants(stream, f"{run}/rounds", regions=4)
    return long_model(rounds, "model_id", "round", "reason", parts=("bias",),
                      extra=("total_samples", "updates", "participants", "anomalies"))


@query(ALL_UPDATES)
def stream_edge_training(spark: SparkSession, folder: str) -> DataFrame:
    """An update for every fifty readings of each entity, carried from trigger to trigger."""
    return _long_updates(train_by_entity(_readings(spark, folder), run_folder(spark, "edges"),
                                         X.zscore("voltage", "current")))


# Readings and models in the order they come: by slice, then time, models first. A model that
# comes between two trainings of an entity replaces its weights before the second of them; in
# the fold it is a row of five, the rows of a training have four.
FEEDBACK = f"""{views("readings", "updates")},
came AS ({sql_slices("readings")}),
models AS (
    SELECT model_id, node_id, event_time, weights[1:3] AS weights, bias FROM (
        SELECT * REPLACE (TIMESTAMP '2024-01-01' + to_seconds(node_id * 3600) AS event_time)
        FROM updates)),
sent AS ({sql_slices("models")}),
numbered AS (
    SELECT *, (voltage - 230e0) / 5e0 AS x0, (current - 10e0) / 2e0 AS x1,
           (voltage * current - 2300e0) / 10e0 AS x2,
           row_number() OVER (PARTITION BY edge_id ORDER BY slice, event_time, event_id) AS position
    FROM came),
trainings AS (
    SELECT model_id, edge_id, position // 50 AS batch, (slice, event_time) AS at
    FROM numbered WHERE position % 50 = 0),
adopted AS (
    SELECT t.edge_id, t.batch, arg_max([w[1], w[2], w[3], m.bias, 1e0],
                                       (m.slice, m.event_time, m.node_id)) AS row
    FROM trainings t JOIN trainings b ON b.edge_id = t.edge_id AND b.batch = t.batch - 1
         JOIN (SELECT *, weights AS w FROM sent) m ON m.model_id = t.model_id
              AND (m.slice, m.event_time) <= t.at AND (m.slice, m.event_time) > b.at
    GROUP BY t.edge_id, t.batch),
lines AS (
    SELECT edge_id, (position + 49) // 50 AS batch, position, [x0, x1, x2, label::DOUBLE] AS row
    FROM numbered
    UNION ALL SELECT edge_id, batch, 0, row FROM adopted),
batches AS (SELECT edge_id, batch, batch * 50 AS n FROM trainings),
prefixes AS (
    SELECT b.edge_id, b.batch, b.n, list(l.row ORDER BY l.batch, l.position) AS rows,
           CAST(sum(CASE WHEN len(l.row) = 4 THEN l.row[4] END) AS BIGINT) AS anomalies
    FROM batches b JOIN lines l ON l.edge_id = b.edge_id AND l.batch <= b.batch GROUP BY ALL),
folded AS (
    SELECT *, list_reduce(rows, lambda acc, r: CASE WHEN len(r) = 5 THEN r[1:4]
                                               ELSE {ROW_STEP} END, [0e0, 0e0, 0e0, 0e0]) AS m
    FROM prefixes)
SELECT edge_id, 0 AS lane, CAST(batch - 1 AS INTEGER) AS round, CAST(50 AS BIGINT) AS n_samples,
       CAST(n AS BIGINT) AS total_samples, anomalies AS anomalies_detected,
       CAST(pos - 1 AS INTEGER) AS pos, {sql6("m[pos]")} AS value
FROM folded, range(1, 5) AS r(pos)"""


@query(FEEDBACK)
def stream_feedback(spark: SparkSession, folder: str) -> DataFrame:
    """Entities train on their readings and adopt global models as these come in."""
    known = tables.readings(spark, folder).select("model_id", "edge_id").distinct()
    models = tables.updates(spark, folder).select(
        "model_id", F.expr("timestamp_seconds(1704067200 + node_id * 3600)").alias("event_time"),
        F.slice("weights", 1, 3).alias("weights"), "bias")
    sent = replayed(models, run_folder(spark, "sent"), "event_time")
    return _long_updates(train_by_entity(
        _readings(spark, folder), run_folder(spark, "feedback"), X.zscore("voltage", "current"),
        models=sent, entities=known))


@query(f"""{SEQUENCE},
seen AS (SELECT edge_id, count(*) AS total, CAST(sum(label) AS BIGINT) AS found
         FROM readings GROUP BY edge_id)
SELECT edge_id, total AS total_samples, CAST(n // 50 AS INTEGER) AS round,
       found AS anomalies_detected, CAST(pos - 1 AS INTEGER) AS pos, {sql6("m[pos]")} AS value
FROM models JOIN seen USING (edge_id), range(1, 5) AS r(pos)""")
def stream_periodic_publishing(spark: SparkSession, folder: str) -> DataFrame:
    """What the ticks of a clock publish of each entity once all its readings have come.

    Ticks go on without readings; the run ends when the last reports count every reading.
    """
    run, features = run_folder(spark, "periodic"), X.zscore("voltage", "current")
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 2).load().select(
        F.col("timestamp").alias("event_time"))
    job = EntityTraining(run, len(features), publish_seconds=1.0)
    wanted = tables.readings(spark, folder).count()

    def whole(reports: DataFrame) -> bool:
        return reports.groupBy("edge_id").agg(F.max("total_samples").alias("n")).agg(
            F.sum("n")).first()[0] == wanted

    reports = publish_until(entity_lines(_readings(spark, folder), features), job, ticks, whole)
    newest = latest(reports, ["edge_id"], ["at", "total_samples"])
    return long_model(newest, "edge_id", "round", parts=("bias",),
                      extra=("total_samples", "anomalies_detected"))


def _plant_fold() -> str:
    """Training slice by slice: steps from the plant's newest model, then its average."""
    dots = " + ".join(f"w{j} * x{j}" for j in range(5)) + " + b"
    p = f"1e0 / (1e0 + exp(-greatest(-500e0, least(500e0, {dots}))))"
    moved = ", ".join(f"any_value(w{j}) - 1e-2 * avg(x{j} * e) AS w{j}" for j in range(5))
    names = [*(f"w{j}" for j in range(5)), "b"]
    mean = ", ".join(f"sum(total * {n}) / sum(total) AS {n}" for n in names)
    zero = ", ".join(f"0e0 AS {n}" for n in names)
    text = f"""{views("machine")},
rows AS (
    SELECT model_id, node_id, slice, label::DOUBLE AS y, vibration_x - 0.5e0 AS x0,
           vibration_y - 0.5e0 AS x1, vibration_z - 0.5e0 AS x2, (temperature - 65e0) / 20e0 AS x3,
           (pressure - 100e0) / 30e0 AS x4
    FROM ({sql_slices("machine")})),
global_0 AS (SELECT DISTINCT model_id, {zero} FROM rows)"""
    for c in range(SLICES):
        text += f""",
node{c} AS (
    SELECT model_id, node_id, {c} AS batch, {moved}, any_value(b) - 1e-2 * avg(e) AS b,
           (SELECT count(*) FROM rows r WHERE r.model_id = t.model_id
                AND r.node_id = t.node_id AND slice <= {c}) AS total
    FROM (SELECT *, {p} - y AS e FROM rows JOIN global_{c} USING (model_id) WHERE slice = {c}) t
    GROUP BY model_id, node_id),
global_{c + 1} AS (SELECT model_id, {mean} FROM node{c} GROUP BY model_id)"""
    every = " UNION ALL ".join(f"SELECT * FROM node{c}" for c in range(SLICES))
    return text + f""",
steps AS (SELECT batch::BIGINT AS batch, total AS n_samples, * EXCLUDE (batch, total)
          FROM ({every}))
""" + sql_long("steps", "model_id, node_id, batch, n_samples")


@query(_plant_fold())
def stream_batch_training(spark: SparkSession, folder: str) -> DataFrame:
    """A step of each machine node per micro-batch, then a round, slice by slice."""
    stream = replayed(tables.machine(spark, folder), run_folder(spark, "machine"), "event_time")
    _, nodes = train_by_batch(stream, run_folder(spark, "training"), X.shift_scale())
    trained = nodes.filter(F.col("batch") == F.col("batch_id"))
    return long_model(trained, "model_id", "node_id", "batch", "n_samples", parts=("bias",),
                      extra=())
