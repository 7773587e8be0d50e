"""Gradients, steps, federated rounds, sequential training."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed.functions import features as X
from tidalfed.operators import training as T
from tidalfed.operators.batches import count_batches
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.operators.sequential import last_models, train_sequential
from tidalfed.plans.registry import long_model, query, r6, sql6, views
from tidalfed.session import run_folder, settled
from tidalfed.sources import tables

RATE = 0.01

# Machine features with the oracle's names.
MACHINE_X = """
    SELECT model_id, node_id, label::DOUBLE AS y,
           vibration_x - 0.5e0 AS x0, vibration_y - 0.5e0 AS x1,
           vibration_z - 0.5e0 AS x2, (temperature - 65e0) / 20e0 AS x3,
           (pressure - 100e0) / 30e0 AS x4
    FROM machine"""


def _sql_gradient(source: str, model: str, keys: str = "node_id") -> str:
    """Gradient of each node at the model rows (keys, w0..w4, b) of ``model``."""
    z = " + ".join(f"w{j} * x{j}" for j in range(5)) + " + b"
    p = f"1e0 / (1e0 + exp(-greatest(-500e0, least(500e0, {z}))))"
    sums = ", ".join(f"avg(x{j} * e) AS g{j}" for j in range(5))
    held = ", ".join(f"any_value(w{j}) AS w{j}" for j in range(5))
    return (f"SELECT {keys}, count(*) AS n_samples, {sums}, avg(e) AS gb, {held}, "
            f"any_value(b) AS b FROM (SELECT *, {p} - y AS e FROM {source} "
            f"JOIN {model} USING ({keys})) GROUP BY {keys}")


def _sql_step(gradient: str, keys: str = "node_id") -> str:
    moved = ", ".join(f"w{j} - {RATE}e0 * g{j} AS w{j}" for j in range(5))
    return f"SELECT {keys}, n_samples, {moved}, b - {RATE}e0 * gb AS b FROM {gradient}"


def sql_long(model: str, keys: str) -> str:
    values = ", ".join(f"w{j}" for j in range(5))
    return (f"SELECT {keys}, CAST(pos AS INTEGER) AS pos, {sql6('value')} AS value FROM ("
            f"SELECT {keys}, unnest([{values}, b]) AS value, "
            f"generate_subscripts([{values}, b], 1) - 1 AS pos FROM {model})")


ZERO_MODEL = ("SELECT DISTINCT node_id, 0e0 AS w0, 0e0 AS w1, 0e0 AS w2, 0e0 AS w3, 0e0 AS w4, "
              "0e0 AS b FROM machine")
STEPS = f"""{views("machine")},
features AS ({MACHINE_X}),
start AS ({ZERO_MODEL}),
slope1 AS ({_sql_gradient("features", "start")}),
step1 AS ({_sql_step("slope1")}),
slope2 AS ({_sql_gradient("features", "(SELECT * EXCLUDE (n_samples) FROM step1)")}),
step2 AS ({_sql_step("slope2")})
"""


def _machine(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    machine = tables.machine(spark, folder)
    return machine, settled(T.initial_models(machine, "node_id", 5))


def _long(models: DataFrame, *keys: str) -> DataFrame:
    return long_model(models, *keys, parts=("bias",), extra=())


@query(STEPS + sql_long("step1", "node_id, n_samples"))
def sgd_step(spark: SparkSession, folder: str) -> DataFrame:
    """One step of each node from the zero model."""
    machine, start = _machine(spark, folder)
    stepped = T.sgd_step(machine, start, key="node_id", features=X.shift_scale(), rate=RATE)
    return _long(stepped, "node_id", "n_samples")


@query(STEPS + sql_long("step2", "node_id, n_samples"))
def sgd_two_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Two steps, the second from where the first one ended."""
    machine, start = _machine(spark, folder)
    options = {"key": "node_id", "features": X.shift_scale(), "rate": RATE}
    first = settled(T.sgd_step(machine, start, **options))
    return _long(T.sgd_step(machine, first, **options), "node_id", "n_samples")


@query(STEPS + f"""SELECT node_id, n_samples, CAST(pos AS INTEGER) AS pos,
       {sql6("value")} AS value FROM (
    SELECT node_id, n_samples, unnest([g0, g1, g2, g3, g4, gb]) AS value,
           generate_subscripts([g0, g1, g2, g3, g4, gb], 1) - 1 AS pos FROM slope2)""")
def sgd_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """Gradient of each node after one step."""
    machine, start = _machine(spark, folder)
    options = {"key": "node_id", "features": X.shift_scale()}
    first = settled(T.sgd_step(machine, start, rate=RATE, **options))
    slope = T.gradients(machine, first, **options)
    vector = F.concat("grad_weights", F.array("grad_bias"))
    return slope.select("node_id", "n_samples", F.posexplode(vector).alias("pos", "value")
                        ).withColumn("value", r6("value"))


Z5 = " + ".join(f"w{j} * x{j}" for j in range(5)) + " + b"
P5 = f"1e0 / (1e0 + exp(-greatest(-500e0, least(500e0, {Z5}))))"
Q5 = "greatest(1e-15, least(1e0 - 1e-15, p))"


@query(STEPS + f"""
SELECT node_id, count(*) AS n_samples,
       {sql6("avg(CASE WHEN (p >= 0.5e0) = (y = 1) THEN 1e0 ELSE 0e0 END)")} AS accuracy,
       {sql6(f"-avg(y * ln({Q5}) + (1 - y) * ln(1e0 - {Q5}))")} AS loss
FROM (SELECT features.*, {P5} AS p FROM features JOIN step1 USING (node_id))
GROUP BY node_id""")
def train_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy and loss of each node after a step, on the rows of the step."""
    machine, start = _machine(spark, folder)
    trained = T.train_and_evaluate(machine, start, key="node_id", features=X.shift_scale(),
                                   rate=RATE)
    return trained.select("node_id", "n_samples", r6("accuracy").alias("accuracy"),
                          r6("loss").alias("loss"))


def _sql_round(number: int) -> str:
    """Every node steps from the model before, and the steps are averaged."""
    before, moved = f"global{number - 1}", f"local{number}"
    keys = "model_id, node_id"
    gradient = _sql_gradient("features", f"(SELECT * FROM nodes JOIN {before} USING (model_id))",
                             keys)
    means = ", ".join(f"sum(n_samples * w{j}) / sum(n_samples) AS w{j}" for j in range(5))
    return f"""
slope_{number} AS ({gradient}), {moved} AS ({_sql_step(f"slope_{number}", keys)}),
global{number} AS (SELECT model_id, {means}, sum(n_samples * b) / sum(n_samples) AS b
                   FROM {moved} GROUP BY model_id)"""


FEDERATED = f"""{views("machine")},
features AS ({MACHINE_X}),
nodes AS (SELECT DISTINCT model_id, node_id FROM machine),
global0 AS (SELECT DISTINCT model_id, 0e0 AS w0, 0e0 AS w1, 0e0 AS w2, 0e0 AS w3, 0e0 AS w4,
                            0e0 AS b FROM machine),
{_sql_round(1)},{_sql_round(2)},
tagged AS (SELECT 0 AS round, * FROM global0 UNION ALL SELECT 1, * FROM global1
           UNION ALL SELECT 2, * FROM global2)
"""


@query(FEDERATED + sql_long("tagged", "model_id, round"))
def federated_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Two rounds of local steps and averaging."""
    machine = tables.machine(spark, folder)
    models = T.federated_rounds(spark, machine, run_folder(spark, "models"), rounds=2,
                                key="node_id", features=X.shift_scale(), rate=RATE)
    return _long(models, "model_id", "round")


@query("""
SELECT DISTINCT CAST(l_suppkey % 2 + 1 AS INTEGER) AS node_id, CAST(pos AS INTEGER) AS pos,
       0e0 AS value
FROM lineitem, range(6) AS r(pos)""")
def init_weights(spark: SparkSession, folder: str) -> DataFrame:
    """The zero model of each node."""
    return _long(T.initial_models(tables.machine(spark, folder), "node_id", 5), "node_id")


BY_PLANT = f"""{views("machine")},
features AS ({MACHINE_X}),
start AS (SELECT DISTINCT model_id, node_id, 0e0 AS w0, 0e0 AS w1, 0e0 AS w2, 0e0 AS w3,
                          0e0 AS w4, 0e0 AS b FROM machine),
slope AS ({_sql_gradient("features", "start", "model_id, node_id")}),
step AS ({_sql_step("slope", "model_id, node_id")})
"""


def _sql_uniform(salt: int) -> str:
    """52 bits of md5 of node, position, seed 42 and salt, as a number between 0 and 1."""
    return (f"(CAST(CAST('0x' || substr(md5(node_id || ':' || pos || ':42:{salt}'), 1, 13) "
            f"AS BIGINT) AS DOUBLE) + 0.5e0) / {1 << 52}e0")


@query(f"""
WITH cells AS (SELECT DISTINCT CAST(l_suppkey % 2 + 1 AS INTEGER) AS node_id,
                      CAST(pos AS INTEGER) AS pos FROM lineitem, range(6) AS r(pos))
SELECT node_id, pos,
       CASE WHEN pos = 5 THEN 0e0 ELSE {sql6(f"""0.01e0 * sqrt(-2e0 * ln({_sql_uniform(1)}))
           * cos(6.283185307179586e0 * {_sql_uniform(2)})""")} END AS value
FROM cells""")
def init_weights_seeded(spark: SparkSession, folder: str) -> DataFrame:
    """Small normal start weights that depend on node, position and seed only."""
    machine = tables.machine(spark, folder)
    return _long(T.initial_models(machine, "node_id", 5, seed=42), "node_id")


# Row-by-row training folded over each entity's rows: r is (features, label), acc the model.
ROW_Z = "(acc[1] * r[1] + acc[2] * r[2] + acc[3] * r[3] + acc[4])"
ROW_E = f"(1e0 / (1e0 + exp(-greatest(-500e0, least(500e0, {ROW_Z})))) - r[4])"
DECAY = "(1e0 - 0.01e0 * 0.0001e0)"
ROW_STEP = (f"[acc[1] * {DECAY} - 0.01e0 * {ROW_E} * r[1], "
            f"acc[2] * {DECAY} - 0.01e0 * {ROW_E} * r[2], "
            f"acc[3] * {DECAY} - 0.01e0 * {ROW_E} * r[3], acc[4] - 0.01e0 * {ROW_E}]")
FOLD = f"list_reduce(rows, lambda acc, r: {ROW_STEP}, [0e0, 0e0, 0e0, 0e0])"

SEQUENCE = f"""{views("readings")},
numbered AS (
    SELECT *, (voltage - 230e0) / 5e0 AS x0, (current - 10e0) / 2e0 AS x1,
           (voltage * current - 2300e0) / 10e0 AS x2,
           row_number() OVER (PARTITION BY edge_id ORDER BY event_time, event_id) AS position,
           count(*) OVER (PARTITION BY edge_id) // 50 * 50 AS trained
    FROM readings),
folded AS (
    SELECT model_id, edge_id, count(*) AS n, CAST(sum(label) AS BIGINT) AS anomalies,
           list([x0, x1, x2, label::DOUBLE] ORDER BY position) AS rows
    FROM numbered WHERE position <= trained GROUP BY model_id, edge_id),
models AS (SELECT model_id, edge_id, n, anomalies, {FOLD} AS m FROM folded)
"""


@query(SEQUENCE + f"""
, scored AS (
    SELECT edge_id, avg(CASE WHEN (m[1] * x0 + m[2] * x1 + m[3] * x2 + m[4] > 0) = (label = 1)
                             THEN 1e0 ELSE 0e0 END) AS accuracy
    FROM numbered JOIN models USING (edge_id)
    WHERE position > trained - 50 AND position <= trained GROUP BY edge_id)
SELECT edge_id, CAST(0 AS BIGINT) AS shard, n AS n_samples, n AS total_samples,
       anomalies AS anomalies_detected, CAST(n // 50 AS INTEGER) AS rounds,
       {sql6("accuracy")} AS accuracy, CAST(pos - 1 AS INTEGER) AS pos, {sql6("m[pos]")} AS value
FROM models JOIN scored USING (edge_id), range(1, 5) AS r(pos)""")
def sgd_sequential(spark: SparkSession, folder: str) -> DataFrame:
    """Row-by-row training in batches of fifty; the model each entity ends with."""
    updates = train_sequential(tables.readings(spark, folder),
                               features=X.zscore("voltage", "current"))
    models = last_models(updates).withColumn("accuracy", r6("accuracy"))
    return long_model(models, "edge_id", "shard", parts=("bias",), extra=(
        "n_samples", "total_samples", "anomalies_detected", "rounds", "accuracy"))


@query(SEQUENCE + f"""
SELECT model_id, CAST(sum(n) AS BIGINT) AS total_samples, count(*) AS updates,
       CAST(pos - 1 AS INTEGER) AS pos, {sql6("sum(n * m[pos]) / sum(n)")} AS value
FROM models, range(1, 5) AS r(pos) GROUP BY model_id, pos""")
def sgd_sequential_global(spark: SparkSession, folder: str) -> DataFrame:
    """The entities' sequential models averaged by the samples they trained on."""
    keys = ["model_id", "edge_id"]
    updates = train_sequential(tables.readings(spark, folder), keys=keys,
                               features=X.zscore("voltage", "current"))
    models = fedavg_vector(last_models(updates, keys), ["model_id"], loss=None)
    return long_model(models, "model_id", parts=("bias",))


# Every update of every entity: the fold over all rows up to the end of its batch.
ALL_UPDATES = SEQUENCE + f"""
, batches AS (SELECT edge_id, n, unnest(range(0, n // 50)) AS batch FROM models),
prefixes AS (
    SELECT b.edge_id, b.batch, CAST(sum(label) AS BIGINT) AS anomalies,
           list([x0, x1, x2, label::DOUBLE] ORDER BY position) AS rows
    FROM batches b JOIN numbered r ON r.edge_id = b.edge_id AND position <= (batch + 1) * 50
    GROUP BY ALL),
updates AS (SELECT edge_id, batch, anomalies, {FOLD} AS m FROM prefixes)
SELECT edge_id, 0 AS lane, CAST(batch AS INTEGER) AS round, CAST(50 AS BIGINT) AS n_samples,
       (batch + 1) * 50 AS total_samples, anomalies AS anomalies_detected,
       CAST(pos - 1 AS INTEGER) AS pos, {sql6("m[pos]")} AS value
FROM updates, range(1, 5) AS r(pos)"""


@query(f"""{views("readings")},
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY edge_id ORDER BY event_time, event_id) AS position
    FROM readings),
batches AS (
    SELECT edge_id, region, CAST((position - 1) // 50 AS INTEGER) AS batch, count(*) AS n,
           avg(voltage) AS v, avg(1e0 - label) AS accuracy, sum(label) AS anomalies,
           max(position) AS total
    FROM numbered GROUP BY ALL)
SELECT edge_id, region, batch AS round, n AS n_samples, {sql6("v")} AS coef,
       {sql6("accuracy")} AS local_accuracy, CAST(total AS INTEGER) AS total_samples,
       CAST(anomalies AS INTEGER) AS anomalies_detected, '0,1' AS classes
FROM batches""")
def build_update(spark: SparkSession, folder: str) -> DataFrame:
    """Update messages put together from the batches of each entity."""
    numbered = count_batches(tables.readings(spark, folder))
    trained = numbered.groupBy("edge_id", "region", "batch").agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.array(F.avg("voltage")).alias("weights"), F.lit(0.0).alias("bias"),
        F.avg(1.0 - F.col("label")).alias("accuracy"),
        F.max("position").alias("total_samples"), F.sum("label").alias("anomalies_detected"))
    updates = T.build_updates(trained, "batch")
    return updates.select(
        "edge_id", "region", "round", "n_samples",
        r6(F.col("weights.coef")[0][0]).alias("coef"),
        r6("metrics.local_accuracy").alias("local_accuracy"),
        F.col("metrics.total_samples").alias("total_samples"),
        F.col("metrics.anomalies_detected").alias("anomalies_detected"),
        F.array_join(F.col("weights.classes").cast("array<string>"), ",").alias("classes"))
