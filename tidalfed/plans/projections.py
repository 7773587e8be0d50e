"""Features, scores, labels, keys and model vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed.functions import features as X
from tidalfed.functions import scoring as P
from tidalfed.functions import vectors as V
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.operators.sizing import sized_broadcast
from tidalfed.plans.registry import plain_time, query, r6, sql6, views
from tidalfed.sources import tables

# A fixed five-feature model to score machine readings with.
WEIGHTS = (0.4, -0.8, 1.2, 0.05, 0.3)
BIAS = -0.25

MACHINE_Z = ("(0.4e0 * (vibration_x - 0.5e0) - 0.8e0 * (vibration_y - 0.5e0) "
             "+ 1.2e0 * (vibration_z - 0.5e0) + 0.05e0 * (temperature - 65e0) / 20e0 "
             "+ 0.3e0 * (pressure - 100e0) / 30e0 - 0.25e0)")
MACHINE_P = f"(1e0 / (1e0 + exp(-greatest(-500e0, least(500e0, {MACHINE_Z})))))"


def machine_probability():
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    return P.probability(X.shift_scale(), weights, F.lit(BIAS))


@query(f"""{views("readings")}
SELECT event_id, {sql6("(voltage - 230e0) / 5e0")} AS v_norm,
       {sql6("(current - 10e0) / 2e0")} AS i_norm,
       {sql6("(voltage * current - 2300e0) / 10e0")} AS p_norm
FROM readings""")
def feat_zscore(spark: SparkSession, folder: str) -> DataFrame:
    """Normalized voltage, current and power."""
    v, i, p = X.zscore("voltage", "current")
    return tables.readings(spark, folder).select(
        "event_id", r6(v).alias("v_norm"), r6(i).alias("i_norm"), r6(p).alias("p_norm"))


@query(f"""{views("machine")}
SELECT l_orderkey, l_linenumber, node_id,
       round(vibration_x - 0.5e0, 9) + 0e0 AS x0, round(vibration_y - 0.5e0, 9) + 0e0 AS x1,
       round(vibration_z - 0.5e0, 9) + 0e0 AS x2,
       round((temperature - 65e0) / 20e0, 9) + 0e0 AS x3,
       round((pressure - 100e0) / 30e0, 9) + 0e0 AS x4
FROM machine""")
def feat_shift_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Shifted and scaled machine features; temperatures hold seven decimals, so nine."""
    scaled = [F.round(x, 9).alias(f"x{j}") for j, x in enumerate(X.shift_scale())]
    return tables.machine(spark, folder).select("l_orderkey", "l_linenumber", "node_id", *scaled)


@query(f"""{views("readings")}
SELECT event_id,
       round(CAST(CAST(voltage * current AS VARCHAR) AS DECIMAL(38, 20)), 2)::DOUBLE AS power
FROM readings""")
def feat_power(spark: SparkSession, folder: str) -> DataFrame:
    """Power to two decimals, rounded from its shortest decimal text as Spark does."""
    return tables.readings(spark, folder).select(
        "event_id", X.power("voltage", "current").alias("power"))


@query(f"""{views("cells")},
global_model AS (SELECT model_id, pos, sum(n_samples * w) / sum(n_samples) AS g
                 FROM cells GROUP BY model_id, pos)
SELECT node_id, {sql6("sum(w * g) FILTER (pos < 64) + max(g) FILTER (pos = 64)")} AS score
FROM cells JOIN global_model USING (model_id, pos) GROUP BY node_id""")
def score_linear(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of any length scored with their model's average."""
    updates = tables.updates(spark, folder)
    model = fedavg_vector(updates, ["model_id"]).select(
        "model_id", F.col("weights").alias("_w"), F.col("bias").alias("_b"))
    joined = updates.join(sized_broadcast(model, computed=True), "model_id")
    score = V.dot_arrays(F.col("weights"), F.col("_w")) + F.col("_b")
    return joined.select("node_id", r6(score).alias("score"))


@query(f"""{views("machine")}
SELECT l_orderkey, l_linenumber, {sql6(MACHINE_P)} AS probability FROM machine""")
def score_proba(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of an anomaly under a five-feature model."""
    return tables.machine(spark, folder).select(
        "l_orderkey", "l_linenumber", r6(machine_probability()).alias("probability"))


@query(f"""{views("machine")}
SELECT l_orderkey, l_linenumber, CAST({MACHINE_P} >= 0.5e0 AS INTEGER) AS predicted
FROM machine""")
def predict_class(spark: SparkSession, folder: str) -> DataFrame:
    """Class by the inclusive threshold."""
    return tables.machine(spark, folder).select(
        "l_orderkey", "l_linenumber",
        P.predicted_class(machine_probability()).alias("predicted"))


@query(f"""{views("machine")}
SELECT sensor_id, count(*) AS readings,
       count(*) FILTER (node_id = 1 AND {MACHINE_P} > 0.5e0) AS detected
FROM machine GROUP BY sensor_id""")
def detect_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    """Anomalies by the strict threshold; the second node has no model and detects none."""
    p = F.when(F.col("node_id") == 1, machine_probability())
    return tables.machine(spark, folder).groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(P.is_anomaly(p)).alias("detected"))


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, 0 AS label,
       0e0 AS loss
FROM events""")
def default_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Fields a message lacks get their defaults."""
    parsed = F.from_json("props", "k int, label int, loss double")
    rows = tables.table(spark, folder, "events").select("event_id", parsed.alias("m"))
    return rows.select("event_id", X.with_default("m.k", 0).alias("k"),
                       X.with_default("m.label", 0).alias("label"),
                       X.with_default("m.loss", 0.0).alias("loss"))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS zoned, ts AS parsed_zoned,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS plain, ts AS parsed_plain
FROM events""")
def parse_iso_ts(spark: SparkSession, folder: str) -> DataFrame:
    """Times written as ISO text, with and without zone, and read back."""
    rows = tables.readings(spark, folder).select(
        "event_id", X.iso_text("event_time").alias("zoned"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("plain"))
    return rows.withColumns({"parsed_zoned": plain_time(X.iso_time("zoned")),
                             "parsed_plain": plain_time(X.iso_time("plain"))})


@query(f"""{views("updates")}
SELECT node_id, true AS same, {sql6("weights[1]")} AS first_weight, {sql6("bias")} AS intercept,
       node_id % 2 = 0 AS has_classes
FROM updates""")
def weights_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Models as JSON text and back; a missing part stays missing."""
    model = F.struct(
        F.array("weights").alias("coef"), F.array("bias").alias("intercept"),
        F.when(F.col("node_id") % 2 == 0, F.array(F.lit(0), F.lit(1))).alias("classes"))
    rows = tables.updates(spark, folder).select("node_id", model.alias("model")).withColumn(
        "back", V.model_struct(V.model_text("model")))
    return rows.select(
        "node_id", F.col("model").eqNullSafe(F.col("back")).alias("same"),
        r6(F.col("back.coef")[0][0]).alias("first_weight"),
        r6(F.col("back.intercept")[0]).alias("intercept"),
        F.col("back.classes").isNotNull().alias("has_classes"))


@query(f"""{views("cells")}
SELECT node_id, {sql6("sqrt(sum(w * w) FILTER (pos < 64))")} AS norm
FROM cells GROUP BY node_id""")
def weights_norm(spark: SparkSession, folder: str) -> DataFrame:
    return tables.updates(spark, folder).select(
        "node_id", r6(V.l2_norm("weights")).alias("norm"))


@query(f"""{views("cells")}
SELECT node_id, CAST(pos AS INTEGER) AS pos, {sql6("w")} AS value FROM cells WHERE pos < 3""")
def weights_head(spark: SparkSession, folder: str) -> DataFrame:
    """The first three weights, one per row."""
    return tables.updates(spark, folder).select(
        "node_id", F.posexplode(V.head("weights")).alias("pos", "value")).withColumn(
        "value", r6("value"))


@query(f"""{views("readings")}
SELECT event_id, CASE WHEN voltage >= 240e0 THEN 'overvoltage'
                      WHEN voltage <= 226e0 THEN 'undervoltage'
                      WHEN current >= 12.5e0 THEN 'overcurrent'
                      WHEN voltage >= 232e0 AND current >= 11e0 THEN 'power_surge'
                      ELSE 'normal' END AS type
FROM readings""")
def anomaly_type(spark: SparkSession, folder: str) -> DataFrame:
    """Kinds of anomaly, with cut-offs inside the range of the given readings."""
    kind = X.anomaly_type("voltage", "current", overvoltage=240.0, undervoltage=226.0,
                          overcurrent=12.5, surge_voltage=232.0, surge_current=11.0)
    return tables.readings(spark, folder).select("event_id", kind.alias("type"))


@query(f"""{views("readings")}
SELECT edge_id, CASE WHEN label = 1 THEN 'ANOMALY' ELSE 'NORMAL' END AS status,
       count(*) AS readings
FROM readings GROUP BY ALL""")
def status_label(spark: SparkSession, folder: str) -> DataFrame:
    return tables.readings(spark, folder).groupBy(
        "edge_id", X.status_label("label").alias("status")).agg(
        F.count(F.lit(1)).alias("readings"))
