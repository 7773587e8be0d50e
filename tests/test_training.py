"""Training against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalfed.functions import features as X
from tidalfed.operators import training as T
from tidalfed.operators.fedavg import fedavg_matrix
from tidalfed.operators.sequential import last_models, left_out, train_sequential
from tidalfed.sources import tables


@pytest.fixture(scope="module")
def readings(spark, small):
    return tables.readings(spark, small).cache()


def matrix(readings, edge):
    rows = (readings.filter(F.col("edge_id") == edge).orderBy("event_time", "event_id")
            .select(*[c.alias(f"x{j}") for j, c in enumerate(X.zscore("voltage", "current"))],
                    "label").collect())
    return np.array([r[:3] for r in rows]), np.array([r[3] for r in rows], dtype=float)


def brute_force(x, y, every=50, rate=0.01, alpha=0.0001):
    """All updates of one entity: (rows, weights, bias, accuracy, seen, anomalies)."""
    w, b, start, known, updates = np.zeros(x.shape[1]), 0.0, 0, False, []
    for end in range(every, len(x) + 1, every):
        if not known and len(set(y[start:end])) < 2:
            continue
        known = True
        for i in range(start, end):
            p = 1 / (1 + math.exp(-(x[i] @ w + b)))
            w, b = w * (1 - rate * alpha) - rate * (p - y[i]) * x[i], b - rate * (p - y[i])
        hits = np.mean(((x[start:end] @ w + b) > 0) == (y[start:end] == 1))
        updates.append((end - start, w, b, hits, end, int(y[:end].sum())))
        start = end
    return updates


def assert_updates(rows, expected):
    rows = sorted(rows, key=lambda r: r["round"])
    assert [r["round"] for r in rows] == list(range(len(expected)))
    for row, (n, w, b, accuracy, seen, anomalies) in zip(rows, expected):
        assert row.n_samples == n and row.total_samples == seen
        assert row.anomalies_detected == anomalies
        assert row.weights == pytest.approx(w) and row.bias == pytest.approx(b)
        assert row.accuracy == pytest.approx(accuracy)


@pytest.mark.parametrize("every", [50, 20, 64])
def test_sequential_training(readings, every):
    updates = train_sequential(readings, features=X.zscore("voltage", "current"), every=every)
    rows = updates.collect()
    for edge in ("village_1", "village_2", "village_3", "village_4"):
        expected = brute_force(*matrix(readings, edge), every=every)
        assert expected
        assert_updates([r for r in rows if r.edge_id == edge], expected)


def test_unbroken_chains_over_small_arrow_batches(spark, readings):
    key, old = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    spark.conf.set(key, "37")
    try:
        rows = train_sequential(readings, features=X.zscore("voltage", "current"),
                                shard_rows=None).collect()
    finally:
        spark.conf.set(key, old)
    for edge in ("village_1", "village_2", "village_3", "village_4"):
        assert_updates([r for r in rows if r.edge_id == edge],
                       brute_force(*matrix(readings, edge)))


def test_first_training_waits_for_both_classes(spark):
    rows = spark.range(200).select(
        F.lit("a").alias("edge_id"), F.col("id").alias("event_id"),
        F.timestamp_seconds("id").alias("event_time"), (F.col("id") % 7 - 3.0).alias("x"),
        F.when(F.col("id") == 120, 1).otherwise(0).alias("label"))
    got = train_sequential(rows, features=[F.col("x")]).orderBy("round").collect()
    assert [(r.n_samples, r.total_samples) for r in got] == [(150, 150), (50, 200)]


def test_waiting_rows_are_bounded_by_the_buffer(spark):
    rows = spark.range(200).select(
        F.lit("a").alias("edge_id"), F.col("id").alias("event_id"),
        F.timestamp_seconds("id").alias("event_time"), (F.col("id") % 7 - 3.0).alias("x"),
        F.when(F.col("id") == 120, 1).otherwise(0).alias("label"))
    got = train_sequential(rows, features=[F.col("x")], buffer_rows=80).orderBy("round").collect()
    assert [r.n_samples for r in got] == [80, 50]


def test_too_few_rows_are_not_trained_on(readings):
    updates = train_sequential(readings, features=X.zscore("voltage", "current"), every=10)
    assert updates.agg(F.min("n_samples")).first()[0] >= 20


def test_shards_train_on_every_row(readings):
    updates = train_sequential(readings, features=X.zscore("voltage", "current"),
                               shard_rows=100, group_rows=90)
    models = last_models(updates)
    assert models.select("edge_id", "shard").distinct().count() == models.count() > 4
    x, y = matrix(readings, "village_2")
    first = [r for r in updates.collect() if r.edge_id == "village_2" and r.shard == 1]
    assert_updates(first, brute_force(x[100:200], y[100:200]))


def test_shards_are_whole_batches_for_every_entity_alike(readings):
    features = X.zscore("voltage", "current")
    with pytest.raises(ValueError):
        train_sequential(readings, features=features, every=32, shard_rows=50)
    updates = train_sequential(readings, features=features, every=32, shard_rows=64,
                               buffer_rows=32)
    trained = updates.groupBy("edge_id").agg(F.count(F.lit(1)).alias("n")).collect()
    whole = train_sequential(readings, features=features, every=32, buffer_rows=32)
    assert {r.edge_id for r in trained} == {r.edge_id for r in whole.collect()}
    assert updates.agg(F.max("total_samples")).first()[0] == 64
    assert whole.agg(F.max("shard")).first()[0] == 0


def test_readings_without_a_feature_are_counted(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "edge_id string, x double")
    got = left_out(rows, features=[F.col("x")]).orderBy("edge_id").collect()
    assert [tuple(r) for r in got] == [("a", 1, 2), ("b", 0, 1)]


def test_wide_matrices_keep_their_shape(spark):
    width = 1 << 20
    model = F.struct(F.array(F.array_repeat(F.lit(2.0), width)).alias("coef"),
                     F.array(F.lit(0.5)).alias("intercept"),
                     F.array(F.lit(0), F.lit(1)).alias("classes"))
    updates = spark.range(1).select(F.lit("m").alias("model_id"), F.col("id").alias("at"),
                                    model.alias("weights"), F.lit(3).alias("n_samples"))
    got = fedavg_matrix(updates, ["model_id"], "at").select(
        F.size("global_weights.coef"), F.size(F.col("global_weights.coef")[0]),
        "global_weights.intercept").first()
    assert tuple(got) == (1, width, [0.5])


def test_steps_match_numpy(spark, small):
    machine = tables.machine(spark, small).cache()
    names = [f"x{j}" for j in range(5)]
    rows = machine.select("node_id", "label", *[
        c.alias(n) for c, n in zip(X.shift_scale(), names)]).toPandas()
    models = T.initial_models(machine, "node_id", 5, seed=3).checkpoint()
    start = {r.node_id: (np.array(r.weights), r.bias) for r in models.collect()}
    options = {"key": "node_id", "features": X.shift_scale()}
    trained = {r.node_id: r for r in T.train_and_evaluate(machine, models, rate=0.1,
                                                          **options).collect()}
    for node, group in rows.groupby("node_id"):
        x, y = group[names].to_numpy(), group["label"].to_numpy()
        w, b = start[node]
        error = 1 / (1 + np.exp(-(x @ w + b))) - y
        w, b = w - 0.1 * x.T @ error / len(x), b - 0.1 * error.mean()
        p = 1 / (1 + np.exp(-(x @ w + b)))
        q = np.clip(p, 1e-15, 1 - 1e-15)
        assert trained[node].weights == pytest.approx(w)
        assert trained[node].bias == pytest.approx(b)
        assert trained[node].loss == pytest.approx(
            -np.mean(y * np.log(q) + (1 - y) * np.log(1 - q)))
        assert trained[node].accuracy == pytest.approx(np.mean((p >= 0.5) == (y == 1)))


def test_rows_without_a_feature_are_left_out(spark):
    rows = spark.createDataFrame([(1, 1.0, 1), (1, None, 1), (1, 2.0, None)],
                                 "node_id int, x double, label int")
    models = T.initial_models(rows, "node_id", 1)
    got = T.gradients(rows, models, key="node_id", features=[F.col("x")]).first()
    assert got.n_samples == 2
    assert got.grad_weights == pytest.approx([(1 * -0.5 + 2 * 0.5) / 2])


def test_seeded_start_weights(spark):
    nodes = spark.range(2000).withColumnRenamed("id", "node_id")
    a = T.initial_models(nodes, "node_id", 5, seed=1)
    b = T.initial_models(nodes.repartition(7), "node_id", 5, seed=1)
    assert a.exceptAll(b).count() == 0
    spread = a.select(F.explode("weights").alias("w")).agg(F.avg("w"), F.stddev("w")).first()
    assert spread[0] == pytest.approx(0, abs=5e-4) and spread[1] == pytest.approx(0.01, rel=0.05)


def test_rounds_lower_the_loss(spark, small, tmp_path):
    machine = tables.machine(spark, small).withColumn("model_id", F.lit("plant"))
    models = T.federated_rounds(spark, machine, str(tmp_path / "models"), rounds=4,
                                key="node_id", features=X.shift_scale(), rate=0.005)
    losses = [r.weighted_loss for r in models.orderBy("round").collect()]
    assert losses[0] is None and losses[1] > losses[2] > losses[3] > losses[4]
    assert [r.total_samples for r in models.orderBy("round").collect()][1:] == [
        machine.count()] * 4
