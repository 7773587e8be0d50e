"""Hand-worked values."""

import math

import pytest
from pyspark.sql import functions as F

from tidalfed.functions import features as X
from tidalfed.functions import scoring as P
from tidalfed.functions import vectors as V
from tidalfed.operators import fedavg as A
from tidalfed.operators import joins as J
from tidalfed.operators import monitor, rounds
from tidalfed.sources import topics
from tidalfed.sources.roundlog import read_rounds

UPDATE = "model_id string, region string, n_samples bigint, weights array<double>, bias double, loss double"
MATRIX = ("model_id string, at int, n_samples bigint, weights struct<coef: array<array<double>>, "
          "intercept: array<double>, classes: array<int>>")


def updates(spark, *rows):
    return spark.createDataFrame([("m", *r) for r in rows], UPDATE)


def test_fedavg_of_two_matrices(spark):
    rows = [("m", 1, 100, ([[1.0, 2.0, 3.0]], [0.5], [0, 1])),
            ("m", 2, 200, ([[2.0, 3.0, 4.0]], [1.0], [0, 1]))]
    got = A.fedavg_matrix(spark.createDataFrame(rows, MATRIX), ["model_id"], "at").first()
    assert got.global_weights.coef[0] == pytest.approx([5 / 3, 8 / 3, 11 / 3])
    assert got.global_weights.intercept == pytest.approx([5 / 6])
    assert got.global_weights.classes == [0, 1]
    assert (got.total_samples, got.updates) == (300, 2)


def test_fedavg_of_three_vectors(spark):
    got = A.fedavg_vector(updates(
        spark, ("a", 100, [2.0, 3.0], 0.5, 0.1), ("a", 200, [3.0, 4.0], 1.0, None),
        ("b", 50, [1.0, 2.0], 0.0, 0.4)), ["model_id"]).first()
    assert got.weights == pytest.approx([17 / 7, 24 / 7])
    assert got.bias == pytest.approx(5 / 7)
    assert got.weighted_loss == pytest.approx((100 * 0.1 + 50 * 0.4) / 350)


def test_fedavg_of_nothing_or_of_no_samples_gives_no_row(spark):
    assert A.fedavg_vector(updates(spark), ["model_id"]).count() == 0
    none = updates(spark, ("a", 0, [1.0], 0.5, 0.1), ("b", 0, [2.0], 0.5, 0.1))
    assert A.fedavg_vector(none, ["model_id"]).count() == 0
    assert A.fedavg_equal_split(none, ["model_id"]).count() == 0


@pytest.mark.parametrize("second", [[1.0, 2.0, 3.0], [1.0, None]])
def test_fedavg_refuses_vectors_of_other_shape(spark, second):
    mixed = updates(spark, ("a", 1, [1.0, 2.0], 0.5, 0.1), ("a", 1, second, 0.5, 0.1))
    with pytest.raises(Exception, match="differ in shape"):
        A.fedavg_vector(mixed, ["model_id"]).collect()


def test_fedavg_matrix_refuses_other_shape_of_equal_size(spark):
    rows = [("m", 1, 1, ([[1.0, 2.0], [3.0, 4.0]], [0.5], [0, 1])),
            ("m", 2, 1, ([[1.0, 2.0, 3.0, 4.0]], [0.5], [0, 1]))]
    with pytest.raises(Exception, match="differ in shape"):
        A.fedavg_matrix(spark.createDataFrame(rows, MATRIX), ["model_id"], "at").collect()


def test_equal_split_leaves_the_remainder_out(spark):
    got = A.fedavg_equal_split(updates(
        spark, ("a", 100, [2.0], 0.0, 0.0), ("a", 51, [4.0], 1.0, 0.0)), ["model_id"]).first()
    assert (got.total_samples, got.updates) == (150, 2)
    assert got.weights == pytest.approx([3.0])


@pytest.mark.parametrize("v, i, expected", [
    (230.0, 10.0, [0, 0, 0]), (250.0, 15.0, [4, 2.5, 145]), (235.0, 12.0, [1, 1, 52]),
    (235.4, 12.3, [1.08, 1.15, 59.542])])
def test_zscore(spark, v, i, expected):
    row = spark.range(1).select(*[c.alias(n) for c, n in zip(
        X.zscore(F.lit(v), F.lit(i)), "vip")]).first()
    assert list(row) == pytest.approx(expected)


@pytest.mark.parametrize("v, i, kind", [
    (299.0, 10.0, "overvoltage"), (161.0, 10.0, "undervoltage"), (230.0, 20.0, "overcurrent"),
    (276.0, 15.0, "power_surge"), (230.0, 10.0, "normal")])
def test_anomaly_types(spark, v, i, kind):
    assert spark.range(1).select(X.anomaly_type(F.lit(v), F.lit(i))).first()[0] == kind


def test_thresholds_at_one_half(spark):
    row = spark.range(1).select(P.predicted_class(F.lit(0.5)), P.is_anomaly(F.lit(0.5)),
                                P.is_anomaly(F.lit(None).cast("double"))).first()
    assert list(row) == [1, False, False]


def test_sigmoid_is_clipped(spark):
    low, high, mid = spark.range(1).select(
        *[P.sigmoid(F.lit(z)) for z in (-1000.0, 1000.0, 0.0)]).first()
    assert low == pytest.approx(math.exp(-500)) and high == 1.0 and mid == 0.5


def test_no_score_gives_no_probability_and_no_anomaly(spark):
    none = F.lit(None).cast("double")
    p = P.probability([F.lit(1.0)], F.lit(None).cast("array<double>"), none)
    row = spark.range(1).select(P.sigmoid(none), p, P.is_anomaly(p), P.predicted_class(p),
                                P.cross_entropy(p, F.lit(1))).first()
    assert list(row) == [None, None, False, None, None]


def test_loss_of_certain_predictions_is_finite(spark):
    wrong, right = spark.range(1).select(P.cross_entropy(F.lit(0.0), F.lit(1)),
                                         P.cross_entropy(F.lit(1.0), F.lit(1))).first()
    assert wrong == pytest.approx(-math.log(1e-15)) and right == pytest.approx(0, abs=1e-12)


def test_vectors(spark):
    w = F.array(F.lit(3.0), F.lit(4.0))
    row = spark.range(1).select(V.l2_norm(w), V.head(w), V.tail(w, 1), V.tail(w, 10),
                                V.dot_arrays(w, w)).first()
    assert list(row) == [5.0, [3.0, 4.0], [4.0], [3.0, 4.0], 25.0]


def test_improvement(spark):
    log = spark.createDataFrame(
        [("m", 1, "a", 0.7), ("m", 2, "b", 0.5), ("m", 3, "c", 0.35), ("z", 1, "a", 0.0)],
        "model_id string, round int, timestamp string, weighted_loss double")
    got = {r.model_id: r for r in monitor.log_summary(log).collect()}
    assert got["m"].improvement_pct == pytest.approx(50) and got["m"].last_timestamp == "c"
    assert got["z"].improvement_pct is None


def test_equal_losses_scale_to_zero(spark):
    log = spark.createDataFrame([("m", 1, 0.5), ("m", 2, 0.5)],
                                "model_id string, round int, weighted_loss double")
    assert {r.scaled_loss for r in monitor.loss_minmax(log).collect()} == {0.0}


def test_bad_log_lines_are_skipped(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text(
        '{"round":1,"weighted_loss":0.7,"participating_nodes":["1"]}\nbad\n'
        '{"round":2,"weighted_loss":0.35,"participating_nodes":[]}\n{"round":\n')
    rows = read_rounds(spark, str(tmp_path)).orderBy("round").collect()
    assert [(r.round, r.weighted_loss) for r in rows] == [(1, 0.7), (2, 0.35)]


def test_rejects_keep_the_message(spark):
    sent = spark.createDataFrame(
        [("k", '{"edge_id":"a","weights":{"coef":[[1.0]]}}'), ("k", "bad"), ("k", None),
         ("k", '{"edge_id":"a","weights":{"coef":[]}}'), ("k", '{"weights":{"coef":[[1.0]]}}')],
        "key string, value string").withColumns(
        {"topic": F.lit("t"), "timestamp": F.lit("2024-01-01").cast("timestamp")})
    good, rejected = topics.split_rejects(
        sent, "edge_id string, weights struct<coef: array<array<double>>>", ["edge_id"],
        not_empty=["weights.coef"])
    assert [r.edge_id for r in good.collect()] == ["a"]
    assert rejected.count() == 4 and rejected.columns == sent.columns


def test_latest_model_keeps_missing_parts_local(spark):
    local = spark.createDataFrame([("m", [1.0], 0.1), ("other", [2.0], 0.2)],
                                  "model_id string, weights array<double>, bias double")
    models = spark.createDataFrame([("m", 1, [5.0], 0.5), ("m", 2, [7.0], None)],
                                   "model_id string, round int, weights array<double>, bias double")
    got = {r.model_id: (r.weights, r.bias) for r in J.with_latest_model(local, models).collect()}
    assert got == {"m": ([7.0], 0.1), "other": ([2.0], 0.2)}


def test_confusion_rates(spark):
    scored = spark.createDataFrame(
        [("a", 1, 1)] * 6 + [("a", 1, 0)] * 2 + [("a", 0, 0)] * 8 + [("a", 0, 1)] * 4 + [("b", 0, 0)],
        "key string, predicted int, label int")
    got = {r.key: r for r in monitor.classification_metrics(scored, ["key"]).collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].fpr, got["a"].fnr) == (
        0.75, 0.6, 0.2, 0.4)
    assert got["b"].precision is None and got["b"].fpr == 0.0


def test_rounds_need_enough_participants(spark):
    seen = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b")], "round int, region string")
    got = {r["round"]: (r.participants, r.ready) for r in rounds.round_ready(seen, ["round"]).collect()}
    assert got == {1: (1, False), 2: (2, True)}


def test_missing_nodes_finds_all_gaps(spark):
    seen = spark.createDataFrame([("a", 2), ("a", 4), ("a", 4), ("b", 1), ("x", 1)], "node string, round int")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    got = {tuple(r) for r in rounds.missing_nodes(seen, nodes, "node", "round", 1, 4).collect()}
    assert got == {("a", 1), ("a", 3), ("b", 2), ("b", 3), ("b", 4),
                   ("c", 1), ("c", 2), ("c", 3), ("c", 4)}


def test_node_stats_share_the_last_round(spark):
    log = spark.createDataFrame([(1, 100, 0.7), (2, 151, 0.5)],
                                "round int, total_samples bigint, weighted_loss double")
    members = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (2, 3)],
                                    "round int, node_id int")
    got = {r.node_id: tuple(r)[1:] for r in monitor.node_stats(log, members).collect()}
    assert got == {1: (2, 50, 0.5), 2: (2, 50, 0.5), 3: (1, 50, 0.5)}
