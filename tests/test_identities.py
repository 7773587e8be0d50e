"""Averages that must come out equal."""

import pytest
from pyspark.sql import functions as F

from tidalfed.operators import fedavg as A
from tidalfed.sources import tables


def models(frame):
    return {r["round"]: [*r.weights, r.bias, r.weighted_loss] for r in frame.collect()}


@pytest.fixture(scope="module")
def updates(spark, small):
    return tables.updates(spark, small).cache()


def same(a, b):
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key], abs=1e-9)


def test_hierarchical_equals_flat(updates):
    same(models(A.fedavg_hierarchical(updates, ["round"])),
         models(A.fedavg_vector(updates, ["round"])))


def test_scaling_all_samples_changes_nothing(updates):
    scaled = updates.withColumn("n_samples", F.col("n_samples") * 17)
    same(models(A.fedavg_vector(scaled, ["round"])), models(A.fedavg_vector(updates, ["round"])))


def test_order_changes_nothing(updates):
    shuffled = updates.repartition(13, "node_id").orderBy(F.xxhash64("node_id"))
    same(models(A.fedavg_vector(shuffled, ["round"])),
         models(A.fedavg_vector(updates, ["round"])))


def test_one_node_gives_its_own_weights(updates):
    one = updates.filter("node_id = 7")
    row, own = A.fedavg_vector(one, ["round"]).first(), one.first()
    assert row.weights == pytest.approx(own.weights) and row.bias == pytest.approx(own.bias)


def test_equal_split_equals_exact_where_updates_are_equal(updates):
    even = updates.withColumn("n_samples", F.lit(10))
    exact = {k: v[:-1] for k, v in models(A.fedavg_vector(even, ["round"])).items()}
    split = {r["round"]: [*r.weights, r.bias]
             for r in A.fedavg_equal_split(even, ["round"]).collect()}
    same(split, exact)


def test_contributions_add_up_to_one(updates):
    shares = A.contributions(updates, ["round"]).groupBy("round").agg(
        F.sum("weight_factor").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in shares)
