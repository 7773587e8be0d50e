"""Full-batch logistic training as Spark aggregates, and the federated rounds around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.functions.scoring import cross_entropy, predicted_class, probability
from tidalfed.functions.vectors import zeros
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.operators.sizing import sized_broadcast
from tidalfed.session import settled


def initial_models(nodes: DataFrame, key: str, features: int,
                   seed: int | None = None) -> DataFrame:
    """A start model per node: zeros, or small normal values fixed by the seed.

    The seeded values are a Box-Muller transform of two numbers made of the first 52 bits of
    md5 of ``key:position:seed:1`` and ``:2``: they do not depend on the partitioning, as
    ``randn`` would, and any SQL engine can repeat them.
    """
    if seed is None:
        weights = zeros(features)
    else:
        def uniform(salt: int, j: Column) -> Column:
            name = F.concat_ws(":", F.col(key).cast("string"), j.cast("string"),
                               F.lit(str(seed)), F.lit(str(salt)))
            bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double")
            return (bits + 0.5) / float(1 << 52)

        weights = F.transform(
            F.sequence(F.lit(0), F.lit(features - 1)),
            lambda j: F.lit(0.01) * F.sqrt(F.lit(-2.0) * F.ln(uniform(1, j)))
            * F.cos(F.lit(6.283185307179586) * uniform(2, j)))
    return nodes.select(key).distinct().select(
        key, weights.alias("weights"), F.lit(0.0).alias("bias"))


def _names(*columns: str | Sequence[str] | None) -> list[str]:
    """Column names in order, each once."""
    flat = [n for c in columns if c is not None for n in ([c] if isinstance(c, str) else c)]
    return list(dict.fromkeys(flat))


def _joined(readings: DataFrame, models: DataFrame, on: Sequence[str],
            features: Sequence[Column], label: str, carry: Sequence[str]) -> DataFrame:
    """Readings as flat columns ``_x0.. _y`` beside their model; rows with a missing feature
    cannot be trained on and are left out."""
    flat = readings.select(
        *_names(on, carry),
        *[x.alias(f"_x{j}") for j, x in enumerate(features)],
        F.coalesce(label, F.lit(0)).cast("double").alias("_y"),
    )
    usable = flat.dropna(subset=[f"_x{j}" for j in range(len(features))])
    model = models.select(*on, *[F.col("weights")[j].alias(f"_w{j}")
                                for j in range(len(features))], F.col("bias").alias("_b"))
    return usable.join(sized_broadcast(model), list(on))


def _unpack(dim: int) -> tuple[list[Column], Column]:
    return [F.col(f"_x{j}") for j in range(dim)], F.array(*[F.col(f"_w{j}") for j in range(dim)])


def gradients(readings: DataFrame, models: DataFrame, *, key: str, features: Sequence[Column],
              on: str | Sequence[str] | None = None, label: str = "label") -> DataFrame:
    """Gradient of the mean logistic loss per node, with the model it was taken at.

    ``on`` joins the models (by default the node itself; ``model_id`` when all nodes start
    from one model). The averages are pre-aggregated, so the shuffle carries one row per
    node and input task.
    """
    dim, on = len(features), _names(on or key)
    keys = _names(on, key)
    rows = _joined(readings, models, on, features, label, keys)
    xs, weights = _unpack(dim)
    error = probability(xs, weights, F.col("_b")) - F.col("_y")
    scored = rows.withColumn("_e", error)
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"),
        *[F.avg(x * F.col("_e")).alias(f"_g{j}") for j, x in enumerate(xs)],
        F.avg("_e").alias("grad_bias"),
        *[F.max(f"_w{j}").alias(f"_w{j}") for j in range(dim)],
        F.max("_b").alias("bias"),
    ).select(
        *keys, "n_samples",
        F.array(*[F.col(f"_g{j}") for j in range(dim)]).alias("grad_weights"),
        "grad_bias",
        F.array(*[F.col(f"_w{j}") for j in range(dim)]).alias("weights"),
        "bias",
    )


def sgd_step(readings: DataFrame, models: DataFrame, *, key: str, features: Sequence[Column],
             on: str | Sequence[str] | None = None, label: str = "label",
             rate: float = S.LEARNING_RATE) -> DataFrame:
    """One full-batch step per node: ``weights, bias`` after it and ``n_samples``."""
    slope = gradients(readings, models, key=key, features=features, on=on, label=label)
    moved = F.zip_with("weights", "grad_weights", lambda w, g: w - F.lit(rate) * g)
    return slope.select(
        *_names(on, key), "n_samples", moved.alias("weights"),
        (F.col("bias") - F.lit(rate) * F.col("grad_bias")).alias("bias"))


def evaluate(readings: DataFrame, models: DataFrame, *, key: str, features: Sequence[Column],
             on: str | Sequence[str] | None = None, label: str = "label") -> DataFrame:
    """Samples, accuracy and loss per node under the given models."""
    on = _names(on or key)
    keys = _names(on, key)
    rows = _joined(readings, models, on, features, label, keys)
    xs, weights = _unpack(len(features))
    p = probability(xs, weights, F.col("_b"))
    return rows.withColumn("_p", p).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.avg((predicted_class(F.col("_p")) == F.col("_y")).cast("double")).alias("accuracy"),
        F.avg(cross_entropy(F.col("_p"), F.col("_y"))).alias("loss"),
    )


def train_and_evaluate(readings: DataFrame, models: DataFrame, *, key: str,
                       features: Sequence[Column],
                       on: str | Sequence[str] | None = None, label: str = "label",
                       rate: float = S.LEARNING_RATE) -> DataFrame:
    """One step, then accuracy and loss of the new model on the same rows."""
    stepped = settled(sgd_step(readings, models, key=key, features=features, on=on, label=label,
                               rate=rate))
    keys = _names(on, key)
    scores = evaluate(readings, stepped, key=key, on=keys, features=features, label=label)
    return stepped.join(scores.select(*keys, "accuracy", "loss"), keys)


def federated_rounds(spark: SparkSession, readings: DataFrame, store: str, *, rounds: int,
                     key: str, features: Sequence[Column], label: str = "label",
                     rate: float = S.LEARNING_RATE) -> DataFrame:
    """Run ``rounds`` rounds: every node steps from the global model, the steps are averaged.

    Each round's global model is appended to the table at ``store`` and read back, which
    cuts the lineage and survives lost executors. Nodes continue from the global model of
    the round before; round 0 is the zero model. Only plans pass through the driver.
    """
    schema = ("model_id string, weights array<double>, bias double, weighted_loss double, "
              "total_samples bigint, updates bigint")
    start = initial_models(readings, "model_id", len(features)).select(
        "model_id", "weights", "bias", F.lit(None).cast("double").alias("weighted_loss"),
        F.lit(0).cast("bigint").alias("total_samples"), F.lit(0).cast("bigint").alias("updates"))
    start.write.mode("overwrite").parquet(f"{store}/round=0")
    for number in range(1, rounds + 1):
        current = spark.read.schema(schema).parquet(f"{store}/round={number - 1}")
        stepped = sgd_step(readings, current, key=key, features=features, on="model_id",
                           label=label, rate=rate)
        local = settled(stepped)
        keys = _names("model_id", key)
        scores = evaluate(readings, local, key=key, on=keys, features=features, label=label)
        scored = local.join(scores.select(*keys, "loss"), keys)
        averaged = fedavg_vector(scored, ["model_id"])
        averaged.write.mode("overwrite").parquet(f"{store}/round={number}")
    return spark.read.schema(f"{schema}, round int").parquet(store)


def build_updates(trained: DataFrame, previous_round: str | Column = "round") -> DataFrame:
    """Package trained models as update messages; the round advances with each of them."""
    number = F.col(previous_round) if isinstance(previous_round, str) else previous_round
    return publishable(trained).select(
        "edge_id", "region", number.cast("int").alias("round"), "n_samples",
        F.struct(
            F.array("weights").alias("coef"),
            F.array("bias").alias("intercept"),
            F.array(F.lit(0), F.lit(1)).alias("classes"),
        ).alias("weights"),
        F.struct(
            F.col("accuracy").alias("local_accuracy"),
            F.col("total_samples").cast("int").alias("total_samples"),
            F.col("anomalies_detected").cast("int").alias("anomalies_detected"),
        ).alias("metrics"),
    )


def publishable(trained: DataFrame, samples: str = "n_samples") -> DataFrame:
    """Only models that have been trained on something are published."""
    return trained.filter(F.col(samples) > 0)
