"""Sample-weighted averaging of model updates (FedAvg) and its variants.

The averages are ``sum(n * w) / sum(n)`` per vector position. Spark pre-aggregates them
before the shuffle, so the shuffle carries groups * positions values however many updates
a group has, and no task ever holds a group's updates together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalfed.functions.features import with_default
from tidalfed.operators.sizing import lookup, sized_broadcast

SHAPE_ERROR = "weight vectors of one group differ in shape or hold nulls"


def weighted_vectors(df: DataFrame, keys: Sequence[str], vector: Column,
                     samples: Column, extra: Sequence[Column] = ()) -> DataFrame:
    """Average ``vector`` by ``samples`` within each key.

    Gives ``vector, total_samples, updates`` per key and drops keys without samples.
    ``extra`` are aggregates over the single updates (each sees every update of the key
    once per position, so it has to be a minimum, a maximum or alike). Vectors of unequal
    length or with null entries are an error, not a silent mix.
    """
    cells = df.select(*df.columns, samples.cast("bigint").alias("_n"),
                      F.posexplode(vector).alias("_pos", "_w"))
    names = [f"_x{i}" for i in range(len(extra))]
    sums = cells.groupBy(*keys, "_pos").agg(
        F.sum(F.col("_n") * F.col("_w")).alias("_nw"),
        F.sum("_n").alias("_total"),
        F.count("_w").alias("_filled"),
        F.count(F.lit(1)).alias("_updates"),
        *[x.alias(n) for x, n in zip(extra, names)],
    )
    means = sums.filter(F.col("_total") > 0).withColumn("_mean", F.col("_nw") / F.col("_total"))
    ragged = (F.min("_updates") != F.max("_updates")) | (F.min("_filled") != F.max("_updates"))
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "_mean")))
    result = means.groupBy(*keys).agg(
        F.when(ragged, F.raise_error(F.lit(SHAPE_ERROR)).cast("array<double>"))
        .otherwise(F.transform(ordered, lambda x: x["_mean"])).alias("vector"),
        F.max("_total").alias("total_samples"),
        F.max("_updates").alias("updates"),
        *[F.min(n).alias(n) for n in names],
    )
    return result


def fedavg_vector(updates: DataFrame, keys: Sequence[str], *, weights: str = "weights",
                  bias: str = "bias", loss: str | None = "loss",
                  samples: str = "n_samples") -> DataFrame:
    """Average weights, bias and loss; a missing loss counts as 0.

    Gives ``weights, bias, weighted_loss, total_samples, updates`` per key.
    """
    loss_value = with_default(loss, 0.0) if loss else F.lit(0.0)
    packed = F.concat(F.col(weights), F.array(F.col(bias), loss_value))
    means = weighted_vectors(updates, keys, packed, F.col(samples))
    size = F.size("vector")
    return means.select(
        *keys,
        F.slice("vector", F.lit(1), size - 2).alias("weights"),
        F.element_at("vector", -2).alias("bias"),
        F.element_at("vector", -1).alias("weighted_loss"),
        "total_samples",
        "updates",
    )


def fedavg_hierarchical(updates: DataFrame, keys: Sequence[str], region: str = "region",
                        samples: str = "n_samples") -> DataFrame:
    """Average within each region, then over regions by their sample totals.

    Equal to the flat average, because each level keeps ``sum(n)``; the first level is what
    regional nodes would send on. ``updates`` counts the regions.
    """
    regional = fedavg_vector(updates, [*keys, region], samples=samples)
    return fedavg_vector(regional, keys, loss="weighted_loss", samples="total_samples")


def fedavg_equal_split(updates: DataFrame, keys: Sequence[str], region: str = "region",
                       weights: str = "weights", bias: str = "bias",
                       samples: str = "n_samples") -> DataFrame:
    """The variant in which each update of a region counts ``total // updates`` samples.

    The division leaves remainders out, so the reported total can be below the true one.
    Within a region all updates weigh the same: their plain sums are enough.
    """
    cells = updates.select(
        *keys, region, F.col(samples).cast("bigint").alias("_n"),
        F.posexplode(F.concat(F.col(weights), F.array(F.col(bias)))).alias("_pos", "_w"))
    regional = cells.groupBy(*keys, region, "_pos").agg(
        F.sum("_w").alias("_sum"), F.sum("_n").alias("_total"),
        F.count(F.lit(1)).alias("_updates"), F.count("_w").alias("_filled"))
    share = F.expr("_total div _updates")
    merged = regional.groupBy(*keys, "_pos").agg(
        F.sum(share * F.col("_sum")).alias("_nw"),
        F.sum(share * F.col("_updates")).alias("_n"),
        F.sum("_updates").alias("_members"),
        F.sum("_filled").alias("_filled"),
    ).filter(F.col("_n") > 0).withColumn("_mean", F.col("_nw") / F.col("_n"))
    ragged = (F.min("_members") != F.max("_members")) | (F.min("_filled") != F.max("_members"))
    vector = F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_mean"))),
                         lambda x: x["_mean"])
    result = merged.groupBy(*keys).agg(
        F.when(ragged, F.raise_error(F.lit(SHAPE_ERROR)).cast("array<double>"))
        .otherwise(vector).alias("vector"),
        F.max("_n").alias("total_samples"), F.max("_members").alias("updates"))
    return result.select(
        *keys,
        F.slice("vector", F.lit(1), F.size("vector") - 1).alias("weights"),
        F.element_at("vector", -1).alias("bias"),
        "total_samples", "updates",
    )


def fedavg_matrix(updates: DataFrame, keys: Sequence[str], order_by: str,
                  model: str = "weights", samples: str = "n_samples") -> DataFrame:
    """Average ``struct<coef: matrix, intercept: vector, classes>`` models.

    Coefficients and intercepts are averaged cell by cell; the classes are those of the
    first update in ``order_by``. Gives the same struct as ``global_weights``.
    """
    coef, intercept = F.col(f"{model}.coef"), F.col(f"{model}.intercept")
    even = F.forall(coef, lambda row: F.size(row) == F.size(coef[0]))
    # Plain numbers, so that their minima and maxima stay in the hash aggregate.
    shaped = updates.withColumns({
        "_rows": F.when(even, F.size(coef)).otherwise(-1), "_columns": F.size(coef[0]),
        "_intercepts": F.size(intercept)})
    means = weighted_vectors(shaped, keys, F.concat(F.flatten(coef), intercept), F.col(samples),
                             extra=[of(side) for side in ("_rows", "_columns", "_intercepts")
                                    for of in (F.min, F.max)])
    classes = updates.groupBy(*keys).agg(
        F.min_by(f"{model}.classes", order_by).alias("_classes"))
    joined = lookup(means, classes, keys)
    rows, columns, intercepts = F.col("_x0"), F.col("_x2"), F.col("_x4")
    matrix = F.transform(F.sequence(F.lit(0), rows - 1),
                         lambda i: F.slice("vector", i * columns + 1, columns))
    uneven = ((rows != F.col("_x1")) | (columns != F.col("_x3"))
              | (intercepts != F.col("_x5")) | (rows < 0))
    return joined.select(
        *keys,
        F.struct(
            F.when(uneven, F.raise_error(F.lit(SHAPE_ERROR)).cast("array<array<double>>"))
            .otherwise(matrix).alias("coef"),
            F.slice("vector", rows * columns + 1, intercepts).alias("intercept"),
            F.col("_classes").alias("classes"),
        ).alias("global_weights"),
        "total_samples", "updates",
    )


def contributions(updates: DataFrame, round_keys: Sequence[str], node: str = "node_id",
                  samples: str = "n_samples", loss: str = "loss") -> DataFrame:
    """Each update's share of its round.

    The round totals come from a pre-aggregated table and are joined back, so a large
    round is not gathered in one task as a window over it would be.
    """
    totals = (updates.groupBy(*round_keys).agg(F.sum(samples).alias("_round_samples"))
              .filter(F.col("_round_samples") > 0))
    return updates.join(sized_broadcast(totals, computed=True), list(round_keys)).select(
        *round_keys, node, F.col(samples).cast("bigint").alias("samples"),
        (F.col(samples) / F.col("_round_samples")).alias("weight_factor"),
        with_default(loss, 0.0).alias("loss"),
    )
