"""Lookups, semi joins, newest-model and as-of-model joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.operators.ordered import running
from tidalfed.operators.sizing import sized_broadcast


def region_dimension(spark: SparkSession, regions: dict[str, str] | None = None) -> DataFrame:
    """The known entities and their regions."""
    known = S.EDGE_REGIONS if regions is None else regions
    return spark.createDataFrame(sorted(known.items()), "edge_id string, region string")


def with_region(readings: DataFrame, dimension: DataFrame,
                default: str = S.UNKNOWN_REGION) -> DataFrame:
    """Look the region up by entity; entities outside the dimension get the default."""
    bare = readings.drop("region")
    return (bare.join(sized_broadcast(dimension), "edge_id", "left")
            .withColumn("region", F.coalesce("region", F.lit(default))))


def known_only(readings: DataFrame, dimension: DataFrame) -> DataFrame:
    """Keep the readings of known entities."""
    return readings.join(sized_broadcast(dimension.select("edge_id")), "edge_id", "left_semi")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key, pre-aggregated before the shuffle."""
    value = F.struct(*[c for c in df.columns if c not in keys])
    newest = df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias("_row"))
    return newest.select(*keys, "_row.*")


def with_latest_model(readings: DataFrame, models: DataFrame, key: str = "model_id",
                      round_column: str = "round") -> DataFrame:
    """Join the newest model (weights and bias) of each ``model_id`` to the readings.

    Where a local ``weights`` or ``bias`` column exists, a part missing from the model
    keeps its local value. The newest model is looked up once: on a stream it is the one at
    the start; to follow a growing model table, call this for each micro-batch
    (:mod:`tidalfed.streaming.scoring`).
    """
    newest = latest(models.select(key, round_column, "weights", "bias"), [key], [round_column])
    renamed = newest.select(key, F.col("weights").alias("_weights"), F.col("bias").alias("_bias"))
    joined = readings.join(sized_broadcast(renamed, computed=True), key, "left")
    parts = {}
    for part in ("weights", "bias"):
        update = F.col(f"_{part}")
        parts[part] = F.coalesce(update, F.col(part)) if part in readings.columns else update
    return joined.withColumns(parts).drop("_weights", "_bias")


def with_model_in_force(readings: DataFrame, models: DataFrame, *, key: str = "edge_id",
                        time: str = "event_time", published: str = "published_at",
                        row_id: str = "event_id", model: Sequence[str] = ("weights", "bias"),
                        group_rows: int = S.GROUP_ROWS) -> DataFrame:
    """As-of join: each reading gets the last model published up to its event time.

    Readings and models are put on one time line per key and the model is carried
    forward; a model published at the time of a reading is already in force. Models must
    be in the same key as the readings; keys of any size are cut into segments.
    """
    current = F.struct(*model)
    none = F.lit(None).cast(models.select(current.alias("m")).schema["m"].dataType)
    left = readings.withColumns({"_kind": F.lit(1), "_tie": F.lit(0).cast("bigint"),
                                 "_model": none})
    # Of models published at one time, the same one is in force in every run.
    right = models.select(key, F.col(published).alias(time), F.lit(0).alias("_kind"),
                          F.xxhash64(*model).alias("_tie"), current.alias("_model"))
    line = left.unionByName(right, allowMissingColumns=True)
    carried = running(line, [key], [time, "_kind", "_tie", row_id],
                      last={"_current": F.col("_model")}, group_rows=group_rows)
    return carried.filter(F.col("_kind") == 1).select(*readings.columns, "_current.*")
