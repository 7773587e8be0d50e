"""Rounds: who takes part, when a round is ready, its number, history and timeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.functions.vectors import l2_norm
from tidalfed.operators.ordered import position, running, top_per_key
from tidalfed.operators.sizing import lookup, sized_broadcast


def round_ready(updates: DataFrame, keys: Sequence[str], participant: str = "region",
                minimum: int = S.REGIONS_PER_ROUND) -> DataFrame:
    """Distinct participants of each round and whether they are enough."""
    seen = updates.select(*keys, participant).distinct()
    return seen.groupBy(*keys).agg(F.count(participant).alias("participants")).withColumn(
        "ready", F.col("participants") >= minimum)


def participants(updates: DataFrame, keys: Sequence[str], participant: str = "region",
                 list_rows: int = S.LIST_ROWS) -> DataFrame:
    """Distinct participants of each round as sorted lists of at most ``list_rows``.

    Rounds with more participants have several rows, told apart by ``page``.
    """
    seen = updates.select(*keys, participant).distinct()
    numbered = position(seen, list(keys), [participant], "_position")
    paged = numbered.withColumn("page", F.expr(f"cast((_position - 1) div {list_rows} AS int)"))
    return paged.groupBy(*keys, "page").agg(
        F.array_sort(F.collect_list(participant)).alias("participants"))


def global_metrics(updates: DataFrame, keys: Sequence[str],
                   participant: str = "region") -> DataFrame:
    """Samples, participants, updates and anomalies of each round."""
    per_participant = updates.groupBy(*keys, participant).agg(
        F.sum("n_samples").alias("_n"), F.count(F.lit(1)).alias("_updates"),
        F.sum("anomalies").alias("_anomalies"))
    return per_participant.groupBy(*keys).agg(
        F.sum("_n").alias("total_samples"),
        F.count(participant).alias("participants"),
        F.sum("_updates").alias("num_updates"),
        F.sum("_anomalies").alias("anomalies_detected"))


def drop_stale(updates: DataFrame, as_of: Column, max_age: str,
               event_time: str = "event_time") -> DataFrame:
    """Leave out updates older than ``max_age`` at ``as_of``."""
    return updates.filter(F.col(event_time) >= as_of - F.expr(f"interval {max_age}"))


def round_numbers(windows: DataFrame, keys: Sequence[str] = ("model_id",),
                  start: str = "window_start") -> DataFrame:
    """Number the published windows of each model from 1; rows of one window share it."""
    distinct = windows.select(*keys, start).distinct()
    numbered = position(distinct, list(keys), [start], "round")
    return lookup(windows, sized_broadcast(numbered, computed=True), [*keys, start])


def loss_history(rounds: DataFrame, keys: Sequence[str] = ("model_id",), order: str = "round",
                 loss: str = "weighted_loss", page_rows: int = S.LIST_ROWS) -> DataFrame:
    """The losses of all rounds of a model, oldest first, in lists of ``page_rows``.

    One list per model would grow without bound and one list per round would grow with its
    square, so the history is kept once, in pages; the history at a round is its prefix.
    """
    numbered = position(rounds, list(keys), [order], "_position")
    paged = numbered.withColumn("page", F.expr(f"cast((_position - 1) div {page_rows} AS int)"))
    entries = F.array_sort(F.collect_list(F.struct(order, loss)))
    return paged.groupBy(*keys, "page").agg(
        F.min(order).alias("first_round"), F.max(order).alias("last_round"),
        F.transform(entries, lambda e: e[loss]).alias("losses"))


def loss_tail(rounds: DataFrame, keys: Sequence[str] = ("model_id",), order: str = "round",
              loss: str = "weighted_loss", length: int = S.TAIL_LOSSES) -> DataFrame:
    """The last losses of each model, oldest first."""
    newest = top_per_key(rounds, list(keys), [F.col(order).desc()], length)
    entries = F.array_sort(F.collect_list(F.struct(order, loss)))
    return newest.groupBy(*keys).agg(F.transform(entries, lambda e: e[loss]).alias("losses"))


def last_rounds(rounds: DataFrame, keys: Sequence[str] = ("model_id",), order: str = "round",
                rows: int = S.SHOWN_ROUNDS) -> DataFrame:
    """The rounds a monitor shows: the newest of each model."""
    return top_per_key(rounds, list(keys), [F.col(order).desc()], rows)


def metrics_history(metrics: DataFrame, keys: Sequence[str] = ("model_id",),
                    order: str = "round", rows: int = S.HISTORY_ROWS) -> DataFrame:
    """The newest metric rows of each model."""
    return top_per_key(metrics, list(keys), [F.col(order).desc()], rows)


def rounds_timeline(metrics: DataFrame, order: str = "round") -> DataFrame:
    """Samples and anomalies as two series over the rounds."""
    return (metrics.unpivot(["model_id", order], ["total_samples", "anomalies_detected"],
                            "series", "value")
            .orderBy("model_id", "series", order))


def sample_participants(nodes: DataFrame, keys: Sequence[str], node: str, count: int,
                        seed: int = 0) -> DataFrame:
    """A reproducible random choice of ``count`` nodes per round.

    Nodes are ranked by a hash of seed, round and node, so the choice does not depend on
    the partitioning and a rerun gives the same nodes.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys],
                       F.col(node).cast("string"))
    drawn = nodes.select(*keys, node).distinct().withColumn("_draw", F.md5(text))
    return top_per_key(drawn, list(keys), [F.col("_draw"), F.col(node)], count).drop("_draw")


def missing_nodes(updates: DataFrame, nodes: DataFrame, node: str, order: str,
                  first_round: int, last_round: int) -> DataFrame:
    """Rounds ``[first_round, last_round]`` in which a known node did not take part.

    Found as the gaps between the rounds a node did take part in, instead of subtracting
    from the product of all nodes and rounds.
    """
    joined_in = (updates.filter(F.col(order).between(first_round, last_round))
                 .select(node, F.col(order).cast("bigint").alias("_round")).distinct())
    edge = nodes.select(node).distinct()
    bounds = edge.withColumn("_round", F.lit(first_round - 1).cast("bigint"))
    known = joined_in.join(edge, node, "left_semi").unionByName(bounds)
    following = F.lead("_round", 1, last_round + 1).over(W.partitionBy(node).orderBy("_round"))
    gaps = known.withColumn("_next", following).filter(F.col("_next") > F.col("_round") + 1)
    return gaps.select(node, F.explode(
        F.sequence(F.col("_round") + 1, F.col("_next") - 1)).alias(order))


def round_log(rounds: DataFrame) -> DataFrame:
    """Log rows with the norm of the weights: one per round and page of participants."""
    return rounds.select("round", "timestamp", "weighted_loss", "total_samples",
                         "participating_nodes", l2_norm("weights").alias("weights_norm"),
                         "page")


def cumulative(rounds: DataFrame, keys: Sequence[str], order: Sequence[str],
               column: str, name: str) -> DataFrame:
    """Running total of a column over rounds."""
    return running(rounds, list(keys), list(order), sums={name: F.col(column)})
