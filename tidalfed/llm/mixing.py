"""Operator 7: mix sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, gone through up to twice. A
document's virtual finish time is the source's tokens up to its end, divided by the
source's target; all queues are range-sorted by that time and cut at the total budget.

The shuffle is the order of md5(seed:doc_id), so reruns agree. Null texts have size 0, a
null source is a source of its own (the last), empty tables give empty results. Repeated
rows are queued as rows of their own. Whole documents are taken, never parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalfed.llm.common import running_totals, settled, word_count

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
REPEATS = 2
SEED = "mix"

SOURCE_ORDER = ("_no_source", "source")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   budget: float = BUDGET, repeats: int = REPEATS) -> tuple[DataFrame, int]:
    """One row per source with its weight and target, and the budget in tokens.

    Targets share the budget by weight; one that exceeds ``repeats`` times its source stops
    there and the excess is shared anew, which is repeated until none does.
    """
    sources = sizes.groupBy(*SOURCE_ORDER).agg(F.sum("size").alias("source_size"))
    ranked = running_totals(sources, list(SOURCE_ORDER), "source_size", "sources")
    cycle = F.array(*(F.lit(w) for w in weights))
    ranked = settled(ranked.select(
        *SOURCE_ORDER, "source_size", F.col("_rank").alias("_place"),
        F.get(cycle, (F.col("_rank") % len(weights)).cast("int")).alias("_weight")), "weights")
    room = repeats * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    goal = int(budget * total)
    level, full = 0.0, F.lit(False)
    while True:
        open_weight, taken = ranked.agg(
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0)),
            F.coalesce(F.sum(F.when(full, room)), F.lit(0))).first()
        if not open_weight:
            break
        before, level = level, (goal - taken) / open_weight
        if level == before:
            break
        full = room <= F.col("_weight") * F.lit(level)
    target = F.when(full, room.cast("double")).otherwise(F.col("_weight") * F.lit(level))
    return ranked.withColumn("target", target), goal


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
        repeats: int = REPEATS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, times (how often a row is taken)."""
    queued = queue(docs, weights, budget, repeats, seed)
    return queued.select("doc_id", "size", "source_size", "target",
                         (F.col("times") * F.col("size")).alias("taken"), "source", "times")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
          repeats: int = REPEATS, seed: str = SEED) -> DataFrame:
    """The documents, each as often as the mix takes it, with their own columns alone."""
    rows = settled(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "rows")
    times = queue(rows, weights, budget, repeats, seed, ("_mix_row",)).filter(
        "times > 0").select("_mix_row", F.sequence(F.lit(1), "times").alias("_mix_times"))
    return rows.join(times, "_mix_row").withColumn(
        "_mix_time", F.explode("_mix_times")).select(
        *(rows[c] for c in docs.columns))


def queue(docs: DataFrame, weights: tuple[int, ...], budget: float, repeats: int,
          seed: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per document with its ``times`` and the ``carried`` columns."""
    rows = docs.select(
        *carried, "doc_id", "source", F.col("source").isNull().alias("_no_source"),
        word_count().alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"),
                                                     F.lit("null"))).cast("binary"))
        .alias("_key"))
    rows = settled(rows, "sizes")  # texts are read once, not again for the range bounds
    lined = running_totals(rows, [*SOURCE_ORDER, "_key", "size"], "size", "queues")
    sources, goal = source_targets(lined, weights, budget, repeats)
    sources = settled(sources, "targets")
    starts = lined.groupBy(*SOURCE_ORDER).agg(F.min("_before").alias("_start"))
    # One row per source: sort-merge beyond the broadcast threshold, split by AQE if skewed.
    keyed = starts.join(sources, starts["_no_source"].eqNullSafe(sources["_no_source"])
                        & starts["source"].eqNullSafe(sources["source"])).select(
        starts["source"].alias("_source"), "_start", "source_size", "_place", "target")
    timed = settled(lined.join(keyed, F.col("source").eqNullSafe(F.col("_source"))).select(
        *carried, "doc_id", "source", "size", "source_size", "target", "_place",
        (F.col("_before") - F.col("_start") + F.col("size")).alias("_end")), "timed")
    finish = finish_time(F.col("_end") + F.col("_pass") * F.col("source_size"))
    turns = timed.filter("size > 0").select(
        "size", "source_size", "target", "_place", "_end",
        F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_pass")).select(
        finish.alias("_finish"), "_place",
        (F.col("_end") + F.col("_pass") * F.col("source_size")).alias("_to"), "size")
    merged = running_totals(turns, ["_finish", "_place", "_to"], "size", "turns")
    last = merged.filter(F.col("_before") + F.col("size") <= goal).agg(
        F.max(F.struct("_finish", "_place", "_to")).alias("cut")).first()["cut"]
    if last is None:
        return timed.withColumn("times", F.lit(0))
    cut = F.struct(F.lit(last["_finish"]).alias("a"), F.lit(last["_place"]).alias("b"),
                   F.lit(last["_to"]).alias("c"))
    times = F.lit(0)
    for turn in range(repeats):
        end = F.col("_end") + turn * F.col("source_size")
        at = F.struct(finish_time(end).alias("a"), F.col("_place").alias("b"), end.alias("c"))
        times = times + F.when((F.col("size") > 0) & (at <= cut), 1).otherwise(0)
    return timed.withColumn("times", times)


def finish_time(end):
    return F.when(F.col("target") > 0, end.cast("double") / F.col("target")).otherwise(
        F.lit(float("inf")))
