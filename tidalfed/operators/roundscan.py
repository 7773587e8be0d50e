"""Rounds closed by enough participants or by time, found without going row by row.

Where a round ends depends only on the message it opens with: at the message that brings the
last participant needed, or before the first message beyond its time. So for every message
the place is computed at which a round opened there would be followed by the next one, all
messages alike; the true rounds are then those reached from the first message along these
pointers. Pointers are followed inside blocks of consecutive messages first, and only the few
messages at which some block is left are joined, doubling the stretch each time. Positions,
limits and counts are running values over ranges (:mod:`ordered`), so one model may hold all
messages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.operators.ordered import position, running
from tidalfed.operators.sizing import group_sizes, key_counts
from tidalfed.session import settled, written

AT, NEXT, LIMIT, KTH = "_at", "_next", "_limit", "_kth"
BLOCK_ROWS = 65_536


def _within(rows: DataFrame, key: str, time: str, seconds: float, group_rows: int,
            counts: DataFrame) -> DataFrame:
    """For each key and time of a message, how many messages come up to ``seconds`` later."""
    moved = F.col(time) + F.make_dt_interval(secs=F.lit(float(seconds)))
    asked = rows.select(key, time).distinct().select(
        key, moved.alias("_when"), F.lit(1).alias("_kind"), F.col(time).alias("_asked"))
    line = rows.select(key, F.col(time).alias("_when"), F.lit(0).alias("_kind"),
                       F.lit(None).cast("timestamp").alias("_asked")).unionByName(asked)
    counted = running(line, [key], ["_when", "_kind", "_asked"], sums={
        LIMIT: (1 - F.col("_kind")).cast("bigint")}, group_rows=group_rows, counts=counts)
    return counted.filter("_kind = 1").select(key, F.col("_asked").alias(time), LIMIT)


def _recent(rows: DataFrame, key: str, participant: str, most: int, block_rows: int,
            one_block: bool) -> DataFrame:
    """For each message, the position from which on ``most`` participants have been seen up to
    it (0 where there are fewer): the last place of the ``most``-th most recent one."""
    cut = rows.select(key, AT, participant,
                      F.expr(f"cast(({AT} - 1) div {block_rows} AS bigint)").alias("_block"))
    # What a block hands on: the last places of its most recent participants.
    if one_block:
        lined = cut.withColumn("_before", F.lit(None).cast(
            f"array<struct<_last: bigint, {participant}: string>>"))
        return _scanned(lined, rows, key, participant, most)
    ends = cut.groupBy(key, "_block", participant).agg(F.max(AT).alias("_last"))
    brought = written(ends.groupBy(key, "_block").agg(F.slice(F.sort_array(F.collect_list(
        F.struct("_last", participant)), asc=False), 1, most).alias("_list")), "blocks")
    carried = _carried(brought, key, participant, most)
    lined = cut.join(carried, [key, "_block"], "left").withColumn(
        "_before", F.when((F.col(AT) - 1) % block_rows == 0, F.col("_list"))).drop("_list")
    return _scanned(lined, rows, key, participant, most)


def _scanned(lined: DataFrame, rows: DataFrame, key: str, participant: str,
             most: int) -> DataFrame:
    """``_since`` of each message, block by block, from what earlier blocks hand on."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        current = None
        for frame in frames:
            for (name, block), part in frame.groupby([key, "_block"], sort=False, dropna=False):
                if (name, block) != current:
                    current, before = (name, block), part["_before"].iloc[0]
                    seen = {r[participant]: r["_last"] for r in (
                        before if before is not None else [])}
                yield pd.DataFrame({key: part[key], AT: part[AT], "_since": kth_last(
                    part[participant].to_numpy(), part[AT].to_numpy(), seen, most)})

    kind = rows.schema[key].dataType.simpleString()
    return lined.repartition(key, "_block").sortWithinPartitions(key, "_block", AT).mapInPandas(
        scan, f"{key} {kind}, {AT} bigint, _since bigint")


def kth_last(names: np.ndarray, places: np.ndarray, seen: dict, most: int) -> np.ndarray:
    """The ``most``-th largest of the participants' last places, at each message; updates
    ``seen`` to the most recent participants."""
    codes, labels = pd.factorize(np.concatenate([np.array(list(seen), object), names]))
    lasts = np.zeros(max(len(labels), most), np.int64)
    lasts[codes[:len(seen)]] = list(seen.values())
    codes, out = codes[len(seen):], np.empty(len(names), np.int64)
    step = max(1, 4_000_000 // len(lasts))
    for start in range(0, len(names), step):
        here = codes[start:start + step]
        table = np.zeros((len(here) + 1, len(lasts)), np.int64)
        table[0] = lasts
        table[np.arange(1, len(here) + 1), here] = places[start:start + step]
        table = np.maximum.accumulate(table, axis=0)
        out[start:start + step] = np.partition(table[1:], -most, axis=1)[:, -most]
        lasts = table[-1]
    recent = np.argsort(-lasts, kind="stable")[:most]
    seen.clear()
    seen.update({labels[i]: int(lasts[i]) for i in recent if i < len(labels) and lasts[i]})
    return out


def _carried(brought: DataFrame, key: str, participant: str, most: int) -> DataFrame:
    """The most recent participants before each block: a few for each earlier block joined,
    twice as many blocks back each time."""
    blocks = brought.agg(F.max("_block")).first()[0] or 0
    known, back = brought, 1
    while back <= blocks:
        earlier = known.select(key, (F.col("_block") + back).alias("_block"),
                               F.col("_list").alias("_more"))
        both = F.concat("_list", F.coalesce("_more", F.expr("slice(_list, 1, 0)")))
        best = known.join(earlier, [key, "_block"], "left").select(
            key, "_block", F.explode(both).alias("_one")).groupBy(
            key, "_block", f"_one.{participant}").agg(F.max("_one._last").alias("_last"))
        known = written(best.groupBy(key, "_block").agg(F.slice(F.sort_array(F.collect_list(
            F.struct("_last", participant)), asc=False), 1, most).alias("_list")), "blocks")
        back *= 2
    return known.select(key, (F.col("_block") + 1).alias("_block"), "_list")


def _starts(pointers: DataFrame, key: str, block_rows: int, one_block: bool) -> DataFrame:
    """The positions reached from 1 along ``NEXT``. With one block a key there is nothing to
    join: it is entered at its first message."""
    block = F.expr(f"cast(({AT} - 1) div {block_rows} AS bigint)")
    dealt = pointers.select(key, AT, NEXT, block.alias("_block"))
    kind = pointers.schema[key].dataType.simpleString()

    def leave(frame: pd.DataFrame) -> pd.DataFrame:
        """Where each message of a block leaves it."""
        frame = frame.sort_values(AT)
        first, n = int(frame[AT].iloc[0]), len(frame)
        to = frame[NEXT].to_numpy() - first
        while (inside := to < n).any():
            to = np.where(inside, to[np.minimum(to, n - 1)], to)
        return pd.DataFrame({key: frame[key], AT: frame[AT], "_out": to + first})

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        """The messages of a block reached from the one it is entered at."""
        frame = frame.sort_values(AT)
        first, n = int(frame[AT].iloc[0]), len(frame)
        to = np.append(np.minimum(frame[NEXT].to_numpy() - first, n), n)
        reached = np.append(frame["_entered"].to_numpy(bool), False)
        while (to[:-1] < n).any():
            reached[to[reached]] = True
            to = to[to]
        reached[to[reached]] = True
        return frame.loc[reached[:-1], [key, AT]]

    if one_block:
        first = dealt.withColumn("_entered", F.col(AT) == 1)
        return first.groupBy(key, "_block").applyInPandas(walk, f"{key} {kind}, {AT} bigint")
    exits = written(dealt.groupBy(key, "_block").applyInPandas(
        leave, f"{key} {kind}, {AT} bigint, _out bigint"), "exits")
    # Only places that some block is left for can be entered; from each, the next such place.
    doors = exits.select(key, F.col("_out").alias(AT)).distinct().unionByName(
        exits.select(key, F.lit(1).cast("bigint").alias(AT)).distinct()).distinct()
    hops = written(doors.join(exits, [key, AT]), "doors")
    entered = written(hops.select(key, F.lit(1).cast("bigint").alias(AT)).distinct(), "entered")
    blocks = dealt.agg(F.max("_block")).first()[0] or 0
    for _ in range(int(blocks).bit_length()):
        more = entered.join(hops, [key, AT]).select(key, F.col("_out").alias(AT))
        entered = written(entered.unionByName(more).distinct(), "entered")
        further = hops.select(key, F.col(AT).alias("_out"), F.col("_out").alias("_far"))
        hops = written(hops.join(further, [key, "_out"], "left").select(
            key, AT, F.coalesce("_far", "_out").alias("_out")), "doors")
    marked = dealt.join(entered.withColumn("_entered", F.lit(True)), [key, AT], "left").withColumn(
        "_entered", F.coalesce("_entered", F.lit(False)))
    return marked.groupBy(key, "_block").applyInPandas(walk, f"{key} {kind}, {AT} bigint")


def rounds_scan(messages: DataFrame, *, key: str = "model_id", participant: str = "region",
                time: str = "event_time", minimum: int = S.REGIONS_PER_ROUND,
                timeout_seconds: float = S.ROUND_TIMEOUT_SECONDS, clock: Column | None = None,
                group_rows: int = S.GROUP_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The messages with ``round`` (from 0 per key), ``reason`` and ``opened``.

    A round is closed by the message that brings the last of ``minimum`` participants, or by
    the first message more than ``timeout_seconds`` after its own first. ``reason`` is
    ``regions`` or ``timeout``, and null for the last round if it is still open at ``clock``
    (without one: at the end of the messages). Messages at one time come by participant.
    """
    tied = messages.withColumn("_tie", F.xxhash64(*messages.columns))
    counts = settled(key_counts(tied, [key]))
    # No line below has more than twice a key's messages.
    twice = counts.withColumn("_rows", 2 * F.col("_rows"))
    one_block = group_sizes(tied, [key], counts)[0] <= block_rows
    rows = written(position(tied, [key], [time, participant, "_tie"], AT, group_rows, counts),
                   "placed")
    limits = _within(rows, key, time, timeout_seconds, group_rows, twice)
    since = _recent(rows, key, participant, minimum, block_rows, one_block)
    # The k-th participant after i comes at the first place whose "since" is not before i.
    line = since.select(key, F.col("_since").alias("_place"), F.lit(1).alias("_kind")).unionByName(
        since.select(key, F.col(AT).alias("_place"), F.lit(0).alias("_kind")))
    kth = running(line, [key], ["_place", "_kind"], sums={KTH: F.col("_kind").cast("bigint")},
                  group_rows=group_rows, counts=twice).filter("_kind = 0").select(
        key, F.col("_place").alias(AT), (F.col(KTH) + 1).alias(KTH))
    pointed = written(
        rows.select(key, AT, time).join(limits, [key, time]).join(kth, [key, AT]).join(
            counts, key).select(
            key, AT, time, "_rows", LIMIT,
            F.when(F.col(KTH) <= F.col(LIMIT), F.col(KTH) + 1).otherwise(F.col(LIMIT) + 1)
            .alias(NEXT), (F.col(KTH) <= F.col(LIMIT)).alias("_full")), "pointers")
    starts = _starts(pointed, key, block_rows, one_block).join(pointed, [key, AT])
    ends = F.col(time) + F.make_dt_interval(secs=F.lit(float(timeout_seconds)))
    timed = (F.col(LIMIT) < F.col("_rows")) | (ends < clock if clock is not None else F.lit(False))
    numbered = position(starts, [key], [AT], "round", group_rows, counts).select(
        key, AT, (F.col("round") - 1).cast("int").alias("round"), F.col(time).alias("opened"),
        F.when(F.col("_full"), "regions").when(timed, "timeout").alias("reason"))
    joined = rows.join(numbered.withColumn("_new", F.struct("round", "opened", "reason")).select(
        key, AT, "_new"), [key, AT], "left")
    carried = running(joined, [key], [AT], last={"_round": F.col("_new")}, group_rows=group_rows,
                      counts=counts)
    return carried.select(*messages.columns, "_round.*")
