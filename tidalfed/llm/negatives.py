"""Operator 12: hard-negative mining by angular triangle filtering.

Vectors are turned into whole numbers. Each row stores its norm and its angles to a few
reference directions (the ``REFERENCES`` rows whose ids hash lowest, a bounded sample). The
angle between an anchor and a row lies between the difference and the sum of their angles to
any reference, which gives an interval of cosines and, times the norms, of scores, widened by
more than what rounding can take away. Rows are kept sorted by label, nearest reference and
angle to it, in blocks; a block whose interval misses what an anchor looks for is passed over,
and of the others only the rows in the anchor's window of angles are scored, in whole numbers.

Anchors are a stated query set (every 50th id) met with all rows, in chunks of a bounded
number of bytes: each chunk is broadcast, every task keeps the best of its rows, and the
tasks' lists, a few rows per anchor each, are ranked together. Positives come first; what they
scored sets the windows negatives are looked for in, and the best found so far narrows them.

Rows with a null label, vector or id, or a null or non-finite component, take no part. Rows
that share an id count once, as the one with the smallest label, then vector. Vectors of
different lengths never meet. Components are held to the range of a long, and so are scores,
which are exact below that. Equal scores come in order of id. An empty table, or one without
anchors, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidalfed.llm.common import partitions, settled

ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
#: Least and most a negative may score, in per cent of the positive's score.
LEAST, MOST = 50, 95
SCALE, SHIFT_EVERY, LABELS = 256, 7, 10

REFERENCES = 16
BLOCK_ROWS, ANCHORS_AT_ONCE = 1024, 256
CHUNK_BYTES = 16 * 1024 * 1024
#: Angles are off by less than 1e-7 through rounding; intervals are widened by ten times that.
ANGLE_SLACK = 1e-6
NONE = -(2**63) + 1

STORED = "vec_id long, label long, vector array<long>, norm double, angles array<double>, cell int"


def participants(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and whole-number vector of the rows that take part."""
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull()
              & F.col("embedding").isNotNull()
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                         & (F.abs(x) < float("inf"))))
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    return embeddings.filter(usable).select(
        vec_id.alias("vec_id"),
        F.struct(
            F.when(vec_id % SHIFT_EVERY == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
            F.transform("embedding", lambda x: F.floor(scale * x.cast("double"))).alias("vector")
        ).alias("row")).groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of vector in a column."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[starts[rows][:, None] + np.arange(size)]


def norms_of(vectors: np.ndarray) -> np.ndarray:
    return np.linalg.norm(vectors.astype(np.float64), axis=1)


def angles_to(vectors: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles to each direction; a vector of zeros scores zero anyway and stands at 0."""
    unit = vectors.astype(np.float64) / np.where(norms == 0, 1, norms)[:, None]
    return np.where(norms[:, None] == 0, 0.0, np.arccos(np.clip(unit @ directions.T, -1, 1)))


def stored(rows: DataFrame, references: int = REFERENCES) -> DataFrame:
    """The rows with norm and angles, sorted by label, nearest reference and angle to it."""
    nonzero = rows.filter(F.exists("vector", lambda x: x != 0))
    found = nonzero.orderBy(F.xxhash64("vec_id"), "vec_id").limit(references).select(
        "vector").collect()  # ``references`` rows
    directions: dict[int, list] = {}
    for r in found:
        directions.setdefault(len(r["vector"]), []).append(r["vector"])
    units = {n: (m := np.array(v, np.float64)) / norms_of(m)[:, None]
             for n, v in directions.items()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in by_length(batch.column("vector")):
                part, n = batch.take(pa.array(at)), len(at)
                norms = norms_of(vectors)
                angles = angles_to(vectors, norms, units.get(
                    vectors.shape[1], np.zeros((0, vectors.shape[1]))))
                k = angles.shape[1]
                cells = angles.argmin(axis=1) if k else np.zeros(n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(norms), pa.ListArray.from_arrays(
                        pa.array(np.arange(0, n * k + 1, k) if k else np.zeros(n + 1, int),
                                 pa.int32()), pa.array(angles.ravel())),
                     pa.array(cells.astype(np.int32))],
                    names=["vec_id", "label", "vector", "norm", "angles", "cell"])

    near = F.get("angles", "cell")
    return settled(
        rows.mapInArrow(measure, STORED).withColumn("_near", near).repartitionByRange(
            partitions(rows.sparkSession), "label", "cell", "_near", "vec_id")
        .sortWithinPartitions("label", "cell", "_near", "vec_id").drop("_near"), "vectors")


class Vectors:
    """Rows of one vector length: ids, labels, vectors, norms and angles."""

    def __init__(self, batch: pa.RecordBatch, rows: np.ndarray, vectors: np.ndarray):
        self.ids = batch.column("vec_id").to_numpy()[rows]
        self.labels = batch.column("label").to_numpy()[rows]
        self.vectors = vectors
        self.norms = batch.column("norm").to_numpy()[rows]
        # Of one length, all rows have angles to the same references.
        part = batch.column("angles").take(pa.array(rows))
        self.angles = part.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)

    def take(self, at: np.ndarray | slice) -> Vectors:
        out = object.__new__(Vectors)
        for name in ("ids", "labels", "vectors", "norms", "angles"):
            setattr(out, name, getattr(self, name)[at])
        return out


def in_lengths(batch: pa.RecordBatch) -> dict[int, Vectors]:
    return {v.shape[1]: Vectors(batch, rows, v) for rows, v in by_length(batch.column("vector"))}


def blocks_of(rows: Vectors) -> Iterator[Vectors]:
    """Neighbours of one label, at most ``BLOCK_ROWS``."""
    edges = [0, *(np.flatnonzero(np.diff(rows.labels)) + 1).tolist(), len(rows.ids)]
    for start, end in zip(edges, edges[1:]):
        for at in range(start, end, BLOCK_ROWS):
            yield rows.take(slice(at, min(at + BLOCK_ROWS, end)))


def scores(anchors: np.ndarray, rows: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products. ``bound``: norms multiplied, which no partial sum exceeds."""
    if bound < 2**52:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    whole = anchors.astype(object) @ rows.astype(object).T
    return np.clip(whole, NONE + 1, -NONE).astype(np.int64)


def reach(angles: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest angle between each anchor and rows whose angles to the references
    lie between ``low`` and ``high``: the triangle inequality, the best over all references."""
    if not angles.shape[1]:
        return np.zeros(len(angles)), np.full(len(angles), np.pi)
    least = np.maximum(0, np.maximum(low - angles, angles - high)).max(axis=1)
    first, last = angles + low, angles + high
    most = np.where(last <= np.pi, last, np.where(first >= np.pi, 2 * np.pi - first, np.pi))
    return np.maximum(0, least - ANGLE_SLACK), np.minimum(np.pi, most.min(axis=1) + ANGLE_SLACK)


def bounds(anchors: Vectors, block: Vectors) -> tuple[np.ndarray, np.ndarray]:
    """Scores that no row of the block can be below or above, for each anchor."""
    least, most = reach(anchors.angles, block.angles.min(axis=0), block.angles.max(axis=0))
    small, large = block.norms.min() * anchors.norms, block.norms.max() * anchors.norms
    low, high = np.cos(most), np.cos(least)
    slack = 1 + large * 1e-9
    return (np.where(low < 0, large, small) * low - slack,
            np.where(high > 0, large, small) * high + slack)


def window(anchors: Vectors, block: Vectors, place: int, order: np.ndarray,
           wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Part of the block, sorted by its angle to one reference, that may score ``wanted``."""
    sorted_angles = block.angles[order, place]
    norm = np.where(wanted > 0, block.norms.max(), block.norms.min()) * anchors.norms
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.nan_to_num((wanted - 1) / norm, nan=-1, posinf=2, neginf=-1)
    widest = np.where(cosine <= 1 + 1e-9, np.arccos(np.clip(cosine, -1, 1)) + ANGLE_SLACK, -1)
    mine = anchors.angles[:, place]
    start = np.searchsorted(sorted_angles, mine - widest, "left")
    return start, np.maximum(start, np.searchsorted(sorted_angles, mine + widest, "right"))


class Best:
    """The best rows of each slot so far: highest score, then smallest id."""

    def __init__(self, slots: int, most: int):
        self.most = most
        self.score = np.full((slots, most), NONE)
        self.id = np.zeros((slots, most), np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.unique(slot)
        all_slots = np.concatenate([np.repeat(touched, self.most), slot])
        all_scores = np.concatenate([self.score[touched].ravel(), score])
        all_ids = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((all_ids, -all_scores, all_slots))
        sorted_slots = all_slots[order]
        starts = np.searchsorted(sorted_slots, touched)
        rank = np.arange(len(order)) - np.repeat(starts, np.diff([*starts, len(order)]))
        keep = rank < self.most
        self.score[sorted_slots[keep], rank[keep]] = all_scores[order][keep]
        self.id[sorted_slots[keep], rank[keep]] = all_ids[order][keep]

    def batch(self, anchors: np.ndarray, per_anchor: int) -> pa.RecordBatch:
        slot, place = np.nonzero(self.score > NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors[slot // per_anchor]), pa.array((slot % per_anchor).astype(np.int32)),
             pa.array(self.id[slot, place]), pa.array(self.score[slot, place])],
            names=["anchor_id", "slot", "vec_id", "score"])


def scan(anchors: Vectors, low: np.ndarray, high: np.ndarray, same: bool, best: Best,
         block: Vectors) -> None:
    """Meet one block with all anchors of the same label, or of other labels.

    ``low`` and ``high`` have a column per slot of an anchor: the scores it looks for.
    """
    per = low.shape[1]
    kth = best.score[:, -1].reshape(-1, per)
    wanted_low = np.maximum(low, kth)  # equal scores may still win by id
    least, most = wanted_low.min(axis=1), high.max(axis=1)
    meets = (anchors.labels == block.labels[0]) == same
    below, above = bounds(anchors, block)
    open_ = np.flatnonzero(meets & (above >= least) & (below <= most))
    if not len(open_):
        return
    if anchors.angles.shape[1]:
        place = int(np.argmax(np.ptp(block.angles, axis=0)))
        order = np.argsort(block.angles[:, place], kind="stable")
        rows = block.take(order)
    else:
        place, order, rows = None, None, block
    largest = float(block.norms.max())
    for at in range(0, len(open_), ANCHORS_AT_ONCE):
        some = open_[at:at + ANCHORS_AT_ONCE]
        mine = anchors.take(some)
        if place is None:
            start, end = np.zeros(len(some), int), np.full(len(some), len(rows.ids))
        else:
            start, end = window(mine, block, place, order, least[some].astype(np.float64))
        first, last = int(start.min()), int(end.max())
        if first >= last:
            continue
        here = rows.take(slice(first, last))
        found = scores(mine.vectors, here.vectors, float(mine.norms.max()) * largest)
        column = np.arange(first, last)
        inside = (column >= start[:, None]) & (column < end[:, None])
        inside &= here.ids[None, :] != mine.ids[:, None]
        for j in range(per):
            fits = inside & (found >= wanted_low[some, j][:, None]) & (
                found <= high[some, j][:, None])
            if not fits.any():
                continue
            if fits.shape[1] > best.most:  # below the block's own best there is nothing to add
                held = np.where(fits, found, NONE)
                cut = np.partition(held, -best.most, axis=1)[:, -best.most]
                fits &= found >= cut[:, None]
            a, b = np.nonzero(fits)
            best.add(some[a] * per + j, found[a, b], here.ids[b])


def scanned(rows: DataFrame, chunk: pa.Table, slots: int, most: int, same: bool) -> DataFrame:
    """anchor_id, slot, vec_id, score: the best rows of every task for a chunk of anchors.

    The chunk's columns ``low`` and ``high`` (lists of ``slots`` scores) say what is looked for.
    """
    shared = rows.sparkSession.sparkContext.broadcast(chunk)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not shared.value.num_rows:
            return
        whole = shared.value.combine_chunks().to_batches()[0]
        groups = {}
        for at, vectors in by_length(whole.column("vector")):
            low, high = (whole.column(c).take(pa.array(at)).flatten().to_numpy(
                zero_copy_only=False).reshape(-1, slots) for c in ("low", "high"))
            groups[vectors.shape[1]] = (Vectors(whole, at, vectors), low, high,
                                        Best(len(at) * slots, most))
        for batch in batches:
            for length, part in in_lengths(batch).items():
                if length in groups:
                    anchors, low, high, best = groups[length]
                    for block in blocks_of(part):
                        scan(anchors, low, high, same, best, block)
        for anchors, _, _, best in groups.values():
            yield best.batch(anchors.ids, slots)

    return rows.mapInArrow(meet, "anchor_id long, slot int, vec_id long, score long")


def ranked(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The best of the tasks' lists, as ``rank``; a key has at most ``most`` rows per task."""
    order = W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   every: int = ANCHOR_EVERY, least: int = LEAST, most: int = MOST,
                   chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = stored(participants(embeddings))
    anchors = rows.filter(F.col("vec_id") % every == 0)
    size = anchors.agg(F.sum(F.size("vector") * 8 + 8 * (REFERENCES + 4 * positives + 8))).first()
    chunks = max(1, -(-(size[0] or 0) // chunk_bytes))
    chunk_of = F.pmod(F.xxhash64("vec_id"), F.lit(chunks))
    results = [
        mined(rows, anchors.filter(chunk_of == i), positives, negatives, least, most)
        for i in range(chunks)] if size[0] else []
    if not results:
        return rows.sparkSession.createDataFrame([], RESULT)
    return reduce(DataFrame.union, results)


RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


def mined(rows: DataFrame, anchors: DataFrame, positives: int, negatives: int, least: int,
          most: int) -> DataFrame:
    """The result for one chunk of anchors, whose vectors are at most ``CHUNK_BYTES``."""
    anything = {"low": F.array(F.lit(NONE + 1)), "high": F.array(F.lit(-NONE))}
    first = settled(ranked(scanned(rows, anchors.withColumns(anything).toArrow(), 1, positives,
                                   True), ["anchor_id"], positives), "positives")
    # Bounds in whole numbers; beyond what a long times 100 holds, in decimals.
    score = F.col("score").cast("decimal(25,0)")
    low = F.ceil(score * least / 100).cast("long")
    high = F.floor(score * most / 100).cast("long")
    windows = first.select("anchor_id", "rank", low.alias("low"), high.alias("high")).groupBy(
        "anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "low", "high"))).alias("w"))
    places = F.sequence(F.lit(0), F.lit(positives - 1))
    chunk = anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).withColumns({
        "low": F.transform(places, lambda i: F.coalesce(F.get("w", i)["low"], F.lit(-NONE))),
        "high": F.transform(places, lambda i: F.coalesce(F.get("w", i)["high"], F.lit(NONE)))})
    found = settled(ranked(scanned(rows, chunk.drop("w", "anchor_id").toArrow(), positives,
                                   negatives, False), ["anchor_id", "slot"], negatives),
                    "negatives")
    pair = first.select(F.col("anchor_id").alias("_anchor"), (F.col("rank") - 1).alias("_slot"),
                        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(pair, (F.col("anchor_id") == F.col("_anchor"))
                      & (F.col("slot") == F.col("_slot"))).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
