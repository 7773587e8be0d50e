"""Operator 8: near-duplicate vectors of one label by p-stable Euclidean hashing.

Vectors are scaled to length one; projections on Gaussian directions, shifted and cut into
steps of ``STEP``, give ``WIDTH`` whole numbers per table, and vectors that agree in all of
them meet in a bucket. Cosine 0.98 is a distance of 0.2, at which a table meets with chance
0.25, so that 20 tables miss a pair at the threshold with chance 0.003. Pairs are then
checked by exact cosine; one that meets in several tables counts in the first.

Equal vectors are one class with a number of copies, never pairs. Buckets above ``BLOCK``
classes are cut into chunks that meet two by two, so no pair is lost and no task holds an
unbounded bucket. Null, zero and non-finite vectors and rows without a label link with
nothing; vectors of different lengths never link. Rows that share a vec_id are one node.
Labels are whole numbers. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalfed.llm.common import in_blocks, runs, settled
from tidalfed.llm.components import components

COSINE = 0.98
TABLES, WIDTH, STEP = 20, 8, 1.0
BLOCK = 1024


def bucket_keys(unit: np.ndarray, tables: int = TABLES, width: int = WIDTH,
                step: float = STEP, seed: int = 8) -> np.ndarray:
    """One 64-bit key per vector and table."""
    rng = np.random.default_rng([seed, unit.shape[1]])
    directions = rng.normal(size=(unit.shape[1], tables * width))
    shifts = rng.uniform(0, step, tables * width)
    cells = np.floor((unit @ directions + shifts) / step).astype(np.int64)
    cells = cells.reshape(len(unit), tables, width).astype(np.uint64)
    keys = np.arange(tables, dtype=np.uint64)[None, :] + np.uint64(unit.shape[1] << 8)
    for i in range(width):
        keys = (keys ^ cells[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) for each vector length in a column of vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    found = []
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        values = flat[starts[rows][:, None] + np.arange(size)]
        values = values / np.abs(values).max(axis=1, keepdims=True)
        found.append((rows, values / np.linalg.norm(values, axis=1, keepdims=True)))
    return found


def vector_classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the hash of their vector, and one row per label and distinct vector."""
    usable = (F.col("label").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                         & (F.abs(x) < float("inf")))
              & F.exists("embedding", lambda x: x != 0))
    rows = settled(vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"),
        F.when(usable, F.col("embedding").cast("array<double>")).alias("vector")).withColumn(
        "_hash", F.when(F.col("vector").isNotNull(), F.md5(F.to_json("vector").cast("binary")))),
        "vectors")
    classes = rows.filter("_hash IS NOT NULL AND vec_id IS NOT NULL").groupBy(
        "label", "_hash").agg(F.min("vec_id").alias("class"), F.count("*").alias("copies"),
                              F.first("vector").alias("vector"))
    return rows, settled(classes, "classes")


def links_of(classes: DataFrame, cosine: float, tables: int, block: int) -> DataFrame:
    """``label``, ``_hash``, ``class``, ``other``, ``links``: for each block and class with
    links their number, and the smallest id of its component there."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, unit in matrix(batch.column("vector")):
                keys = bucket_keys(unit, tables)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(np.repeat(rows, tables)))
                     for c in ("_hash", "label")]
                    + [pa.array(np.tile(np.arange(tables, dtype=np.int32), len(rows))),
                       pa.array(keys.ravel())], names=["_hash", "label", "table", "key"])

    classes = classes.withColumn("label", F.col("label").cast("long"))
    buckets = classes.select("_hash", "label", "vector").mapInArrow(
        keyed, "_hash string, label long, table int, key long")
    key = ["label", "table", "key"]
    # Vectors join by label and hash, what makes a class, only where a bucket holds two or more.
    met = in_blocks(settled(buckets, "buckets"), key, "_hash", block).join(
        classes.select("label", "_hash", "class", "copies", "vector"), ["label", "_hash"])
    order = [*key, "_a", "_b"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, order, 4096):
            out = check_blocks(batch, order, cosine, tables)
            if out is not None:
                yield out

    return met.repartition(*order).sortWithinPartitions(*order).mapInArrow(
        verify, "label long, _hash string, class long, other long, links long")


def check_blocks(batch: pa.RecordBatch, order: list[str], cosine: float,
                 tables: int) -> pa.RecordBatch | None:
    change = np.zeros(batch.num_rows, bool)
    for name in order:
        values = batch.column(name).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
    ids, copies, own = (batch.column(c).to_numpy() for c in ("class", "copies", "_own"))
    a, b, table = (batch.column(c).to_numpy() for c in ("_a", "_b", "table"))
    rows, units = zip(*matrix(batch.column("vector")))
    unit_of = np.empty(batch.num_rows, object)
    for r, u in zip(rows, units):
        k = bucket_keys(u, tables)
        for i, at in enumerate(r):
            unit_of[at] = (u[i], k[i])
    out: list[tuple[int, int, int, int]] = []
    for start, end in zip(starts, starts[1:]):
        if end - start < 2:
            continue
        here = slice(start, end)
        unit = np.array([u for u, _ in unit_of[here]])
        keys = np.array([k for _, k in unit_of[here]])
        linked = unit @ unit.T >= cosine
        np.fill_diagonal(linked, False)
        if a[start] != b[start]:  # two chunks: pairs within one meet in its own block
            linked &= own[here][:, None] != own[here][None, :]
        for earlier in range(table[start]):  # met in an earlier table already
            linked &= keys[:, None, earlier] != keys[None, :, earlier]
        if not linked.any():
            continue
        totals = linked @ copies[here]
        least = ids[here].copy()
        while True:
            step = np.minimum(least, np.where(linked, least[None, :], np.iinfo(np.int64).max)
                              .min(axis=1))
            if (step == least).all():
                break
            least = step
        for i in np.flatnonzero(totals).tolist():
            out.append((start + i, int(ids[start + i]), int(least[i]), int(totals[i])))
    if not out:
        return None
    rows, *counts = zip(*out)
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c).take(pa.array(rows)) for c in ("label", "_hash")),
         *(pa.array(c, pa.int64()) for c in counts)],
        names=["label", "_hash", "class", "other", "links"])


def near_vectors(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES,
                 block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows, classes = vector_classes(vectors)
    found = settled(links_of(classes, cosine, tables, block), "found")
    linked = found.groupBy("label", "_hash").agg(F.sum("links").alias("_linked"))
    parts = components(found.select(F.col("class").alias("a"), F.col("other").alias("b")))
    known = classes.select("label", "_hash", "class", "copies").join(
        linked, ["label", "_hash"], "left").join(
        parts, F.col("class") == F.col("node"), "left").select(
        "label", "_hash",
        (F.col("copies") - 1 + F.coalesce("_linked", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class").alias("_component"))
    return rows.select("vec_id", "label", "_hash").join(known, ["label", "_hash"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_component", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))
