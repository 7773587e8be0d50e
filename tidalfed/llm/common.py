"""Helpers the operators share: clash-free names, settled tables, running totals, models."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalfed import session

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of an Arrow batch on its way to or from Python, in MB.
BATCH_MB = 4


def prepare(spark: SparkSession) -> SparkSession:
    """The session's settings, and batches bounded by bytes: 10,000 rows of two texts each are
    far too many for a worker, and the memory of the largest stays with it and with the JVM."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_MB << 20))
    return session.prepare(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def settled(df: DataFrame, label: str) -> DataFrame:
    """Compute once, as a Parquet table of the shared folder; a lost executor changes nothing."""
    return session.written(df, label)


def alone(make: Callable[[], DataFrame], spark: SparkSession, label: str) -> DataFrame:
    """What ``make`` gives, settled; the tables that were settled on the way are deleted."""
    path = session.run_folder(spark, label)
    with session.scratch(spark):
        df = make()
        df.write.parquet(path)
    session.keep(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(column: str = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % modulus


def running_totals(df: DataFrame, order: list[str], size: str, label: str) -> DataFrame:
    """``df`` with ``_rank`` (0, 1, ...) and ``_before`` (sum of ``size`` over the rows before).

    Rows are range-sorted by ``order``, summed inside each range, and the totals of the
    earlier ranges are added. Only one row per range is looked at as a whole.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()),
                           T.StructField("_rank", T.LongType()),
                           T.StructField("_before", T.LongType())])
    at = df.columns.index(size)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, rank, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(sizes)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)),
                 pa.array(np.arange(rank, rank + n)), pa.array(ends - sizes)],
                names=[*batch.schema.names, "_part", "_rank", "_before"])
            rank, total = rank + n, int(ends[-1]) if n else total

    ranged = df.repartitionByRange(partitions(df.sparkSession), *order)
    local = settled(ranged.sortWithinPartitions(*order).mapInArrow(scan, schema), label)
    totals = local.groupBy("_part").agg(
        F.count("*").alias("_rows"), F.sum(size).alias("_sum"))
    rows = sorted(totals.collect())  # one row per range
    ranks = np.cumsum([0, *(r["_rows"] for r in rows)])
    sums = np.cumsum([0, *(r["_sum"] for r in rows)])
    starts = df.sparkSession.createDataFrame(
        [(r["_part"], int(a), int(b)) for r, a, b in zip(rows, ranks, sums)],
        "_part int, _rank0 long, _before0 long")
    return local.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_rank") + F.col("_rank0")).alias("_rank"),
        (F.col("_before") + F.col("_before0")).alias("_before"))


def pieces_of(batch: pa.RecordBatch, column: int, most: int) -> Iterator[tuple[int, int]]:
    """Slices of a batch whose texts hold about ``most`` bytes, one text at least."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(
        zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


class Codes(dict):
    """Hash of a token, remembered; emptied when it holds a million tokens."""

    def __missing__(self, token: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        code = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        return code


def runs(batches: Iterator[pa.RecordBatch], keys: list[str],
         most: int) -> Iterator[pa.RecordBatch]:
    """Sorted batches cut anew so that rows of one key stay in one batch.

    Each batch holds whole keys, about ``most`` rows or one key.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < most:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        change = np.zeros(whole.num_rows, bool)
        for key in keys:
            values = whole.column(key).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        at = np.flatnonzero(change)
        if len(at):
            yield whole.slice(0, int(at[-1]))
            whole = whole.slice(int(at[-1]))
        held = [whole]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def in_blocks(members: DataFrame, key: list[str], node: str, most: int) -> DataFrame:
    """Deal each key's members to blocks: ``_a``, ``_b`` (chunks met in the block), ``_own``.

    A key of up to ``most`` members is one block. A larger one is cut into chunks, and each
    two chunks meet in one block, so every pair meets once and no block is unbounded.
    """
    sizes = members.groupBy(*key).agg(F.count("*").alias("_size")).filter("_size > 1")
    cut = members.join(sizes, key).withColumn("_cuts", F.ceil(F.col("_size") / most)).withColumn(
        "_own", F.pmod(F.xxhash64(node), F.col("_cuts")).cast("int"))
    met = F.explode(F.sequence(F.lit(0), (F.col("_cuts") - 1).cast("int")))
    return cut.select("*", met.alias("_met")).select(
        *members.columns, F.least("_own", "_met").alias("_a"),
        F.greatest("_own", "_met").alias("_b"), "_own")
