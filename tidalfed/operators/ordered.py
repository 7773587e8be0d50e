"""Running values along an order within each key, safe for keys of any size.

A window over one key runs in one task, so a key holding a third of the table would hold
the whole job up. Here the largest key is counted first. While it is small the plain
window is used. Beyond the bound the rows are range-partitioned by (keys, order), which
cuts a large key into consecutive segments of about equal size; each segment is scanned on
its own, and what the earlier segments of the same key add up to is carried in by a join.
The segment of a row must not change between the two uses, nor when an executor is lost, so
the ranged rows are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.operators.sizing import group_sizes, lookup, sized_broadcast
from tidalfed.session import written

SEGMENT = "_segment"


def segmented(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              group_rows: int = S.GROUP_ROWS,
              counts: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """Add the segment number of each row; the flag tells whether any key was cut.

    ``counts`` are the key counts, where the caller has them already.
    """
    largest, total = group_sizes(df, keys, counts)
    if largest <= group_rows:
        return df.withColumn(SEGMENT, F.lit(0)), False
    parts = -(-total // group_rows) + 1
    # Rows that agree in keys and order are told apart by all their columns, and copies of one
    # row by a number, so that no tie is too large for a segment.
    tied = df.withColumns({"_hash": F.xxhash64(*df.columns),
                           "_copy": F.monotonically_increasing_id()})
    ranged = tied.repartitionByRange(parts, *keys, *order, "_hash", "_copy").drop(
        "_hash", "_copy")
    return written(ranged.withColumn(SEGMENT, F.spark_partition_id()), "segments"), True


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            sums: Mapping[str, Column] | None = None,
            last: Mapping[str, Column] | None = None,
            group_rows: int = S.GROUP_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Add running sums and last non-null values, from a key's first row up to each row.

    ``order`` must be total within a key (end it with an id), or ties come in any order.
    """
    sums, last = dict(sums or {}), dict(last or {})
    rows, cut = segmented(df, keys, order, group_rows, counts)
    span = (W.partitionBy(*keys, SEGMENT).orderBy(*order)
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    scanned = rows.select(
        "*",
        *[F.sum(value).over(span).alias(name) for name, value in sums.items()],
        *[F.last(value, ignorenulls=True).over(span).alias(name)
          for name, value in last.items()],
    )
    if not cut:
        return scanned.drop(SEGMENT)

    position = F.struct(*order)
    ends = rows.groupBy(*keys, SEGMENT).agg(
        *[F.sum(value).alias(name) for name, value in sums.items()],
        *[F.max_by(value, F.when(value.isNotNull(), position)).alias(name)
          for name, value in last.items()],
    )
    earlier = (W.partitionBy(*keys).orderBy(SEGMENT)
               .rowsBetween(W.unboundedPreceding, -1))
    carried = ends.select(
        *keys, SEGMENT,
        *[F.sum(name).over(earlier).alias(f"_carry_{name}") for name in sums],
        *[F.last(name, ignorenulls=True).over(earlier).alias(f"_carry_{name}")
          for name in last],
    )
    joined = lookup(scanned, sized_broadcast(carried, computed=True), [*keys, SEGMENT], "left")
    summed = [F.when(F.col(f"_carry_{n}").isNull(), F.col(n))
              .otherwise(F.coalesce(n, F.lit(0)) + F.col(f"_carry_{n}")).alias(n)
              for n in sums]
    filled = [F.coalesce(n, f"_carry_{n}").alias(n) for n in last]
    return joined.select(*df.columns, *summed, *filled)


def position(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
             group_rows: int = S.GROUP_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Number the rows of each key from 1 along the order."""
    return running(df, keys, order, sums={name: F.lit(1).cast("bigint")},
                   group_rows=group_rows, counts=counts)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int,
                spread: int = 1024, rank: str | None = None) -> DataFrame:
    """The first ``limit`` rows of each key.

    Two levels: every input task keeps at most ``limit`` rows of a key, up to ``spread``
    groups per key thin those out, and one task ranks what is left (at most spread * limit).
    """
    name, lane = rank or "_rank", "_lane"
    first = W.partitionBy(*keys, lane).orderBy(*order)
    final = W.partitionBy(*keys).orderBy(*order)
    thinned = (df.withColumn(lane, F.spark_partition_id() % spread)
               .withColumn(name, F.row_number().over(first))
               .filter(F.col(name) <= limit).drop(name, lane))
    ranked = thinned.withColumn(name, F.row_number().over(final)).filter(F.col(name) <= limit)
    return ranked if rank else ranked.drop(name)
