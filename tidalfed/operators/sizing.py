"""Size checks that decide between a plain plan and its wide-scale form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalfed import settings as S
from tidalfed.session import settled


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each key, as ``_rows``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def group_sizes(df: DataFrame, keys: Sequence[str],
                counts: DataFrame | None = None) -> tuple[int, int]:
    """Rows of the largest group and of the whole table, from one pre-aggregated pass."""
    sizes = key_counts(df, keys) if counts is None else counts
    row = sizes.agg(F.max("_rows").alias("largest"), F.sum("_rows").alias("total")).first()
    return int(row["largest"] or 0), int(row["total"] or 0)


def row_bytes(schema: T.StructType) -> int:
    """Least width of one row."""
    return 16 + 16 * len(schema.fields)


def measured_bytes(schema: T.StructType) -> Column:
    """Width of a row as it is: texts and lists by their length, other nested values as JSON."""
    width = F.lit(row_bytes(schema)).cast("long")
    for field in schema.fields:
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            more = F.octet_length(value)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            more = 8 * F.size(value)
        elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            more = F.octet_length(F.to_json(F.struct(value)))
        else:
            continue
        width = width + F.greatest(F.coalesce(more, F.lit(0)), F.lit(0))
    return width


def sized_broadcast(df: DataFrame, max_bytes: int = S.BROADCAST_BYTES,
                    computed: bool = False) -> DataFrame:
    """Mark the side for broadcast only when its rows, as measured, fit ``max_bytes``.

    Beyond that the frame is returned as it is: the join then shuffles both sides, and
    adaptive execution splits the partitions of a hot key. A ``computed`` side, such as an
    aggregate, is settled first, so that the count and the join do not both compute it.
    """
    if computed:
        df = settled(df)
    # No more rows are measured than could fit.
    bound = max(1, max_bytes // row_bytes(df.schema))
    found = df.limit(bound + 1).agg(F.sum(measured_bytes(df.schema)).alias("bytes")).first()
    return F.broadcast(df) if (found["bytes"] or 0) <= max_bytes else df


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str],
           how: str = "inner") -> DataFrame:
    """Add the other columns of ``right`` to ``left`` by key; null matches null.

    The keys of ``right`` are renamed first, as it is often derived from ``left``.
    """
    renamed = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    matches = F.lit(True)
    for key in keys:
        matches = matches & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return left.join(renamed, matches, how).drop(*[f"_key_{k}" for k in keys])
