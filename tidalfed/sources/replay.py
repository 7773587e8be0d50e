"""Recorded tables replayed in time order, a bounded part per trigger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalfed.session import written

SLICES = 5
#: Rows of a file of the largest slice.
FILE_ROWS = 500_000


def sliced(rows: DataFrame, time: str, count: int = SLICES, name: str = "_slice") -> DataFrame:
    """Number rows 0 to ``count`` - 1 by time: equal spans between the first and the last.

    Only the first and the last time are looked at as a whole.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    first, last = rows.agg(F.min(micros), F.max(micros)).first()
    if first is None:
        return rows.withColumn(name, F.lit(0))
    span = max(1, last - first)
    place = F.expr(f"cast((unix_micros(cast({time} AS timestamp)) - {first}) * {count} "
                   f"div {span} AS int)")
    return rows.withColumn(name, F.coalesce(F.least(F.lit(count - 1), place), F.lit(0)))


def replayed(rows: DataFrame, folder: str, time: str, count: int = SLICES,
             late: Column | None = None, by: int = 2, file_rows: int = FILE_ROWS) -> DataFrame:
    """A stream of the rows in ``count`` slices of time, one trigger each.

    Rows for which ``late`` holds arrive ``by`` slices after their time, the last slice at
    the latest. Every slice has the same number of files, about ``file_rows`` rows each in the
    largest slice, and a trigger takes that many; files are read in the order they were written
    in. ``count`` bounds what a trigger holds, ``file_rows`` what a task writes.
    """
    spark = rows.sparkSession
    numbered = sliced(rows, time, count)
    if late is not None:
        numbered = numbered.withColumn("_slice", F.when(
            late, F.least(F.lit(count - 1), F.col("_slice") + by)).otherwise(F.col("_slice")))
    cut = written(numbered, "slices", "_slice")
    largest = cut.groupBy("_slice").count().agg(F.max("count")).first()[0] or 0
    files = max(1, -(-largest // file_rows))
    # An empty file would not be written: each gets a line that marks it and is left out again.
    marks = spark.range(files).select(
        F.col("id").cast("int").alias("_file"), F.lit(True).alias("_mark"))
    for number in range(count):
        dealt = cut.filter(F.col("_slice") == number).drop("_slice").withColumns({
            "_file": F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int"),
            "_mark": F.lit(False)})
        dealt.unionByName(marks, allowMissingColumns=True).repartitionById(
            files, F.col("_file")).drop("_file").write.mode("append").parquet(folder)
    schema = T.StructType([*rows.schema.fields, T.StructField("_mark", T.BooleanType())])
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
            .parquet(folder).filter(~F.col("_mark")).drop("_mark"))
