"""Start a stream, let it work through what is there, and read its result."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidalfed.operators.joins import latest
from tidalfed.sources.topics import publish_to_all, table_sink


def run_to_table(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Write all available input to ``folder/data``; a restart continues where it ended."""
    query = (stream.writeStream.format("parquet").outputMode(mode)
             .option("path", f"{folder}/data")
             .option("checkpointLocation", f"{folder}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/data")


def run_upserts(stream: DataFrame, folder: str, keys: Sequence[str],
                stop_after: int | None = None) -> DataFrame:
    """Run in update mode and keep the newest row of each key.

    Update mode emits a window again whenever it changes. Each batch goes to its own
    folder, and reading takes each key's row of the highest batch, so that nothing is
    counted twice and a repeated batch replaces itself. With ``stop_after`` the run breaks
    off when that batch has been written but not committed, as a lost driver would.
    """
    spark, data = stream.sparkSession, f"{folder}/data"
    # So that there is a table to read even when no batch brings a row.
    table_sink(data)(spark.createDataFrame([], stream.schema), -1)
    sinks = [table_sink(data)]
    if stop_after is not None:
        sinks.append(partial(_stop, stop_after))
    publish_to_all(stream, f"{folder}/checkpoint", sinks, mode="update").awaitTermination()
    return newest_rows(spark, data, stream.schema, keys)


def _stop(after: int, batch: DataFrame, batch_id: int) -> None:
    if batch_id == after:
        raise RuntimeError(f"stopped before batch {batch_id} was committed")


def newest_rows(spark: SparkSession, path: str, schema: T.StructType,
                keys: Sequence[str]) -> DataFrame:
    """The current row of each key of a table written batch by batch."""
    columns = [f.name for f in schema.fields]
    stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(stored).parquet(path)
    return latest(rows, list(keys), ["batch_id"]).select(*columns)


class BatchTable:
    """A table written by ``foreachBatch``, one folder per batch number."""

    def __init__(self, path: str, schema: str) -> None:
        self.path = path
        self.schema = schema

    def write(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Write a batch's rows, replacing those of an earlier attempt, and read them back."""
        columns = [part.split()[0] for part in self.schema.split(", ")]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        return self._batch(rows.sparkSession, batch_id)

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows of the batch before; none at the start."""
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return self._batch(spark, batch_id - 1)

    def read(self, spark: SparkSession) -> DataFrame:
        """All batches, with their numbers."""
        return spark.read.schema(f"{self.schema}, batch_id bigint").parquet(self.path)

    def _batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id}")
