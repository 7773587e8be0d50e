"""The log of aggregation rounds, one JSON line per round."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidalfed.schemas import ROUND_LOG


def append_rounds(rounds: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Append rounds to the log. With a batch number a repeated batch replaces itself."""
    if batch_id is None:
        rounds.write.mode("append").json(path)
    else:
        rounds.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")


def read_rounds(spark: SparkSession, path: str, schema: str = ROUND_LOG) -> DataFrame:
    """Rounds of the log; lines that cannot be read are skipped."""
    return (spark.read.schema(schema).option("mode", "DROPMALFORMED")
            .option("recursiveFileLookup", "true").json(path))
