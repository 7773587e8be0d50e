"""Slices replayed from several files each, and messages fed and parsed once."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tidalfed.sources.replay import SLICES, replayed


def triggers(stream, folder):
    """The ids that came with each trigger."""
    came = {}

    def take(batch, number):
        came[number] = sorted(r["id"] for r in batch.collect())

    stream.writeStream.foreachBatch(take).option("checkpointLocation", folder).trigger(
        availableNow=True).start().awaitTermination()
    return [came[n] for n in sorted(came)]


@pytest.mark.parametrize("rows", [0, 3, 1000])
def test_a_slice_of_many_files_is_one_trigger(spark, rows):
    run = tempfile.mkdtemp()
    table = spark.range(rows).select("id", F.timestamp_seconds(F.col("id") * 60).alias("at"))
    got = triggers(replayed(table, f"{run}/in", "at", file_rows=30, late=F.col("id") % 7 == 5),
                   f"{run}/checkpoint")
    want = [[] for _ in range(SLICES)]
    for i in range(rows):
        own = min(SLICES - 1, i * SLICES // max(1, rows - 1))
        want[min(SLICES - 1, own + 2 * (i % 7 == 5))].append(i)
    assert got == want


def test_no_task_writes_a_whole_slice(spark):
    run = tempfile.mkdtemp()
    table = spark.range(1000).select("id", F.timestamp_seconds(F.col("id") * 60).alias("at"))
    replayed(table, f"{run}/in", "at", file_rows=30)
    files = spark.read.parquet(f"{run}/in").filter("NOT _mark").groupBy(
        F.input_file_name()).count().agg(F.max("count"), F.count("*")).first()
    assert files[0] <= 60 and files[1] > SLICES
