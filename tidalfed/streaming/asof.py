"""The model in force at a reading's time, on two streams that come out of order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidalfed.operators.joins import with_model_in_force
from tidalfed.sources.topics import publish_to_all, table_sink
from tidalfed.streaming.state import ChangeTable

#: After every time there can be.
END = "9999-12-31 00:00:00"


class ModelsInForce:
    """A ``foreachBatch`` function that holds readings until their model must have come.

    Models may come ``delay_seconds`` later than newer ones, not more. Once the newest one
    seen is that much beyond a reading's time, no older model can still come and the reading
    is released with the last model published up to its time; one that itself comes late is
    released at once. Arrivals are appended as they come, never rewritten: a batch reads of
    the earlier ones the stretch of time by which the mark has moved. The join is the batch
    one, so a key of any size is cut into segments.
    """

    def __init__(self, folder: str, delay_seconds: float, model: Sequence[str] = (
            "weights", "bias"), key: str = "edge_id") -> None:
        self.folder, self.delay, self.model, self.key = folder, delay_seconds, list(model), key
        self.marks = ChangeTable(f"{folder}/marks", "name string, mark timestamp", ["name"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        readings = batch.filter("reading IS NOT NULL").select("reading.*")
        models = batch.filter("model IS NOT NULL").select("model.*")
        table_sink(f"{self.folder}/readings")(readings, batch_id)
        table_sink(f"{self.folder}/models")(models, batch_id)
        before = self.marks.before(batch.sparkSession, batch_id)
        moved = models.select(F.lit("models").alias("name"), (
            F.col("published_at") - F.make_dt_interval(secs=F.lit(self.delay))).alias("mark"))
        self.marks.change(moved.unionByName(before).groupBy("name").agg(
            F.max("mark").alias("mark")), batch_id)
        self._release(batch.sparkSession, batch_id, self._mark(batch.sparkSession, batch_id))

    def finish(self, spark: SparkSession) -> DataFrame:
        """Release what is still held, as no more models will come; all released readings."""
        last = self.marks.changes(spark, gone=True).agg(F.max("batch_id")).first()[0]
        if last is not None:
            self._release(spark, last + 1, END)
        return spark.read.parquet(f"{self.folder}/data").drop("batch_id")

    def _mark(self, spark: SparkSession, batch_id: int) -> str | None:
        row = self.marks.at(spark, batch_id).select(F.col("mark").cast("string")).first()
        return row[0] if row else None

    def _release(self, spark: SparkSession, batch_id: int, mark: str | None) -> None:
        before = self._mark(spark, batch_id - 1)
        arrived = spark.read.parquet(f"{self.folder}/readings")
        time, now = F.col("event_time"), F.lit(mark).cast("timestamp")
        done = F.lit(before).cast("timestamp")
        held = (F.col("batch_id") < batch_id) & (F.lit(before is None) | (time > done))
        free = arrived.filter(F.col("batch_id") <= batch_id).filter(
            (time <= now) & (held | (F.col("batch_id") == batch_id))).drop("batch_id")
        models = spark.read.parquet(f"{self.folder}/models").filter(
            F.col("batch_id") <= batch_id)
        table_sink(f"{self.folder}/data")(with_model_in_force(
            free, models, key=self.key, model=self.model), batch_id)


def start_in_force(readings: DataFrame, models: DataFrame, job: ModelsInForce,
                   trigger: dict | None = None) -> StreamingQuery:
    """Start the join. ``models`` needs the key, ``published_at`` and the model's columns."""
    left, right = F.struct(*readings.columns), F.struct(job.key, "published_at", *job.model)
    reading, model = (frame.select(value.alias("v")).schema["v"].dataType
                      for frame, value in ((readings, left), (models, right)))
    line = readings.select(left.alias("reading"), F.lit(None).cast(model).alias("model")).union(
        models.select(F.lit(None).cast(reading).alias("reading"), right.alias("model")))
    return publish_to_all(line, f"{job.folder}/checkpoint", [job], trigger=trigger)


def in_force(readings: DataFrame, models: DataFrame, job: ModelsInForce) -> DataFrame:
    """Work through both streams, then release everything."""
    start_in_force(readings, models, job).awaitTermination()
    return job.finish(readings.sparkSession)
