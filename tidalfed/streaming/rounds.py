"""Rounds over a stream of updates: by window, by trigger, by participants or time-out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidalfed import settings as S
from tidalfed.functions.features import iso_text
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.operators.joins import latest
from tidalfed.operators.rollup import windowed
from tidalfed.operators.rounds import participants, round_log
from tidalfed.operators.roundscan import rounds_scan
from tidalfed.session import settled
from tidalfed.sources.roundlog import append_rounds
from tidalfed.streaming.run import BatchTable
from tidalfed.streaming.state import ChangeTable

MODEL = ("round int, model_id string, weights array<double>, bias double, "
         "weighted_loss double, total_samples bigint, updates bigint")
PENDING = ("model_id string, node_id bigint, weights array<double>, bias double, loss double, "
           "n_samples bigint, event_time timestamp")


def rounds_by_window(updates: DataFrame, duration: str = S.WINDOW,
                     watermark: str = S.WATERMARK) -> DataFrame:
    """One round per event-time window and model, closed by the watermark.

    The state holds one sum per window, model and vector position, never the updates.
    """
    timed = windowed(updates.withWatermark("event_time", watermark), duration)
    averaged = fedavg_vector(timed, ["window", "model_id"])
    return averaged.select(
        "model_id", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "weights", "bias", "weighted_loss", "total_samples", "updates")


class TriggerRounds:
    """A round per non-empty trigger, once enough nodes have reported.

    Used as a ``foreachBatch`` function. The newest update of each node counts. While a
    model has fewer than ``min_nodes`` nodes its updates wait in the pending table; they
    leave it when their round is published. A batch writes the updates and counters it changed
    (see :class:`ChangeTable`), and a repeated batch replaces its own output. Rows stay on the
    executors.
    """

    def __init__(self, folder: str, min_nodes: int = S.NODES_PER_ROUND) -> None:
        self.models = BatchTable(f"{folder}/models", MODEL)
        self.counts = ChangeTable(f"{folder}/counts", "model_id string, round int", ["model_id"])
        self.pending = ChangeTable(f"{folder}/pending", PENDING, ["model_id", "node_id"])
        self.log = f"{folder}/log"
        self.min_nodes = min_nodes

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        waiting = self.pending.before(spark, batch_id)
        counts = self.counts.before(spark, batch_id)
        if batch.isEmpty():
            return
        arrived = batch.select(*waiting.columns).unionByName(waiting)
        seen = settled(latest(arrived, ["model_id", "node_id"], ["event_time"]))
        ready = seen.groupBy("model_id").agg(F.count(F.lit(1)).alias("_nodes")).filter(
            F.col("_nodes") >= self.min_nodes)
        averaged = fedavg_vector(seen.join(ready, "model_id", "left_semi"), ["model_id"])
        models = averaged.join(counts, "model_id", "left").withColumn(
            "round", F.coalesce("round", F.lit(0)) + 1)
        published = self.models.write(models, batch_id)
        done = published.select("model_id", "round")
        came = batch.select("model_id", "node_id").distinct()
        self.pending.change(
            seen.join(came, ["model_id", "node_id"], "left_semi").join(
                done, "model_id", "left_anti"), batch_id,
            gone=waiting.join(done, "model_id", "left_semi"))
        self.counts.change(done, batch_id)
        members = participants(seen.select("model_id", F.col("node_id").cast("string")),
                               ["model_id"], "node_id")
        entries = published.join(members, "model_id").select(
            "round", iso_text(F.current_timestamp()).alias("timestamp"), "weighted_loss",
            "total_samples", F.col("participants").alias("participating_nodes"),
            "weights", "page")
        append_rounds(round_log(entries), self.log, batch_id)


def start_rounds(updates: DataFrame, folder: str, min_nodes: int = S.NODES_PER_ROUND,
                 trigger: dict | None = None) -> StreamingQuery:
    """Start publishing rounds, by default one every round interval."""
    return (updates.writeStream.foreachBatch(TriggerRounds(folder, min_nodes))
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(**(trigger or {"processingTime": S.ROUND_INTERVAL})).start())


def rounds_by_trigger(updates: DataFrame, folder: str,
                      min_nodes: int = S.NODES_PER_ROUND) -> DataFrame:
    """Work through the available updates and return the table of published models."""
    start_rounds(updates, folder, min_nodes, {"availableNow": True}).awaitTermination()
    return TriggerRounds(folder, min_nodes).models.read(updates.sparkSession)


ROUND = ("model_id string, round int, reason string, weights array<double>, bias double, "
         "total_samples bigint, updates bigint, participants int, anomalies bigint")


REGIONAL = ("model_id string, region string, event_time timestamp, weights array<double>, "
            "bias double, total_samples bigint, updates bigint, anomalies bigint")


class ParticipantRounds:
    """Rounds closed by enough regions or by their time running out; for ``foreachBatch``.

    Messages are held until the watermark, ``delay_seconds`` behind the newest one, has passed
    them and are then gone through in order of time and region, so files and triggers do not
    change the rounds. A round still open when all older messages are in is closed by the
    watermark itself. The rounds of a trigger come from :func:`rounds_scan`; kept between
    triggers are the held messages and those of open rounds. A message older than the
    watermark joins the round that is open when it comes.
    """

    def __init__(self, folder: str, regions: int = S.REGIONS_PER_ROUND,
                 timeout_seconds: float = S.ROUND_TIMEOUT_SECONDS,
                 delay_seconds: float = S.ROUND_DELAY_SECONDS, **scan) -> None:
        self.folder, self.regions, self.timeout = folder, regions, timeout_seconds
        self.delay, self.scan = delay_seconds, scan
        self.waiting = BatchTable(f"{folder}/waiting", REGIONAL)
        self.rounds = BatchTable(f"{folder}/rounds", ROUND)
        self.counts = ChangeTable(f"{folder}/counts", "model_id string, round int", ["model_id"])
        self.marks = ChangeTable(f"{folder}/marks", "name string, mark timestamp", ["name"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        came = batch.filter("total_samples > 0").select(*_columns(REGIONAL))
        moved = came.select(F.lit("mark").alias("name"), (
            F.col("event_time") - F.make_dt_interval(secs=F.lit(float(self.delay)))).alias("mark"))
        self.marks.change(moved.unionByName(self.marks.before(spark, batch_id)).groupBy(
            "name").agg(F.max("mark").alias("mark")), batch_id)
        newest = self.marks.at(spark, batch_id).select(F.col("mark").cast("string")).first()
        mark = F.lit(newest[0] if newest else None).cast("timestamp")
        arrived = settled(came.unionByName(self.waiting.before(spark, batch_id)))
        scanned = settled(rounds_scan(
            arrived.filter(F.col("event_time") <= mark), minimum=self.regions,
            timeout_seconds=self.timeout, clock=mark, **self.scan))
        counts = self.counts.before(spark, batch_id).withColumnRenamed("round", "_done")
        closed = scanned.filter("reason IS NOT NULL").join(counts, "model_id", "left").withColumn(
            "round", F.col("round") + F.coalesce("_done", F.lit(0)))
        keys = ["model_id", "round", "reason"]
        models = fedavg_vector(closed, keys, loss=None, samples="total_samples").drop("updates")
        sums = closed.groupBy(*keys).agg(
            F.sum("updates").alias("updates"), F.sum("anomalies").alias("anomalies"),
            F.count_distinct("region").cast("int").alias("participants"))
        published = self.rounds.write(models.join(sums, keys), batch_id)
        self.counts.change(published.groupBy("model_id").agg(
            (F.max("round") + 1).alias("round")), batch_id)
        later = arrived.filter((F.col("event_time") > mark) | mark.isNull())
        self.waiting.write(scanned.filter("reason IS NULL").select(*arrived.columns).unionByName(
            later), batch_id)


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def rounds_by_participants(regional: DataFrame, folder: str,
                           regions: int = S.REGIONS_PER_ROUND,
                           timeout_seconds: float = S.ROUND_TIMEOUT_SECONDS,
                           **options) -> DataFrame:
    """Work through a stream of regional models, the output of the regional roll-up; rounds."""
    job = ParticipantRounds(folder, regions, timeout_seconds, **options)
    (regional.writeStream.foreachBatch(job).option("checkpointLocation", f"{folder}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return job.rounds.read(regional.sparkSession)
