"""Training on a stream: a step per micro-batch, or row by row with a model per entity."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidalfed import settings as S
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.operators.sequential import REPORT, Learner
from tidalfed.operators.sizing import sized_broadcast
from tidalfed.operators.training import evaluate, sgd_step
from tidalfed.session import settled
from tidalfed.sources.topics import table_sink
from tidalfed.streaming.rounds import MODEL as GLOBAL_MODEL
from tidalfed.streaming.state import ChangeTable, committed

NODE = ("model_id string, node_id int, weights array<double>, bias double, n_samples bigint, "
        "loss double, accuracy double, batch bigint, adopted int, waiting boolean")


class BatchTraining:
    """One step per node and micro-batch, then a round, then the next batch starts from it.

    Used as a ``foreachBatch`` function. The model table is the way back to the nodes: a
    node adopts each global model once (``adopted`` is its round) and goes on from its own
    until a newer one comes. Its newest update is ``waiting`` until a round takes it, which
    needs ``min_nodes`` of them, from whatever batches. ``n_samples`` counts a node's
    rows since its start and is not reset by a global model. A batch writes only the nodes
    and models it changed.
    """

    def __init__(self, folder: str, features: Sequence[Column], rate: float = S.LEARNING_RATE,
                 min_nodes: int = S.NODES_PER_ROUND) -> None:
        self.models = ChangeTable(f"{folder}/models", GLOBAL_MODEL, ["model_id"])
        self.nodes = ChangeTable(f"{folder}/nodes", NODE, ["model_id", "node_id"])
        self.features = list(features)
        self.rate = rate
        self.min_nodes = min_nodes

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = self.nodes.before(spark, batch_id)
        newest = self.models.before(spark, batch_id)
        if batch.isEmpty():
            return
        batch.persist()  # read by the start models, the step and the evaluation
        try:
            self._train(batch, batch_id, known, newest)
        finally:
            batch.unpersist()

    def _train(self, batch: DataFrame, batch_id: int, known: DataFrame,
               newest: DataFrame) -> None:
        keys = ["model_id", "node_id"]
        step = {"key": "node_id", "on": keys, "features": self.features}
        start = settled(self._start(batch, known, newest))
        stepped = settled(sgd_step(batch, start, rate=self.rate, **step))
        scores = evaluate(batch, stepped, **step).select(*keys, "loss", "accuracy")
        trained = settled(stepped.join(scores, keys)
                          .join(start.select(*keys, "_before", "adopted"), keys)
                          .withColumn("n_samples", F.col("n_samples") + F.col("_before"))
                          .withColumn("batch", F.lit(batch_id))
                          .withColumn("waiting", F.lit(True)).drop("_before"))
        idle = known.join(trained.select(*keys), keys, "left_anti").filter("waiting")
        waiting = settled(trained.unionByName(idle))

        done = newest.select("model_id", "round")
        models = settled(fedavg_vector(waiting, ["model_id"])
                         .filter(F.col("updates") >= self.min_nodes)
                         .join(done, "model_id", "left")
                         .withColumn("round", F.coalesce("round", F.lit(0)) + 1))
        closed = models.select("model_id", F.lit(True).alias("_closed"))
        # Changed are the nodes of this batch and those whose update a round has taken.
        left = waiting.join(closed, "model_id", "left").withColumn(
            "waiting", F.col("_closed").isNull())
        self.nodes.change(left.filter((F.col("batch") == batch_id) | ~F.col("waiting")), batch_id)
        self.models.change(models, batch_id)

    def _start(self, batch: DataFrame, known: DataFrame, newest: DataFrame) -> DataFrame:
        """The model each node of the batch starts from.

        That is a global model newer than the one it last adopted, else its own, else zero.
        """
        keys = ["model_id", "node_id"]
        zero = F.array_repeat(F.lit(0.0), len(self.features))
        models = newest.select("model_id", F.col("round").alias("_round"),
                               F.col("weights").alias("_gw"), F.col("bias").alias("_gb"))
        adopted = F.coalesce("adopted", F.lit(0))
        newer = F.col("_round") > adopted
        return (batch.select(*keys).distinct().join(known, keys, "left")
                .join(models, "model_id", "left")
                .select(*keys,
                        F.when(newer, F.col("_gw")).otherwise(F.coalesce("weights", zero))
                        .alias("weights"),
                        F.when(newer, F.col("_gb")).otherwise(F.coalesce("bias", F.lit(0.0)))
                        .alias("bias"),
                        F.when(newer, F.col("_round")).otherwise(adopted).alias("adopted"),
                        F.coalesce("n_samples", F.lit(0)).alias("_before")))


def start_training(readings: DataFrame, job: BatchTraining, folder: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Start training on a stream, by default every five seconds."""
    return (readings.writeStream.foreachBatch(job)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(**(trigger or {"processingTime": S.TRAIN_INTERVAL})).start())


def train_by_batch(readings: DataFrame, folder: str, features: Sequence[Column],
                   rate: float = S.LEARNING_RATE,
                   min_nodes: int = S.NODES_PER_ROUND) -> tuple[DataFrame, DataFrame]:
    """Work through the available readings; gives the models and the nodes at each batch."""
    job = BatchTraining(folder, features, rate, min_nodes)
    start_training(readings, job, folder, {"availableNow": True}).awaitTermination()
    spark = readings.sparkSession
    return job.models.changes(spark), job.nodes.changes(spark)


UPDATE = f"edge_id string, lane int, {REPORT}"
ENTITY = ("edge_id string, lane int, weights array<double>, bias double, round int, "
          "initialized boolean, total_samples bigint, anomalies_detected bigint, "
          "x array<double>, y array<int>")
KEYS = ["edge_id", "lane"]
STATE, MODEL, READING = 0, 1, 2


class EntityTraining:
    """Row-by-row training of every entity, trigger by trigger; a ``foreachBatch`` function.

    Trains whenever ``every`` further readings have come and adopts global models as they
    come. Triggers count in the order they arrive, as from a topic. The rows of one trigger are
    put in order by Spark, by entity, time and id, whatever files they came in, each entity's
    kept model before them; a task goes through them one Arrow batch after another and holds
    one learner, with at most ``buffer_rows`` waiting readings, however many rows an entity
    has. With ``lanes`` above 1 an entity trains that many models side by side, chosen by a
    hash of the reading, so that a hot entity is not one task's work.

    Updates go to ``folder/updates``. With ``publish_seconds``, a trigger that brings ticks
    (``ticks`` of :func:`start_entities`) publishes the models not published for that long.
    """

    def __init__(self, folder: str, features: int, *, every: int = S.TRAIN_EVERY,
                 buffer_rows: int = S.BUFFER_ROWS, rate: float = S.LEARNING_RATE,
                 alpha: float = S.L2_ALPHA, publish_seconds: float | None = None) -> None:
        self.folder, self.features = folder, features
        self.options = {"every": every, "buffer_rows": buffer_rows, "rate": rate, "alpha": alpha}
        self.entities = ChangeTable(f"{folder}/entities", ENTITY, KEYS)
        self.publish_seconds = publish_seconds
        self.published = ChangeTable(f"{folder}/published",
                                     "edge_id string, lane int, at timestamp", KEYS)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        came = batch.filter("edge_id IS NOT NULL")
        known = self.entities.before(spark, batch_id)
        touched = known.join(came.select(*KEYS).distinct(), KEYS, "left_semi")
        states = touched.select(
            *KEYS, F.lit(STATE).alias("kind"), F.lit(None).cast("timestamp").alias("event_time"),
            F.lit(-1).cast("bigint").alias("event_id"), "x", F.lit(0).alias("label"), "weights",
            "bias", "y", "round", "initialized", "total_samples", "anomalies_detected")
        lines = came.unionByName(states, allowMissingColumns=True)
        order = [F.col(c).asc_nulls_first() for c in (*KEYS, "event_time", "kind", "event_id")]
        out = settled(lines.repartition(*KEYS).sortWithinPartitions(*order).mapInPandas(
            self._learn, f"{ENTITY}, n_samples bigint, accuracy double"))
        updates = out.filter("n_samples IS NOT NULL")
        table_sink(f"{self.folder}/updates")(updates.select(*self._report()), batch_id)
        self.entities.change(out.filter("n_samples IS NULL"), batch_id)
        if self.publish_seconds is not None:
            self._publish(batch.filter("edge_id IS NULL"), batch_id)

    @staticmethod
    def _report() -> list[str]:
        return [part.split()[0] for part in UPDATE.split(", ")]

    def _publish(self, ticks: DataFrame, batch_id: int) -> None:
        """Report the trained models whose last report is long enough ago at the newest tick."""
        spark = ticks.sparkSession
        now = ticks.agg(F.max("event_time")).first()[0]
        before = self.published.before(spark, batch_id)
        nothing = before.filter(F.lit(False))
        if now is None:
            self.published.change(nothing, batch_id)
            return
        due = F.col("at").isNull() | (F.lit(now) >= F.col("at") + F.make_dt_interval(
            secs=F.lit(float(self.publish_seconds))))
        models = settled(self.entities.at(spark, batch_id).filter("initialized").join(
            before, KEYS, "left").filter(due).withColumns({
                "n_samples": F.col("total_samples"), "accuracy": F.lit(None).cast("double"),
                "at": F.lit(now)}))
        table_sink(f"{self.folder}/reports")(models.select(*self._report(), "at"), batch_id)
        self.published.change(models, batch_id)

    def _learn(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by entity, the kept state first; an entity may go on in the next frame."""
        current, learner = None, None
        for frame in frames:
            out = []
            change = (frame[KEYS] != frame[KEYS].shift()).any(axis=1)
            runs = (change | (frame["kind"] != READING)
                    | (frame["kind"].shift() != READING)).cumsum().to_numpy()
            for _, run in frame.groupby(runs, sort=False):
                key = tuple(run[KEYS].iloc[0])
                if key != current:
                    if current is not None:
                        out.append(self._state(current, learner))
                    current, learner = key, Learner(np.zeros(self.features))
                kind = run["kind"].iloc[0]
                if kind == STATE:
                    learner = self._restored(run.iloc[0])
                elif kind == MODEL:
                    learner.adopt(run["weights"].iloc[0], run["bias"].iloc[0])
                else:
                    x = np.stack(run["x"].to_numpy()).astype(float)
                    for report in learner.feed(x, run["label"].to_numpy(dtype=int),
                                               **self.options):
                        out.append({**dict(zip(KEYS, key)), **report})
            if out:
                yield self._frame(out)
        if current is not None:
            yield self._frame([self._state(current, learner)])

    def _restored(self, row) -> Learner:
        x = np.asarray(row["x"], dtype=float).reshape(-1, self.features)
        return Learner(np.asarray(row["weights"], dtype=float), float(row["bias"]),
                       int(row["round"]), bool(row["initialized"]), int(row["total_samples"]),
                       int(row["anomalies_detected"]), x, np.asarray(row["y"], dtype=int))

    @staticmethod
    def _state(key: tuple, learner: Learner) -> dict:
        return {**dict(zip(KEYS, key)), "weights": learner.weights.tolist(),
                "bias": learner.bias, "round": learner.round,
                "initialized": learner.initialized, "total_samples": learner.total_samples,
                "anomalies_detected": learner.anomalies, "x": learner.x.ravel().tolist(),
                "y": learner.y.tolist()}

    @staticmethod
    def _frame(rows: list[dict]) -> pd.DataFrame:
        names = [part.split()[0] for part in ENTITY.split(", ")] + ["n_samples", "accuracy"]
        frame = pd.DataFrame(rows, columns=names).astype(object)
        return frame.where(frame.notna(), None)


def entity_lines(readings: DataFrame, features: Sequence[Column], *,
                 models: DataFrame | None = None, entities: DataFrame | None = None,
                 lanes: int = 1) -> DataFrame:
    """Readings, and global models sent to every lane of the entities that follow them.

    ``models`` has ``model_id, event_time, weights, bias``, ``entities`` ``model_id, edge_id``.
    Readings that lack a feature are left out.
    """
    lane = (F.pmod(F.xxhash64("event_id"), F.lit(lanes)).cast("int") if lanes > 1
            else F.lit(0))
    lines = readings.select(
        "edge_id", lane.alias("lane"), F.lit(READING).alias("kind"), "event_time", "event_id",
        F.array(*features).alias("x"), F.coalesce("label", F.lit(0)).alias("label"),
        F.lit(None).cast("array<double>").alias("weights"),
        F.lit(None).cast("double").alias("bias"),
    ).filter(~F.exists("x", lambda v: v.isNull()) & F.col("edge_id").isNotNull())
    if models is None:
        return lines
    members = entities.select("model_id", "edge_id", F.explode(
        F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    sent = models.join(sized_broadcast(members, computed=True), "model_id").select(
        "edge_id", "lane", F.lit(MODEL).alias("kind"), "event_time",
        F.lit(-1).cast("bigint").alias("event_id"),
        F.lit(None).cast("array<double>").alias("x"), F.lit(0).alias("label"),
        "weights", "bias")
    return lines.unionByName(sent)


def start_entities(lines: DataFrame, job: EntityTraining, ticks: DataFrame | None = None,
                   trigger: dict | None = None) -> StreamingQuery:
    """Start training on a stream of :func:`entity_lines`.

    ``ticks`` is a stream of times (``event_time``), such as Spark's rate source: it makes
    triggers come, and so models be published, when no reading does.
    """
    if ticks is not None:
        lines = lines.unionByName(ticks.select("event_time"), allowMissingColumns=True)
    return (lines.writeStream.foreachBatch(job)
            .option("checkpointLocation", f"{job.folder}/checkpoint")
            .trigger(**(trigger or {"processingTime": S.TRAIN_INTERVAL})).start())


def train_by_entity(readings: DataFrame, folder: str, features: Sequence[Column], *,
                    models: DataFrame | None = None, entities: DataFrame | None = None,
                    lanes: int = 1, **options) -> DataFrame:
    """Work through the available readings; gives an update per trained batch of an entity."""
    job = EntityTraining(folder, len(features), **options)
    lines = entity_lines(readings, features, models=models, entities=entities, lanes=lanes)
    start_entities(lines, job, trigger={"availableNow": True}).awaitTermination()
    return readings.sparkSession.read.schema(UPDATE).parquet(f"{folder}/updates")


def publish_until(lines: DataFrame, job: EntityTraining, ticks: DataFrame,
                  done: Callable[[DataFrame], bool], limit_seconds: float = 300) -> DataFrame:
    """Train and publish by the clock until ``done`` says so of the reports so far.

    Triggers follow one another without a pause, as ticks never end by themselves.
    """
    spark, schema = lines.sparkSession, f"{UPDATE}, at timestamp"
    path, end = f"{job.folder}/reports", time.monotonic() + limit_seconds
    query = start_entities(lines, job, ticks, {"processingTime": "0 seconds"})
    try:
        while query.isActive and time.monotonic() < end:
            if query.lastProgress and committed(spark, f"{path}/batch_id={batch_of(query)}"):
                reports = spark.read.schema(schema).parquet(path)
                if done(reports):
                    return reports
            time.sleep(0.5)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()
    raise TimeoutError(f"not done after {limit_seconds} seconds")


def batch_of(query: StreamingQuery) -> int:
    """The number of the newest finished trigger."""
    return query.lastProgress["batchId"]
