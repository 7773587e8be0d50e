"""Jobs that talk by messages: edge, region, global and back.

A network is a set of topics and of checkpointed jobs. Each job reads what has come in its
topics since its last trigger, decodes it, works on it and publishes messages in the declared
wire formats; no job sees another's tables. Global models go back to the edges as messages,
which closes the cycle; it ends after a number of published rounds. A job's state is a
:class:`ChangeTable`, and a batch's messages are put once: a repeated batch leaves what an
earlier attempt has published.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.functions import features as X
from tidalfed.operators.fedavg import SHAPE_ERROR, fedavg_vector
from tidalfed.operators.joins import latest, region_dimension, with_region
from tidalfed.operators.monitor import anomaly_alerts
from tidalfed.operators.rollup import regional_pages
from tidalfed.operators.training import build_updates, evaluate, sgd_step
from tidalfed.schemas import (
    ALERT, EDGE_UPDATE, GLOBAL_METRICS, GLOBAL_MODEL_ELECTRIC, GLOBAL_MODEL_MACHINE, NODE_UPDATE,
    READING_ELECTRIC, READING_MACHINE, REGION_AGGREGATE)
from tidalfed.session import settled, written
from tidalfed.sources import topics
from tidalfed.streaming.state import ChangeTable, committed

NETWORK = "network"


class RecordedTopics:
    """Topics as folders of messages, one folder per published batch."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def stream(self, names: Sequence[str]) -> DataFrame:
        """What is published to any of these topics."""
        def one(name: str) -> DataFrame:
            self.put(self.spark.createDataFrame([], topics.MESSAGE), name, "start")
            return topics.subscribe(self.spark, [name], format="parquet", path=self.path(name),
                                    options={"recursiveFileLookup": "true"})

        return reduce(DataFrame.unionByName, map(one, names))

    def table(self, name: str, schema: str) -> DataFrame:
        """Everything published to a topic so far, decoded."""
        messages = self.spark.read.schema(topics.MESSAGE).option(
            "recursiveFileLookup", "true").parquet(self.path(name))
        return topics.decode(messages, schema)

    def put(self, messages: DataFrame, name: str, batch: str) -> None:
        """Publish a batch under its name; one that stands there already is left."""
        path = f"{self.path(name)}/{batch}"
        if not committed(self.spark, path):
            messages.write.mode("overwrite").parquet(path)


class BrokerTopics:
    """The same over a broker; a repeated batch is published again there."""

    def __init__(self, spark: SparkSession, options: dict[str, str]) -> None:
        self.spark, self.options = spark, options

    def stream(self, names: Sequence[str]) -> DataFrame:
        return topics.subscribe(self.spark, names, start="earliest", options=self.options)

    def put(self, messages: DataFrame, name: str, batch: str) -> None:
        messages.select("key", "value", "topic").write.format("kafka").options(
            **self.options).save()


class Job:
    """A ``foreachBatch`` function with its topics and the folder of its state."""

    name: str
    reads: tuple[str, ...]

    def __init__(self, channel: RecordedTopics | BrokerTopics, folder: str) -> None:
        self.channel, self.folder = channel, f"{folder}/{self.name}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # jobs read it once per topic and once for the evaluation
        try:
            self.work(batch, batch_id)
        finally:
            batch.unpersist()

    def work(self, batch: DataFrame, batch_id: int) -> None:
        raise NotImplementedError

    def state(self, name: str, schema: str, *keys: str) -> ChangeTable:
        return ChangeTable(f"{self.folder}/{name}", schema, keys)

    def publish(self, messages: DataFrame, topic: str, batch_id: int) -> None:
        self.channel.put(messages, topic, f"{self.name}-{batch_id}")

    def run(self) -> None:
        """Work through everything published since the last run."""
        (self.channel.stream(self.reads).writeStream.foreachBatch(self)
         .option("checkpointLocation", f"{self.folder}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())


def of_topic(batch: DataFrame, *names: str) -> DataFrame:
    return batch.filter(F.col("topic").isin(*names))


def train_nodes(readings: DataFrame, known: DataFrame, newest: DataFrame, *, key: str,
                features: Sequence[Column], rate: float = S.LEARNING_RATE) -> DataFrame:
    """One step of each node that has readings, evaluated on the same rows.

    A node starts from a global model newer than the one it last adopted, else from its own,
    else from zero. ``known`` has the nodes' own models, ``newest`` the newest global one of
    each ``model_id``. Gives the model, ``loss``, ``accuracy``, the ``n_samples`` of the batch
    and the ``adopted`` round.
    """
    keys = ["model_id", key]
    zero = F.array_repeat(F.lit(0.0), len(features))
    models = newest.select("model_id", F.col("round").alias("_round"),
                           F.col("weights").alias("_gw"), F.col("bias").alias("_gb"))
    adopted = F.coalesce("adopted", F.lit(-1))
    newer = F.col("_round") > adopted
    own = known.select(*keys, "weights", "bias", "adopted")
    start = settled(readings.select(*keys).distinct().join(own, keys, "left").join(
        models, "model_id", "left").select(
        *keys, F.when(newer, F.col("_gw")).otherwise(F.coalesce("weights", zero)).alias("weights"),
        F.when(newer, F.col("_gb")).otherwise(F.coalesce("bias", F.lit(0.0))).alias("bias"),
        F.when(newer, F.col("_round")).otherwise(adopted).alias("adopted")))
    step = {"key": key, "on": keys, "features": list(features)}
    stepped = settled(sgd_step(readings, start, rate=rate, **step))
    scores = evaluate(readings, stepped, **step).select(*keys, "loss", "accuracy")
    return stepped.join(scores, keys).join(start.select(*keys, "adopted"), keys)


class EdgeJob(Job):
    """Trains each entity's model on its readings and publishes an update of it."""

    name = "edge"
    reads = (S.TOPICS["sensor_data"], S.TOPICS["global_model"])
    EDGES = ("model_id string, edge_id string, region string, weights array<double>, bias double, "
             "adopted int, round int, total_samples bigint, anomalies_detected bigint")
    MODELS = "model_id string, round int, weights array<double>, bias double"

    def __init__(self, channel: RecordedTopics | BrokerTopics, folder: str,
                 rate: float = S.LEARNING_RATE) -> None:
        super().__init__(channel, folder)
        self.rate = rate
        self.edges = self.state("edges", self.EDGES, "model_id", "edge_id")
        self.models = self.state("models", self.MODELS, "model_id")

    def work(self, batch: DataFrame, batch_id: int) -> None:
        spark, model = batch.sparkSession, F.lit(NETWORK).alias("model_id")
        came, _ = topics.split_rejects(of_topic(batch, S.TOPICS["global_model"]),
                                       GLOBAL_MODEL_ELECTRIC, ["round"], ["global_weights.coef"])
        models = came.select(model, "round", F.flatten("global_weights.coef").alias("weights"),
                             F.col("global_weights.intercept")[0].alias("bias"))
        newest = settled(latest(models.unionByName(self.models.before(spark, batch_id)),
                                ["model_id"], ["round"]))
        self.models.change(newest, batch_id)
        good, _ = topics.split_rejects(of_topic(batch, S.TOPICS["sensor_data"]),
                                       READING_ELECTRIC, ["edge_id", "voltage", "current"])
        readings = written(with_region(good, region_dimension(spark)).withColumn(
            "model_id", model), "readings")  # messages are parsed once, not for each use
        known = self.edges.before(spark, batch_id)
        trained = train_nodes(readings, known, newest, key="edge_id",
                              features=X.zscore("voltage", "current"), rate=self.rate)
        keys = ["model_id", "edge_id"]
        seen = readings.groupBy(*keys).agg(
            F.first("region").alias("region"), F.max("event_time").alias("event_time"),
            F.count(F.lit(1)).alias("_rows"), F.count_if(F.col("label") == 1).alias("_anomalies"))
        before = known.select(*keys, F.col("round").alias("_last"),
                              F.col("total_samples").alias("_samples"),
                              F.col("anomalies_detected").alias("_found"))
        # The counters of an entity start at nothing, the first update is round 0.
        updated = settled(trained.join(seen, keys).join(before, keys, "left").withColumns({
            "round": F.coalesce(F.col("_last") + 1, F.lit(0)),
            "total_samples": F.coalesce("_samples", F.lit(0)) + F.col("_rows"),
            "anomalies_detected": F.coalesce("_found", F.lit(0)) + F.col("_anomalies")}))
        times = updated.select("edge_id", "event_time")
        rows = build_updates(updated).join(times, "edge_id").withColumn(
            "timestamp", X.iso_text("event_time"))
        fields = ["edge_id", "region", "round", "timestamp", "n_samples", "weights", "metrics"]
        self.publish(topics.encode(rows, topic=S.TOPICS["edge_weights"], key="edge_id",
                                   time="event_time", payload=fields),
                     S.TOPICS["edge_weights"], batch_id)
        self.edges.change(updated, batch_id)


class RegionJob(Job):
    """Rolls the updates of a trigger up by window and region, stamps and publishes them.

    A message covers its own updates only: where those of a window come over several
    triggers, or are more than a page, there are several messages, to be added up.
    """

    name = "region"
    reads = (S.TOPICS["edge_weights"],)

    def __init__(self, channel: RecordedTopics | BrokerTopics, folder: str,
                 duration: str = S.WINDOW, page_rows: int = S.LIST_ROWS) -> None:
        super().__init__(channel, folder)
        self.duration, self.page_rows = duration, page_rows

    def work(self, batch: DataFrame, batch_id: int) -> None:
        good, _ = topics.split_rejects(batch, EDGE_UPDATE, ["edge_id", "region", "n_samples"],
                                       ["weights.coef"])
        updates = good.withColumns({"accuracy": F.col("metrics.local_accuracy"),
                                    "anomalies": F.col("metrics.anomalies_detected")})
        rows = X.stamped(regional_pages(updates, self.duration, self.page_rows))
        fields = ["region", "window_start", "window_end", "contributing_edges", "all_weights",
                  "total_n_samples", "avg_accuracy", "total_anomalies", "fog_timestamp"]
        self.publish(topics.encode(rows, topic=S.TOPICS["fog_agg"], key="region",
                                   time="window_end", payload=fields),
                     S.TOPICS["fog_agg"], batch_id)


class GlobalJob(Job):
    """Averages regional messages into rounds, closed by enough regions or by time.

    Each model of a regional message counts ``total // models`` samples. What an open round
    has taken in is kept as sums per cell of the model and per region, never as messages. A
    round closes at the end of the trigger in which enough regions are in it, or in which its
    first and last window lie further apart than the time-out.
    """

    name = "global"
    reads = (S.TOPICS["fog_agg"],)
    CELL = ["part", "i", "j"]

    def __init__(self, channel: RecordedTopics | BrokerTopics, folder: str,
                 regions: int = S.REGIONS_PER_ROUND,
                 timeout_seconds: int = S.ROUND_TIMEOUT_SECONDS) -> None:
        super().__init__(channel, folder)
        self.regions, self.timeout = regions, timeout_seconds
        self.cells = self.state("cells", "part string, i int, j int, nw double, n bigint, "
                                         "updates bigint", *self.CELL)
        self.members = self.state(
            "members", "region string, samples bigint, updates bigint, anomalies bigint, "
                       "classes array<int>, first timestamp, last timestamp", "region")
        self.rounds = self.state("rounds", "model_id string, round int", "model_id")

    def work(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        good, _ = topics.split_rejects(batch, REGION_AGGREGATE, ["region"], ["all_weights"])
        shares = good.withColumn("_n", F.expr("total_n_samples div size(all_weights)"))
        members = settled(self._members(shares, self.members.before(spark, batch_id)))
        cells = settled(self._cells(shares, self.cells.before(spark, batch_id)))
        number = self.rounds.before(spark, batch_id)
        seen, first, last = members.agg(F.count(F.lit(1)), F.min("first"), F.max("last")).first()
        timed = seen and (last - first).total_seconds() > self.timeout
        nothing = cells.filter(F.lit(False))
        if seen < self.regions and not timed:
            self.cells.change(cells, batch_id)
            self.members.change(members, batch_id)
            self.rounds.change(number.filter(F.lit(False)), batch_id)
            self._publish(nothing, members, number, batch_id)
            return
        self._publish(cells, members, number, batch_id)
        self.cells.change(nothing, batch_id, gone=cells)
        self.members.change(members.filter(F.lit(False)), batch_id, gone=members)
        self.rounds.change(self._number(spark, number), batch_id)

    def _members(self, shares: DataFrame, before: DataFrame) -> DataFrame:
        new = shares.select(
            "region", (F.col("_n") * F.size("all_weights")).alias("samples"),
            F.size("all_weights").cast("bigint").alias("updates"),
            F.col("total_anomalies").alias("anomalies"),
            F.col("all_weights")[0]["classes"].alias("classes"),
            F.col("window_end").alias("first"), F.col("window_end").alias("last"))
        return new.unionByName(before).groupBy("region").agg(
            F.sum("samples").alias("samples"), F.sum("updates").alias("updates"),
            F.sum("anomalies").alias("anomalies"),
            F.min_by("classes", F.struct("first", "classes")).alias("classes"),
            F.min("first").alias("first"), F.max("last").alias("last"))

    def _cells(self, shares: DataFrame, before: DataFrame) -> DataFrame:
        models = shares.select("_n", F.explode("all_weights").alias("m"))
        matrix = models.select("_n", F.posexplode("m.coef").alias("i", "_row")).select(
            F.lit("coef").alias("part"), "i", "_n", F.posexplode("_row").alias("j", "_w"))
        offset = models.select("_n", F.posexplode("m.intercept").alias("j", "_w")).select(
            F.lit("intercept").alias("part"), F.lit(0).alias("i"), "_n", "j", "_w")
        new = matrix.unionByName(offset).select(
            *self.CELL, (F.col("_n") * F.col("_w")).alias("nw"), F.col("_n").alias("n"),
            F.lit(1).cast("bigint").alias("updates"))
        return new.unionByName(before).groupBy(*self.CELL).agg(
            F.sum("nw").alias("nw"), F.sum("n").alias("n"), F.sum("updates").alias("updates"))

    @staticmethod
    def _number(spark: SparkSession, before: DataFrame) -> DataFrame:
        """The round just closed: one after the last."""
        start = spark.createDataFrame([(NETWORK, -1)], "model_id string, round int")
        return start.unionByName(before).groupBy("model_id").agg(
            (F.max("round") + 1).alias("round"))

    def _publish(self, cells: DataFrame, members: DataFrame, number: DataFrame,
                 batch_id: int) -> None:
        """The model and the metrics of a closed round; nothing where there are no cells."""
        spark = cells.sparkSession
        line = F.array_sort(F.collect_list(F.struct("j", (F.col("nw") / F.col("n")).alias("w"))))
        lines = cells.filter("n > 0").groupBy("part", "i").agg(
            F.transform(line, lambda x: x["w"]).alias("line"), F.min("updates").alias("_least"),
            F.max("updates").alias("_most"))
        every = F.array_sort(F.collect_list(F.struct("part", "i", "line")))
        ragged = F.min("_least") != F.max("_most")
        one = F.lit(NETWORK).alias("model_id")
        model = lines.groupBy(one).agg(
            F.when(ragged, F.raise_error(F.lit(SHAPE_ERROR)).cast(
                "array<struct<part:string,i:int,line:array<double>>>"))
            .otherwise(every).alias("_lines")).filter(F.size("_lines") > 0)
        totals = members.groupBy(one).agg(
            F.sum("samples").alias("total_samples"), F.sum("updates").alias("num_updates"),
            F.sum("anomalies").alias("anomalies_detected"), F.max("last").alias("_time"),
            F.array_sort(F.collect_list("region")).alias("participating_regions"),
            F.min_by("classes", F.struct("first", "region")).alias("_classes"))
        of = lambda part: F.transform(
            F.filter("_lines", lambda x: x["part"] == part), lambda x: x["line"])
        named = model.join(totals, "model_id").join(self._number(spark, number), "model_id")
        rows = settled(named.select(
            "round", X.iso_text("_time").alias("timestamp"), F.struct(
                of("coef").alias("coef"), of("intercept")[0].alias("intercept"),
                F.col("_classes").alias("classes")).alias("global_weights"),
            "participating_regions", "total_samples", "num_updates", "anomalies_detected",
            "_time"))
        key = X.prefixed_key("round", "round")
        for topic, fields in (
                ("global_model", ["round", "timestamp", "global_weights", "participating_regions",
                                  "total_samples"]),
                ("global_metrics", ["round", "timestamp", "total_samples", "participating_regions",
                                    "num_updates", "anomalies_detected"])):
            self.publish(topics.encode(rows, topic=S.TOPICS[topic], key=key, time="_time",
                                       payload=fields), S.TOPICS[topic], batch_id)


class NodeJob(Job):
    """Trains each machine node's model and publishes it with its lifetime sample count."""

    name = "node"
    reads = (*S.MACHINE_TOPICS.values(), S.MACHINE_MODEL_TOPIC)
    NODES = ("model_id string, node_id int, weights array<double>, bias double, adopted int, "
             "num_samples bigint")

    def __init__(self, channel: RecordedTopics | BrokerTopics, folder: str,
                 rate: float = S.LEARNING_RATE) -> None:
        super().__init__(channel, folder)
        self.rate = rate
        self.nodes = self.state("nodes", self.NODES, "model_id", "node_id")
        self.models = self.state("models", EdgeJob.MODELS, "model_id")

    def work(self, batch: DataFrame, batch_id: int) -> None:
        spark, model = batch.sparkSession, F.lit(NETWORK).alias("model_id")
        came, _ = topics.split_rejects(of_topic(batch, S.MACHINE_MODEL_TOPIC),
                                       GLOBAL_MODEL_MACHINE, ["round"],
                                       ["aggregated_weights.weights"])
        newest = settled(latest(came.select(model, "round", "aggregated_weights.*").unionByName(
            self.models.before(spark, batch_id)), ["model_id"], ["round"]))
        self.models.change(newest, batch_id)
        good, _ = topics.split_rejects(of_topic(batch, *S.MACHINE_TOPICS.values()),
                                       READING_MACHINE, ["node_id", "features"])
        readings = written(good.select(model, "node_id", "label", "event_time", "features.*"),
                           "readings")  # messages are parsed once, not for each use
        known = self.nodes.before(spark, batch_id)
        trained = train_nodes(readings, known, newest, key="node_id", features=X.shift_scale(),
                              rate=self.rate)
        keys = ["model_id", "node_id"]
        times = readings.groupBy(*keys).agg(F.max("event_time").alias("event_time"))
        before = known.select(*keys, F.col("num_samples").alias("_before"))
        updated = settled(trained.join(times, keys).join(before, keys, "left").withColumn(
            "num_samples", F.coalesce("_before", F.lit(0)) + F.col("n_samples")))
        rows = updated.select(
            "node_id", X.iso_text("event_time").alias("timestamp"),
            F.struct("weights", "bias", "num_samples").alias("model_weights"), "loss",
            "event_time")
        self.publish(topics.encode(
            rows, topic=S.MACHINE_WEIGHTS_TOPIC, key=X.prefixed_key("fog_node", "node_id"),
            time="event_time", payload=["node_id", "timestamp", "model_weights", "loss"]),
            S.MACHINE_WEIGHTS_TOPIC, batch_id)
        self.nodes.change(updated, batch_id)


class AggregatorJob(Job):
    """A round per trigger in which enough nodes have an update waiting."""

    name = "aggregator"
    reads = (S.MACHINE_WEIGHTS_TOPIC,)
    WAITING = ("node_id int, weights array<double>, bias double, num_samples bigint, loss double, "
               "event_time timestamp")

    def __init__(self, channel: RecordedTopics | BrokerTopics, folder: str,
                 min_nodes: int = S.NODES_PER_ROUND) -> None:
        super().__init__(channel, folder)
        self.min_nodes = min_nodes
        self.waiting = self.state("waiting", self.WAITING, "node_id")
        self.rounds = self.state("rounds", "round int, weighted_loss double", "round")

    def work(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        good, _ = topics.split_rejects(batch, NODE_UPDATE, ["node_id"], ["model_weights.weights"])
        came = good.select("node_id", "model_weights.*", "loss", "event_time")
        seen = settled(latest(came.unionByName(self.waiting.before(spark, batch_id)),
                              ["node_id"], ["event_time", "num_samples"]))
        enough = seen.count() >= self.min_nodes
        ready = seen if enough else seen.filter(F.lit(False))
        model = F.lit(NETWORK).alias("model_id")
        past = self.rounds.before(spark, batch_id)
        history = past.groupBy(model).agg(F.transform(
            F.array_sort(F.collect_list(F.struct("round", "weighted_loss"))),
            lambda r: r["weighted_loss"]).alias("_past"), F.max("round").alias("_last"))
        nodes = ready.groupBy(model).agg(F.array_sort(F.collect_list("node_id")).alias("participating_nodes"),
                          F.max("event_time").alias("_time"))
        average = fedavg_vector(ready.withColumn("model_id", model), ["model_id"],
                                samples="num_samples")
        rows = settled(average.join(history, "model_id", "left").join(nodes, "model_id").select(
            F.coalesce(F.col("_last") + 1, F.lit(1)).alias("round"),
            F.struct("weights", "bias").alias("aggregated_weights"),
            F.concat(F.coalesce("_past", F.array().cast("array<double>")),
                     F.array("weighted_loss")).alias("loss_history"),
            X.iso_text("_time").alias("timestamp"), "participating_nodes",
            F.struct("weights", "bias", "total_samples", "weighted_loss")
            .alias("aggregation_info"), "weighted_loss", "_time"))
        fields = ["round", "aggregated_weights", "loss_history", "timestamp",
                  "participating_nodes", "aggregation_info"]
        self.publish(topics.encode(rows, topic=S.MACHINE_MODEL_TOPIC,
                                   key=F.lit(S.MACHINE_MODEL_KEY), time="_time", payload=fields),
                     S.MACHINE_MODEL_TOPIC, batch_id)
        self.rounds.change(rows, batch_id)
        self.waiting.change(seen.filter(F.lit(not enough)), batch_id,
                            gone=ready if enough else None)


def publish_alerts(channel: RecordedTopics, folder: str, duration: str = S.WINDOW,
                   watermark: str = S.WATERMARK, rate: float = S.ALERT_RATE) -> None:
    """Alert messages for the windows that the readings published so far have closed."""
    readings, _ = topics.split_rejects(channel.stream([S.TOPICS["sensor_data"]]),
                                       READING_ELECTRIC, ["edge_id"])
    alerts = anomaly_alerts(readings, duration, rate, watermark=watermark)
    messages = topics.encode(alerts, topic=S.TOPICS["alerts"], key="edge_id", time="window_end",
                             payload=["edge_id", "window_start", "window_end", "n_samples",
                                      "anomaly_rate", "severity"])
    topics.publish(messages, f"{folder}/alerts/checkpoint", format="parquet",
                   path=channel.path(S.TOPICS["alerts"])).awaitTermination()


def run_cycle(feed: Callable[[int], None], jobs: Sequence[Job], rounds: int) -> None:
    """Feed readings and run the jobs in turn, ``rounds`` times."""
    for number in range(rounds):
        feed(number)
        for job in jobs:
            job.run()


#: What can be read back from each topic.
FORMATS = {
    S.TOPICS["edge_weights"]: EDGE_UPDATE, S.TOPICS["fog_agg"]: REGION_AGGREGATE,
    S.TOPICS["global_model"]: GLOBAL_MODEL_ELECTRIC, S.TOPICS["global_metrics"]: GLOBAL_METRICS,
    S.TOPICS["alerts"]: ALERT, S.MACHINE_WEIGHTS_TOPIC: NODE_UPDATE,
    S.MACHINE_MODEL_TOPIC: GLOBAL_MODEL_MACHINE,
}
