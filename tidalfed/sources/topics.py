"""Keyed JSON topics: read, decode, route, encode, write.

The broker format is a parameter. ``kafka`` needs Spark's own connector on the classpath;
any file format holding the same columns (``key, value, topic, timestamp``) replays a
recorded topic through the same functions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

MESSAGE = "key string, value string, topic string, timestamp timestamp"


def subscribe(spark: SparkSession, topics: Sequence[str] = (), *, format: str = "kafka",
              path: str | None = None, pattern: str | None = None, start: str = "latest",
              options: dict[str, str] | None = None) -> DataFrame:
    """Stream the messages of one or more topics as ``key, value, topic, timestamp``.

    ``start`` is ``latest`` or ``earliest`` and, like ``pattern``, applies to a broker; a
    recorded topic is always read from its beginning.
    """
    reader = spark.readStream.format(format).options(**(options or {}))
    if format == "kafka":
        names = {"subscribePattern": pattern} if pattern else {"subscribe": ",".join(topics)}
        messages = reader.options(**names).option("startingOffsets", start).load()
        return messages.select(F.col("key").cast("string"), F.col("value").cast("string"),
                               "topic", "timestamp")
    messages = reader.schema(MESSAGE).load(path)
    if pattern:
        return messages.filter(F.col("topic").rlike(f"^(?:{pattern})$"))
    return messages.filter(F.col("topic").isin(list(topics))) if topics else messages


def table_stream(spark: SparkSession, folder: str, table: str,
                 options: dict[str, str] | None = None) -> DataFrame:
    """Stream a Parquet table, a single file or a folder of files, as it stands."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    # A pattern, because a stream refuses a path that names one file.
    return (spark.readStream.schema(schema).options(**(options or {}))
            .parquet(f"{folder}/{table}.parquet*"))


def encode(rows: DataFrame, *, topic: str | Column, key: str | Column, time: str | Column,
           payload: Sequence[str] | None = None) -> DataFrame:
    """Messages whose value is the JSON text of each row; null fields are left out."""
    value = F.struct(*(payload or rows.columns))
    return rows.select(
        (F.col(key) if isinstance(key, str) else key).cast("string").alias("key"),
        F.to_json(value).alias("value"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        (F.col(time) if isinstance(time, str) else time).cast("timestamp").alias("timestamp"),
    )


def decode(messages: DataFrame, schema: str, event_time: str = "event_time") -> DataFrame:
    """Fields of the JSON value, with the record's time as event time.

    Text that is not JSON, and fields of another type, become nulls; see
    :func:`split_rejects`.
    """
    parsed = messages.select(F.from_json("value", schema).alias("data"), "timestamp")
    return parsed.select("data.*", F.col("timestamp").alias(event_time))


def parsed_once(messages: DataFrame, value: Column, name: str) -> DataFrame:
    """``messages`` with the parsed value beside them. A generator holds the parser: filters on
    its fields stay above it, where they would otherwise take a copy of it each."""
    return messages.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def checked(messages: DataFrame, schema: str, required: Sequence[str],
            not_empty: Sequence[str] = ()) -> DataFrame:
    """Messages with ``data``, the decoded fields, and ``_sound``: all required ones are there."""
    sound = F.lit(True)
    for name in required:
        sound = sound & F.col(f"data.{name}").isNotNull()
    for name in not_empty:
        sound = sound & (F.coalesce(F.size(f"data.{name}"), F.lit(0)) > 0)
    return parsed_once(messages, F.from_json("value", schema), "data").withColumn("_sound", sound)


def split_rejects(messages: DataFrame, schema: str, required: Sequence[str],
                  not_empty: Sequence[str] = (),
                  event_time: str = "event_time") -> tuple[DataFrame, DataFrame]:
    """Decoded rows that hold all required fields, and the messages that do not."""
    parsed = checked(messages, schema, required, not_empty)
    good = parsed.filter("_sound").select("data.*", F.col("timestamp").alias(event_time))
    return good, parsed.filter(~F.col("_sound")).drop("data", "_sound")


def has_fields(names: Sequence[str], parsed: str) -> Column:
    """Whether the parsed message holds all these fields: messages are told apart by shape."""
    found = F.lit(True)
    for name in names:
        found = found & F.try_variant_get(parsed, f"$.{name}", "string").isNotNull()
    return found


def with_kind(messages: DataFrame) -> DataFrame:
    """Messages with ``kind``: ``model``, ``metrics``, ``reading`` or ``other``; each text is
    parsed once."""
    kind = (
        F.when(has_fields(["global_weights"], "_parsed"), "model")
        .when(has_fields(["round", "participating_regions"], "_parsed"), "metrics")
        .when(has_fields(["edge_id", "label"], "_parsed"), "reading")
        .otherwise("other")
    )
    parsed = parsed_once(messages, F.try_parse_json("value"), "_parsed")
    return parsed.withColumn("kind", kind).drop("_parsed")


def publish(messages: DataFrame, checkpoint: str, *, format: str = "kafka",
            path: str | None = None, mode: str = "append", trigger: dict | None = None,
            options: dict[str, str] | None = None) -> StreamingQuery:
    """Start a query that writes messages to their topics, or to a recorded topic."""
    writer = (messages.writeStream.format(format).outputMode(mode)
              .option("checkpointLocation", checkpoint).options(**(options or {}))
              .trigger(**(trigger or {"availableNow": True})))
    return writer.option("path", path).start() if path else writer.start()


def publish_to_all(rows: DataFrame, checkpoint: str,
                   sinks: Sequence[Callable[[DataFrame, int], None]], *, mode: str = "append",
                   trigger: dict | None = None) -> StreamingQuery:
    """One query, several sinks: each batch is kept while all of them write it.

    The source is read and the state updated once, where one query per sink would do both
    for each. Sinks get the batch number and must write a repeated batch only once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return (rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start())


def table_sink(path: str, format: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch to its own folder, so that a repeat replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(format).save(f"{path}/batch_id={batch_id}")

    return write


def console_sink(rows: int = 20) -> Callable[[DataFrame, int], None]:
    """A sink that shows the head of each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.show(rows, truncate=False)

    return write
