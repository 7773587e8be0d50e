"""Scripted replays: late and bad rows, restarts, rounds, keyed models."""

import datetime as dt
import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidalfed.functions import features as X
from tidalfed.operators import rollup
from tidalfed.operators.fedavg import fedavg_vector
from tidalfed.operators.sequential import train_sequential
from tidalfed.schemas import EDGE_UPDATE
from tidalfed.sources import tables, topics
from tidalfed.sources.roundlog import read_rounds
from tidalfed.streaming.rollup import RollupTables, rolled_up
from tidalfed.streaming.rounds import (
    PENDING, rounds_by_participants, rounds_by_trigger, rounds_by_window)
from tidalfed.streaming.run import run_to_table, run_upserts
from tidalfed.streaming.scoring import start_scoring
from tidalfed.streaming.state import ChangeTable
from tidalfed.streaming.training import (
    EntityTraining, entity_lines, start_entities, train_by_batch, train_by_entity)

DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def add_file(spark, frame, folder, number):
    """One more file of a recorded topic; files are replayed in the order of their times."""
    frame.coalesce(1).write.mode("append").parquet(folder)
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        if name.endswith(".parquet") and os.path.getmtime(path) > 2e6:
            os.utime(path, (1000 + number, 1000 + number))


def replay(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def message(edge, region, n, at):
    value = None if edge is None else json.dumps({
        "edge_id": edge, "region": region, "round": 0, "timestamp": "", "n_samples": n,
        "weights": {"coef": [[1.0]], "intercept": [0.0], "classes": [0, 1]},
        "metrics": {"local_accuracy": 0.5, "total_samples": n, "anomalies_detected": 1}})
    time = DAY + dt.timedelta(minutes=int(at[:2]), seconds=int(at[3:]))
    return (edge or "", value or "bad", "edge_weights", time)


FILES = [
    [("v1", "north", 50, "00:05"), ("v2", "north", 100, "00:10"), ("v3", "south", 50, "00:11")],
    [("v1", "north", 50, "00:35"), (None, None, 0, "00:36"), ("v4", "south", 70, "01:10")],
    [("late", "north", 999, "00:06"), ("v3", "south", 30, "02:10")],
]


def write_files(spark, folder, files, first=0):
    for number, rows in enumerate(files, first):
        add_file(spark, spark.createDataFrame([message(*r) for r in rows], topics.MESSAGE),
                 folder, number)


def regional(spark, folder):
    stream = replay(spark, folder, topics.MESSAGE)
    good, _ = topics.split_rejects(stream, EDGE_UPDATE, ["edge_id"], ["weights.coef"])
    return good.withColumns({"accuracy": F.col("metrics.local_accuracy"),
                             "anomalies": F.col("metrics.anomalies_detected")})


def rolled(spark, folder):
    return rollup.regional_totals(regional(spark, folder), "30 seconds", "10 seconds")


def rows_of(frame):
    return sorted((r.window_start.strftime("%M:%S"), r.region, r.total_n_samples,
                   r.total_anomalies, r.num_updates) for r in frame.collect())


def test_append_keeps_late_rows_of_the_next_batch_and_drops_bad_ones(spark, tmp_path):
    source, run = str(tmp_path / "topic"), str(tmp_path / "run")
    write_files(spark, source, FILES)
    expected = [("00:00", "north", 1149, 3, 3), ("00:00", "south", 50, 1, 1),
                ("00:30", "north", 50, 1, 1), ("01:00", "south", 70, 1, 1)]
    assert rows_of(run_to_table(rolled(spark, source), run)) == expected
    assert rows_of(run_to_table(rolled(spark, source), run)) == expected  # a restart
    write_files(spark, source, [[("v9", "south", 5, "05:00")]], first=3)
    assert rows_of(run_to_table(rolled(spark, source), run)) == expected + [
        ("02:00", "south", 30, 1, 1)]


def test_updates_are_upserted(spark, tmp_path):
    source, run = str(tmp_path / "topic"), str(tmp_path / "run")
    write_files(spark, source, FILES)
    result = run_upserts(rolled(spark, source), run, ["region", "window_start"])
    assert rows_of(result) == [
        ("00:00", "north", 1149, 3, 3), ("00:00", "south", 50, 1, 1),
        ("00:30", "north", 50, 1, 1), ("01:00", "south", 70, 1, 1),
        ("02:00", "south", 30, 1, 1)]
    assert spark.read.parquet(f"{run}/data").count() > result.count()


def test_totals_and_members_come_from_one_pass(spark, tmp_path):
    source, run = str(tmp_path / "topic"), str(tmp_path / "run")
    write_files(spark, source, FILES)
    totals, members = rolled_up(regional(spark, source), run, "30 seconds")
    expected = [("00:00", "north", 1149, 3, 3), ("00:00", "south", 50, 1, 1),
                ("00:30", "north", 50, 1, 1), ("01:00", "south", 70, 1, 1),
                ("02:00", "south", 30, 1, 1)]
    assert rows_of(totals) == expected
    assert sorted(r.edge_id for r in members.collect()) == [
        "late", "v1", "v1", "v2", "v3", "v3", "v4"]
    changed = RollupTables(run).totals.changes(spark).groupBy("batch_id").count()
    assert {r.batch_id: r["count"] for r in changed.collect()} == {0: 2, 1: 2, 2: 2}
    again, _ = rolled_up(regional(spark, source), run, "30 seconds")  # nothing new
    assert rows_of(again) == expected


def test_change_table_reads_the_same_with_and_without_snapshots(spark, tmp_path):
    schema = "key string, n bigint"
    steps = [([("a", 1), ("b", 1)], []), ([("b", 2)], []), ([("c", 3)], ["a"]), None,
             ([("a", 4)], ["b"]), ([("d", 5)], [])]
    wanted, seen = {}, []
    for step in steps:
        if step:
            wanted = {**{k: n for k, n in wanted.items() if k not in step[1]}, **dict(step[0])}
        seen.append(dict(wanted))
    for every in (1, 2, 16):
        table = ChangeTable(str(tmp_path / f"t{every}"), schema, ["key"], every)
        for number, step in enumerate(steps):
            if step is None:
                continue  # a batch without rows
            for _ in range(2):  # a repeated batch does the same again
                gone = spark.createDataFrame([(k,) for k in step[1]], "key string")
                table.change(spark.createDataFrame(step[0], schema), number, gone)
            assert {r.key: r.n for r in table.at(spark, number).collect()} == seen[number]
            assert {r.key: r.n for r in table.before(spark, number).collect()} == (
                seen[number - 1] if number else {})
        assert {r.key: r.n for r in table.current(spark).collect()} == seen[-1]


def test_two_sinks_read_the_source_once(spark, tmp_path):
    source = str(tmp_path / "topic")
    write_files(spark, source, FILES)
    seen = []
    query = topics.publish_to_all(
        replay(spark, source, topics.MESSAGE), str(tmp_path / "checkpoint"),
        [topics.table_sink(str(tmp_path / "a")), lambda batch, n: seen.append(batch.count()),
         topics.console_sink(1)])
    query.awaitTermination()
    assert seen == [3, 3, 2] and spark.read.parquet(str(tmp_path / "a")).count() == 8


def test_topics_are_told_apart(spark, tmp_path):
    source = str(tmp_path / "topic")
    rows = spark.createDataFrame([("a", "1", "one", DAY), ("b", "2", "two", DAY),
                                  ("c", "3", "other", DAY)], topics.MESSAGE)
    add_file(spark, rows, source, 0)
    both = topics.subscribe(spark, ["one", "two"], format="parquet", path=source)
    match = topics.subscribe(spark, format="parquet", path=source, pattern="o.*")
    assert run_to_table(both, str(tmp_path / "r1")).count() == 2
    assert run_to_table(match, str(tmp_path / "r2")).count() == 2


def slices(spark, frame, folder, count, order):
    """The rows in ``count`` files, in order."""
    ranked = frame.withColumn("_slice", F.ntile(count).over(W.orderBy(order)))
    for number in range(1, count + 1):
        add_file(spark, ranked.filter(F.col("_slice") == number).drop("_slice"), folder, number)
    return replay(spark, folder, frame.schema)


def test_rounds_by_window_equal_the_batch_average(spark, small, tmp_path):
    updates = tables.updates(spark, small)
    stream = slices(spark, updates, str(tmp_path / "updates"), 4, "event_time")
    models = run_to_table(rounds_by_window(stream), str(tmp_path / "run"))
    windows = rollup.windowed(updates)
    want = {(r.window.start, r.model_id): r
            for r in fedavg_vector(windows, ["window", "model_id"]).collect()}
    got = models.collect()
    last = updates.agg(F.max("event_time")).first()[0] - dt.timedelta(seconds=10)
    assert len(got) == sum(1 for at, _ in want if at + dt.timedelta(seconds=30) <= last)
    for row in got:
        same = want[row.window_start, row.model_id]
        assert row.weights == pytest.approx(same.weights)
        assert (row.total_samples, row.updates) == (same.total_samples, same.updates)


def test_rounds_by_trigger_wait_for_enough_nodes(spark, tmp_path):
    schema = ("model_id string, node_id bigint, weights array<double>, bias double, loss double, "
              "n_samples bigint, event_time timestamp")
    files = [[("m", 1, [1.0], 0.0, 0.5, 10, DAY)],
             [("m", 1, [3.0], 0.0, 0.3, 10, DAY + dt.timedelta(seconds=9)),
              ("m", 2, [5.0], 1.0, None, 30, DAY), ("z", 7, [1.0], 0.0, 0.1, 1, DAY)],
             [("m", 3, [8.0], 0.0, 0.2, 10, DAY), ("m", 4, [4.0], 0.0, 0.2, 10, DAY)]]
    for number, rows in enumerate(files):
        add_file(spark, spark.createDataFrame(rows, schema), str(tmp_path / "u"), number)
    run = str(tmp_path / "run")
    models = rounds_by_trigger(replay(spark, str(tmp_path / "u"), schema), run, min_nodes=2)
    got = {r["round"]: r for r in models.collect()}
    assert sorted(got) == [1, 2]
    assert got[1].weights == pytest.approx([(10 * 3 + 30 * 5) / 40])
    assert got[1].weighted_loss == pytest.approx(0.3 * 10 / 40)
    assert got[2].weights == pytest.approx([6.0]) and got[2].total_samples == 20
    log = {r["round"]: r for r in read_rounds(spark, f"{run}/log").collect()}
    assert log[1].participating_nodes == ["1", "2"] and log[2].participating_nodes == ["3", "4"]
    assert log[2].weights_norm == pytest.approx(6.0)
    waiting = ChangeTable(f"{run}/pending", PENDING, ["model_id", "node_id"]).current(spark)
    assert [(r.model_id, r.node_id) for r in waiting.collect()] == [("z", 7)]


def test_round_closes_by_regions_or_by_time(spark, tmp_path):
    schema = ("model_id string, region string, event_time timestamp, weights array<double>, "
              "bias double, total_samples bigint, updates bigint, anomalies bigint")

    def row(region, second, w, n):
        return ("m", region, DAY + dt.timedelta(seconds=second), [w], 0.0, n, 1, 2)

    files = [[row("north", 0, 1.0, 10), row("north", 5, 2.0, 10)], [row("south", 20, 4.0, 20)],
             [row("north", 30, 5.0, 10)], [row("east", 200, 7.0, 10)],
             [row("west", 210, 9.0, 30)], [row("north", 220, 2.0, 5)], [row("north", 400, 3.0, 5)]]
    for number, rows in enumerate(files):
        add_file(spark, spark.createDataFrame(rows, schema), str(tmp_path / "r"), number)
    result = rounds_by_participants(replay(spark, str(tmp_path / "r"), schema),
                                    str(tmp_path / "run"))
    got = [(r["round"], r.reason, r.weights[0], r.total_samples, r.updates, r.participants,
            r.anomalies) for r in result.orderBy("round").collect()]
    assert got == [
        (0, "regions", pytest.approx((10 + 20 + 80) / 40), 40, 3, 2, 6),
        (1, "timeout", pytest.approx(5.0), 10, 1, 1, 2),
        (2, "regions", pytest.approx((70 + 270) / 40), 40, 2, 2, 4),
        (3, "timeout", pytest.approx(2.0), 5, 1, 1, 2)]


def test_timer_ends_a_round_without_further_messages_of_its_model(spark, tmp_path):
    schema = ("model_id string, region string, event_time timestamp, weights array<double>, "
              "bias double, total_samples bigint, updates bigint, anomalies bigint")
    files = [[("quiet", "north", DAY, [1.0], 0.0, 10, 1, 0)],
             [("busy", "north", DAY + dt.timedelta(seconds=300), [2.0], 0.0, 10, 1, 0)]]
    for number, rows in enumerate(files):
        add_file(spark, spark.createDataFrame(rows, schema), str(tmp_path / "r"), number)
    result = rounds_by_participants(replay(spark, str(tmp_path / "r"), schema),
                                    str(tmp_path / "run"))
    assert [(r.model_id, r.reason) for r in result.collect()] == [("quiet", "timeout")]


def test_keyed_training_over_batches_equals_the_table_form(spark, small, tmp_path):
    readings = tables.readings(spark, small)
    features = X.zscore("voltage", "current")
    stream = slices(spark, readings, str(tmp_path / "readings"), 5, "event_time")
    streamed = train_by_entity(stream, str(tmp_path / "run"), features)
    batch = train_sequential(readings, features=features)
    got = {(r.edge_id, r["round"]): r for r in streamed.collect()}
    want = {(r.edge_id, r["round"]): r for r in batch.collect()}
    assert got.keys() == want.keys() and got
    for key, row in got.items():
        assert row.weights == pytest.approx(want[key].weights)
        assert (row.n_samples, row.total_samples, row.anomalies_detected) == (
            want[key].n_samples, want[key].total_samples, want[key].anomalies_detected)


def test_keyed_training_does_not_depend_on_file_or_arrow_order(spark, small, tmp_path):
    readings, features = tables.readings(spark, small), X.zscore("voltage", "current")
    source, key = str(tmp_path / "readings"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    readings.repartition(6, F.xxhash64("event_id")).sortWithinPartitions(
        F.xxhash64("event_id")).write.parquet(source)
    spark.conf.set(key, "37")
    try:
        streamed = train_by_entity(spark.readStream.schema(readings.schema).parquet(source),
                                   str(tmp_path / "run"), features).collect()
    finally:
        spark.conf.set(key, "10000")
    want = {(r.edge_id, r["round"]): r
            for r in train_sequential(readings, features=features).collect()}
    assert {(r.edge_id, r["round"]) for r in streamed} == want.keys()
    for row in streamed:
        assert row.weights == pytest.approx(want[row.edge_id, row["round"]].weights)


def test_nodes_keep_their_steps_until_a_newer_global_model(spark, tmp_path):
    schema = "model_id string, node_id int, x double, label int"
    files = [[("m", 1, 1.0, 1), ("m", 2, 2.0, 0)], [("m", 1, 1.0, 1)], [("m", 1, 1.0, 1)],
             [("m", 2, 2.0, 0)]]
    for number, rows in enumerate(files):
        add_file(spark, spark.createDataFrame(rows, schema), str(tmp_path / "u"), number)
    models, nodes = train_by_batch(replay(spark, str(tmp_path / "u"), schema),
                                   str(tmp_path / "run"), [F.col("x")], rate=0.5, min_nodes=2)

    def step(model, x, y):
        slope = 0.5 * (1 / (1 + np.exp(-(model[0] * x + model[1]))) - y)
        return np.array([model[0] - slope * x, model[1] - slope])

    first = (step((0, 0), 1, 1) + step((0, 0), 2, 0)) / 2
    one, two = step(step(first, 1, 1), 1, 1), step(first, 2, 0)
    got = {r["round"]: [r.weights[0], r.bias] for r in models.collect()}
    assert got == {1: pytest.approx(first), 2: pytest.approx((3 * one + 2 * two) / 5)}
    kept = nodes.filter("batch_id = 2 AND node_id = 1").first()
    assert [kept.weights[0], kept.bias] == pytest.approx(one)
    assert (kept.n_samples, kept.adopted, kept.waiting) == (3, 1, True)
    newest = nodes.groupBy("node_id").agg(F.max_by("waiting", "batch_id").alias("waiting"))
    assert newest.filter("waiting").count() == 0


def test_scoring_follows_the_model_table(spark, tmp_path):
    readings = spark.range(4).select(
        F.when(F.col("id") == 3, "none").otherwise("m").alias("model_id"),
        F.col("id").alias("event_id"), (F.col("id") + 1.0).alias("x"))
    schema = "model_id string, round int, weights array<double>, bias double"
    table = str(tmp_path / "models")

    def publish(number, weight):
        spark.createDataFrame([("m", number, [weight], 0.0)], schema).write.mode(
            "append").parquet(table)

    def run():
        start_scoring(replay(spark, str(tmp_path / "readings"), readings.schema),
                      lambda: spark.read.schema(schema).parquet(table), str(tmp_path / "run"),
                      [F.col("x")]).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "run" / "data")).collect()
        return {(r.event_id, r.batch_id): (r.probability, r.anomaly) for r in rows}

    publish(1, -1.0)
    add_file(spark, readings, str(tmp_path / "readings"), 0)
    first = run()
    assert first[0, 0] == (pytest.approx(1 / (1 + np.e)), False) and first[3, 0] == (None, False)
    publish(2, 1.0)
    add_file(spark, readings, str(tmp_path / "readings"), 1)
    second = run()
    assert second[0, 0] == first[0, 0]
    assert second[0, 1] == (pytest.approx(1 / (1 + np.exp(-1))), True)


def test_lanes_take_every_reading(spark, small, tmp_path):
    readings = tables.readings(spark, small)
    stream = slices(spark, readings, str(tmp_path / "readings"), 2, "event_time")
    rows = train_by_entity(stream, str(tmp_path / "run"), X.zscore("voltage", "current"),
                           lanes=3, every=20)
    last = rows.groupBy("edge_id", "lane").agg(F.max("total_samples").alias("n"))
    lane = F.pmod(F.xxhash64("event_id"), F.lit(3)).cast("int").alias("lane")
    want = readings.groupBy("edge_id", lane).count()
    joined = last.join(want, ["edge_id", "lane"])
    assert joined.count() == 12
    assert joined.filter((F.col("n") > F.col("count")) | (F.col("n") < F.col("count") - 40)
                         ).count() == 0


def test_entities_continue_from_the_global_model(spark, tmp_path):
    readings = spark.range(40).select(
        F.lit("m").alias("model_id"), F.lit("a").alias("edge_id"), F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("event_time"),
        (F.col("id") % 3 - 1.0).alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    model = spark.createDataFrame(
        [("m", DAY + dt.timedelta(seconds=20), [5.0], -1.0),
         ("other", DAY + dt.timedelta(seconds=21), [99.0], 9.0)],
        "model_id string, event_time timestamp, weights array<double>, bias double")
    add_file(spark, readings, str(tmp_path / "readings"), 0)
    add_file(spark, model, str(tmp_path / "models"), 0)
    known = spark.createDataFrame([("m", "a")], "model_id string, edge_id string")
    rows = train_by_entity(
        replay(spark, str(tmp_path / "readings"), readings.schema), str(tmp_path / "run"),
        [F.col("x")], models=replay(spark, str(tmp_path / "models"), model.schema),
        entities=known, every=20).orderBy("round").collect()
    data = [(r.x, r.label) for r in readings.orderBy("event_id").collect()]
    w, b = np.array([5.0]), -1.0
    for x, y in data[20:]:
        slope = 0.01 * (1 / (1 + np.exp(-(x * w[0] + b))) - y)
        w, b = w * (1 - 0.01 * 0.0001) - slope * x, b - slope
    assert [r["round"] for r in rows] == [0, 1]
    assert rows[1].weights == pytest.approx(w) and rows[1].bias == pytest.approx(b)
    assert rows[1].total_samples == 40


def test_ticks_publish_without_readings(spark, tmp_path):
    """Reports come by the clock, at most one per interval, and count what was trained."""
    readings = spark.range(60).select(
        F.lit("a").alias("edge_id"), F.col("id").alias("event_id"),
        F.timestamp_seconds("id").alias("event_time"),
        (F.col("id") % 3 - 1.0).alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    add_file(spark, readings, str(tmp_path / "readings"), 0)
    add_file(spark, spark.createDataFrame([(DAY,)], "event_time timestamp"),
             str(tmp_path / "ticks"), 0)
    stream = replay(spark, str(tmp_path / "readings"), readings.schema)
    ticks = replay(spark, str(tmp_path / "ticks"), "event_time timestamp")
    job = EntityTraining(str(tmp_path / "run"), 1, every=20, publish_seconds=10)
    lines = entity_lines(stream, [F.col("x")])
    start_entities(lines, job, ticks, {"availableNow": True}).awaitTermination()
    for second in (5, 12, 30):
        add_file(spark, spark.createDataFrame([(DAY + dt.timedelta(seconds=second),)],
                                              "event_time timestamp"),
                 str(tmp_path / "ticks"), second)
    start_entities(lines, job, ticks, {"availableNow": True}).awaitTermination()
    updates = spark.read.parquet(str(tmp_path / "run" / "updates"))
    reports = spark.read.parquet(str(tmp_path / "run" / "reports")).orderBy("at").collect()
    assert updates.count() == 3
    assert [(r.at - DAY.replace(tzinfo=None)).seconds for r in reports] == [0, 12, 30]
    assert all((r.n_samples, r["round"], r.accuracy) == (60, 3, None) for r in reports)


def test_hot_entity_is_gone_through_batch_by_batch(spark, tmp_path):
    """One entity holding all rows: no frame is larger than an Arrow batch."""
    readings = spark.range(5000).select(
        F.lit("a").alias("edge_id"), F.col("id").alias("event_id"),
        F.timestamp_seconds("id").alias("event_time"),
        (F.col("id") % 7 - 3.0).alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    job = EntityTraining(str(tmp_path / "run"), 1)
    seen = []

    class Counting(EntityTraining):
        def _learn(self, frames):
            for frame in super()._learn(f for f in frames if not seen.append(len(f))):
                yield frame

    lines = entity_lines(readings, [F.col("x")]).toPandas()
    lines = lines.assign(round=None, initialized=None, y=None)
    counting = Counting(str(tmp_path / "run"), 1)
    parts = [lines.iloc[i:i + 100] for i in range(0, len(lines), 100)]
    out = pd.concat(list(counting._learn(iter(parts))))
    assert max(seen) == 100 and (out.n_samples.notna()).sum() == 100
    whole = pd.concat(list(job._learn(iter([lines]))))
    assert out.iloc[-1].weights == pytest.approx(whole.iloc[-1].weights)


def test_batch_training_carries_models_and_counts(spark, small, tmp_path):
    machine = tables.machine(spark, small).withColumn("model_id", F.lit("plant")).cache()
    stream = slices(spark, machine, str(tmp_path / "machine"), 3, "l_orderkey")
    models, nodes = train_by_batch(stream, str(tmp_path / "run"), X.shift_scale(), rate=0.05)
    assert [r["round"] for r in models.orderBy("batch_id").collect()] == [1, 2, 3]
    ends = nodes.filter("batch_id = 2").agg(F.sum("n_samples")).first()[0]
    assert ends == machine.count()
    names = [f"x{j}" for j in range(5)]
    parts = [spark.read.schema(machine.schema).parquet(f).select(
        "node_id", "label", *[c.alias(n) for c, n in zip(X.shift_scale(), names)]).toPandas()
        for f in sorted((str(p) for p in (tmp_path / "machine").glob("*.parquet")),
                        key=os.path.getmtime)]
    w, b, seen = np.zeros(5), 0.0, {}
    for part in parts:
        total, mean_w, mean_b = 0, np.zeros(5), 0.0
        for node, group in part.groupby("node_id"):
            x, y = group[names].to_numpy(), group["label"].to_numpy()
            error = 1 / (1 + np.exp(-(x @ w + b))) - y
            seen[node] = seen.get(node, 0) + len(x)
            total += seen[node]
            mean_w = mean_w + seen[node] * (w - 0.05 * x.T @ error / len(x))
            mean_b += seen[node] * (b - 0.05 * error.mean())
        w, b = mean_w / total, mean_b / total
    final = models.filter("round = 3").first()
    assert final.weights == pytest.approx(w) and final.bias == pytest.approx(b)
