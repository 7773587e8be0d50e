"""The wide-scale forms give what the plain ones give, with a key that holds most rows."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidalfed.operators import batches, joins, ordered, rollup, rounds
from tidalfed.operators.sizing import sized_broadcast


@pytest.fixture(scope="module")
def rows(spark):
    """Three thousand rows, two thirds of one key, many of one instant, a null key."""
    return spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 3 == 2, F.concat(
            F.lit("k"), (F.col("id") % 7).cast("string"))).alias("name"),
        F.timestamp_seconds(F.when(F.col("id") < 1000, 5).otherwise(F.col("id") % 400))
        .alias("event_time"),
        (F.col("id") % 5).alias("x"), (F.col("id") % 4 == 0).cast("int").alias("label"),
    ).withColumn("edge_id", F.when(F.col("event_id") % 50 != 49, F.col("name"))).drop(
        "name").cache()


def ids(frame, *columns):
    return sorted((tuple(str(v) for v in r) for r in frame.select(*columns).collect()))


def test_segments_of_a_hot_key_are_bounded(rows):
    cut, flag = ordered.segmented(rows, ["edge_id"], ["event_time", "event_id"], 200)
    sizes = [r["count"] for r in cut.groupBy("edge_id", ordered.SEGMENT).count().collect()]
    assert flag and max(sizes) < 3 * 200 and sum(sizes) == 3000


@pytest.mark.parametrize("group_rows", [100, 700])
def test_running_over_segments(rows, group_rows):
    keys, order = ["edge_id"], ["event_time", "event_id"]
    odd = F.when(F.col("event_id") % 11 == 0, F.col("event_id"))
    sums = {"total": F.when(F.col("event_id") % 2 == 0, F.col("x")), "n": F.lit(1)}
    plain = ordered.running(rows, keys, order, sums, {"seen": odd})
    cut = ordered.running(rows, keys, order, sums, {"seen": odd}, group_rows=group_rows)
    columns = ["edge_id", "event_id", "total", "n", "seen"]
    assert ids(plain, *columns) == ids(cut, *columns)


def test_count_batches_over_segments(rows):
    plain = batches.count_batches(rows, size=50)
    cut = batches.count_batches(rows, size=50, group_rows=150)
    columns = ["edge_id", "event_id", "position", "batch", "complete"]
    assert ids(plain, *columns) == ids(cut, *columns)


def test_shards_are_consecutive_and_bounded(rows):
    cut = batches.shards(rows, ["edge_id"], ["event_time", "event_id"], 90, group_rows=200)
    sizes = cut.groupBy("edge_id", "shard").count()
    assert sizes.agg(F.max("count")).first()[0] == 90 and cut.count() == 3000
    ends = cut.groupBy("edge_id", "shard").agg(
        F.min(F.struct("event_time", "event_id")).alias("low"),
        F.max(F.struct("event_time", "event_id")).alias("high"))
    after = F.lead("low").over(W.partitionBy("edge_id").orderBy("shard"))
    assert ends.withColumn("next", after).filter(F.col("next") <= F.col("high")).count() == 0


def test_models_in_force_over_segments(spark, rows):
    models = spark.range(60).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise("k1").alias("edge_id"),
        F.timestamp_seconds(F.col("id") * 9).alias("published_at"),
        F.col("id").alias("number"))
    known = rows.filter("edge_id is not null")
    plain = joins.with_model_in_force(known, models, model=["number"])
    cut = joins.with_model_in_force(known, models, model=["number"], group_rows=100)
    columns = ["event_id", "edge_id", "number"]
    brute = {}
    published = [(r.edge_id, r.published_at, r.number) for r in models.collect()]
    for r in known.collect():
        brute[r.event_id] = max((n for e, t, n in published
                                 if e == r.edge_id and t <= r.event_time), default=None)
    assert ids(plain, *columns) == ids(cut, *columns)
    assert {r.event_id: r.number for r in cut.collect()} == brute


def test_top_rows_of_a_hot_key(rows):
    got = ordered.top_per_key(rows.repartition(12), ["edge_id"],
                              [F.col("event_time").desc(), F.col("event_id").desc()], 30, spread=3)
    rank = F.row_number().over(W.partitionBy("edge_id").orderBy(
        F.desc("event_time"), F.desc("event_id")))
    want = rows.withColumn("r", rank).filter("r <= 30")
    assert ids(got, "edge_id", "event_id") == ids(want, "edge_id", "event_id")


@pytest.mark.parametrize("page_rows", [10_000, 25])
def test_rollup_messages_add_up_at_any_size(rows, page_rows):
    updates = rows.select(
        F.lit("r").alias("region"), F.col("event_id").cast("string").alias("edge_id"),
        "event_time", F.array(F.col("x").cast("double")).alias("weights"),
        F.lit(2).alias("n_samples"), F.lit(0.5).alias("accuracy"), F.col("label").alias("anomalies"))
    pages = rollup.regional_pages(updates, "100 seconds", page_rows, group_rows=200).cache()
    assert pages.agg(F.max(F.size("all_weights"))).first()[0] <= page_rows
    members = [r[0] for r in pages.select(F.explode("contributing_edges")).collect()]
    assert sorted(members, key=int) == [str(i) for i in range(3000)]
    added = pages.groupBy("window_start").agg(F.sum("num_updates"), F.sum("total_n_samples"))
    totals = rollup.regional_totals(updates, "100 seconds").select(
        "window_start", "num_updates", "total_n_samples")
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, totals.collect()))
    listed = rollup.regional_members(updates, "100 seconds")
    assert listed.count() == 3000 and "page" not in listed.columns


def copies(spark):
    """One reading two thousand times over, and a hundred others of its entity."""
    return spark.range(2100).select(
        F.lit("hot").alias("edge_id"), F.greatest(F.lit(0), F.col("id") - 2000).alias("event_id"),
        F.timestamp_seconds(F.lit(9)).alias("event_time"), F.lit(1).alias("x"),
        F.lit("r").alias("region"), F.array(F.lit(1.0)).alias("weights"),
        F.lit(1).alias("n_samples"), F.lit(0.5).alias("accuracy"), F.lit(0).alias("anomalies"))


def test_copies_of_one_row_are_spread_over_segments(spark):
    order = ["event_time", "event_id"]
    cut, flag = ordered.segmented(copies(spark), ["edge_id"], order, 200)
    sizes = [r["count"] for r in cut.groupBy(ordered.SEGMENT).count().collect()]
    assert flag and max(sizes) < 3 * 200 and sum(sizes) == 2100
    numbered = ordered.position(copies(spark), ["edge_id"], order, "n", group_rows=200)
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 2101))


def test_copies_of_one_update_are_spread_over_pages(spark):
    pages = rollup.regional_pages(copies(spark), page_rows=50, group_rows=200).cache()
    sizes = [len(r.contributing_edges) for r in pages.collect()]
    assert sum(sizes) == 2100 and max(sizes) == 50
    assert sum(r.num_updates for r in pages.collect()) == 2100


def test_history_pages_join_up(spark):
    log = spark.range(1, 96).select(
        F.lit("m").alias("model_id"), F.col("id").alias("round"),
        (F.lit(1.0) / F.col("id")).alias("weighted_loss"))
    pages = rounds.loss_history(log, page_rows=10).orderBy("page").collect()
    assert [len(p.losses) for p in pages] == [10] * 9 + [5]
    assert [x for p in pages for x in p.losses] == [1.0 / i for i in range(1, 96)]
    people = rounds.participants(log.withColumn("node", F.col("round").cast("string")),
                                 ["model_id"], "node", list_rows=30).collect()
    assert sorted(int(n) for p in people for n in p.participants) == list(range(1, 96))
    assert max(len(p.participants) for p in people) == 30


def test_broadcast_only_below_the_bound(spark, rows):
    small = rows.select("event_id")
    assert "ResolvedHint" in sized_broadcast(small)._jdf.queryExecution().analyzed().toString()
    wide = sized_broadcast(small, max_bytes=32 * 2000)
    assert "ResolvedHint" not in wide._jdf.queryExecution().analyzed().toString()
    joined = rows.join(wide, "event_id").count()
    assert joined == 3000


def test_sampling_does_not_depend_on_partitions(rows):
    nodes = rows.select("event_id", (F.col("event_id") % 3).alias("round"))
    a = rounds.sample_participants(nodes, ["round"], "event_id", 20, seed=3)
    b = rounds.sample_participants(nodes.repartition(9), ["round"], "event_id", 20, seed=3)
    c = rounds.sample_participants(nodes, ["round"], "event_id", 20, seed=4)
    assert ids(a, "round", "event_id") == ids(b, "round", "event_id")
    assert a.count() == 60 and ids(a, "round", "event_id") != ids(c, "round", "event_id")
