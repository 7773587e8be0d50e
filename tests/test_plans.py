"""Shapes of the plans: what is pre-aggregated, broadcast and kept out of Python."""

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from tidalfed.operators.sizing import sized_broadcast
from tidalfed import plans
from tidalfed.functions import features as X
from tidalfed.operators import fedavg, joins
from tidalfed.operators import training as T
from tidalfed.sources import tables

SEQUENTIAL = {"sgd_sequential", "sgd_sequential_global"}
BATCH = sorted(n for n in entry.queries() if not n.startswith(("stream_", "src_")))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_query_pairs_rows_or_leaves_the_jvm(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert ("Pandas" in text or "Python" in text) == (name in SEQUENTIAL)


def test_averages_are_partial_before_the_shuffle(spark, small):
    text = plan(fedavg.fedavg_vector(tables.updates(spark, small), ["region"]))
    assert "partial_sum" in text and text.count("Exchange") == 2
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning")


def test_gradients_are_partial_and_models_broadcast(spark, small):
    machine = tables.machine(spark, small)
    models = T.initial_models(machine, "node_id", 5).checkpoint()
    text = plan(T.gradients(machine, models, key="node_id", features=X.shift_scale()))
    assert "partial_avg" in text and "BroadcastHashJoin" in text
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text


def test_scoring_is_one_narrow_projection(spark, small):
    readings = tables.readings(spark, small)
    models = spark.createDataFrame(
        [("grid_a", 1, [1.0, 2.0, 3.0], 0.0), ("grid_b", 1, [1.0, 2.0, 3.0], 0.5)],
        "model_id string, round int, weights array<double>, bias double")
    scored = joins.with_latest_model(readings, models)
    text = plan(scored)
    probe = text[text.index("BroadcastHashJoin"):text.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in probe


def test_scans_read_only_what_is_needed(spark, small):
    text = plan(tables.readings(spark, small).groupBy("edge_id").agg(F.sum("label")))
    schema = text[text.index("ReadSchema: "):].split("\n")[0]
    assert schema == "ReadSchema: struct<user_id:bigint,event_type:string>"


def test_entity_filter_is_not_a_shuffle(spark, small):
    text = plan(entry.queries()["filter_entity"](spark, small))
    assert "Exchange" not in text


def test_messages_are_parsed_once(spark, small):
    told = plan(plans.queries()["reject_bad"](spark, small))
    assert told.count("from_json(") == 1 and told.count("FileScan") == 1
    # Three branches make the messages; the parser stands above their union.
    kinds = plan(plans.queries()["demux_messages"](spark, small))
    assert kinds.lower().count("parsejson") == 1


def test_topic_sizes_come_from_one_pass(spark, small):
    sizes = plan(plans.queries()["bytes_by_topic"](spark, small))
    assert sizes.count("FileScan") == 2  # readings and updates, once each


def test_broadcast_is_measured(spark):
    def hinted(frame, most):
        side = sized_broadcast(frame, max_bytes=most)
        return "ResolvedHint" in side._jdf.queryExecution().analyzed().toString()

    lists = spark.range(100).select("id", F.array_repeat(F.lit(1.0), 1000).alias("weights"))
    # 100 rows of 8000 bytes and 48 for the row itself.
    assert hinted(lists, 804_800) and not hinted(lists, 804_799)
    texts = spark.range(10).select(F.repeat(F.lit("ab"), 500).alias("text"))
    assert hinted(texts, 10_320) and not hinted(texts, 10_319)
    nested = spark.range(10).select(F.struct(F.repeat(F.lit("ab"), 500).alias("t")).alias("s"))
    assert hinted(nested, 20_000) and not hinted(nested, 10_320)
    assert hinted(spark.range(0), 100)
