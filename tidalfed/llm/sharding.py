"""Operator 10: contiguous shards of nearly equal bytes, cut from global prefix sums.

Rows are put in the order (hash of the text, doc_id), so that equal texts are neighbours.
Their sizes are summed inside range partitions and across partition totals; a row lies in
the shard that holds the middle of its bytes. A group of equal texts goes to one shard as
long as it is small beside a shard; a larger one is cut between rows like any others.

Null texts count as empty, null ids are rows like others, repeated rows are rows of their
own, an empty table gives an empty result. Extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalfed.llm.common import running_totals, settled, whole_text

SHARDS = 16
#: Equal texts stay together while they fill at most this share of a shard.
TOGETHER = 0.01


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS,
                   together: float = TOGETHER) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; law is ``bytes``."""
    text = whole_text()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_text"))
    rows = settled(rows, "sizes")  # texts are read once, not again for the range bounds
    placed = running_totals(rows, ["_text", "doc_id"], "size", "shards")
    total = placed.agg(F.sum("size")).first()[0] or 0
    groups = placed.groupBy("_text").agg(
        F.sum("size").alias("_bytes"), F.min("_before").alias("_start"), F.count("*").alias("_n"))
    groups = groups.filter((F.col("_n") > 1) & (F.col("_bytes") <= together * total / shards))
    middle = F.coalesce(F.col("_start") + F.col("_bytes") / 2,
                        F.col("_before") + F.col("size") / 2)
    shard = F.least(F.floor(middle * shards / max(total, 1)), F.lit(shards - 1)).cast("int")
    cut = placed.join(groups, "_text", "left").withColumn("shard", shard)
    firsts = cut.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return cut.join(F.broadcast(firsts), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_rank") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS) -> DataFrame:
    """Write one folder ``shard=k`` per shard and return the assignment.

    Ids have to be unique here, since they tell which row goes where.
    """
    plan = shard_by_bytes(docs, shards)
    docs.join(plan.select("doc_id", "shard", "slot"), "doc_id").repartition(
        shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(folder)
    return plan
