"""The regional roll-up on a stream: totals as state, members as a table, from one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidalfed import settings as S
from tidalfed.operators.rollup import regional_members
from tidalfed.session import settled
from tidalfed.sources.topics import publish_to_all, table_sink
from tidalfed.streaming.state import ChangeTable

KEYS = ["region", "window_start", "window_end"]
SUMS = ["total_n_samples", "accuracy_sum", "accuracy_count", "total_anomalies", "num_updates"]


class RollupTables:
    """A ``foreachBatch`` function that keeps totals per window and region and lists members.

    Totals are a :class:`ChangeTable` of plain sums: a batch adds to the windows it touches
    and writes only these. Members are appended as they come, one row per update. A batch is
    read once for both.
    """

    def __init__(self, folder: str, duration: str = S.WINDOW) -> None:
        self.duration = duration
        self.totals = ChangeTable(
            f"{folder}/totals", "region string, window_start timestamp, window_end timestamp, "
            "total_n_samples bigint, accuracy_sum double, accuracy_count bigint, "
            "total_anomalies bigint, num_updates bigint", KEYS)
        self.path = f"{folder}/members"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        members = regional_members(batch, self.duration)
        table_sink(self.path)(members, batch_id)
        new = settled(members.groupBy(*KEYS).agg(
            F.sum("n_samples").alias("total_n_samples"), F.sum("accuracy").alias("accuracy_sum"),
            F.count("accuracy").alias("accuracy_count"),
            F.sum("anomalies").alias("total_anomalies"),
            F.count(F.lit(1)).alias("num_updates")))
        before = self.totals.before(batch.sparkSession, batch_id)
        touched = before.join(new.select(*KEYS), KEYS, "left_semi")
        added = new.unionByName(touched).groupBy(*KEYS).agg(
            *(F.sum(c).alias(c) for c in SUMS))
        self.totals.change(added, batch_id)


def start_rollup(updates: DataFrame, folder: str, duration: str = S.WINDOW,
                 trigger: dict | None = None) -> StreamingQuery:
    """Start the roll-up; its tables are ``folder/totals`` and ``folder/members``."""
    return publish_to_all(updates, f"{folder}/checkpoint", [RollupTables(folder, duration)],
                          trigger=trigger)


def rolled_up(updates: DataFrame, folder: str,
              duration: str = S.WINDOW) -> tuple[DataFrame, DataFrame]:
    """Totals and members of all available updates."""
    start_rollup(updates, folder, duration).awaitTermination()
    tables = RollupTables(folder, duration)
    totals = tables.totals.current(updates.sparkSession).withColumn(
        "avg_accuracy", F.try_divide("accuracy_sum", "accuracy_count"))
    return totals, updates.sparkSession.read.parquet(tables.path)
