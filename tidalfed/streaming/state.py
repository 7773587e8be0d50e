"""State tables of ``foreachBatch`` jobs, written as changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.operators.joins import latest

GONE = "_gone"


class ChangeTable:
    """The newest row of each key, kept as a log of changes with snapshots in between.

    A batch writes the keys it changed into a folder of its own, so its cost follows the
    changes and not the size of the state. Every ``every`` batches the state is written out
    whole as well; reading takes the newest snapshot and the changes after it, at most
    ``every`` folders. A repeated batch replaces its own folders and reads only earlier
    ones, so it does the same again. ``every`` must stay the same for the life of a table.
    """

    def __init__(self, path: str, schema: str, keys: Sequence[str],
                 every: int = S.SNAPSHOT_EVERY) -> None:
        self.path, self.schema, self.keys, self.every = path, schema, list(keys), every

    def columns(self, spark: SparkSession) -> list[str]:
        return spark.createDataFrame([], self.schema).columns

    def change(self, rows: DataFrame, batch_id: int, gone: DataFrame | None = None) -> None:
        """Write the changed rows of a batch, and the keys in ``gone`` as removed."""
        spark = rows.sparkSession
        changed = rows.select(*self.columns(spark)).withColumn(GONE, F.lit(False))
        if gone is not None:
            changed = changed.unionByName(gone.select(*self.keys).withColumn(GONE, F.lit(True)),
                                          allowMissingColumns=True)
        changed.write.mode("overwrite").parquet(self._changes(batch_id))
        if (batch_id + 1) % self.every == 0:
            self._at(spark, batch_id, batch_id - 1).write.mode("overwrite").parquet(self._snapshot(batch_id))

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The state a batch starts from."""
        return self.at(spark, batch_id - 1)

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The state after a batch; empty before the first."""
        return self._at(spark, batch_id, batch_id)

    def _at(self, spark: SparkSession, batch_id: int, upto: int) -> DataFrame:
        """The same, from snapshots up to ``upto``: a repeated batch makes its own anew."""
        last = (upto + 1) // self.every * self.every - 1
        while last >= 0 and not committed(spark, self._snapshot(last)):
            last -= self.every  # a batch that had nothing to write
        if last >= 0 and last == batch_id:
            return spark.read.schema(self.schema).parquet(self._snapshot(last))
        logged = f"{self.schema}, {GONE} boolean"
        rows = spark.createDataFrame([], f"{logged}, _batch bigint")
        if last >= 0:
            rows = rows.unionByName(spark.read.schema(self.schema).parquet(
                self._snapshot(last)).withColumns({GONE: F.lit(False),
                                                   "_batch": F.lit(last).cast("bigint")}))
        for number in range(max(last, -1) + 1, batch_id + 1):
            if committed(spark, self._changes(number)):
                rows = rows.unionByName(spark.read.schema(logged).parquet(
                    self._changes(number)).withColumn("_batch", F.lit(number).cast("bigint")))
        newest = latest(rows, self.keys, ["_batch"])
        return newest.filter(~F.col(GONE)).select(*self.columns(spark))

    def current(self, spark: SparkSession) -> DataFrame:
        """The state after the last batch that changed anything."""
        last = self.changes(spark, gone=True).agg(F.max("batch_id")).first()[0]
        return self.at(spark, -1 if last is None else last)

    def changes(self, spark: SparkSession, gone: bool = False) -> DataFrame:
        """All rows ever written, with the batch that wrote them; removals on demand."""
        rows = spark.read.schema(f"{self.schema}, {GONE} boolean, batch_id bigint").parquet(
            f"{self.path}/changes")
        return rows if gone else rows.filter(~F.col(GONE)).drop(GONE)

    def _changes(self, batch_id: int) -> str:
        return f"{self.path}/changes/batch_id={batch_id}"

    def _snapshot(self, batch_id: int) -> str:
        return f"{self.path}/snapshots/upto={batch_id}"


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a folder has been written to its end."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)
