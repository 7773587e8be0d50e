"""Session defaults and the shared folder for checkpoints, replays and stream results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Paths of the tables written inside the innermost ``scratch``, if any.
_paths: ContextVar[list[str] | None] = ContextVar("paths", default=None)


def local_session(cores: str = "8", app: str = "tidalfed") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every job here relies on: event times are UTC, state lives in RocksDB."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; a cluster without the
    setting is an error, since a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidalfed-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """Compute a small result once: its lineage ends in files of the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Compute a large result once, as a table of the shared folder.

    Unlike a checkpoint it is computed in one pass, and later reads prune its columns; with
    ``by`` they also read only the folders of the values asked for.
    """
    path = run_folder(df.sparkSession, label)
    keep(path)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep(path: str) -> None:
    """Leave a path to the innermost ``scratch``, if there is one."""
    if (paths := _paths.get()) is not None:
        paths.append(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end; nothing that reads them may leave."""
    token = _paths.set([])
    try:
        yield
    finally:
        paths = _paths.get()
        _paths.reset(token)
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, used by one run only."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
