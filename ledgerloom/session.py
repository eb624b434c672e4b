"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys even when that costs one more shuffle downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # JSON objects with a repeated key keep the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A busy customer's transactions are merged into visits before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Open visits live on disk next to the executor instead of in its heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings every job relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", name: str = "ledgerloom", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only on a local master, where driver and
    executors are one process.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not current:
            context.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; never reused, so no run overwrites another.

    All paths of one application lie in one folder, which can go once it has ended.
    """
    application = spark.sparkContext.applicationId
    path = f"{shared_dir(spark).rstrip('/')}/ledgerloom-{application}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


# Paths handed out inside each open scope, the innermost last.
_scopes: list[list[str]] = []


@contextmanager
def released_scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Remove what is stored in the shared folder on the way to a result once that result is stored.

    The function this gives stores a result outside the scope. Nothing else
    that was made inside may be read after it.
    """
    mine: list[str] = []
    _scopes.append(mine)

    def keep(df: DataFrame) -> DataFrame:
        _scopes.append([])
        try:
            return cut_lineage(df)
        finally:
            kept = _scopes.pop()
            outer = _scopes[:-1]
            if outer:
                outer[-1].extend(kept)

    try:
        yield keep
    finally:
        _scopes.pop()
        for path in mine:
            remove_path(spark, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store rows in the shared folder and go on from there.

    A lost executor then costs no replay of earlier rounds, and the planner sees
    the true size of what was stored when it picks the next joins.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names under a folder of any store Spark reaches; none if it is not there."""
    system, folder = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(folder)) if system.exists(folder) else []


def file_stamps(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of change of the files of a table; two equal stamps are one state of it."""
    system, folder = _file_system(spark, path)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in system.listStatus(folder)))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this application wrote and no longer reads."""
    system, folder = _file_system(spark, path)
    system.delete(folder, True)
