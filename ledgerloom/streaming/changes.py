"""Change feeds: keeping a copy in sync, auditing changes, watching the outbox.

A micro-batch only ever appends: its changes, reduced to the last one per key,
go to a folder named after the batch, and a retried batch rewrites that folder
alone. Every few batches the earlier folders are absorbed into one row per key
and removed, so a batch reads a bounded number of folders. Readers merge base
and changes; ``compact`` folds them into a new base.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import monitoring
from ledgerloom.operators.audit import log_rows
from ledgerloom.operators.dimensions import latest_per_key
from ledgerloom.session import child_names, remove_path
from ledgerloom.sources import tables

DELETE = "d"
BATCH = "batch_id"
# Folder of absorbed batches; readers of the path skip names that begin so.
ABSORBED = "_absorbed"
ABSORB_EVERY = 8
RUN_LENGTH = 100_000
KEEP_PROCESSED = timedelta(days=30)


def record_changes(path: str, key: str, order: list[str]) -> Callable[[DataFrame, int], None]:
    """Batch handler that stores the last change per key."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        schema = T.StructType(batch.schema.fields)
        absorb(batch.sparkSession, path, key, order, schema, batch_id)
        latest_per_key(batch, key, order).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return handle


def _absorbed(spark: SparkSession, path: str, before: int | None = None) -> int:
    """The batch up to which earlier ones are stored as one; 0 if none are."""
    found = [int(name) for name in child_names(spark, f"{path}/{ABSORBED}")]
    done = [n for n in found if (before is None or n <= before) and "_SUCCESS" in child_names(spark, f"{path}/{ABSORBED}/{n}")]
    return max(done, default=0)


def absorb(spark: SparkSession, path: str, key: str, order: list[str], schema: T.StructType, batch_id: int) -> None:
    """Every ``ABSORB_EVERY`` batches, store what came before as the last change per key and drop its folders.

    A batch that is tried again finds what it needs: only folders before it go,
    and only once what they held is stored.
    """
    if batch_id == 0 or batch_id % ABSORB_EVERY or _absorbed(spark, path, batch_id) == batch_id:
        return
    was = _absorbed(spark, path, batch_id)
    earlier = read_changes(spark, path, schema, batch_id).drop(BATCH)
    latest_per_key(earlier, key, order).write.mode("overwrite").parquet(f"{path}/{ABSORBED}/{batch_id}")
    for n in range(was, batch_id):
        remove_path(spark, f"{path}/{BATCH}={n}")
    if was:
        remove_path(spark, f"{path}/{ABSORBED}/{was}")


def read_changes(spark: SparkSession | DataFrame, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Stored changes with the batch they came in, absorbed ones under the batch before the next; optionally only those before a batch."""
    spark = spark if isinstance(spark, SparkSession) else spark.sparkSession
    full = T.StructType(schema.fields + [T.StructField(BATCH, T.LongType())])
    was = _absorbed(spark, path, before)
    rows = spark.createDataFrame([], full)
    numbers = [int(n.split("=")[1]) for n in child_names(spark, path) if n.startswith(f"{BATCH}=")]
    kept = [n for n in numbers if n >= was and (before is None or n < before)]
    if kept:
        rows = spark.read.schema(full).option("basePath", path).parquet(*[f"{path}/{BATCH}={n}" for n in kept])
    if was:
        stored = spark.read.schema(schema).parquet(f"{path}/{ABSORBED}/{was}")
        rows = rows.unionByName(stored.withColumn(BATCH, F.lit(was - 1).cast("bigint")))
    return rows


def current_copy(base: DataFrame, changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The copy as of the last change: changed rows replaced, new rows added, deleted rows gone."""
    latest = latest_per_key(changes, key, order)
    kept = base.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest.filter(F.col("op") != DELETE).select(*base.columns))


def compact(base: DataFrame, changes: DataFrame, key: str, order: list[str], path: str) -> DataFrame:
    """Write the current copy as the new base; changes up to it can then be dropped."""
    return tables.write_new(current_copy(base, changes, key, order), path)


def record_audit(
    base: DataFrame, changes_path: str, audit_path: str, key: str, order: list[str], table: str, schema: T.StructType
) -> Callable[[DataFrame, int], None]:
    """Batch handler that logs every change with the state before and after it, then stores the changes.

    Changes are taken in ``order``, the first of which is a number; batches must
    come in that order too. How the feed is cut into batches shows in no log row.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        touched = batch.select(key).distinct()
        absorb(batch.sparkSession, changes_path, key, order, schema, batch_id)
        earlier = read_changes(batch.sparkSession, changes_path, schema, batch_id).drop(BATCH)
        before = current_copy(base.join(touched, key, "left_semi"), earlier.join(touched, key, "left_semi"), key, order)
        log = log_rows(_with_images(batch, before, key, order), base.columns, key, table, [F.col(name) for name in order])
        # The log is written first: if the batch is retried, the state it compares with is unchanged.
        log.write.mode("overwrite").parquet(f"{audit_path}/{BATCH}={batch_id}")
        latest_per_key(batch, key, order).write.mode("overwrite").parquet(f"{changes_path}/{BATCH}={batch_id}")
        batch.unpersist()

    return handle


def _with_images(batch: DataFrame, before: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each change with the row after it (``new``) and before it (``old``).

    Changes are lagged inside runs of change numbers, then from run to run, so
    no window holds more than a run or the list of runs of one key.
    """
    image = F.struct(F.when(F.col("op") != DELETE, F.struct(*before.columns)).alias("row"))
    staged = batch.withColumn("_image", image).withColumn("_run", F.floor(F.col(order[0]) / RUN_LENGTH))
    inside = Window.partitionBy(key, "_run").orderBy(*order)
    lasts = staged.groupBy(key, "_run").agg(F.max_by("_image", F.struct(*order)).alias("_last"))
    carried = lasts.select(key, "_run", F.lag("_last").over(Window.partitionBy(key).orderBy("_run")).alias("_carried"))
    state = before.select(F.col(key).alias("_key"), F.struct(*before.columns).alias("_state"))
    joined = staged.withColumn("_lagged", F.lag("_image").over(inside)).join(carried, [key, "_run"]).join(state, F.col(key) == F.col("_key"), "left")
    old = F.when(F.col("_lagged").isNotNull(), F.col("_lagged.row")).when(F.col("_carried").isNotNull(), F.col("_carried.row")).otherwise(F.col("_state"))
    return joined.select(old.alias("old"), F.col("_image.row").alias("new"), *order)


def watch_outbox(
    state_path: str, alerts_path: str, as_of: Callable[[int], datetime], schema: T.StructType, keep_processed: timedelta = KEEP_PROCESSED
) -> Callable[[DataFrame, int], None]:
    """Batch handler that keeps the pending events and logs the backlog after each batch.

    The feed carries an event again with ``processed`` set once it was handled.
    Processed ids are kept for ``keep_processed`` after their creation, so that a
    late repeat of the unprocessed event does not bring it back. State is
    rewritten per batch; versions that no retry can need are removed.
    """
    columns = [f.name for f in schema.fields]

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = batch.select(*columns)
        if batch_id > 0:
            known = known.unionByName(spark.read.schema(schema).parquet(f"{state_path}/v{batch_id - 1}"))
        # An event once processed stays so, whichever row arrives last.
        state = known.groupBy("event_id").agg(
            F.min("created_at").alias("created_at"), F.max("processed").alias("processed")
        )
        horizon = F.lit((as_of(batch_id) - keep_processed).strftime("%Y-%m-%d %H:%M:%S.%f")).cast(schema["created_at"].dataType)
        lasting = state.filter(~F.coalesce("processed", F.lit(False)) | F.coalesce(F.col("created_at") >= horizon, F.lit(True)))
        lasting.select(*columns).write.mode("overwrite").parquet(f"{state_path}/v{batch_id}")
        stored = spark.read.schema(schema).parquet(f"{state_path}/v{batch_id}")
        lag = monitoring.outbox_lag(stored, as_of(batch_id))
        lag.write.mode("overwrite").parquet(f"{alerts_path}/{BATCH}={batch_id}")
        if batch_id > 1:
            remove_path(spark, f"{state_path}/v{batch_id - 2}")

    return handle
