"""Events of order sagas, delivered once.

An event's identifier is made from what it says, so an event written again by a
task that was run twice is the same event. The outbox may hand events over more
than once: within a batch, in a batch that is tried again, or days later.
Delivered events are kept by the day they were created, which a repeat shares,
so a batch is compared with the days it names and with no others, however long
ago they are; nothing is forgotten after a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.identifiers import name_uuid
from ledgerloom.session import child_names, cut_lineage
from ledgerloom.sources import tables
from ledgerloom.streaming.changes import BATCH

DAY = "created_day"
#: Namespace of the identifiers: any fixed one serves, as long as it stays.
SAGAS = uuid.uuid5(uuid.NAMESPACE_URL, "order-sagas")

# The steps of an order saga and the nodes they are sent to.
STEPS = {"reserve_stock": "node3_inventory", "charge_payment": "node1_payments"}


def saga_events(orders: DataFrame, *more: str) -> DataFrame:
    """One event per order and step: event_id, saga_id, event_type, destination, payload, created_at, and ``more`` of the order."""
    steps = F.explode(F.array(*[F.struct(F.lit(k).alias("event_type"), F.lit(v).alias("destination")) for k, v in STEPS.items()]))
    said = orders.select("order_id", "created_at", *more, steps.alias("s")).select("order_id", "created_at", *more, "s.*")
    return said.select(
        name_uuid(SAGAS, F.concat_ws(":", "order_id", "event_type")).alias("event_id"),
        name_uuid(SAGAS, F.col("order_id").cast("string")).alias("saga_id"),
        "event_type",
        "destination",
        F.to_json(F.struct("order_id")).alias("payload"),
        "created_at",
        *more,
    )


def delivered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Delivered events with their day and the batch that delivered them; none before the first batch."""
    full = T.StructType([*schema.fields, T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.LongType())])
    if not child_names(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def deliver_once(path: str) -> Callable[[DataFrame, int], None]:
    """Batch handler that stores the events of a batch that were not delivered before.

    A batch that is tried again replaces what its earlier try stored, and is not
    compared with it.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, T.StructType(batch.schema.fields)
        # A batch names a few days; each is a folder.
        days = [r[0] for r in batch.select(F.to_date("created_at")).distinct().collect()]
        known = [day for day in days if day is not None]
        earlier = delivered(spark, path, schema).filter((F.col(BATCH) < batch_id) & (F.col(DAY).isin(known) | F.col(DAY).isNull()))
        # Repeats of the batch and earlier deliveries are found by one shuffle on the identifier.
        events = batch.dropDuplicates(["event_id"]).withColumn(DAY, F.to_date("created_at"))
        fresh = events.join(earlier.select("event_id"), "event_id", "left_anti").withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        tables.replace_partitions(cut_lineage(fresh.select(*schema.names, DAY, BATCH)), path, [DAY, BATCH])

    return handle
