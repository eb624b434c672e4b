"""Point-of-sale visits from a live feed of transactions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.visits import VISIT_GAP_MINUTES


END_OF_FEED = datetime(9999, 1, 1)


def with_end_of_feed(orders: DataFrame, markers_path: str) -> DataFrame:
    """The feed, and with it the rows of ``markers_path``: a folder that stays empty until the feed has ended.

    ``close_feed`` puts a row there that lies beyond every watermark. A query
    that is then resumed from its checkpoint closes the visits still open; the
    row's own visit never closes.
    """
    Path = orders.sparkSession._jvm.org.apache.hadoop.fs.Path
    path = Path(markers_path)
    path.getFileSystem(orders.sparkSession._jsc.hadoopConfiguration()).mkdirs(path)
    return orders.unionByName(orders.sparkSession.readStream.schema(orders.schema).parquet(markers_path))


def close_feed(spark: SparkSession, schema: T.StructType, markers_path: str) -> None:
    end = {"channel": F.lit("retail"), "order_date": F.lit(END_OF_FEED.isoformat(" ")).cast("timestamp_ntz")}
    row = [end.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    spark.range(1).select(*row).write.mode("append").parquet(markers_path)


def visit_stream(orders: DataFrame, lateness: str, gap_minutes: int = VISIT_GAP_MINUTES) -> DataFrame:
    """Closed visits, each emitted once the watermark has passed its end.

    The rule counts minute boundaries, so sessions are built on whole minutes.
    Minutes 15 apart belong together and minutes 16 apart do not; a session gap
    half way between the two separates them exactly.
    """
    minute = F.date_trunc("minute", "order_date")
    gap = f"{gap_minutes * 60 + 30} seconds"
    sessions = (
        orders.filter(F.col("channel") == "retail")
        .withColumn("_minute", minute)
        .withWatermark("_minute", lateness)
        .groupBy("customer_id", "store_id", F.session_window("_minute", gap).alias("_session"))
        .agg(
            F.min("order_date").alias("visit_start"),
            F.max("order_date").alias("visit_end"),
            F.count("order_id").alias("transaction_count"),
            F.sum("total_amount").alias("visit_total"),
        )
    )
    return sessions.select("customer_id", "store_id", "visit_start", "visit_end", "transaction_count", "visit_total")
