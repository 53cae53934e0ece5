"""Did everything that was published arrive?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import ENVELOPE
from tickloom.sources.messages import BAD_SHAPE

# Fixed value: an error text of the delivery check.
NO_MESSAGES = "No messages found after push"


def reconcile(published: DataFrame, landed: DataFrame, key: str = "run_id") -> DataFrame:
    """Published against landed records per run, with either side possibly absent.

    ``published`` has ``records_pushed`` per run; ``landed`` has one row per record.
    """
    sent = published.groupBy(key).agg(F.sum("records_pushed").cast("long").alias("published"))
    arrived = landed.groupBy(key).agg(F.count(F.lit(1)).alias("landed"))
    return (
        sent.join(arrived, key, "full_outer")
        .select(
            key,
            F.coalesce("published", F.lit(0)).alias("published"),
            F.coalesce("landed", F.lit(0)).alias("landed"),
        )
        .withColumn("missing", F.col("published") - F.col("landed"))
        .withColumn("complete", F.col("missing") == 0)
    )


def newest_messages(messages: DataFrame) -> DataFrame:
    """The newest message of each topic partition and the records in it."""
    return (
        messages.groupBy("topic", "partition")
        .agg(
            F.max("offset").alias("offset"),
            F.max_by(F.col("value").cast("string"), F.col("offset")).alias("_text"),
        )
        .withColumn("_message", F.from_json("_text", ENVELOPE))
        .select(
            "topic",
            "partition",
            "offset",
            F.col("_message.timestamp").alias("message_timestamp"),
            F.col("_message.data").isNotNull().alias("well_formed"),
            F.when(
                F.col("_message.data").isNotNull(), F.size("_message.data")
            ).alias("records"),
        )
    )


def verify_delivery(messages: DataFrame) -> DataFrame:
    """One row: messages looked at, and the record count of the newest one, or an error."""
    latest = F.max_by(F.struct("well_formed", "records"), F.struct("message_timestamp", "offset"))
    return (
        newest_messages(messages)
        .agg(F.count(F.lit(1)).alias("messages"), latest.alias("_latest"))
        .select(
            "messages",
            F.col("_latest.records").alias("records"),
            F.when(F.col("messages") == 0, NO_MESSAGES)
            .when(~F.col("_latest.well_formed"), BAD_SHAPE)
            .alias("error_message"),
        )
    )
