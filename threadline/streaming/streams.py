"""Message streams: repeated ids, bursts of automated rows, daily counts, late rows.

A stream has msg_id, chat_id, type, message and ts (a timestamp).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_of_each_id(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """The first row of each id; an id's state is dropped ``delay`` after it."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["msg_id"])


def bursts(stream: DataFrame, gap: str = "60 seconds", delay: str = "10 minutes") -> DataFrame:
    """Runs of rows not from users in a chat without a pause of ``gap``."""
    rows = stream.where("type <> 'user'").withWatermark("ts", delay)
    each = rows.groupBy("chat_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n_messages"), F.max("ts").alias("ended_at"))
    return each.select("chat_id", F.col("w.start").alias("started_at"), "ended_at", "n_messages")


def daily_counts(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Messages and user messages per day."""
    rows = stream.withWatermark("ts", delay)
    each = rows.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("messages"), F.count_if(F.col("type") == "user").alias("from_users"))
    return each.select(F.col("w.start").alias("day"), "messages", "from_users")


def write_batches(stream: DataFrame, path: str, checkpoint: str, late_after: str = "3 days"):
    """Append each micro-batch to ``path``; rows older than the batch's newest by ``late_after`` go to ``path``_late.

    A batch that is tried again overwrites its own folder.  ``replay.segment_batches`` keeps
    segments current, late rows included.
    """

    def write(batch: DataFrame, number: int) -> None:
        newest = batch.agg(F.max("ts").alias("newest"))  # one row
        rows = batch.crossJoin(F.broadcast(newest)).withColumn("late", F.col("ts") < F.col("newest") - F.expr(f"INTERVAL {late_after}")).drop("newest")
        for late, folder in ((False, path), (True, f"{path}_late")):
            rows.where(F.col("late") == late).drop("late").write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
