"""Message tables made from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of ``type`` that make a timeline, and the one system text that counts as well.
TIMELINE_TYPES = ("user", "assistant", "automated", "team")
NO_REPLY = "[Tool Call] noReply"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts) -> F.Column:
    """Microseconds since 1970 of a timestamp without time zone (taken as UTC)."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """msg_id, chat_id, user_id, type, message, at of the events."""
    k = F.get_json_object("props", "$.k").cast("int")
    kinds = {"click": "user", "view": "assistant", "purchase": "automated", "signup": "team", "error": "system"}
    kind = F.col("event_type")
    typed = F.coalesce(*[F.when(kind == a, F.lit(b)) for a, b in kinds.items()])
    text = F.when((kind == "error") & (k % 3 == 0), F.lit(NO_REPLY)).otherwise(F.concat(kind, F.lit(" "), (k % 4).cast("string")))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("msg_id"), F.col("user_id").alias("chat_id"), "user_id", typed.alias("type"), text.alias("message"), micros(F.col("ts")).alias("at_us")
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns from conversations; a turn is a minute."""
    role = F.when((F.col("role") == "assistant") & (F.col("conv_id") % 3 == 0), F.lit("automated")).otherwise(F.col("role"))
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("msg_id"),
        F.col("conv_id").alias("chat_id"),
        F.col("conv_id").alias("user_id"),
        role.alias("type"),
        F.col("text").alias("message"),
        (F.lit(1_704_067_200_000_000) + F.col("turn") * 60_000_000).alias("at_us"),
    )


EVENTS_SQL = f"""
msgs_all AS (
  SELECT event_id AS msg_id, user_id AS chat_id, user_id,
    CASE event_type WHEN 'click' THEN 'user' WHEN 'view' THEN 'assistant' WHEN 'purchase' THEN 'automated' WHEN 'signup' THEN 'team' WHEN 'error' THEN 'system' END AS type,
    CASE WHEN event_type = 'error' AND (props->>'$.k')::INT % 3 = 0 THEN '{NO_REPLY}' ELSE event_type || ' ' || ((props->>'$.k')::INT % 4)::VARCHAR END AS message,
    epoch_us(ts) AS at_us
  FROM events),
timeline AS (
  SELECT * FROM msgs_all WHERE type IN ('user', 'assistant', 'automated', 'team') OR (type = 'system' AND message = '{NO_REPLY}'))"""

TURNS_SQL = """
turns AS (
  SELECT conv_id * 1000 + turn AS msg_id, conv_id AS chat_id, conv_id AS user_id,
    CASE WHEN role = 'assistant' AND conv_id % 3 = 0 THEN 'automated' ELSE role END AS type,
    text AS message, 1704067200000000 + turn * 60000000 AS at_us
  FROM conversations)"""
