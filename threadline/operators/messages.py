"""Timelines: which messages count, and which are copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadline.sources.views import NO_REPLY, TIMELINE_TYPES

from .chains import taken

SECOND = 1_000_000
MINUTE, HOUR, DAY = 60 * SECOND, 3600 * SECOND, 86_400 * SECOND

# A chat's rows in order of time; the id decides between equals.
def in_time():
    return Window.partitionBy("chat_id").orderBy("at_us", "msg_id")


def timeline(messages: DataFrame) -> DataFrame:
    """Rows of the timeline types, and the system rows that say that no reply was due."""
    return messages.where(F.col("type").isin(*TIMELINE_TYPES) | ((F.col("type") == "system") & (F.col("message") == NO_REPLY)))


def first_of_each_id(messages: DataFrame) -> DataFrame:
    """Of rows with the same id the earliest stays; of equal times the first by chat, type and text."""
    order = Window.partitionBy("msg_id").orderBy(F.asc_nulls_last("at_us"), "chat_id", "type", "message")
    return messages.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def without_near_copies(messages: DataFrame, span: int = 2 * SECOND) -> DataFrame:
    """Drop rows not from users whose text was kept at most ``span`` earlier in the chat.

    A row more than span after the one before it with the same text is always kept, so
    texts fall into islands; those of several rows are chains, spread over the tasks, each of which
    holds one time.  User rows and rows without a time always stay.
    """
    loose = (F.col("type") == "user") | F.col("at_us").isNull()
    same = Window.partitionBy("chat_id", "message").orderBy("at_us", "msg_id")
    before, after = F.col("at_us") - F.lag("at_us").over(same), F.lead("at_us").over(same) - F.col("at_us")
    rows = messages.where(~loose).withColumns({"_first": F.coalesce(before > span, F.lit(True)), "_last": F.coalesce(after > span, F.lit(True))})
    rows = rows.withColumn("_island", F.sum(F.col("_first").cast("int")).over(same)).withColumn("_span", F.lit(span).cast("long"))
    helpers = ["_first", "_last", "_island", "_span"]
    alone = rows.where("_first AND _last").drop(*helpers)
    several = rows.where("NOT (_first AND _last)")
    keys = ["chat_id", "message", "_island"]
    # only what the chain needs goes through Python
    chained = taken(several.select(F.xxhash64(*keys).alias("_a"), F.hash(*keys).alias("_b"), "at_us", "_span", "msg_id"), ["_a", "_b"], "at_us", "_span", ["msg_id"])
    kept_rows = several.drop(*helpers).join(chained.select("msg_id"), "msg_id", "left_semi")
    return messages.where(loose).unionByName(alone).unionByName(kept_rows)


def unanswered(messages: DataFrame, run: str | None = None) -> DataFrame:
    """messages with ``unanswered``: a user row, no reaction, that no one answers before the next user row (in the same run)."""
    from threadline.functions.text import is_reaction

    # the next row in time, read backwards: linear, unlike a frame that ends at the partition's end
    later = Window.partitionBy("chat_id", *([run] if run else [])).orderBy(F.desc("at_us"), F.desc("msg_id")).rowsBetween(Window.unboundedPreceding, -1)
    counts = F.col("type").isin(*TIMELINE_TYPES) | ((F.col("type") == "system") & (F.col("message") == NO_REPLY))
    following = F.last(F.when(counts, F.col("type")), ignorenulls=True).over(later)
    flag = (F.col("type") == "user") & ~F.coalesce(is_reaction(F.col("message")), F.lit(False)) & (following.isNull() | (following == "user"))
    return messages.withColumn("unanswered", flag)
