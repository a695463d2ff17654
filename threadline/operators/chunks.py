"""Chunks of a timeline: bursts of automated rows and windows that a user opens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .chains import taken
from .messages import DAY, HOUR, MINUTE, in_time


def _starts(rows: DataFrame, keys: list[str], value: str, span: str, at_least: bool) -> DataFrame:
    """keys and value of the chain over each group's values: the first, then each beyond ``span`` after the one taken last.

    Beyond: at least span after it, or more than that.  One pass over each group's sorted values, in
    the distribution that everything here is in; a task holds one value at a time.
    """
    values = rows.where(" AND ".join(f"{k} IS NOT NULL" for k in (*keys, value))).select(*keys, value, span)
    return taken(values, keys, value, span, at_least=at_least).select(*keys, value)


def chunks(messages: DataFrame, gap: int = MINUTE, window: int = 3 * DAY, reply: int = HOUR, run: str | None = None) -> DataFrame:
    """messages with chunk_no (from 1 within the chat) and kind.

    The first user row, and each more than ``window`` after the anchor before it, is an
    anchor.  A row belongs to its anchor's engaged chunk when it is at most ``window``
    after it and, if a later user row lies in the window, at most ``reply`` after the
    last such row.  All other rows are bot rows; a bot row opens a chunk when the row
    before it is engaged or more than ``gap`` earlier.  Rows without a time take that
    of the row before them by id.

    With ``run`` several segmentations are made at once: messages then hold each row once
    per value of that column, and gap and window may be columns that depend on it.
    """
    keys = ["chat_id", *([run] if run else [])]
    here = lambda *more: Window.partitionBy(*keys, *more)
    time = here().orderBy("at_us", "msg_id")
    before = here().orderBy("msg_id").rowsBetween(Window.unboundedPreceding, 0)
    after = here().orderBy(F.desc("msg_id")).rowsBetween(Window.unboundedPreceding, 0)
    known = F.coalesce("at_us", F.last("at_us", ignorenulls=True).over(before), F.last("at_us", ignorenulls=True).over(after), F.lit(0))
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    rows = messages.withColumn("at_us", known).withColumns({"_gap": as_column(gap), "_window": as_column(window)})
    user = F.col("type") == "user"
    anchors = _starts(rows.where(user), keys, "at_us", "_window", False).withColumns({"_anchor": F.lit(True), "_user": F.lit(True)})
    rows = rows.withColumn("_user", user).join(anchors, [*keys, "at_us", "_user"], "left")
    of_time = here("at_us", "_user").orderBy("msg_id")
    rows = rows.withColumn("_opens", F.col("_anchor").isNotNull() & (F.row_number().over(of_time) == 1))
    rows = rows.withColumn("anchor", F.last(F.when(F.col("_opens"), F.col("at_us")), ignorenulls=True).over(time))
    rows = rows.withColumn("_in", F.coalesce(F.col("at_us") - F.col("anchor") <= F.col("_window"), F.lit(False)))
    rows = rows.withColumn("_last", F.max(F.when(user & F.col("_in"), F.col("at_us"))).over(here("anchor")))
    engaged = F.col("_in") & ((F.col("_last") == F.col("anchor")) | (F.col("at_us") <= F.col("_last")) | (F.col("at_us") - F.col("_last") <= reply))
    rows = rows.withColumn("_engaged", engaged)
    prior, prior_at = F.lag("_engaged").over(time), F.lag("at_us").over(time)
    opens = F.when(F.col("_engaged"), F.col("_opens")).otherwise(prior.isNull() | prior | (F.col("at_us") - prior_at > F.col("_gap")))
    rows = rows.withColumn("_new", opens.cast("long"))
    return rows.select(
        *messages.columns,
        F.sum("_new").over(time).alias("chunk_no"),
        F.when(F.col("_engaged"), F.lit("user_engaged")).otherwise(F.lit("bot_only")).alias("kind"),
    )


def chunk_table(chunked: DataFrame) -> DataFrame:
    """One row per chunk, with the chunk it is merged into: a bot chunk goes before the engaged one that follows it."""
    each = chunked.groupBy("chat_id", "user_id", "chunk_no").agg(
        F.max("kind").alias("kind"), F.count("*").alias("n_messages"), F.min("at_us").alias("started_at"), F.max("at_us").alias("ended_at"), F.bool_and(F.col("type") == "automated").alias("all_automated")
    )
    order = Window.partitionBy("chat_id").orderBy("chunk_no")
    prepended = (F.col("kind") == "bot_only") & F.coalesce(F.lead("kind").over(order) == "user_engaged", F.lit(False))
    return each.withColumn("prepended", prepended).withColumn("owner_no", F.when(F.col("prepended"), F.col("chunk_no") + 1).otherwise(F.col("chunk_no")))


def windows(messages: DataFrame, size: int) -> DataFrame:
    """messages with window_no: the next window starts at the first user row at or after ``size`` rows."""
    rows = messages.withColumn("pos", (F.row_number().over(in_time()) - 1).cast("long"))
    if size <= 0:
        return rows.withColumn("window_no", F.lit(0).cast("long"))
    size_of = rows.where("type = 'user'").withColumn("_size", F.lit(size))
    # the first window starts at row 0, as if a user row stood there
    zero = rows.where("pos = 0 AND type <> 'user'").withColumn("_size", F.lit(size))
    starts = _starts(size_of.unionByName(zero).select("chat_id", "pos", "_size"), ["chat_id"], "pos", "_size", True).withColumn("_start", F.lit(1))
    numbered = rows.join(starts, ["chat_id", "pos"], "left")
    number = F.count("_start").over(Window.partitionBy("chat_id").orderBy("pos")) - 1
    return numbered.select(*messages.columns, "pos", number.cast("long").alias("window_no"))


def histories(windowed: DataFrame) -> DataFrame:
    """One text per window: numbered rows with their type."""
    line = F.concat(F.row_number().over(Window.partitionBy("chat_id", "window_no").orderBy("pos")) - 1, F.lit(" ["), F.col("type"), F.lit("]: "), F.coalesce("message", F.lit("")))
    rows = windowed.withColumn("_line", line)
    lines = F.array_sort(F.collect_list(F.struct("pos", "_line")))
    return rows.groupBy("chat_id", "window_no").agg(F.count("*").alias("n_messages"), F.array_join(F.transform(lines, lambda x: x["_line"]), "\n").alias("history"))


def merge_images(windowed: DataFrame) -> DataFrame:
    """Rows that stay when image-only bot rows join the nearest kept row before them.

    The first row of a window always stays (its text becomes the tag); the text gets one
    tag per absorbed row, and new_pos counts the kept rows.
    """
    from threadline.functions.text import is_image_only

    order = Window.partitionBy("chat_id", "window_no").orderBy("pos")
    rows = windowed.withColumn("_first", F.row_number().over(order) == 1).withColumn("_image", (F.col("type") != "user") & F.coalesce(is_image_only(F.col("message")), F.lit(False)))
    rows = rows.withColumn("_gone", F.col("_image") & ~F.col("_first"))
    rows = rows.withColumn("keeper", F.last(F.when(~F.col("_gone"), F.col("msg_id")), ignorenulls=True).over(order))
    counted = rows.withColumn("absorbed", F.count_if(F.col("_gone")).over(Window.partitionBy("chat_id", "window_no", "keeper")))
    text = F.concat(F.when(F.col("_image"), F.lit("[image]")).otherwise(F.coalesce("message", F.lit(""))), F.repeat(F.lit(" [image]"), F.col("absorbed").cast("int")))
    kept = counted.where(~F.col("_gone"))
    return kept.select("chat_id", "window_no", "msg_id", (F.row_number().over(order) - 1).cast("long").alias("new_pos"), text.alias("text"), "absorbed")
