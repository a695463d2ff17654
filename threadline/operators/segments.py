"""Segments of chunked timelines, their rules and routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .messages import unanswered

#: segment_id = chat_id * SEGMENTS_PER_CHAT + chunk_no
SEGMENTS_PER_CHAT = 100_000

# Fixed value: words of scheduling texts.
SCHEDULING = (
    r"(?i)(schedul|availab|date\s+time|when\s+are\s+you\s+free|confirm.*date|reschedul|pick\s+a\s+time|time\s+slot"
    r"|book\s+(a|your)\s+date|set\s+up\s+a\s+date|date\s+is\s+(set|confirmed|booked)|what\s+time|select.*time)"
)


def bridge(chunked: DataFrame, run: str | None = None) -> DataFrame:
    """One row per message of a segment, with its position in the chat (of the same run)."""
    pos = F.row_number().over(Window.partitionBy("chat_id", *([run] if run else [])).orderBy("at_us", "msg_id")) - 1
    return chunked.withColumn("segment_id", F.col("chat_id") * SEGMENTS_PER_CHAT + F.col("chunk_no")).withColumn("pos", pos.cast("long"))


def segments(chunked: DataFrame, run: str | None = None) -> DataFrame:
    """Bounds, counts and labels of each segment (of each run): topic is its commonest type, sub_topic its first."""
    return of_bridge(bridge(unanswered(chunked, run), run), run)


def of_bridge(rows: DataFrame, run: str | None = None) -> DataFrame:
    """The same from a bridge that has ``unanswered``."""
    keys = [*([run] if run else []), "segment_id", "chat_id", "user_id", "kind"]
    counted = rows.groupBy(*keys, "type").agg(F.count("*").alias("n"), F.min("at_us").alias("lo"), F.max("at_us").alias("hi"), F.min(F.struct("at_us", "msg_id")).alias("first"), F.bool_or("unanswered").alias("failed"))
    user, bot = F.sum(F.when(F.col("type") == "user", F.col("n"))), F.sum(F.when(F.col("type") != "user", F.col("n")))
    each = counted.groupBy(*keys).agg(
        F.sum("n").alias("n_messages"),
        F.min("lo").alias("started_at"),
        F.max("hi").alias("ended_at"),
        F.bool_or(F.col("type") == "user").alias("has_user"),
        F.bool_or("failed").alias("has_failure"),
        F.min_by("type", F.struct(-F.col("n"), F.col("type"))).alias("topic"),
        F.min_by("type", "first").alias("sub_topic"),
        user.alias("_user"),
        bot.alias("_bot"),
    )
    rate = F.when((F.col("_user") > 0) & (F.col("_bot") > 0), F.least(F.col("_user") / F.col("_bot"), F.lit(1.0)))
    return each.select(
        *keys,
        "n_messages",
        "started_at",
        "ended_at",
        "has_user",
        "has_failure",
        "topic",
        "sub_topic",
        F.coalesce(rate, F.lit(0.0)).alias("response_rate"),
        F.when(F.col("has_user"), (F.col("n_messages") * 37 % 100) / 100).otherwise(F.lit(1.0)).alias("confidence"),
    )


def routes(chunked: DataFrame, links: DataFrame, pattern: str = SCHEDULING) -> DataFrame:
    """How each chunk is labelled, the first rule that holds deciding.

    prepended (labelled with the chunk after it), first automated chunk, scheduling text
    (the first of the user's is a request, later ones reminders), all automated
    (templates), other bot chunks, user chunks.
    """
    texts = chunked.groupBy("chat_id", "chunk_no").agg(F.bool_or(F.coalesce(F.col("message").rlike(pattern), F.lit(False))).alias("scheduling"))
    rows = links.join(texts, ["chat_id", "chunk_no"])
    bot = F.col("kind") == "bot_only"
    opening = bot & (F.col("chunk_no") == 1) & F.col("all_automated")
    due = bot & ~F.col("prepended") & ~opening & F.col("scheduling")
    rows = rows.withColumn("_due", due)
    turn = F.sum(F.col("_due").cast("int")).over(Window.partitionBy("user_id").orderBy("chat_id", "chunk_no"))
    route = (
        F.when(F.col("prepended"), "prepended")
        .when(opening, "onboarding")
        .when(F.col("_due") & (turn == 1), "availability_request")
        .when(F.col("_due"), "availability_reminder")
        .when(bot & F.col("all_automated"), "template")
        .when(bot, "bot_label")
        .otherwise("user_label")
    )
    return rows.select("chat_id", "chunk_no", "kind", route.alias("route"))


def one_owner(rows: DataFrame) -> DataFrame:
    """Bridge rows after the duplicates' vote: a bot message in several segments of a window
    stays where most other members lie within three positions; ties go to the lowest segment."""
    near = Window.partitionBy("window_id", "segment_no").orderBy("pos").rangeBetween(-3, 3)
    scored = rows.withColumn("_near", F.count("*").over(near) - 1)
    best = Window.partitionBy("window_id", "msg_id").orderBy(F.desc("_near"), "segment_no")
    return scored.withColumn("_rank", F.row_number().over(best)).where((F.col("type") == "user") | (F.col("_rank") == 1)).drop("_near", "_rank")


def with_orphans(members: DataFrame, positions: DataFrame) -> DataFrame:
    """Every position of a window with a segment: those in none join the nearest member.

    members: window_id, pos, segment_no (several rows per position count as its lowest);
    positions: window_id, pos.  An orphan right before a member takes the lower of its two
    neighbours' segments, any other the one on its left, or on its right if there is none.
    """
    own = members.groupBy("window_id", "pos").agg(F.min("segment_no").alias("own"))
    rows = positions.join(own, ["window_id", "pos"], "left")
    left = Window.partitionBy("window_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    right = Window.partitionBy("window_id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    member = F.when(F.col("own").isNotNull(), F.struct("pos", "own"))
    rows = rows.withColumn("_l", F.last(member, ignorenulls=True).over(left)).withColumn("_r", F.last(member, ignorenulls=True).over(right))
    near = (
        F.when(F.col("_l").isNull(), F.col("_r.own"))
        .when(F.col("_r").isNull() | (F.col("pos") != F.col("_r.pos") - 1), F.col("_l.own"))
        .otherwise(F.least("_l.own", "_r.own"))
    )
    return rows.select("window_id", "pos", F.coalesce("own", near).alias("segment_no"), F.col("own").isNull().alias("orphan"))


def rebuilt(members: DataFrame) -> DataFrame:
    """Bounds and size of each segment of a window from its members (window_id, segment_no, at_us): those left without any are gone."""
    return members.groupBy("window_id", "segment_no").agg(F.min("at_us").alias("started_at"), F.max("at_us").alias("ended_at"), F.count("*").alias("n_messages"))


def original_indices(members: DataFrame, kept: DataFrame) -> DataFrame:
    """members (window_id, segment_no, new_pos) with the row that each new index stands for; indices out of range are dropped.

    kept: window_id, new_pos, msg_id of the rows that stayed when images were absorbed.
    """
    return members.join(kept.select("window_id", "new_pos", "msg_id"), ["window_id", "new_pos"]).select("window_id", "segment_no", "msg_id").distinct()


def with_absorbed(members: DataFrame, absorbed: DataFrame) -> DataFrame:
    """members (window_id, segment_no, msg_id) and the rows that their keepers absorbed (window_id, msg_id, keeper), each once per segment."""
    more = absorbed.join(members.withColumnRenamed("msg_id", "keeper"), ["window_id", "keeper"]).select("window_id", "segment_no", "msg_id")
    return members.select("window_id", "segment_no", "msg_id").unionByName(more).distinct()


def fallbacks(windows: DataFrame, labelled: DataFrame) -> DataFrame:
    """One unclassified segment for each window without a labelled item; bot windows are certain of it, user windows not."""
    missing = windows.join(labelled.select("window_id").distinct(), "window_id", "left_anti")
    each = missing.groupBy("window_id").agg(F.min("at_us").alias("started_at"), F.max("at_us").alias("ended_at"), F.count("*").alias("n_messages"), F.bool_or(F.col("type") == "user").alias("has_user"))
    return each.select("window_id", F.lit("unclassified").alias("topic"), F.lit("unclassified").alias("sub_topic"), F.when(~F.col("has_user"), F.lit(1.0)).alias("confidence"), "started_at", "ended_at", "n_messages")


def since_last(messages: DataFrame, segments: DataFrame) -> DataFrame:
    """Each user's rows after the end of their segment that started last (all rows of users without one; rows without a time never)."""
    order = Window.partitionBy("user_id").orderBy(F.desc_nulls_first("started_at"), "segment_id")
    latest = segments.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("user_id", F.col("ended_at").alias("_cutoff"))
    rows = messages.join(latest, "user_id", "left")
    return rows.where(F.col("_cutoff").isNull() | (F.coalesce("at_us", "_cutoff") > F.col("_cutoff"))).drop("_cutoff")


def running_context(segments: DataFrame) -> DataFrame:
    """segment_id and the lines of the user's earlier segments, one per segment, under one header."""
    order = Window.partitionBy("user_id").orderBy(F.asc_nulls_first("started_at"), "segment_id").rowsBetween(Window.unboundedPreceding, -1)
    line = F.concat(F.lit("- "), F.coalesce("topic", F.lit("unknown")), F.lit(" / "), F.coalesce("sub_topic", F.lit("unknown")), F.lit(': "'), F.coalesce("summary", F.lit("")), F.lit('"'))
    lines = F.collect_list(line).over(order)
    text = F.when(F.size(lines) > 0, F.concat(F.lit("Previous segments:\n"), F.array_join(lines, "\n"))).otherwise(F.lit(""))
    return segments.select("segment_id", "user_id", text.alias("context"))


def adjusted(rows: DataFrame, pure: bool = False) -> DataFrame:
    """rows (has_user, confidence, sentiment) after the rules: without the user confidence is 1 and there is no sentiment; in pure mode all stays as labelled."""
    if pure:
        return rows
    return rows.withColumn("confidence", F.when(F.col("has_user"), F.col("confidence")).otherwise(F.lit(1.0))).withColumn("sentiment", F.when(F.col("has_user"), F.col("sentiment")))


def sentiment_streaks(rows: DataFrame, user: str, order: list[str]) -> DataFrame:
    """user, nth (from 1), sentiment and n of each run of equal sentiments; rows without a sentiment don't break a run."""
    w = Window.partitionBy(user).orderBy(*order)
    known = rows.where(F.col("sentiment").isNotNull())
    new = F.coalesce(F.lag("sentiment").over(w) != F.col("sentiment"), F.lit(True))
    numbered = known.withColumn("_new", new.cast("long")).withColumn("nth", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(user, "nth").agg(F.first("sentiment").alias("sentiment"), F.count("*").alias("n"))


def sentiment_trends(rows: DataFrame, user: str, order: list[str], width: int = 3) -> DataFrame:
    """rows with mood (positive 1, negative -1, else 0, over the last ``width`` rows with a sentiment) and whether it fell below the one before."""
    w = Window.partitionBy(user).orderBy(*order)
    score = F.when(F.col("sentiment") == "positive", 1).when(F.col("sentiment") == "negative", -1).otherwise(0)
    known = rows.where(F.col("sentiment").isNotNull()).withColumn("mood", F.avg(score).over(w.rowsBetween(1 - width, 0)))
    return known.withColumn("falling", F.coalesce(F.col("mood") < F.lag("mood").over(w), F.lit(False)))


def needing_a_person(rows: DataFrame, user: str, order: list[str], urgent: list[str], complaints: list[str], last: int = 5, least: int = 2) -> DataFrame:
    """rows with ``why``: an urgent topic, or the ``least``-th negative complaint within the user's last ``last`` rows."""
    w = Window.partitionBy(user).orderBy(*order).rowsBetween(1 - last, 0)
    bad = F.coalesce(F.col("topic").isin(*complaints) & (F.col("sentiment") == "negative"), F.lit(False))
    marked = rows.withColumn("_bad", bad).withColumn("_n", F.count_if("_bad").over(w))
    why = F.when(F.col("topic").isin(*urgent), "urgent").when(F.col("_bad") & (F.col("_n") >= least), "repeated")
    return marked.withColumn("why", why).where("why IS NOT NULL").drop("_bad", "_n")
