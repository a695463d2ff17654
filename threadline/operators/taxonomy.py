"""Topic taxonomies: union, freshness, conflicts, guards, remapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def union(*taxonomies: DataFrame) -> DataFrame:
    out = taxonomies[0]
    for t in taxonomies[1:]:
        out = out.unionByName(t)
    return out


def freshness(topics: DataFrame, subs: DataFrame) -> DataFrame:
    """Latest change per type, of a topic or any of its sub-topics."""
    child = subs.groupBy("topic_slug").agg(F.max("updated_at").alias("_s"))
    rows = topics.join(child, topics["slug"] == child["topic_slug"], "left")
    return rows.groupBy("type").agg(F.max(F.greatest("updated_at", F.coalesce("_s", "updated_at"))).alias("freshest"))


def nested(topics: DataFrame, subs: DataFrame) -> DataFrame:
    """Topics with their sub-topics as one text, in order."""
    child = subs.groupBy("topic_slug").agg(F.array_join(F.array_sort(F.collect_list("slug")), " | ").alias("options"))
    return topics.join(child, topics["slug"] == child["topic_slug"], "left").select("slug", "type", F.coalesce("options", F.lit("")).alias("options"))


def conflicts(topics: DataFrame, subs: DataFrame) -> DataFrame:
    """Slugs used more than once over topics and sub-topics."""
    both = topics.select("slug").unionAll(subs.select("slug"))
    return both.groupBy("slug").agg(F.count("*").alias("uses")).where("uses > 1")


def admitted(candidates: DataFrame, topics: DataFrame, subs: DataFrame, kind: str) -> DataFrame:
    """New (topic, sub_topic) pairs of a kind that break no uniqueness: refused if a slug exists in
    another type's taxonomy, a new sub-topic equals an own topic, or a new topic an own sub-topic."""
    fresh = candidates.select("topic", "sub_topic").distinct()
    typed = subs.join(topics.select(F.col("slug").alias("topic_slug"), "type"), "topic_slug").select("slug", "type")
    other = topics.select("slug", "type").unionAll(typed).where(F.col("type") != kind).select("slug").distinct()
    own_topics, own_subs = topics.where(F.col("type") == kind).select("slug"), typed.where(F.col("type") == kind).select("slug").distinct()
    for column, known in (("topic", other), ("sub_topic", other), ("sub_topic", own_topics), ("topic", own_subs)):
        fresh = fresh.join(known.withColumnRenamed("slug", column), column, "left_anti")
    # a new sub-topic belongs to the first topic (by name) that brings it
    first = Window.partitionBy("sub_topic").orderBy("topic")
    return fresh.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("topic", "sub_topic")


def remap_bot_topic(topic, table: dict[str, str], default: str):
    """A bot topic as a user topic: by table, event topics to the event inquiry, else the default."""
    out = F.coalesce(*[F.when(topic == a, F.lit(b)) for a, b in table.items()])
    return F.coalesce(out, F.when(topic.startswith("event_"), F.lit("event_inquiry")), F.lit(default))


def for_pool(topics: DataFrame, pools: DataFrame, allowed: DataFrame) -> DataFrame:
    """(pool, slug) of the topics that each pool may use; a pool without a list may use all."""
    listed = allowed.select("pool").distinct().withColumn("_listed", F.lit(True))
    marked = pools.join(F.broadcast(listed), "pool", "left")
    some = marked.where("_listed").select("pool").join(allowed, "pool").join(topics.select("slug"), "slug").select("pool", "slug")
    every = topics.agg(F.collect_list("slug").alias("slugs"))  # the taxonomy: one row
    rest = marked.where("_listed IS NULL").select("pool").crossJoin(F.broadcast(every)).select("pool", F.explode("slugs").alias("slug"))
    return some.unionByName(rest)


def other_type(rows: DataFrame, topics: DataFrame, kind: str) -> DataFrame:
    """rows with ``violates``: the topic belongs to another type's taxonomy only."""
    of = topics.groupBy(F.col("slug").alias("topic")).agg(F.bool_or(F.col("type") == kind).alias("_own"))
    return rows.join(of, "topic", "left").withColumn("violates", F.coalesce(~F.col("_own"), F.lit(False))).drop("_own")


def unblocked(rows: DataFrame, topics: DataFrame, subs: DataFrame) -> DataFrame:
    """rows with unknown labels emptied: of an unknown topic both, of a sub-topic not under its topic only itself."""
    known = topics.select(F.col("slug").alias("topic")).distinct().withColumn("_t", F.lit(True))
    under = subs.select(F.col("topic_slug").alias("topic"), F.col("slug").alias("sub_topic")).distinct().withColumn("_s", F.lit(True))
    joined = rows.join(known, "topic", "left").join(under, ["topic", "sub_topic"], "left")
    changes = {"topic": F.when(F.col("_t"), F.col("topic")), "sub_topic": F.when(F.col("_t") & F.col("_s"), F.col("sub_topic"))}
    return joined.select(*[changes.get(c, F.col(c)).alias(c) for c in rows.columns])


def pool_of(pool, pools):
    """The pool in lower case, else the first of the pools, else null."""
    return F.coalesce(F.lower(pool), F.lower(F.try_element_at(pools, F.lit(1))))


def review_route(rows: DataFrame, confirmed_topics: DataFrame, confirmed_subs: DataFrame, least: float = 0.6) -> DataFrame:
    """rows with ``review``: P1 unconfirmed topic, P2 unconfirmed sub-topic, P3 low confidence, else accepted."""
    t = confirmed_topics.select(F.col("slug").alias("topic")).distinct().withColumn("_t", F.lit(True))
    s = confirmed_subs.select(F.col("topic_slug").alias("topic"), F.col("slug").alias("sub_topic")).distinct().withColumn("_s", F.lit(True))
    route = F.when(F.col("_t").isNull(), "P1").when(F.col("_s").isNull(), "P2").when(F.coalesce("confidence", F.lit(0.0)) < least, "P3").otherwise("accepted")
    return rows.join(t, "topic", "left").join(s, ["topic", "sub_topic"], "left").withColumn("review", route).drop("_t", "_s")


def changed_since(topics: DataFrame, subs: DataFrame, last_run: int | None) -> DataFrame:
    """Topics that changed, they or a sub-topic, after the last run; all if there was none."""
    child = subs.groupBy(F.col("topic_slug").alias("slug")).agg(F.max("updated_at").alias("_s"))
    rows = topics.join(child, "slug", "left").withColumn("freshest", F.greatest("updated_at", F.coalesce("_s", "updated_at"))).drop("_s")
    return rows if last_run is None else rows.where(F.col("freshest") > last_run)


def pool_texts(allowed: DataFrame, topics: DataFrame, subs: DataFrame) -> DataFrame:
    """Per pool the taxonomy as a text: a line per topic, its sub-topics behind it."""
    lines = nested(topics, subs).select("slug", F.concat(F.lit("- "), F.col("slug"), F.when(F.col("options") != "", F.concat(F.lit(": "), F.col("options"))).otherwise(F.lit(""))).alias("line"))
    rows = allowed.join(lines, "slug")
    return rows.groupBy("pool").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slug", "line"))), lambda x: x["line"]), "\n").alias("text"))


def bot_texts(user_texts: DataFrame, bot_texts: DataFrame) -> DataFrame:
    """pool and the text that its bot messages are labelled with: the bot taxonomy's, or the user taxonomy's where that is empty."""
    both = user_texts.toDF("pool", "_user").join(bot_texts.toDF("pool", "_bot"), "pool", "full")
    return both.select("pool", F.coalesce(F.nullif(F.col("_bot"), F.lit("")), "_user").alias("text"))


def grown(topics: DataFrame, subs: DataFrame, labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Topics and sub-topics with those that labelled templates (topic, sub_topic, summary) bring, the summary as description."""
    first = labelled.groupBy("topic", "sub_topic").agg(F.min("summary").alias("description"))
    new_topics = first.groupBy(F.col("topic").alias("slug")).agg(F.min("description").alias("description")).join(topics.select("slug"), "slug", "left_anti")
    new_subs = first.select(F.col("topic").alias("topic_slug"), F.col("sub_topic").alias("slug"), "description").join(subs.select("topic_slug", "slug"), ["topic_slug", "slug"], "left_anti")
    return new_topics, new_subs
