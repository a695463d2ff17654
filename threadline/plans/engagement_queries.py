"""Registered queries on sentiment, templates' effect, cohorts by pool, logs with their run and tables made anew, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadline.operators import messages as ms
from threadline.operators import responses as rs
from threadline.operators import segments as sg
from threadline.operators import tables as tb
from threadline.operators import taxonomy as tx
from threadline.sources.views import EVENTS_SQL, event_messages, table
from threadline.work import folder

from .segment_queries import _segments_sql, segments
from .table_queries import _signals

C = F.col
MOODS = ("positive", "neutral", "negative", "Negative", "mixed")


def labelled(spark, sf_dir):
    """Segments out of labelling responses, ten conversations to a user: user, segment, topic, has_user, confidence, sentiment.

    A response names the rows of its conversation: those not from the user in every fourth one, all others else.
    """
    row = F.struct(C("turn"), (C("role") == "user").alias("user"))
    chats = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("r"), F.sum(F.length("text")).alias("chars"), F.count("*").cast("int").alias("n_msgs"))
    places = F.filter(F.transform("r", lambda x, i: F.when((C("conv_id") % 4 != 0) | ~x["user"], i)), lambda i: i.isNotNull())
    item = F.struct(
        F.concat(F.lit("t"), (C("chars") % 3).cast("string")).alias("topic"), F.lit("s").alias("subTopic"), F.lit("x").alias("summary"), places.alias("messageIndices"),
        (C("chars") % 100 / 100).alias("confidence"), F.element_at(F.array(*map(F.lit, MOODS)), (C("chars") % 5 + 1).cast("int")).alias("sentiment"),
    )
    asked = chats.select(C("conv_id").alias("window_id"), "n_msgs", F.to_json(F.struct(F.array(item).alias("segments"))).alias("response"))
    found = rs.parsed(asked).where("reason IS NULL").join(chats.select(C("conv_id").alias("window_id"), "r"), "window_id")
    has_user = F.exists("indices", lambda i: C("r")[i]["user"])
    return found.select(F.expr("window_id div 10").alias("user_id"), C("window_id").alias("segment_id"), "topic", has_user.alias("has_user"), "confidence", "sentiment")


def rule_labels(spark, sf_dir):
    """Confidence and sentiment after the rules and in pure mode."""
    rows = labelled(spark, sf_dir)
    columns = ["segment_id", "confidence", "sentiment"]
    return sg.adjusted(rows).select(*columns, F.lit("rules").alias("mode")).unionByName(sg.adjusted(rows, pure=True).select(*columns, F.lit("pure").alias("mode")))


def sentiment_streaks(spark, sf_dir):
    return sg.sentiment_streaks(sg.adjusted(labelled(spark, sf_dir)), "user_id", ["segment_id"])


def sentiment_trends(spark, sf_dir):
    rows = sg.sentiment_trends(sg.adjusted(labelled(spark, sf_dir)), "user_id", ["segment_id"])
    return rows.select("segment_id", "user_id", F.round("mood", 6).alias("mood"), "falling")


def needing_a_person(spark, sf_dir):
    rows = sg.needing_a_person(sg.adjusted(labelled(spark, sf_dir)), "user_id", ["segment_id"], ["t0"], ["t1", "t2"])
    return rows.select("segment_id", "user_id", "topic", "why")


def sentiment_features(spark, sf_dir):
    """A user's segments in one row: counts by sentiment, share with the user, mean confidence, engagement."""
    rows = sg.adjusted(labelled(spark, sf_dir))
    wide = [F.count_if(C("sentiment") == s).alias(s) for s in rs.SENTIMENTS]
    engaged = F.avg(C("has_user").cast("double"))
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), *wide, F.round(engaged, 6).alias("engaged"), F.round(F.avg("confidence"), 6).alias("confidence"), F.round(engaged * F.log(1 + F.count("*").cast("double")), 6).alias("engagement"))


def template_effects(spark, sf_dir):
    """Automated texts ranked by how often a user's row follows within a day, before another automated one."""
    rows = ms.timeline(event_messages(spark, sf_dir)).where("type IN ('user', 'automated')")
    after = Window.partitionBy("chat_id").orderBy("at_us", "msg_id")
    answered = F.coalesce((F.lead("type").over(after) == "user") & (F.lead("at_us").over(after) - C("at_us") <= ms.DAY), F.lit(False))
    rate = rows.withColumn("answered", answered).where("type = 'automated'").groupBy("message").agg(F.count("*").alias("sent"), F.count_if("answered").alias("answered"))
    rated = rate.withColumn("rate", F.round(C("answered") / C("sent"), 6))
    return rated.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("rate"), "message")))  # one row per template


def pool_lift(spark, sf_dir):
    """Share of each topic within the users of a pool over its share overall."""
    pools = table(spark, sf_dir, "customer").select(C("c_custkey").alias("user_id"), C("c_mktsegment").alias("pool"))
    n = segments(spark, sf_dir).join(pools, "user_id").groupBy("pool", "topic").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    n = n.withColumn("in_pool", F.sum("n").over(Window.partitionBy("pool"))).withColumn("in_topic", F.sum("n").over(Window.partitionBy("topic"))).crossJoin(F.broadcast(total))  # one row
    return n.select("pool", "topic", "n", F.round((C("n") / C("in_pool")) / (C("in_topic") / C("total")), 6).alias("lift"))


def remap_log(spark, sf_dir):
    s = segments(spark, sf_dir).select("segment_id", "user_id", "has_user", C("topic").alias("from_topic"), C("sub_topic").alias("from_sub_topic"), tx.remap_bot_topic(C("topic"), {"user": "a"}, "other").alias("to_topic"))
    return tb.remap_log(s, 3, group_id=5, run_id=8)


def regenerated_signals(spark, sf_dir):
    """A table of signals cleared and written again; the first try of the second run broke off."""
    path = f"{folder(spark)}/threadline-signals-{uuid.uuid4().hex}/signals"
    rows = _signals(spark, sf_dir).select("matching_id", F.array_join("signal", ",").alias("signals"))
    tb.regenerate(rows.where("matching_id % 2 = 0"), path, 1)
    rows.where("matching_id % 3 = 0").write.parquet(f"{path}/run=2")
    tb.regenerate(rows, path, 2)
    return tb.generated(spark, path)


QUERIES = {f.__name__: f for f in (rule_labels, sentiment_streaks, sentiment_trends, needing_a_person, sentiment_features, template_effects, pool_lift, remap_log, regenerated_signals)}

_LABELLED = """
c AS (SELECT conv_id, sum(length(text)) AS chars, bool_or(role = 'user') AS u, bool_or(role <> 'user') AS b FROM conversations GROUP BY conv_id),
lb AS (
  SELECT conv_id // 10 AS user_id, conv_id AS segment_id, 't' || (chars % 3)::BIGINT AS topic, conv_id % 4 <> 0 AND u AS has_user, least(0.99, (chars % 100) / 100.0)::DOUBLE AS confidence,
    lower(['positive', 'neutral', 'negative', 'Negative', 'mixed'][(chars % 5)::INT + 1]) AS sentiment
  FROM c WHERE b OR conv_id % 4 <> 0),
ad AS (SELECT user_id, segment_id, topic, has_user, CASE WHEN has_user THEN confidence ELSE 1.0 END::DOUBLE AS confidence, CASE WHEN has_user THEN sentiment END AS sentiment FROM lb)"""

ORACLE_SQL = {
    "rule_labels": f"WITH {_LABELLED} SELECT segment_id, confidence, sentiment, 'rules' AS mode FROM ad UNION ALL SELECT segment_id, confidence, sentiment, 'pure' FROM lb",
    "sentiment_streaks": f"""WITH {_LABELLED},
s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY segment_id) - row_number() OVER (PARTITION BY user_id, sentiment ORDER BY segment_id) AS run FROM ad WHERE sentiment IS NOT NULL),
g AS (SELECT user_id, sentiment, run, min(segment_id) AS begun, count(*) AS n FROM s GROUP BY ALL)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY begun) AS nth, sentiment, n FROM g""",
    "sentiment_trends": f"""WITH {_LABELLED},
m AS (
  SELECT segment_id, user_id, avg(CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY segment_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mood
  FROM ad WHERE sentiment IS NOT NULL)
SELECT segment_id, user_id, round(mood, 6) AS mood, coalesce(mood < lag(mood) OVER (PARTITION BY user_id ORDER BY segment_id), false) AS falling FROM m""",
    "needing_a_person": f"""WITH {_LABELLED},
n AS (SELECT *, coalesce(topic IN ('t1', 't2') AND sentiment = 'negative', false) AS bad FROM ad),
k AS (SELECT *, count(*) FILTER (bad) OVER (PARTITION BY user_id ORDER BY segment_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS k FROM n)
SELECT segment_id, user_id, topic, CASE WHEN topic = 't0' THEN 'urgent' ELSE 'repeated' END AS why FROM k WHERE topic = 't0' OR (bad AND k >= 2)""",
    "sentiment_features": f"""WITH {_LABELLED}
SELECT user_id, count(*) AS n, count(*) FILTER (sentiment = 'positive') AS positive, count(*) FILTER (sentiment = 'neutral') AS neutral, count(*) FILTER (sentiment = 'negative') AS negative,
  count(*) FILTER (sentiment = 'mixed') AS mixed, round(avg(has_user::INT), 6) AS engaged, round(avg(confidence), 6) AS confidence, round(avg(has_user::INT) * ln(1 + count(*)), 6) AS engagement
FROM ad GROUP BY user_id""",
    "template_effects": f"""WITH {EVENTS_SQL},
a AS (
  SELECT message, type, coalesce(lead(type) OVER w = 'user' AND lead(at_us) OVER w - at_us <= {ms.DAY}, false) AS ok
  FROM timeline WHERE type IN ('user', 'automated') WINDOW w AS (PARTITION BY chat_id ORDER BY at_us, msg_id)),
r AS (SELECT message, count(*) AS sent, count(*) FILTER (ok) AS answered, round(count(*) FILTER (ok) / count(*), 6) AS rate FROM a WHERE type = 'automated' GROUP BY message)
SELECT *, (row_number() OVER (ORDER BY rate DESC, message))::INT AS rank FROM r""",
    "pool_lift": f"""{_segments_sql()},
n AS (SELECT c_mktsegment AS pool, topic, count(*) AS n FROM seg_gt JOIN customer ON c_custkey = user_id GROUP BY ALL)
SELECT pool, topic, n, round((n / sum(n) OVER (PARTITION BY pool)) / (sum(n) OVER (PARTITION BY topic) / sum(n) OVER ()), 6) AS lift FROM n""",
    "remap_log": f"""{_segments_sql()}, m AS (SELECT *, CASE WHEN topic = 'user' THEN 'a' ELSE 'other' END AS to_topic FROM seg_gt)
SELECT segment_id, 'taxonomy_remap' AS event, user_id,
  '{{"direction":"' || CASE WHEN has_user THEN 'bot_to_user' ELSE 'user_to_bot' END || '","original_topic":"' || topic || '","original_sub_topic":"' || sub_topic || '","remapped_topic":"' || to_topic || '"}}' AS payload,
  3::BIGINT AS config_id, 5::BIGINT AS group_id, 8::BIGINT AS run_id FROM m WHERE topic <> to_topic""",
}
