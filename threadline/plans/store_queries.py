"""Registered reads and writes of the segment store, its dimensions and its logs, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadline.operators import messages as ms
from threadline.operators import responses as rs
from threadline.operators import segments as sg
from threadline.operators import tables as tb
from threadline.operators import taxonomy as tx
from threadline.sources.views import EVENTS_SQL, event_messages, table

from .segment_queries import GRADERS_SQL, _defects, _segments_sql, segments
from .table_queries import TAXONOMY_SQL, _signals, _taxonomy
from .timeline_queries import chunked

C = F.col
LABELS = ["segment_id", "user_id", "topic", "sub_topic", "true_topic", "true_sub_topic", "summary"]


def _marked(spark, sf_dir):
    """Segments with review marks and summaries on some of them, dealt over four runs."""
    s = C("segment_id")
    mark = lambda x: F.when(s % 7 == 0, F.lit(x))
    return segments(spark, sf_dir).withColumns({"true_topic": mark("t"), "true_sub_topic": mark("s"), "summary": F.when(s % 3 != 0, F.concat(F.lit("about "), C("topic"))), "run_id": s % 4})


MARKED_SQL = f"""{_segments_sql()},
mk AS (SELECT *, CASE WHEN segment_id % 7 = 0 THEN 't' END AS true_topic, CASE WHEN segment_id % 7 = 0 THEN 's' END AS true_sub_topic,
  CASE WHEN segment_id % 3 <> 0 THEN 'about ' || topic END AS summary, segment_id % 4 AS run_id FROM seg_gt)"""
_LABELS = ", ".join(LABELS)


def _users(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(C("c_custkey").alias("user_id"))


def chat_lookup(spark, sf_dir):
    chats = table(spark, sf_dir, "events").select("user_id", C("user_id").alias("chat_id"))
    return tb.lookup(_users(spark, sf_dir), chats)


def no_chat(spark, sf_dir):
    return chat_lookup(spark, sf_dir).agg(F.count("*").alias("users"), F.count_if(C("chat_id").isNull()).alias("no_chat"))


def template_texts(spark, sf_dir):
    p, k, text = table(spark, sf_dir, "part"), C("p_partkey"), F.lit(None).cast("string")
    one = lambda a, b, c: F.struct(a.alias("message"), b.alias("text"), c.alias("content"))
    content = F.when(k % 5 == 0, F.array().cast("array<struct<message:string,text:string,content:string>>")).when(k % 7 == 0, F.array(one(F.lit(""), text, F.lit("")))).otherwise(
        F.array(one(F.lit(""), C("p_name"), C("p_type")), one(text, text, text), one(C("p_brand"), text, C("p_type")))
    )
    return tb.template_texts(p.select(k.alias("template_id"), content.alias("content"))).select("template_id", "full_text", F.size("texts").alias("n_texts"))


def signal_users(spark, sf_dir):
    """Distinct users of all matchings with a signal."""
    return _signals(spark, sf_dir).select(F.explode("users").alias("user_id")).distinct()


def filtered_segments(spark, sf_dir):
    return tb.filtered(_marked(spark, sf_dir), {"topic", "true_topic"}, topic="user", true_topic=None).select(*LABELS)


def unreviewed_of_users(spark, sf_dir):
    """Each user's first three unreviewed segments (a capped list)."""
    return tb.of_users(_marked(spark, sf_dir), False, 3).select("user_id", "segment_id", "nth")


def ground_truth(spark, sf_dir):
    return tb.ground_truth(_marked(spark, sf_dir)).select(*LABELS)


def summaries(spark, sf_dir):
    """Segments with a summary and a user, by run."""
    return _marked(spark, sf_dir).where("summary IS NOT NULL AND has_user").select("run_id", "segment_id", "summary")


def reviewed_users(spark, sf_dir):
    return _marked(spark, sf_dir).where("true_topic IS NOT NULL AND true_sub_topic IS NOT NULL").select("user_id").distinct()


def run_counts(spark, sf_dir):
    """Segments of each run, the number of its first one and the order of runs by their start."""
    n = _marked(spark, sf_dir).groupBy("run_id").agg(F.count("*").alias("n"), F.min("started_at").alias("started_at"))
    return n.withColumn("nth", F.row_number().over(Window.orderBy(F.asc_nulls_first("started_at"), "run_id")))  # a row per run


def run_rows(spark, sf_dir):
    return tb.with_run(_marked(spark, sf_dir).select("segment_id", "topic"), run_id=7, model="m1", temperature=0.2)


def quarantined(spark, sf_dir):
    rows, _, source = _defects(spark, sf_dir)
    return tb.invariants(rows, source)


def appended_segments(spark, sf_dir):
    rows, segs, source = _defects(spark, sf_dir)
    first = sg.bridge(chunked(spark, sf_dir)).groupBy("segment_id").agg(F.min_by("msg_id", F.struct("at_us", "msg_id")).alias("first_msg"))
    return tb.appended(segs, first, tb.invariants(rows, source)).select("segment_id", "user_id", "segment_key")


def remaining_segments(spark, sf_dir):
    """After the unreviewed segments of every second user and a list of ids are deleted."""
    rows = _marked(spark, sf_dir)
    left = tb.without(rows, users=rows.where("user_id % 2 = 0").select("user_id").distinct())
    return tb.without(left, ids=rows.where("segment_id % 11 = 0")).select(*LABELS)


def updated_clusters(spark, sf_dir):
    rows = _marked(spark, sf_dir).select("segment_id", F.lit("old").alias("cluster"))
    new = rows.where("segment_id % 2 = 0").select("segment_id", F.concat(F.lit("c"), (C("segment_id") % 5).cast("string")).alias("cluster"))
    return tb.update(rows, new, "segment_id", "cluster")


def segment_fingerprint(spark, sf_dir):
    return tb.fingerprint(_marked(spark, sf_dir).where("summary IS NOT NULL"), "segment_id")


def _named(spark, sf_dir):
    topics, subs = _taxonomy(spark, sf_dir)
    return topics.select("slug", C("type").alias("name"), "updated_at"), subs.select("topic_slug", "slug", F.lit("old").alias("name"), "updated_at")


def _batch(spark, sf_dir):
    """A batch of topics with nested sub-topics: known and new ones."""
    p = table(spark, sf_dir, "part")
    grouped = p.groupBy(F.lower("p_brand").alias("b"), F.lower("p_type").alias("t")).agg(F.max("p_partkey").alias("u"))
    batch = grouped.groupBy(F.when(C("u") % 2 == 0, C("t")).otherwise(C("b")).alias("slug")).agg(F.max("u").alias("updated_at"), F.array_sort(F.collect_set("b")).alias("brands"))
    one = lambda b: F.struct(b.alias("slug"), F.lit("new").alias("name"))
    return batch.select("slug", F.lit("batch").alias("name"), (C("updated_at") + 100_000).alias("updated_at"), F.transform("brands", one).alias("subs"))


BATCH_SQL = f"""{TAXONOMY_SQL},
gr AS (SELECT lower(p_brand) AS b, lower(p_type) AS t, max(p_partkey) AS u FROM part GROUP BY ALL),
bt AS (SELECT CASE WHEN u % 2 = 0 THEN t ELSE b END AS slug, max(u) + 100000 AS updated_at, list_sort(list_distinct(list(b))) AS brands FROM gr GROUP BY 1),
bs AS (SELECT slug AS topic_slug, unnest(brands) AS slug, updated_at FROM bt)"""


def batch_topics(spark, sf_dir):
    return tb.nested_upsert(*_named(spark, sf_dir), _batch(spark, sf_dir))[0]


def batch_subs(spark, sf_dir):
    return tb.nested_upsert(*_named(spark, sf_dir), _batch(spark, sf_dir))[1]


def touched_topics(spark, sf_dir):
    topics, subs = _named(spark, sf_dir)
    return tb.touched(topics, subs.where("updated_at % 3 = 0").withColumn("updated_at", C("updated_at") * 2))


def configs(spark, sf_dir):
    """Configurations by model and prompt versions: known ones and those asked for."""
    p, k = table(spark, sf_dir, "part"), C("p_size")
    prompt = lambda kind: tb.prompt_version(F.when(k % 3 == 0, F.concat(F.lit("bot_v"), k.cast("string"))).otherwise(F.concat(F.lit(f"label_prompt_{kind}_v"), k.cast("string"))))
    asked = p.select(C("p_brand").alias("model"), prompt("user").alias("user_prompt"), prompt("bot").alias("bot_prompt"))
    return tb.get_or_create(asked.where("user_prompt < 'v3'").distinct(), asked, ["model", "user_prompt", "bot_prompt"])


def run_groups(spark, sf_dir):
    """Groups by name, the newest first: a known name takes the new objective."""
    p = table(spark, sf_dir, "part")
    group = lambda rows, what: rows.groupBy(C("p_brand").alias("name")).agg(F.max("p_type").alias("objective"), F.max("p_partkey").alias("created_at")).withColumn("kind", F.lit(what))
    after = tb.upsert(group(p.where("p_size < 25"), "old"), group(p.where("p_size % 2 = 0"), "new"), ["name"], kept=["created_at"])
    return after.withColumn("nth", F.row_number().over(Window.orderBy(F.desc("created_at"), "name")))  # a row per group


def run_summaries(spark, sf_dir):
    """Run summaries under two keys: a run that is scored again keeps its group, configuration and creation."""
    o = table(spark, sf_dir, "orders")
    score = lambda rows: rows.groupBy((C("o_custkey") % 10).alias("group_id"), (C("o_orderkey") % 5).alias("config_id")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("created"))
    return tb.upsert(score(o.where("o_orderkey % 3 <> 0")), score(o.where("o_orderkey % 3 = 0")), ["group_id", "config_id"], kept=["created"])


def event_log(spark, sf_dir):
    """An event per remapped topic: what it was, what it is."""
    s = segments(spark, sf_dir).select("segment_id", C("topic").alias("from_topic"), tx.remap_bot_topic(C("topic"), {"user": "a"}, "other").alias("to_topic"), "sub_topic", "user_id")
    return tb.events(s.where("from_topic <> to_topic"), "topic_remap", ["from_topic", "to_topic", "sub_topic", "user_id"])


def regenerated(spark, sf_dir):
    source = table(spark, sf_dir, "orders").where("o_orderstatus IN ('F', 'P')").select(C("o_orderkey").alias("matching_id"))
    return tb.regenerated(source, _signals(spark, sf_dir), "matching_id")


def taxonomy_union(spark, sf_dir):
    topics, _ = _taxonomy(spark, sf_dir)
    return tx.union(topics, topics.where("length(slug) % 2 = 0").withColumn("type", F.lit("benchmark")))


def first_users(spark, sf_dir):
    """The first 50 users with segments (a limit that the caller sets)."""
    return segments(spark, sf_dir).select("user_id").distinct().orderBy("user_id").limit(50)


def sampled_users(spark, sf_dir):
    """A tenth of the users, drawn alike in every run."""
    return tb.user_sample(segments(spark, sf_dir).select("user_id").distinct(), 0.1, 7)


def top_sub_topics(spark, sf_dir):
    """The three commonest pairs of labels (a top-k report)."""
    n = segments(spark, sf_dir).groupBy("topic", "sub_topic").agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), "topic", "sub_topic").limit(3)


def broken_constraints(spark, sf_dir):
    _, segs, _ = _defects(spark, sf_dir)
    return tb.constraints(segs, {"confidence": C("confidence").between(0, 0.99), "topic": C("topic").isin(*ms.TIMELINE_TYPES), "order": C("started_at") <= C("ended_at"), "rate": C("response_rate").between(0, 1)})


def repeated_names(spark, sf_dir):
    return tb.repeated_keys(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


def message_constraints(spark, sf_dir):
    rows = event_messages(spark, sf_dir)
    return tb.constraints(rows, {"type": C("type").isin(*ms.TIMELINE_TYPES), "text": F.length("message") > 6, "chat": C("chat_id") == C("user_id")})


def _template_responses(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), C("p_partkey")
    body = F.concat(F.lit('{"topic": "'), F.when(k % 10 == 3, "").otherwise(F.lower("p_type")), F.lit('", "subTopic": "'), F.lower("p_brand"), F.lit('"'), F.when(k % 10 == 4, "").otherwise(F.concat(F.lit(', "summary": "'), C("p_name"), F.lit('"'))), F.lit("}"))
    text = F.when(k % 10 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k % 10 == 2, F.lit("none")).when(k % 10 == 5, F.lit('{"topic": }')).otherwise(body)
    return p.select(k.alias("template_id"), text.alias("response"))


def template_labels(spark, sf_dir):
    return rs.template_labels(_template_responses(spark, sf_dir))


TEMPLATE_SQL = """
tl AS (
  SELECT p_partkey AS template_id, CASE p_partkey % 10 WHEN 2 THEN 'no object' WHEN 5 THEN 'bad JSON' WHEN 3 THEN 'missing field' WHEN 4 THEN 'missing field' END AS reason,
    CASE WHEN p_partkey % 10 NOT IN (2, 3, 5) THEN lower(p_type) END AS topic, CASE WHEN p_partkey % 10 NOT IN (2, 5) THEN lower(p_brand) END AS sub_topic,
    CASE WHEN p_partkey % 10 NOT IN (2, 4, 5) THEN p_name END AS summary FROM part)"""


def _grown(spark, sf_dir):
    topics, subs = _taxonomy(spark, sf_dir)
    return tx.grown(topics.where("length(slug) % 3 > 0"), subs, rs.template_labels(_template_responses(spark, sf_dir)).where("reason IS NULL"))


def grown_topics(spark, sf_dir):
    return _grown(spark, sf_dir)[0]


def grown_subs(spark, sf_dir):
    return _grown(spark, sf_dir)[1]


QUERIES = {
    f.__name__: f
    for f in (
        chat_lookup, no_chat, template_texts, signal_users, filtered_segments, unreviewed_of_users, ground_truth, summaries, reviewed_users, run_counts, run_rows, quarantined, appended_segments, remaining_segments,
        updated_clusters, segment_fingerprint, batch_topics, batch_subs, touched_topics, configs, run_groups, run_summaries, event_log, regenerated, taxonomy_union, first_users, sampled_users, top_sub_topics,
        broken_constraints, repeated_names, message_constraints, template_labels, grown_topics, grown_subs,
    )
}

_LOST = """inv AS (
  SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(repeated, 0)::BIGINT AS repeated, coalesce(lost, 0)::BIGINT AS lost
  FROM (SELECT user_id, sum(n - 1)::BIGINT AS repeated FROM (SELECT user_id, segment_id, msg_id, count(*) AS n FROM br GROUP BY ALL) GROUP BY 1) a
  FULL JOIN (SELECT user_id, count(*) AS lost FROM timeline t WHERE NOT EXISTS (SELECT 1 FROM br WHERE br.user_id = t.user_id AND br.msg_id = t.msg_id) GROUP BY 1) b ON a.user_id = b.user_id),
failed AS (SELECT * FROM inv WHERE repeated > 0 OR lost > 0)"""
_CHATS = "SELECT c_custkey AS user_id, e.user_id AS chat_id FROM customer LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON e.user_id = c_custkey"
ORACLE_SQL = {
    "chat_lookup": _CHATS,
    "no_chat": f"SELECT count(*) AS users, count(*) FILTER (chat_id IS NULL) AS no_chat FROM ({_CHATS})",
    "template_texts": "SELECT p_partkey AS template_id, p_name || chr(10) || p_brand AS full_text, 2 AS n_texts FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0",
    "signal_users": """
WITH s AS (SELECT o_custkey AS u FROM orders WHERE o_orderstatus = 'F' OR (o_orderstatus = 'P' AND (starts_with(o_orderpriority, '2') OR o_orderkey % 2 = 0)))
SELECT u AS user_id FROM s UNION SELECT u + 1 FROM s""",
    "filtered_segments": f"{MARKED_SQL} SELECT {_LABELS} FROM mk WHERE topic = 'user' AND true_topic IS NULL",
    "unreviewed_of_users": f"{MARKED_SQL} SELECT user_id, segment_id, (row_number() OVER (PARTITION BY user_id ORDER BY started_at, segment_id))::INT AS nth FROM mk WHERE true_topic IS NULL QUALIFY nth <= 3",
    "ground_truth": f"{MARKED_SQL} SELECT {_LABELS} FROM mk WHERE true_topic IS NOT NULL",
    "summaries": f"{MARKED_SQL} SELECT run_id, segment_id, summary FROM mk WHERE summary IS NOT NULL AND has_user",
    "reviewed_users": f"{MARKED_SQL} SELECT DISTINCT user_id FROM mk WHERE true_topic IS NOT NULL",
    "run_counts": f"{MARKED_SQL}, n AS (SELECT run_id, count(*) AS n, min(started_at) AS started_at FROM mk GROUP BY 1) SELECT *, (row_number() OVER (ORDER BY started_at, run_id))::INT AS nth FROM n",
    "run_rows": f"{MARKED_SQL} SELECT segment_id, topic, 7 AS run_id, 'm1' AS model, 0.2::DOUBLE AS temperature FROM mk",
    "quarantined": f"{GRADERS_SQL}, {_LOST} SELECT * FROM failed",
    "appended_segments": f"""{GRADERS_SQL}, {_LOST},
fm AS (SELECT segment_id, arg_min(msg_id, (at_us, msg_id)) AS first_msg FROM ans_gt GROUP BY 1)
SELECT segment_id, user_id, sha256(user_id || '|' || first_msg || '|' || coalesce(topic, '') || '|' || coalesce(sub_topic, '')) AS segment_key
FROM sd JOIN fm USING (segment_id) WHERE user_id NOT IN (SELECT user_id FROM failed)""",
    "remaining_segments": f"{MARKED_SQL} SELECT {_LABELS} FROM mk WHERE segment_id % 11 <> 0 AND (user_id % 2 <> 0 OR true_topic IS NOT NULL)",
    "updated_clusters": f"{MARKED_SQL} SELECT segment_id, CASE WHEN segment_id % 2 = 0 THEN 'c' || (segment_id % 5) ELSE 'old' END AS cluster FROM mk",
    "segment_fingerprint": f"{MARKED_SQL} SELECT count(*) AS n, bit_xor(('0x' || md5(segment_id::VARCHAR)[1:15])::BIGINT) AS digest FROM mk WHERE summary IS NOT NULL",
    "batch_topics": f"""WITH {BATCH_SQL}
SELECT coalesce(t.slug, b.slug) AS slug, CASE WHEN b.slug IS NULL THEN t.type ELSE 'batch' END AS name, coalesce(b.updated_at, t.updated_at) AS updated_at FROM topics t FULL JOIN bt b ON t.slug = b.slug""",
    "batch_subs": f"""WITH {BATCH_SQL}
SELECT coalesce(s.topic_slug, b.topic_slug) AS topic_slug, coalesce(s.slug, b.slug) AS slug, CASE WHEN b.slug IS NULL THEN 'old' ELSE 'new' END AS name, coalesce(b.updated_at, s.updated_at) AS updated_at
FROM subs s FULL JOIN bs b ON s.topic_slug = b.topic_slug AND s.slug = b.slug""",
    "touched_topics": f"""WITH {TAXONOMY_SQL}
SELECT t.slug, t.type AS name, greatest(t.updated_at, coalesce(u, t.updated_at)) AS updated_at
FROM topics t LEFT JOIN (SELECT topic_slug, max(updated_at * 2) AS u FROM subs WHERE updated_at % 3 = 0 GROUP BY 1) s ON s.topic_slug = t.slug""",
    "configs": "SELECT DISTINCT p_brand AS model, 'v' || p_size AS user_prompt, 'v' || p_size AS bot_prompt, NOT ('v' || p_size) < 'v3' AS created FROM part",
    "run_groups": """
WITH o AS (SELECT p_brand AS name, max(p_type) AS objective, max(p_partkey) AS created_at FROM part WHERE p_size < 25 GROUP BY 1),
n AS (SELECT p_brand AS name, max(p_type) AS objective, max(p_partkey) AS created_at FROM part WHERE p_size % 2 = 0 GROUP BY 1),
g AS (SELECT coalesce(o.name, n.name) AS name, coalesce(n.objective, o.objective) AS objective, coalesce(o.created_at, n.created_at) AS created_at, CASE WHEN n.name IS NULL THEN 'old' ELSE 'new' END AS kind FROM o FULL JOIN n ON o.name = n.name)
SELECT *, (row_number() OVER (ORDER BY created_at DESC, name))::INT AS nth FROM g""",
    "run_summaries": """
WITH s AS (SELECT o_custkey % 10 AS group_id, o_orderkey % 5 AS config_id, o_orderkey % 3 = 0 AS again, count(*) AS n, min(o_orderkey) AS created FROM orders GROUP BY ALL)
SELECT coalesce(a.group_id, b.group_id) AS group_id, coalesce(a.config_id, b.config_id) AS config_id, coalesce(b.n, a.n) AS n, coalesce(a.created, b.created) AS created
FROM (SELECT * FROM s WHERE NOT again) a FULL JOIN (SELECT * FROM s WHERE again) b ON a.group_id = b.group_id AND a.config_id = b.config_id""",
    "event_log": f"""{_segments_sql()}, m AS (SELECT *, CASE WHEN topic = 'user' THEN 'a' ELSE 'other' END AS to_topic FROM seg_gt)
SELECT segment_id, 'topic_remap' AS event, '{{"from_topic":"' || topic || '","to_topic":"' || to_topic || '","sub_topic":"' || sub_topic || '","user_id":' || user_id || '}}' AS payload FROM m""",
    "regenerated": """
WITH q AS (SELECT count(*) AS queried, count(*) FILTER (o_orderstatus = 'F' OR starts_with(o_orderpriority, '2') OR o_orderkey % 2 = 0) AS written FROM orders WHERE o_orderstatus IN ('F', 'P'))
SELECT *, queried - written AS skipped FROM q""",
    "taxonomy_union": f"WITH {TAXONOMY_SQL} SELECT * FROM topics UNION ALL SELECT slug, 'benchmark', updated_at FROM topics WHERE length(slug) % 2 = 0",
    "first_users": f"{_segments_sql()} SELECT DISTINCT user_id FROM seg_gt ORDER BY user_id LIMIT 50",
    "sampled_users": f"{_segments_sql()}, u AS (SELECT DISTINCT user_id FROM seg_gt) SELECT user_id FROM u QUALIFY row_number() OVER (ORDER BY md5(user_id || ':7'), user_id) <= greatest(1, floor((SELECT count(*) FROM u) * 0.1))",
    "top_sub_topics": f"{_segments_sql()} SELECT topic, sub_topic, count(*) AS n FROM seg_gt GROUP BY ALL ORDER BY n DESC, topic, sub_topic LIMIT 3",
    "broken_constraints": f"""{GRADERS_SQL}
SELECT 'confidence' AS "check", count(*) FILTER (confidence > 0.99) AS broken FROM sd UNION ALL SELECT 'topic', count(*) FILTER (topic = 'system') FROM sd
UNION ALL SELECT 'order', count(*) FILTER (started_at > ended_at) FROM sd UNION ALL SELECT 'rate', count(*) FILTER (response_rate < 0 OR response_rate > 1) FROM sd""",
    "repeated_names": "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1",
    "message_constraints": f"""WITH {EVENTS_SQL}
SELECT 'type' AS "check", count(*) FILTER (type = 'system') AS broken FROM msgs_all UNION ALL SELECT 'text', count(*) FILTER (length(message) <= 6) FROM msgs_all
UNION ALL SELECT 'chat', count(*) FILTER (chat_id <> user_id) FROM msgs_all""",
    "template_labels": f"WITH {TEMPLATE_SQL} SELECT * FROM tl",
    "grown_topics": f"""WITH {TAXONOMY_SQL}, {TEMPLATE_SQL}
SELECT topic AS slug, min(summary) AS description FROM tl WHERE reason IS NULL AND topic NOT IN (SELECT slug FROM topics WHERE length(slug) % 3 > 0) GROUP BY 1""",
    "grown_subs": f"""WITH {TAXONOMY_SQL}, {TEMPLATE_SQL}
SELECT topic AS topic_slug, sub_topic AS slug, min(summary) AS description FROM tl WHERE reason IS NULL AND (topic, sub_topic) NOT IN (SELECT (topic_slug, slug) FROM subs) GROUP BY ALL""",
}
