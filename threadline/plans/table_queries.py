"""Registered queries on responses, tables, taxonomies, signals, clusters and analytics, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadline.operators import chunks as ch
from threadline.operators import cluster as cl
from threadline.operators import fuzzy as fz
from threadline.operators import messages as ms
from threadline.operators import responses as rs
from threadline.operators import segments as sg
from threadline.operators import signals as sn
from threadline.operators import tables as tb
from threadline.operators import taxonomy as tx
from threadline.sources.views import EVENTS_SQL, TURNS_SQL, event_messages, micros, table, turns

from .segment_queries import _segments_sql, segments


# --- responses -------------------------------------------------------------------------


def _responses(spark, sf_dir):
    """Responses made from conversations: one item per conversation, with faults by conv_id."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    c = F.col("conv_id")
    conf = F.when(c % 10 == 5, "1.2").otherwise("0.5")
    index = F.when(c % 10 == 4, F.col("n").cast("string")).otherwise("0")
    item = F.concat(F.lit('{"topic": "'), F.when(c % 10 == 6, "").otherwise("t"), F.lit('", "subTopic": "s'), (c % 3).cast("string"), F.lit('", '), F.when(c % 10 == 3, "").otherwise('"summary": "x", '), F.lit('"messageIndices": ['), index, F.lit('], "confidence": '), conf, F.lit(', "sentiment": "'), F.when(c % 2 == 0, "Positive").otherwise("odd"), F.lit('"}'))
    text = F.concat(F.lit('{"segments": ['), item, F.lit("]}"))
    text = F.when(c % 10 == 1, F.concat(F.lit("```json\n"), text, F.lit("\n```"))).when(c % 10 == 2, F.lit('{"segments": [')).when(c % 10 == 7, F.lit('{"segments": [}')).when(c % 10 == 8, F.lit('{"other": 1}')).otherwise(text)
    return rows.select(c.alias("window_id"), F.col("n").cast("int").alias("n_msgs"), text.alias("response"))


def responses(spark, sf_dir):
    out = rs.parsed(_responses(spark, sf_dir)).where("reason IS NULL")
    return out.select("window_id", "topic", "sub_topic", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"), "confidence", "sentiment")


def rejects(spark, sf_dir):
    return rs.parsed(_responses(spark, sf_dir)).where("reason IS NOT NULL").select("window_id", "item_no", "reason")


# --- members of several segments, and of none ---------------------------------------------


def _members(spark, sf_dir):
    rows = ch.windows(turns(spark, sf_dir), 0).select(F.col("chat_id").alias("window_id"), "msg_id", "type", "pos")
    a = rows.withColumn("segment_no", F.expr("pos div 3").cast("long"))
    return a.unionByName(a.where("msg_id % 2 = 0").withColumn("segment_no", F.col("segment_no") + 1))


def one_owner(spark, sf_dir):
    return sg.one_owner(_members(spark, sf_dir)).select("window_id", "msg_id", "segment_no")


def orphans(spark, sf_dir):
    rows = ch.windows(turns(spark, sf_dir), 0).select(F.col("chat_id").alias("window_id"), "msg_id", "pos")
    members = rows.where("pos % 4 IN (1, 2)").withColumn("segment_no", F.expr("pos div 2").cast("long"))
    return sg.with_orphans(members, rows.select("window_id", "pos"))


# --- tables -------------------------------------------------------------------------------


def upserted(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.where("c_custkey % 3 <> 0").select("c_custkey", "c_name", "c_mktsegment", F.lit("a").alias("created_by"))
    new = c.where("c_custkey % 2 = 0").select("c_custkey", "c_name", F.lower("c_mktsegment").alias("c_mktsegment"), F.lit("b").alias("created_by"))
    return tb.upsert(old, new, ["c_custkey"], kept=["created_by"])


def inserted(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return tb.insert_missing(c.where("c_custkey % 3 = 0"), c.withColumn("c_name", F.upper("c_name")), ["c_custkey"])


def relabelled(spark, sf_dir):
    s = segments(spark, sf_dir).select("segment_id", "topic", "sub_topic", "confidence", F.when(F.col("segment_id") % 7 == 0, "t").alias("true_topic"), F.when(F.col("segment_id") % 7 == 0, "s").alias("true_sub_topic"))
    return tb.relabel(s, ["topic", "sub_topic", "confidence"])


def foreign_keys(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0")
    return tb.orphans(o, c, [("o_custkey", "c_custkey")]).groupBy("o_custkey").agg(F.count("*").alias("n"))


# --- taxonomies ----------------------------------------------------------------------------


def _taxonomy(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    topics = p.groupBy(F.lower("p_type").alias("slug")).agg(F.max("p_partkey").alias("updated_at"), F.min("p_size").alias("_s")).select("slug", F.when(F.col("slug") < "m", "user").otherwise("bot").alias("type"), "updated_at")
    subs = p.groupBy(F.lower("p_type").alias("topic_slug"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("slug")).agg(F.max("p_partkey").alias("updated_at"))
    return topics, subs


TAXONOMY_SQL = """
topics AS (SELECT lower(p_type) AS slug, CASE WHEN lower(p_type) < 'm' THEN 'user' ELSE 'bot' END AS type, max(p_partkey) AS updated_at FROM part GROUP BY 1, 2),
subs AS (SELECT lower(p_type) AS topic_slug, replace(p_name, ' ', '_') AS slug, max(p_partkey) AS updated_at FROM part GROUP BY 1, 2),
typed AS (SELECT s.slug, s.topic_slug, t.type FROM subs s JOIN topics t ON t.slug = s.topic_slug)"""


def taxonomy_freshness(spark, sf_dir):
    return tx.freshness(*_taxonomy(spark, sf_dir))


def taxonomy_nested(spark, sf_dir):
    return tx.nested(*_taxonomy(spark, sf_dir))


def taxonomy_conflicts(spark, sf_dir):
    return tx.conflicts(*_taxonomy(spark, sf_dir))


def taxonomy_admitted(spark, sf_dir):
    topics, subs = _taxonomy(spark, sf_dir)
    p = table(spark, sf_dir, "part")
    new = p.select(F.lower("p_type").alias("topic"), F.concat(F.lower("p_brand"), F.lit("_"), (F.col("p_size") % 5).cast("string")).alias("sub_topic")).unionAll(p.select(F.lower("p_brand"), F.replace("p_name", F.lit(" "), F.lit("_"))))
    return tx.admitted(new, topics, subs, "user")


def pool_topics(spark, sf_dir):
    topics, _ = _taxonomy(spark, sf_dir)
    pools = table(spark, sf_dir, "customer").select(F.lower("c_mktsegment").alias("pool")).distinct()
    allowed = topics.select("slug").where(F.length("slug") % 2 == 0).crossJoin(F.broadcast(pools.where(F.length("pool") > 8)))
    return tx.for_pool(topics, pools, allowed)


def remapped(spark, sf_dir):
    k = F.concat(F.col("event_type"), F.lit("_"), (F.col("event_id") % 3).cast("string"))
    topic = F.when(F.col("event_type") == "view", F.concat(F.lit("event_"), k)).otherwise(k)
    return table(spark, sf_dir, "events").select("event_id", tx.remap_bot_topic(topic, {"click_0": "a", "click_1": "b"}, "other").alias("topic"))


def closest_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    known = p.select(F.lower("p_type").alias("topic"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("sub_topic")).distinct()
    asked = known.withColumn("sub_topic", F.concat(F.expr("substring(sub_topic, 2)"), F.lit("s")))
    return fz.closest_by_edits(asked, known).select("topic", "sub_topic", "known", F.round("similarity", 6).alias("similarity"))


def planted_templates(rows):
    """Templates out of automated texts, by the length of the text: the text itself, without its last tenth, with an ending, or its first two fifths."""
    texts = rows.where("type = 'automated' AND message <> ''").groupBy("message").agg(F.min("msg_id").alias("template_id"))
    n = F.length("message")
    cut = lambda k: F.expr(f"substring(message, 1, cast(length(message) as int) - cast(floor(length(message) / {k}) as int))")
    text = F.when(n % 4 == 0, F.col("message")).when(n % 4 == 1, cut(10)).when(n % 4 == 2, F.concat("message", F.lit(" See you there!"))).otherwise(F.expr("substring(message, 1, cast(floor(length(message) * 0.4) as int))"))
    return texts.select("template_id", text.alias("template"))


def template_matches(spark, sf_dir):
    rows = turns(spark, sf_dir)
    return fz.template_matches(rows.select("type", "message"), planted_templates(rows))


TEMPLATE_MATCHES_SQL = f"""
WITH {TURNS_SQL},
t AS (
  SELECT message, min(msg_id) AS template_id, length(message) AS n, length(message) - CASE length(message) % 4 WHEN 1 THEN length(message) // 10 ELSE 0 END AS m
  FROM turns WHERE type = 'automated' AND message <> '' GROUP BY message)
SELECT message, template_id, CASE WHEN n % 4 = 2 THEN 2.0 * n / (2 * n + 15) ELSE 2.0 * m / (n + m) END::DOUBLE AS ratio
FROM t WHERE n % 4 <> 3 AND (n % 4 <> 2 OR 2.0 * n / (2 * n + 15) >= 0.75)"""


# --- signals -------------------------------------------------------------------------------


def _signals(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", sn.EXCHANGED).when(F.col("o_orderstatus") == "P", sn.REFUSED).otherwise("Open")
    first = F.when(F.col("o_orderpriority").startswith("1"), "accepted").when(F.col("o_orderpriority").startswith("2"), "rejected")
    second = F.when(F.col("o_orderkey") % 2 == 0, "rejected").otherwise("accepted")
    return sn.classify(o.select(F.col("o_orderkey").alias("matching_id"), F.array(F.col("o_custkey"), F.col("o_custkey") + 1).alias("users"), status.alias("status"), F.array(first, second).alias("acceptance")))


def user_signals(spark, sf_dir):
    return sn.per_user(_signals(spark, sf_dir))


def signal_totals(spark, sf_dir):
    return sn.totals(_signals(spark, sf_dir))


SIGNALS_SQL = f"""
o AS (
  SELECT o_orderkey AS matching_id, o_custkey AS u, CASE o_orderstatus WHEN 'F' THEN '{sn.EXCHANGED}' WHEN 'P' THEN '{sn.REFUSED}' ELSE 'Open' END AS status,
    CASE WHEN starts_with(o_orderpriority, '1') THEN 'accepted' WHEN starts_with(o_orderpriority, '2') THEN 'rejected' END AS a, CASE WHEN o_orderkey % 2 = 0 THEN 'rejected' ELSE 'accepted' END AS b
  FROM orders),
s AS (SELECT * FROM o WHERE status = '{sn.EXCHANGED}' OR (status = '{sn.REFUSED}' AND (coalesce(a, '') = 'rejected' OR b = 'rejected'))),
us AS (
  SELECT matching_id, status, u AS user_id, CASE WHEN status = '{sn.EXCHANGED}' OR coalesce(a, '') = 'accepted' THEN 'TP' ELSE 'FP' END AS signal FROM s
  UNION ALL SELECT matching_id, status, u + 1, CASE WHEN status = '{sn.EXCHANGED}' OR b = 'accepted' THEN 'TP' ELSE 'FP' END FROM s)"""


# --- clusters ------------------------------------------------------------------------------


def cohesion(spark, sf_dir):
    return cl.cohesion(table(spark, sf_dir, "embeddings"), "label")


def separation(spark, sf_dir):
    return cl.separation(table(spark, sf_dir, "embeddings"), "label")


def density_clusters(spark, sf_dir):
    return cl.density(table(spark, sf_dir, "embeddings"), k=5, eps=0.75)


def _clustered(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.when(F.col("vec_id") % 11 != 0, F.col("vec_id") % 7).alias("cluster"), F.concat(F.lit("t"), (F.col("label") % 4).cast("string")).alias("topic"), F.concat(F.lit("s"), F.col("label").cast("string")).alias("sub_topic"))


def majority_labels(spark, sf_dir):
    return cl.majority(_clustered(spark, sf_dir))


def cluster_agreement(spark, sf_dir):
    rows = _clustered(spark, sf_dir)
    return cl.agreement(rows, cl.majority(rows))


CLUSTERED_SQL = """
cd AS (SELECT vec_id, CASE WHEN vec_id % 11 <> 0 THEN vec_id % 7 END AS cluster, 't' || (label % 4) AS topic, 's' || label AS sub_topic FROM embeddings),
cn AS (SELECT cluster, topic, sub_topic, count(*) AS n FROM cd WHERE cluster IS NOT NULL GROUP BY ALL),
mj AS (SELECT cluster, topic, sub_topic, (sum(n) OVER (PARTITION BY cluster))::BIGINT AS size, n / sum(n) OVER (PARTITION BY cluster) AS purity FROM cn
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, topic, sub_topic) = 1)"""


# --- analytics -----------------------------------------------------------------------------


def topic_rates(spark, sf_dir):
    s = segments(spark, sf_dir)
    return s.groupBy("topic").agg(F.count("*").alias("n"), F.round(F.avg("response_rate"), 6).alias("response_rate"), F.round(F.avg(F.col("has_failure").cast("double")), 6).alias("failure_rate"))


def tier_shares(spark, sf_dir):
    s = segments(spark, sf_dir)
    tier = F.when(F.col("has_user"), "user").when(F.col("topic") == "automated", "automated").otherwise("mixed_bot")
    return s.groupBy(tier.alias("tier")).agg(F.count("*").alias("n"), F.sum("n_messages").alias("messages"))


def cohort_lift(spark, sf_dir):
    """Share of each topic within a cohort of users over its share overall."""
    s = segments(spark, sf_dir).withColumn("cohort", F.col("user_id") % 3)
    n = s.groupBy("cohort", "topic").agg(F.count("*").alias("n"))
    of_cohort, of_topic, all_rows = Window.partitionBy("cohort"), Window.partitionBy("topic"), n.agg(F.sum("n").alias("total"))
    n = n.withColumn("in_cohort", F.sum("n").over(of_cohort)).withColumn("in_topic", F.sum("n").over(of_topic)).crossJoin(F.broadcast(all_rows))
    return n.select("cohort", "topic", "n", F.round((F.col("n") / F.col("in_cohort")) / (F.col("in_topic") / F.col("total")), 6).alias("lift"))


def user_features(spark, sf_dir):
    s = segments(spark, sf_dir)
    wide = s.groupBy("user_id").pivot("topic", ["user", "assistant", "automated", "team", "system"]).agg(F.count(F.lit(1))).na.fill(0)
    stats = s.groupBy("user_id").agg(F.count("*").alias("n_segments"), F.round(F.avg("response_rate"), 6).alias("avg_response"))
    return wide.join(stats, "user_id")


def funnel(spark, sf_dir):
    """Users that reach each step after the one before it (first times in order)."""
    e = table(spark, sf_dir, "events")
    first = lambda kind: F.min(F.when(F.col("event_type") == kind, micros(F.col("ts"))))
    u = e.groupBy("user_id").agg(first("signup").alias("a"), first("view").alias("b"), first("purchase").alias("c"))
    steps = F.array(F.lit("signup"), F.when(F.col("b") > F.col("a"), "view"), F.when((F.col("b") > F.col("a")) & (F.col("c") > F.col("b")), "purchase"))
    return u.where("a IS NOT NULL").select(F.explode(F.filter(steps, lambda x: x.isNotNull())).alias("step")).groupBy("step").agg(F.count("*").alias("users"))


def snapshots(spark, sf_dir):
    """Running credit of each user after each event."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    credit = F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "error", -1).otherwise(0)
    return table(spark, sf_dir, "events").select("event_id", "user_id", F.sum(credit).over(w).alias("credit"), F.row_number().over(w).alias("version"))


def daily_failures(spark, sf_dir):
    day = F.expr(f"at_us div {ms.DAY}")
    rows = ms.unanswered(ms.timeline(event_messages(spark, sf_dir)))
    return rows.groupBy(day.alias("day")).agg(F.count("*").alias("messages"), F.count_if("unanswered").alias("failures"))


def dormancy(spark, sf_dir):
    """Users' returns after at least five days without a message."""
    w = Window.partitionBy("user_id").orderBy("at_us", "msg_id")
    rows = ms.timeline(event_messages(spark, sf_dir)).withColumn("gap", F.col("at_us") - F.lag("at_us").over(w))
    return rows.where(F.col("gap") >= 5 * ms.DAY).select("msg_id", "user_id", "gap")


def escalations(spark, sf_dir):
    """The messages at which a user's third error within a week is reached."""
    w = Window.partitionBy("user_id").orderBy("at_us").rangeBetween(-7 * ms.DAY, 0)
    rows = event_messages(spark, sf_dir).where("type = 'system'").withColumn("recent", F.count("*").over(w))
    return rows.where("recent >= 3").select("msg_id", "user_id", "recent")


def chat_sizes(spark, sf_dir):
    n = ms.timeline(event_messages(spark, sf_dir)).groupBy("chat_id").agg(F.count("*").alias("n"))
    band = F.when(F.col("n") < 5, "1-4").when(F.col("n") < 20, "5-19").when(F.col("n") < 50, "20-49").when(F.col("n") < 200, "50-199").otherwise("200+")
    return n.groupBy(band.alias("size")).agg(F.count("*").alias("chats"), F.sum("n").alias("messages"))


def latest_segments(spark, sf_dir):
    """Each user's segment that started last."""
    w = Window.partitionBy("user_id").orderBy(F.desc_nulls_first("started_at"), "segment_id")
    return segments(spark, sf_dir).withColumn("_n", F.row_number().over(w)).where("_n = 1").select("user_id", "segment_id", "started_at", "ended_at")


def topic_distribution(spark, sf_dir):
    s = segments(spark, sf_dir)
    return s.groupBy("topic").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("sub_topic")), ",").alias("sub_topics"), F.round(F.avg("confidence"), 6).alias("confidence"))


def quality_metrics(spark, sf_dir):
    s = segments(spark, sf_dir).withColumn("noise", F.col("segment_id") % 5 == 0)
    return s.agg(
        F.count("*").alias("total"), F.count("topic").alias("labelled"), F.count_if("noise").alias("noise"), F.count_distinct("topic").alias("topics"),
        F.count_if(F.least(F.when(F.col("noise"), 0.0).otherwise(0.9), F.coalesce("confidence", F.lit(0.0))) < 0.6).alias("low_confidence"),
    )


def field_profile(spark, sf_dir):
    """Share of filled values per field, overall and over the 200 newest rows (a fixed report)."""
    e = event_messages(spark, sf_dir)
    fields = ["type", "message", "at_us"]
    shares = lambda rows, name: rows.agg(*[F.round(F.count(c) / F.count("*"), 6).alias(c) for c in fields]).unpivot([], fields, "field", name)
    newest = e.orderBy(F.desc("at_us"), "msg_id").limit(200)
    return shares(e, "overall").join(shares(newest, "newest"), "field")


QUERIES = {
    f.__name__: f
    for f in (
        responses, rejects, one_owner, orphans, upserted, inserted, relabelled, foreign_keys, taxonomy_freshness, taxonomy_nested, taxonomy_conflicts, taxonomy_admitted, pool_topics, remapped,
        closest_names, template_matches, user_signals, signal_totals, cohesion, separation, density_clusters, majority_labels, cluster_agreement, topic_rates, tier_shares, cohort_lift, user_features, funnel, snapshots,
        daily_failures, dormancy, escalations, chat_sizes, latest_segments, topic_distribution, quality_metrics, field_profile,
    )
}

_SEG = _segments_sql()
_TL = f"WITH {EVENTS_SQL}"
ORACLE_SQL = {
    "template_matches": TEMPLATE_MATCHES_SQL,
    "responses": """
WITH r AS (SELECT conv_id AS w, count(*) AS n FROM conversations GROUP BY 1)
SELECT w AS window_id, 't' AS topic, 's' || (w % 3) AS sub_topic, '0' AS indices, CASE WHEN w % 10 = 5 THEN 0.99 ELSE 0.5 END::DOUBLE AS confidence, CASE WHEN w % 2 = 0 THEN 'positive' ELSE 'neutral' END AS sentiment
FROM r WHERE w % 10 IN (0, 1, 5, 9)""",
    "rejects": """
SELECT DISTINCT conv_id AS window_id, CASE WHEN conv_id % 10 IN (2, 7, 8) THEN -1 ELSE 0 END AS item_no,
  CASE conv_id % 10 WHEN 2 THEN 'no object' WHEN 7 THEN 'bad JSON' WHEN 8 THEN 'no list' WHEN 3 THEN 'missing field' WHEN 4 THEN 'no valid index' ELSE 'empty label' END AS reason
FROM conversations WHERE conv_id % 10 IN (2, 3, 4, 6, 7, 8)""",
    "one_owner": f"""WITH {TURNS_SQL},
p AS (SELECT chat_id AS window_id, msg_id, type, row_number() OVER (PARTITION BY chat_id ORDER BY at_us, msg_id) - 1 AS pos FROM turns),
m AS (SELECT *, pos // 3 AS segment_no FROM p UNION ALL SELECT *, pos // 3 + 1 FROM p WHERE msg_id % 2 = 0),
s AS (SELECT *, count(*) OVER (PARTITION BY window_id, segment_no ORDER BY pos RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) - 1 AS near FROM m)
SELECT window_id, msg_id, segment_no FROM s QUALIFY type = 'user' OR row_number() OVER (PARTITION BY window_id, msg_id ORDER BY near DESC, segment_no) = 1""",
    "orphans": f"""WITH {TURNS_SQL},
p AS (SELECT chat_id AS window_id, row_number() OVER (PARTITION BY chat_id ORDER BY at_us, msg_id) - 1 AS pos FROM turns),
o AS (SELECT *, CASE WHEN pos % 4 IN (1, 2) THEN pos // 2 END AS own FROM p),
n AS (
  SELECT *, max(CASE WHEN own IS NOT NULL THEN pos END) OVER (PARTITION BY window_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
    min(CASE WHEN own IS NOT NULL THEN pos END) OVER (PARTITION BY window_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM o)
SELECT window_id, pos, coalesce(own, CASE WHEN l IS NULL THEN r // 2 WHEN r IS NULL OR pos <> r - 1 THEN l // 2 ELSE least(l // 2, r // 2) END) AS segment_no, own IS NULL AS orphan FROM n""",
    "upserted": """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 3 <> 0 THEN 'a' ELSE 'b' END AS created_by
FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0""",
    "inserted": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE upper(c_name) END AS c_name FROM customer",
    "relabelled": f"""{_SEG} SELECT segment_id, CASE WHEN segment_id % 7 = 0 THEN topic END AS topic, CASE WHEN segment_id % 7 = 0 THEN sub_topic END AS sub_topic,
  CASE WHEN segment_id % 7 = 0 THEN confidence END AS confidence, CASE WHEN segment_id % 7 = 0 THEN 't' END AS true_topic, CASE WHEN segment_id % 7 = 0 THEN 's' END AS true_sub_topic FROM seg_gt""",
    "foreign_keys": "SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0) GROUP BY 1",
    "taxonomy_freshness": f"WITH {TAXONOMY_SQL} SELECT type, max(greatest(t.updated_at, coalesce(s.u, t.updated_at))) AS freshest FROM topics t LEFT JOIN (SELECT topic_slug, max(updated_at) AS u FROM subs GROUP BY 1) s ON s.topic_slug = t.slug GROUP BY type",
    "taxonomy_nested": f"WITH {TAXONOMY_SQL} SELECT t.slug, t.type, coalesce(string_agg(s.slug, ' | ' ORDER BY s.slug), '') AS options FROM topics t LEFT JOIN subs s ON s.topic_slug = t.slug GROUP BY ALL",
    "taxonomy_conflicts": f"WITH {TAXONOMY_SQL} SELECT slug, count(*) AS uses FROM (SELECT slug FROM topics UNION ALL SELECT slug FROM subs) GROUP BY slug HAVING count(*) > 1",
    "taxonomy_admitted": f"""WITH {TAXONOMY_SQL},
c AS (SELECT DISTINCT * FROM (SELECT lower(p_type) AS topic, lower(p_brand) || '_' || (p_size % 5) AS sub_topic FROM part UNION ALL SELECT lower(p_brand), replace(p_name, ' ', '_') FROM part)),
other AS (SELECT slug FROM topics WHERE type <> 'user' UNION SELECT slug FROM typed WHERE type <> 'user'),
ok AS (SELECT * FROM c WHERE topic NOT IN (SELECT slug FROM other) AND sub_topic NOT IN (SELECT slug FROM other)
  AND sub_topic NOT IN (SELECT slug FROM topics WHERE type = 'user') AND topic NOT IN (SELECT slug FROM typed WHERE type = 'user'))
SELECT min(topic) AS topic, sub_topic FROM ok GROUP BY sub_topic""",
    "pool_topics": f"""WITH {TAXONOMY_SQL},
pools AS (SELECT DISTINCT lower(c_mktsegment) AS pool FROM customer)
SELECT pool, slug FROM pools, topics WHERE length(pool) <= 8 OR length(slug) % 2 = 0""",
    "remapped": """
WITH k AS (SELECT event_id, event_type, event_type || '_' || (event_id % 3) AS t FROM events)
SELECT event_id, CASE WHEN t = 'click_0' THEN 'a' WHEN t = 'click_1' THEN 'b' WHEN event_type = 'view' THEN 'event_inquiry' ELSE 'other' END AS topic FROM k""",
    "closest_names": """
WITH known AS (SELECT DISTINCT lower(p_type) AS topic, replace(p_name, ' ', '_') AS k FROM part),
a AS (SELECT DISTINCT topic, k[2:] || 's' AS sub_topic FROM known),
j AS (SELECT a.topic, a.sub_topic, k AS known, 1 - levenshtein(a.sub_topic, k) / greatest(length(a.sub_topic), length(k)) AS s FROM a JOIN known USING (topic) WHERE least(length(a.sub_topic), length(k)) >= 0.5 * greatest(length(a.sub_topic), length(k)))
SELECT topic, sub_topic, known, round(s, 6) AS similarity FROM j WHERE s >= 0.5 QUALIFY row_number() OVER (PARTITION BY topic, sub_topic ORDER BY s DESC, known) = 1""",
    "user_signals": f"WITH {SIGNALS_SQL} SELECT matching_id, status, user_id, signal FROM us",
    "signal_totals": f"WITH {SIGNALS_SQL} SELECT status, signal, count(*) AS n, count(DISTINCT user_id) AS users FROM us GROUP BY ALL",
    "cohesion": """
WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings), s AS (SELECT label, i, sum(x) AS s FROM e GROUP BY ALL),
q AS (SELECT label, sum(s * s) AS q FROM s GROUP BY 1), n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT label, n, CASE WHEN n > 1 THEN round((q - n) / (n * (n - 1)), 6) END AS cohesion FROM q JOIN n USING (label)""",
    "separation": """
WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings), s AS (SELECT label, i, sum(x) AS s FROM e GROUP BY ALL),
n AS (SELECT label, sqrt(sum(s * s)) AS n FROM s GROUP BY 1)
SELECT a.label AS a, b.label AS b, round(sum(a.s * b.s) / (any_value(x.n) * any_value(y.n)), 6) AS cosine
FROM s a JOIN s b ON a.i = b.i AND a.label < b.label JOIN n x ON x.label = a.label JOIN n y ON y.label = b.label GROUP BY ALL""",
    "majority_labels": f"WITH {CLUSTERED_SQL} SELECT * FROM mj",
    "cluster_agreement": f"WITH {CLUSTERED_SQL} SELECT count(*) AS n, avg((cd.topic = mj.topic)::INT) AS agreement FROM cd JOIN mj USING (cluster)",
    "topic_rates": f"{_SEG} SELECT topic, count(*) AS n, round(avg(response_rate), 6) AS response_rate, round(avg(has_failure::INT), 6) AS failure_rate FROM seg_gt GROUP BY topic",
    "tier_shares": f"{_SEG} SELECT CASE WHEN has_user THEN 'user' WHEN topic = 'automated' THEN 'automated' ELSE 'mixed_bot' END AS tier, count(*) AS n, sum(n_messages)::BIGINT AS messages FROM seg_gt GROUP BY 1",
    "cohort_lift": f"""{_SEG},
n AS (SELECT user_id % 3 AS cohort, topic, count(*) AS n FROM seg_gt GROUP BY ALL)
SELECT cohort, topic, n, round((n / sum(n) OVER (PARTITION BY cohort)) / (sum(n) OVER (PARTITION BY topic) / sum(n) OVER ()), 6) AS lift FROM n""",
    "user_features": f"""{_SEG} SELECT user_id, {', '.join(f"count(*) FILTER (topic = '{t}') AS {chr(34)}{t}{chr(34)}" for t in ("user", "assistant", "automated", "team", "system"))}, count(*) AS n_segments, round(avg(response_rate), 6) AS avg_response FROM seg_gt GROUP BY user_id""",
    "funnel": """
WITH u AS (SELECT user_id, min(ts) FILTER (event_type = 'signup') AS a, min(ts) FILTER (event_type = 'view') AS b, min(ts) FILTER (event_type = 'purchase') AS c FROM events GROUP BY 1)
SELECT 'signup' AS step, count(*) AS users FROM u WHERE a IS NOT NULL UNION ALL SELECT 'view', count(*) FROM u WHERE b > a HAVING count(*) > 0 UNION ALL SELECT 'purchase', count(*) FROM u WHERE b > a AND c > b HAVING count(*) > 0""",
    "snapshots": """
SELECT event_id, user_id, (sum(CASE event_type WHEN 'purchase' THEN 2 WHEN 'error' THEN -1 ELSE 0 END) OVER w)::BIGINT AS credit, (row_number() OVER w)::INT AS version
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "daily_failures": f"""{_TL},
a AS (SELECT *, type = 'user' AND coalesce(lead(type) OVER (PARTITION BY chat_id ORDER BY at_us, msg_id), 'user') = 'user' AS un FROM timeline)
SELECT at_us // {ms.DAY} AS day, count(*) AS messages, count(*) FILTER (un) AS failures FROM a GROUP BY 1""",
    "dormancy": f"""{_TL}, g AS (SELECT *, at_us - lag(at_us) OVER (PARTITION BY user_id ORDER BY at_us, msg_id) AS gap FROM timeline) SELECT msg_id, user_id, gap FROM g WHERE gap >= {5 * ms.DAY}""",
    "escalations": f"""{_TL}, r AS (SELECT msg_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY at_us RANGE BETWEEN {7 * ms.DAY} PRECEDING AND CURRENT ROW) AS recent FROM msgs_all WHERE type = 'system') SELECT * FROM r WHERE recent >= 3""",
    "chat_sizes": f"""{_TL}, n AS (SELECT chat_id, count(*) AS n FROM timeline GROUP BY 1)
SELECT CASE WHEN n < 5 THEN '1-4' WHEN n < 20 THEN '5-19' WHEN n < 50 THEN '20-49' WHEN n < 200 THEN '50-199' ELSE '200+' END AS size, count(*) AS chats, sum(n)::BIGINT AS messages FROM n GROUP BY 1""",
    "latest_segments": f"{_SEG} SELECT user_id, segment_id, started_at, ended_at FROM seg_gt QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY started_at DESC NULLS FIRST, segment_id) = 1",
    "topic_distribution": f"{_SEG} SELECT topic, count(*) AS n, string_agg(DISTINCT sub_topic, ',' ORDER BY sub_topic) AS sub_topics, round(avg(confidence), 6) AS confidence FROM seg_gt GROUP BY topic",
    "quality_metrics": f"""{_SEG} SELECT count(*) AS total, count(topic) AS labelled, count(*) FILTER (segment_id % 5 = 0) AS noise, count(DISTINCT topic) AS topics,
  count(*) FILTER (least(CASE WHEN segment_id % 5 = 0 THEN 0.0 ELSE 0.9 END, coalesce(confidence, 0)) < 0.6) AS low_confidence FROM seg_gt""",
    "field_profile": f"""{_TL}, f AS (SELECT unnest(['type', 'message', 'at_us']) AS field) SELECT field, 1.0::DOUBLE AS overall, 1.0::DOUBLE AS newest FROM f""",
}
