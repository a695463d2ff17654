"""Registered queries on labels: cutoffs, taxonomy checks, remapped indices, contexts, signals, validation, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadline.functions import text as fx
from threadline.operators import chunks as ch
from threadline.operators import cluster as cl
from threadline.operators import fuzzy as fz
from threadline.operators import graders as gr
from threadline.operators import messages as ms
from threadline.operators import metrics as mx
from threadline.operators import responses as rs
from threadline.operators import segments as sg
from threadline.operators import signals as sn
from threadline.operators import taxonomy as tx
from threadline.sources.views import EVENTS_SQL, TURNS_SQL, event_messages, table, turns
from threadline.work import kept

from .segment_queries import COMPARED_SQL, _records, _segments_sql, segments
from .store_queries import MARKED_SQL, _marked
from .table_queries import CLUSTERED_SQL, SIGNALS_SQL, TAXONOMY_SQL, _clustered, _signals, _taxonomy
from .timeline_queries import WINDOWS_SQL

C = F.col


def incremental(spark, sf_dir):
    """Messages after each user's latest segment, where every second segment is known already."""
    known = segments(spark, sf_dir).where("segment_id % 2 = 0")
    return sg.since_last(ms.timeline(event_messages(spark, sf_dir)), known).select("msg_id", "user_id", "at_us")


def _labels(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = C("p_partkey")
    topic = F.when(k % 5 == 0, F.lower("p_brand")).otherwise(F.lower("p_type"))
    sub = F.when(k % 3 == 0, F.lit("none")).otherwise(F.replace("p_name", F.lit(" "), F.lit("_")))
    return p.select(k.alias("row_id"), topic.alias("topic"), sub.alias("sub_topic"), ((k % 100) / 100).alias("confidence"))


LABELS_SQL = f"""{TAXONOMY_SQL},
lb AS (SELECT p_partkey AS row_id, CASE WHEN p_partkey % 5 = 0 THEN lower(p_brand) ELSE lower(p_type) END AS topic,
  CASE WHEN p_partkey % 3 = 0 THEN 'none' ELSE replace(p_name, ' ', '_') END AS sub_topic, (p_partkey % 100) / 100 AS confidence FROM part)"""


def violations(spark, sf_dir):
    return tx.other_type(_labels(spark, sf_dir), _taxonomy(spark, sf_dir)[0], "user").where("violates").select("row_id", "topic")


def unblocked(spark, sf_dir):
    return tx.unblocked(_labels(spark, sf_dir), *_taxonomy(spark, sf_dir)).select("row_id", "topic", "sub_topic")


def review_routes(spark, sf_dir):
    topics, subs = _taxonomy(spark, sf_dir)
    return tx.review_route(_labels(spark, sf_dir), topics.where("updated_at % 2 = 0"), subs).select("row_id", "review")


def pools(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), C("c_custkey")
    pool = F.when(k % 3 == 0, C("c_mktsegment"))
    of = F.when(k % 3 == 1, F.array(C("c_mktsegment"), F.lit("X"))).when(k % 3 == 2, F.array().cast("array<string>"))
    return c.select(k.alias("user_id"), tx.pool_of(pool, of).alias("pool"))


def reactions(spark, sf_dir):
    """Turns that are reactions to others, and which user turns stay unanswered beside them."""
    k = C("msg_id") % 7
    rows = turns(spark, sf_dir).where("type <> 'system'").withColumn("message", F.concat(F.when(k == 0, "Loved ").when(k == 1, "liked ").when(k == 2, "Questioned").otherwise("Laughed at "), C("msg_id").cast("string")))
    marked = ms.unanswered(rows).where("type = 'user'")
    return marked.select("msg_id", fx.is_reaction(C("message")).alias("reaction"), "unanswered")


def changed_topics(spark, sf_dir):
    return tx.changed_since(*_taxonomy(spark, sf_dir), 100).select("slug", "freshest")


def pool_taxonomies(spark, sf_dir):
    topics, subs = _taxonomy(spark, sf_dir)
    of = table(spark, sf_dir, "customer").select(F.lower("c_mktsegment").alias("pool")).distinct()
    allowed = tx.for_pool(topics, of, topics.select("slug").where("length(slug) % 2 = 0").crossJoin(F.broadcast(of.where("length(pool) > 8"))))  # a row per pool
    return tx.pool_texts(allowed, topics, subs)


def _images(spark, sf_dir):
    rows = ch.windows(turns(spark, sf_dir).where("type <> 'system'"), 3)
    image = F.concat(F.lit("https://storage.googleapis.com/b/"), C("msg_id").cast("string"), F.lit(".png"))
    rows = rows.withColumn("message", F.when(C("msg_id") % 3 == 0, image).otherwise(F.lit("turn")))
    return rows.withColumn("window_id", C("chat_id") * 100 + C("window_no"))


def remapped_members(spark, sf_dir):
    """Members of answered segments in the original rows: indices after absorption map back, absorbed rows follow their keeper."""
    rows = _images(spark, sf_dir)
    keys = [C("chat_id"), C("window_no")]
    kept_rows = ch.merge_images(rows).withColumn("window_id", C("chat_id") * 100 + C("window_no"))
    answered = kept_rows.select("window_id", F.expr("new_pos div 2").alias("segment_no"), "new_pos").unionByName(kept_rows.select("window_id", F.lit(9).cast("long").alias("segment_no"), (C("new_pos") + 50).alias("new_pos")))
    members = sg.original_indices(answered, kept_rows)
    order = Window.partitionBy(*keys).orderBy("pos")
    gone = rows.join(kept_rows.select("msg_id").withColumn("stays", F.lit(True)), "msg_id", "left").withColumn("keeper", F.last(F.when(C("stays"), C("msg_id")), ignorenulls=True).over(order))
    return sg.with_absorbed(members, gone.where("stays IS NULL").select("window_id", "msg_id", "keeper"))


def deduped_bounds(spark, sf_dir):
    """Segments of windows after each bot message has one owner: bounds anew, empty ones gone."""
    rows = ch.windows(turns(spark, sf_dir), 0).select(C("chat_id").alias("window_id"), "msg_id", "type", "pos", "at_us")
    a = rows.withColumn("segment_no", F.expr("pos div 3").cast("long"))
    members = a.unionByName(a.where("msg_id % 2 = 0").withColumn("segment_no", C("segment_no") + 1))
    return sg.rebuilt(sg.one_owner(members))


def orphan_bounds(spark, sf_dir):
    """Bounds of segments after the rows in none joined their nearest member."""
    rows = ch.windows(turns(spark, sf_dir), 0).select(C("chat_id").alias("window_id"), "msg_id", "pos", "at_us")
    members = rows.where("pos % 4 IN (1, 2)").withColumn("segment_no", F.expr("pos div 2").cast("long"))
    return sg.rebuilt(sg.with_orphans(members, rows.select("window_id", "pos")).join(rows, ["window_id", "pos"]))


def fallback_segments(spark, sf_dir):
    rows = turns(spark, sf_dir).select(C("chat_id").alias("window_id"), "type", "at_us")
    labelled = rows.where("window_id % 3 = 0").select("window_id")
    return sg.fallbacks(rows, labelled)


def contexts(spark, sf_dir):
    return sg.running_context(_marked(spark, sf_dir))


def user_signal_segments(spark, sf_dir):
    """Segments with the signals of their users."""
    signals = sn.per_user(_signals(spark, sf_dir)).select("user_id", "signal").distinct()
    return segments(spark, sf_dir).select("segment_id", "user_id").join(signals, "user_id")


def signal_topics(spark, sf_dir):
    rows = gr.signal_topics(segments(spark, sf_dir), sn.per_user(_signals(spark, sf_dir)))
    return rows.select("topic", *[F.round(c, 9).alias(c) for c in ("tp", "fp", "ratio")])


def signal_report(spark, sf_dir):
    rows = gr.signal_report(segments(spark, sf_dir), sn.per_user(_signals(spark, sf_dir)))
    return rows.select("grader", "passed", F.round("value", 9).alias("value"))


def signal_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    status = F.when(C("o_orderstatus") == "F", sn.EXCHANGED).when(C("o_orderstatus") == "P", sn.REFUSED).otherwise("Open")
    return gr.signal_counts(_signals(spark, sf_dir), o.select(status.alias("status")), 100)


def run_configs(spark, sf_dir):
    """Runs with their configurations; runs without one keep their row."""
    runs = _marked(spark, sf_dir).groupBy("run_id").agg(F.count("*").alias("n"))
    known = table(spark, sf_dir, "nation").where("n_nationkey < 3").select(C("n_nationkey").alias("run_id"), C("n_name").alias("model"), (C("n_regionkey") / 10).alias("temperature"))
    return runs.join(F.broadcast(known), "run_id", "left")  # a row per configuration


def closest_subtopics(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    known = p.select(F.lower("p_type").alias("topic"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("sub_topic")).distinct()
    return fz.closest(known.withColumn("sub_topic", F.concat(F.expr("substring(sub_topic, 2)"), F.lit("s"))), known)


def validated_labels(spark, sf_dir):
    """Sub-topics of odd spellings against the taxonomy and the users' true labels."""
    p, k = table(spark, sf_dir, "part"), C("p_partkey")
    known = p.select(F.lower("p_type").alias("topic"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("sub_topic")).distinct()
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    odd = F.when(k % 4 == 0, name).when(k % 4 == 1, F.concat(name, F.lit("_new"))).when(k % 4 == 2, F.concat(F.lit("e_"), name)).otherwise(F.concat(F.split_part(name, F.lit("_"), F.lit(1)), F.lit("_qqqqq_zzz")))
    rows = p.select(k.alias("row_id"), (k % 50).alias("user_id"), F.lower("p_type").alias("topic"), odd.alias("sub_topic"))
    truth = p.where("p_partkey % 2 = 0").select((k % 50).alias("user_id"), name.alias("sub_topic"))
    return fz.validated(rows, known, truth).select("row_id", "valid", "how")


def token_overlaps(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    a, b = F.replace("p_name", F.lit(" "), F.lit("_")), F.concat(F.replace(F.lower("p_type"), F.lit(" "), F.lit("_")), F.lit("_"), F.split_part("p_name", F.lit(" "), F.lit(1)))
    return p.select("p_partkey", fz.token_overlap(a, b).alias("overlap"))


def counts_read(spark, sf_dir):
    k = C("p_partkey")
    text = F.when(k % 6 == 0, "x").when(k % 6 == 1, F.concat(F.lit("-"), k.cast("string"))).when(k % 6 == 2, F.concat(k.cast("string"), F.lit(".7"))).when(k % 6 == 3, k.cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", rs.count_value(text).alias("n"))


# --- quality, clusters, analytics ------------------------------------------------------------


def quality_report(spark, sf_dir):
    """The evaluator's counts: totals, noise, topics, low confidence over cluster and label, unconfirmed labels."""
    s = segments(spark, sf_dir).withColumn("cluster_confidence", F.when(C("segment_id") % 5 != 0, 0.9))
    known = table(spark, sf_dir, "region").select(F.lit("user").alias("slug")).distinct()
    rows = s.join(F.broadcast(known.withColumnRenamed("slug", "topic").withColumn("known", F.lit(True))), "topic", "left")  # one row
    low = F.least(F.coalesce("cluster_confidence", F.lit(0.0)), F.coalesce("confidence", F.lit(0.0))) < 0.6
    return rows.agg(
        F.count("*").alias("total"), F.count("topic").alias("labelled"), F.count_if(C("topic").isNull()).alias("unlabelled"), F.round(F.avg(C("cluster_confidence").isNull().cast("double")), 9).alias("noise"),
        F.count_if(C("topic").isNotNull() & low).alias("low"), F.count_distinct(F.when(C("known").isNull(), C("topic"))).alias("unconfirmed_topics"),
        F.count_distinct(F.when(C("sub_topic") != "user", C("sub_topic"))).alias("unconfirmed_subs"),
    )


def adjusted_labels(spark, sf_dir):
    """Label confidence and sentiment after the rules: without a user certain and without sentiment."""
    s = segments(spark, sf_dir)
    return s.select("segment_id", F.when(C("has_user"), C("confidence")).otherwise(F.lit(1.0)).alias("confidence"), F.when(C("has_user"), F.lit("neutral")).alias("sentiment"))


def cluster_rollup(spark, sf_dir):
    """Clusters, rows and sub-topics of each topic."""
    rows = _clustered(spark, sf_dir)
    return rows.groupBy("topic").agg(F.count_distinct("cluster").alias("clusters"), F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("sub_topic")), ",").alias("sub_topics"))


def cluster_noise(spark, sf_dir):
    rows = _clustered(spark, sf_dir).select(F.coalesce("cluster", F.lit(-1)).alias("cluster"), (C("vec_id") % 10 / 10).alias("membership"))
    return cl.noise_summary(rows).select("n", "clusters", *[F.round(c, 9).alias(c) for c in ("noise", "membership")])


def cluster_report(spark, sf_dir):
    return gr.cluster_report(_clustered(spark, sf_dir)).select("grader", "passed", F.round("value", 9).alias("value"))


def own_distance(spark, sf_dir):
    return cl.own_distance(table(spark, sf_dir, "embeddings"), "label").select("label", "n", F.round("distance", 6).alias("distance"))


def silhouette(spark, sf_dir):
    return cl.silhouette(table(spark, sf_dir, "embeddings"), "label").select("n", F.round("silhouette", 6).alias("silhouette"))


def principal_components(spark, sf_dir):
    return cl.reduced(table(spark, sf_dir, "embeddings")).select("vec_id", F.transform("components", lambda x: F.round(x, 6)).alias("components"))


def size_report(spark, sf_dir):
    users = table(spark, sf_dir, "customer").select(C("c_custkey").alias("user_id"))
    rows = gr.size_report(segments(spark, sf_dir), ms.timeline(event_messages(spark, sf_dir)), users)
    return rows.select("grader", "passed", F.round("value", 9).alias("value"))


def label_report(spark, sf_dir):
    s = segments(spark, sf_dir).withColumn("true_topic", F.when(C("segment_id") % 7 == 0, F.lit("user")))
    names = kept(s.select("topic", "sub_topic").distinct())
    topics = names.select(C("topic").alias("slug"), (C("topic") != "team").alias("confirmed")).distinct()
    subs = names.select(C("topic").alias("topic_slug"), C("sub_topic").alias("slug"), (C("sub_topic") != "team").alias("confirmed"))
    return gr.label_report(s, topics, subs).select("grader", "passed", F.round("value", 9).alias("value"))


def report_order(spark, sf_dir):
    """The printed leaderboard: all segments and those with a user, topic before sub-topic accuracy."""
    records, model = _records(spark, sf_dir)
    scopes = []
    for scope, rows in (("total", records), ("user_engaged", records.where("engaged"))):
        unified, topic, sub = mx.unified(rows, model), mx.topic_scores(rows, model), mx.sub_topic_scores(rows)
        scopes.append(unified.join(topic.select("run_id", C("recall").alias("topic_accuracy")), "run_id").join(sub.select("run_id", C("recall").alias("sub_accuracy")), "run_id").withColumn("scope", F.lit(scope)))
    values = {c: F.round(c, 6) for c in ("unified_score", "topic_accuracy", "sub_accuracy")}
    return mx.report_order(scopes[0].unionByName(scopes[1]).withColumns(values)).select("scope", "run_id", "rank", *values)


def failure_streaks(spark, sf_dir):
    """Each user's longest run of segments with a failure, and the mean response rate of the last three at each segment."""
    order = Window.partitionBy("user_id").orderBy("started_at", "segment_id")
    s = segments(spark, sf_dir).withColumn("group", F.sum((~C("has_failure")).cast("int")).over(order)).withColumn("recent", F.avg("response_rate").over(order.rowsBetween(-2, 0)))
    runs = s.groupBy("user_id", "group").agg(F.count_if("has_failure").alias("n"))
    return runs.groupBy("user_id").agg(F.max("n").alias("longest")).join(s.groupBy("user_id").agg(F.round(F.max("recent"), 6).alias("best_recent")), "user_id")


def sub_topic_ranking(spark, sf_dir):
    """Pairs of labels ranked by response rate within their topic."""
    n = segments(spark, sf_dir).groupBy("topic", "sub_topic").agg(F.count("*").alias("n"), F.round(F.avg("response_rate"), 9).alias("rate"), F.round(F.avg(C("has_failure").cast("double")), 9).alias("failures"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("rate"), "failures", "sub_topic")))


def engagement(spark, sf_dir):
    """Engagement per user: messages, replies to them, active days, as one score."""
    rows = ms.unanswered(ms.timeline(event_messages(spark, sf_dir)))
    u = rows.groupBy("user_id").agg(F.count_if(C("type") == "user").alias("sent"), F.count_if("unanswered").alias("missed"), F.count_distinct(F.expr(f"at_us div {ms.DAY}")).alias("days"))
    return u.withColumn("score", F.round(F.col("sent") - 0.5 * F.col("missed") + 2 * F.col("days"), 6))


def journeys(spark, sf_dir):
    """How often one topic follows another in the users' order of segments."""
    order = Window.partitionBy("user_id").orderBy("started_at", "segment_id")
    s = segments(spark, sf_dir).withColumn("next_topic", F.lead("topic").over(order)).where("next_topic IS NOT NULL")
    return s.groupBy("topic", "next_topic").agg(F.count("*").alias("n"))


def before_after(spark, sf_dir):
    """Response rates in the week before and after each user's first purchase."""
    rows = ms.timeline(event_messages(spark, sf_dir))
    start = rows.where("type = 'automated'").groupBy("user_id").agg(F.min("at_us").alias("t"))
    s = segments(spark, sf_dir).join(start, "user_id").where(F.abs(C("started_at") - C("t")) <= 7 * ms.DAY)
    return s.groupBy((C("started_at") >= C("t")).alias("after")).agg(F.count("*").alias("n"), F.round(F.avg("response_rate"), 6).alias("rate"))


def feedback_rows(spark, sf_dir):
    """One feedback as two rows: who gave it and whom it is about, with their running credit."""
    o = table(spark, sf_dir, "orders")
    both = F.explode(F.array(F.struct(C("o_custkey").alias("user_id"), F.lit("reviewer").alias("part"), F.lit(1).alias("credit")), F.struct((C("o_custkey") + 1).alias("user_id"), F.lit("reviewed").alias("part"), F.when(C("o_orderstatus") == "F", 2).otherwise(-1).alias("credit"))))
    rows = o.select("o_orderkey", both.alias("r")).select("o_orderkey", "r.*")
    order = Window.partitionBy("user_id").orderBy("o_orderkey", "part").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("total", F.sum("credit").over(order)).withColumn("version", F.row_number().over(order))


def credit_as_of(spark, sf_dir):
    """The latest version of each user's credit up to an order key."""
    rows = feedback_rows(spark, sf_dir).where("o_orderkey <= 3000")
    return rows.groupBy("user_id").agg(F.max_by("total", "version").alias("credit"), F.max("version").alias("version"))


def field_coverage(spark, sf_dir):
    """Share of filled values per field overall and over the 200 newest turns (a fixed report), where some fields are empty."""
    k = C("msg_id")
    rows = turns(spark, sf_dir).select("msg_id", "at_us", F.when(k % 3 != 0, C("type")).alias("type"), F.when((k % 2 == 0) & (F.length("message") > 400), C("message")).alias("message"))
    fields = ["type", "message", "at_us"]
    shares = lambda x, name: x.agg(*[F.round(F.count(c) / F.count("*"), 9).alias(c) for c in fields]).unpivot([], fields, "field", name)
    newest = rows.orderBy(F.desc("at_us"), "msg_id").limit(200)
    return shares(rows, "overall").join(shares(newest, "newest"), "field").withColumn("deprecated", C("newest") < 0.5 * C("overall"))


QUERIES = {
    f.__name__: f
    for f in (
        incremental, violations, unblocked, review_routes, pools, reactions, changed_topics, pool_taxonomies, remapped_members, deduped_bounds, orphan_bounds, fallback_segments, contexts, user_signal_segments, signal_topics,
        signal_report, signal_counts, run_configs, closest_subtopics, validated_labels, token_overlaps, counts_read, quality_report, adjusted_labels, cluster_rollup, cluster_noise, cluster_report, own_distance,
        silhouette, principal_components, size_report, label_report, report_order, failure_streaks, sub_topic_ranking, engagement, journeys, before_after, feedback_rows, credit_as_of, field_coverage,
    )
}

#: The closest known sub-topic by similarity ratio of names nm (topic, sub_topic) and known ones kn: the longest common block
#: (first in the name, then in the known one), then the same left and right of it, until nothing is shared.
_CLOSEST = """
pr AS (SELECT DISTINCT sub_topic AS a0, kn.known AS b0 FROM nm JOIN kn USING (topic)),
bl(a0, b0, a, b, n) AS (
  SELECT a0, b0, a0, b0, 0::BIGINT FROM pr
  UNION ALL
  SELECT a0, b0, u.a, u.b, u.n FROM (
    SELECT a0, b0, unnest([
      {'a': substr(a, 1, i - 1), 'b': substr(b, 1, instr(b, substr(a, i, l)) - 1), 'n': l},
      {'a': substr(a, i + l), 'b': substr(b, instr(b, substr(a, i, l)) + l), 'n': 0::BIGINT}]) AS u
    FROM (
      SELECT a0, b0, a, b, top.l AS l, -top.i AS i FROM (
        SELECT a0, b0, a, b, list_max(list_transform(range(1, length(a) + 1), lambda i: {'l': len(list_filter(range(1, length(a) - i + 2), lambda l: contains(b, substr(a, i, l))))::BIGINT, 'i': -i})) AS top
        FROM bl WHERE a <> '' AND b <> '')
      WHERE top.l > 0))),
ra AS (SELECT a0, b0, 2.0::DOUBLE * sum(n)::DOUBLE / (length(a0) + length(b0)) AS similarity FROM bl GROUP BY a0, b0),
cl AS (
  SELECT topic, sub_topic, known, similarity FROM nm JOIN kn USING (topic) JOIN ra ON a0 = sub_topic AND b0 = known WHERE similarity >= 0.5
  QUALIFY row_number() OVER (PARTITION BY topic, sub_topic ORDER BY similarity DESC, known) = 1)"""

_KNOWN = "kn AS (SELECT DISTINCT lower(p_type) AS topic, replace(p_name, ' ', '_') AS known FROM part)"

_SEG = _segments_sql()
_PLAIN = """SELECT '{0}' AS grader, {1} AS passed, round(({2})::DOUBLE, 9) AS value FROM {3}"""


def _graded(*checks) -> str:
    return " UNION ALL ".join(_PLAIN.format(*c) for c in checks)


_IMG = f"""{WINDOWS_SQL},
f AS (SELECT *, chat_id * 100 + window_no AS window_id, msg_id % 3 = 0 AND type <> 'user' AND row_number() OVER (PARTITION BY chat_id, window_no ORDER BY pos) > 1 AS gone FROM windowed),
k AS (SELECT *, max(CASE WHEN NOT gone THEN msg_id END) OVER (PARTITION BY window_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS keeper FROM f),
n AS (SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY pos) - 1 AS new_pos FROM k WHERE NOT gone)"""
_SCOPED = """SELECT '{0}' AS scope, * FROM (
  SELECT r.run_id, round(sum(CASE WHEN matched AND gt_topic = model_topic THEN iou * (0.5 + 0.5 * (gt_sub = model_sub)::INT) ELSE 0 END) / greatest(count(*), any_value(n_model)), 6) AS unified_score,
    round(count(*) FILTER (matched AND gt_topic = model_topic) / count(*), 6) AS topic_accuracy, round(count(*) FILTER (matched AND gt_sub = model_sub) / count(gt_sub), 6) AS sub_accuracy
  FROM records r JOIN totals USING (run_id) WHERE {1} GROUP BY r.run_id)"""
ORACLE_SQL = {
    "incremental": f"""{_SEG},
cut AS (SELECT user_id, ended_at FROM seg_gt WHERE segment_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY started_at DESC NULLS FIRST, segment_id) = 1)
SELECT msg_id, t.user_id, at_us FROM timeline t LEFT JOIN cut c ON c.user_id = t.user_id WHERE c.user_id IS NULL OR at_us > ended_at""",
    "violations": f"WITH {LABELS_SQL} SELECT row_id, topic FROM lb WHERE topic IN (SELECT slug FROM topics WHERE type <> 'user') AND topic NOT IN (SELECT slug FROM topics WHERE type = 'user')",
    "unblocked": f"""WITH {LABELS_SQL}
SELECT row_id, CASE WHEN topic IN (SELECT slug FROM topics) THEN topic END AS topic, CASE WHEN EXISTS (SELECT 1 FROM subs s WHERE s.topic_slug = lb.topic AND s.slug = lb.sub_topic) THEN sub_topic END AS sub_topic FROM lb""",
    "review_routes": f"""WITH {LABELS_SQL}
SELECT row_id, CASE WHEN topic NOT IN (SELECT slug FROM topics WHERE updated_at % 2 = 0) THEN 'P1' WHEN NOT EXISTS (SELECT 1 FROM subs s WHERE s.topic_slug = lb.topic AND s.slug = lb.sub_topic) THEN 'P2'
  WHEN confidence < 0.6 THEN 'P3' ELSE 'accepted' END AS review FROM lb""",
    "pools": "SELECT c_custkey AS user_id, CASE WHEN c_custkey % 3 < 2 THEN lower(c_mktsegment) END AS pool FROM customer",
    "reactions": f"""WITH {TURNS_SQL},
r AS (SELECT *, type = 'user' AND msg_id % 7 IN (0, 3, 4, 5, 6) AS reaction, coalesce(lead(type) OVER (PARTITION BY chat_id ORDER BY at_us, msg_id), 'user') AS nxt FROM turns WHERE type <> 'system')
SELECT msg_id, reaction, NOT reaction AND nxt = 'user' AS unanswered FROM r WHERE type = 'user'""",
    "changed_topics": f"""WITH {TAXONOMY_SQL},
f AS (SELECT t.slug, greatest(t.updated_at, coalesce(u, t.updated_at)) AS freshest FROM topics t LEFT JOIN (SELECT topic_slug, max(updated_at) AS u FROM subs GROUP BY 1) s ON s.topic_slug = t.slug) SELECT * FROM f WHERE freshest > 100""",
    "pool_taxonomies": f"""WITH {TAXONOMY_SQL},
pl AS (SELECT DISTINCT lower(c_mktsegment) AS pool FROM customer),
o AS (SELECT t.slug, '- ' || t.slug || coalesce(': ' || string_agg(s.slug, ' | ' ORDER BY s.slug), '') AS line FROM topics t LEFT JOIN subs s ON s.topic_slug = t.slug GROUP BY t.slug)
SELECT pool, string_agg(line, chr(10) ORDER BY slug) AS text FROM pl, o WHERE length(pool) <= 8 OR length(slug) % 2 = 0 GROUP BY pool""",
    "remapped_members": f"""{_IMG}
SELECT window_id, new_pos // 2 AS segment_no, msg_id FROM n UNION SELECT k.window_id, n.new_pos // 2, k.msg_id FROM k JOIN n ON n.window_id = k.window_id AND n.msg_id = k.keeper WHERE k.gone""",
    "deduped_bounds": f"""WITH {TURNS_SQL},
p AS (SELECT chat_id AS window_id, msg_id, type, at_us, row_number() OVER (PARTITION BY chat_id ORDER BY at_us, msg_id) - 1 AS pos FROM turns),
m AS (SELECT *, pos // 3 AS segment_no FROM p UNION ALL SELECT *, pos // 3 + 1 FROM p WHERE msg_id % 2 = 0),
s AS (SELECT *, count(*) OVER (PARTITION BY window_id, segment_no ORDER BY pos RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) - 1 AS near FROM m),
o AS (SELECT * FROM s QUALIFY type = 'user' OR row_number() OVER (PARTITION BY window_id, msg_id ORDER BY near DESC, segment_no) = 1)
SELECT window_id, segment_no, min(at_us) AS started_at, max(at_us) AS ended_at, count(*) AS n_messages FROM o GROUP BY ALL""",
    "orphan_bounds": f"""WITH {TURNS_SQL},
p AS (SELECT chat_id AS window_id, at_us, row_number() OVER (PARTITION BY chat_id ORDER BY at_us, msg_id) - 1 AS pos FROM turns),
o AS (SELECT *, CASE WHEN pos % 4 IN (1, 2) THEN pos // 2 END AS own FROM p),
n AS (
  SELECT *, max(CASE WHEN own IS NOT NULL THEN pos END) OVER (PARTITION BY window_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
    min(CASE WHEN own IS NOT NULL THEN pos END) OVER (PARTITION BY window_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM o),
a AS (SELECT *, coalesce(own, CASE WHEN l IS NULL THEN r // 2 WHEN r IS NULL OR pos <> r - 1 THEN l // 2 ELSE least(l // 2, r // 2) END) AS segment_no FROM n)
SELECT window_id, segment_no, min(at_us) AS started_at, max(at_us) AS ended_at, count(*) AS n_messages FROM a GROUP BY ALL""",
    "fallback_segments": f"""WITH {TURNS_SQL}
SELECT chat_id AS window_id, 'unclassified' AS topic, 'unclassified' AS sub_topic, CASE WHEN NOT bool_or(type = 'user') THEN 1.0 END::DOUBLE AS confidence, min(at_us) AS started_at, max(at_us) AS ended_at, count(*) AS n_messages
FROM turns WHERE chat_id % 3 <> 0 GROUP BY chat_id""",
    "contexts": f"""{MARKED_SQL},
l AS (SELECT *, '- ' || coalesce(topic, 'unknown') || ' / ' || coalesce(sub_topic, 'unknown') || ': "' || coalesce(summary, '') || '"' AS line FROM mk),
p AS (SELECT segment_id, user_id, list(line) OVER (PARTITION BY user_id ORDER BY started_at, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lines FROM l)
SELECT segment_id, user_id, CASE WHEN len(coalesce(lines, [])) > 0 THEN 'Previous segments:' || chr(10) || array_to_string(lines, chr(10)) ELSE '' END AS context FROM p""",
    "user_signal_segments": f"{_SEG}, {SIGNALS_SQL} SELECT segment_id, s.user_id, signal FROM seg_gt s JOIN (SELECT DISTINCT user_id, signal FROM us) USING (user_id)",
    "signal_topics": f"""{_SEG}, {SIGNALS_SQL},
j AS (SELECT signal, topic, count(*) AS n FROM seg_gt JOIN (SELECT DISTINCT user_id, signal FROM us) USING (user_id) GROUP BY ALL),
h AS (SELECT *, n / sum(n) OVER (PARTITION BY signal) AS share FROM j),
w AS (SELECT topic, max(share) FILTER (signal = 'TP') AS tp, max(share) FILTER (signal = 'FP') AS fp FROM h GROUP BY 1)
SELECT topic, round(tp, 9) AS tp, round(fp, 9) AS fp, round(CASE WHEN fp > 0 THEN tp / fp END, 9) AS ratio FROM w""",
    "signal_report": f"""{_SEG}, {SIGNALS_SQL},
w AS (SELECT count(*) FILTER (s.u IS NULL) AS alone, count(s.u) AS users, count(*) FILTER (g.u IS NOT NULL AND s.u IS NOT NULL) AS both
  FROM (SELECT DISTINCT user_id AS u FROM seg_gt) g FULL JOIN (SELECT DISTINCT user_id AS u FROM us) s ON s.u = g.u)
{_graded(("G0.4", "alone = 0", "alone", "w"), ("G4.2", '"both" >= 0.9 * users', '"both" / users', "w"))}""",
    "signal_counts": f"""WITH {SIGNALS_SQL},
n AS (SELECT status, count(DISTINCT matching_id) AS signals FROM s GROUP BY 1)
SELECT status, signals, matchings, signals <= matchings AS within, sum(signals) OVER () = 100 AS stable FROM n JOIN (SELECT status, count(*) AS matchings FROM o GROUP BY 1) USING (status)""",
    "run_configs": f"{MARKED_SQL} SELECT run_id, n, n_name AS model, n_regionkey / 10 AS temperature FROM (SELECT run_id, count(*) AS n FROM mk GROUP BY 1) LEFT JOIN nation ON n_nationkey = run_id AND n_nationkey < 3",
    "closest_subtopics": f"""WITH RECURSIVE {_KNOWN}, nm AS (SELECT DISTINCT topic, substr(known, 2) || 's' AS sub_topic FROM kn), {_CLOSEST} SELECT * FROM cl""",
    "validated_labels": f"""WITH RECURSIVE {_KNOWN},
p AS (SELECT p_partkey AS row_id, p_partkey % 50 AS user_id, lower(p_type) AS topic, replace(p_name, ' ', '_') AS name FROM part),
r AS (SELECT row_id, user_id, topic, CASE row_id % 4 WHEN 0 THEN name WHEN 1 THEN name || '_new' WHEN 2 THEN 'e_' || name ELSE split_part(name, '_', 1) || '_qqqqq_zzz' END AS sub_topic FROM p),
nm AS (SELECT DISTINCT topic, sub_topic FROM r WHERE NOT EXISTS (FROM kn WHERE kn.topic = r.topic AND known = r.sub_topic)),
{_CLOSEST},
tr AS (SELECT DISTINCT user_id, name FROM p WHERE row_id % 2 = 0),
j AS (
  SELECT row_id, r.sub_topic, cl.known, EXISTS (FROM kn WHERE kn.topic = r.topic AND kn.known = r.sub_topic) AS has, tr.name IS NOT NULL AS true_one,
    list_distinct(string_split(r.sub_topic, '_')) AS x, list_distinct(string_split(cl.known, '_')) AS y
  FROM r LEFT JOIN cl ON cl.topic = r.topic AND cl.sub_topic = r.sub_topic LEFT JOIN tr ON tr.user_id = r.user_id AND tr.name = cl.known),
h AS (SELECT *, CASE WHEN has THEN 'known' WHEN known IS NULL THEN 'kept'
  WHEN starts_with(sub_topic, known || '_') OR ends_with(sub_topic, '_' || known) OR starts_with(known, sub_topic || '_') OR len(list_intersect(x, y)) / least(len(x), len(y)) >= 0.7 THEN 'variant'
  WHEN len(list_intersect(x, y)) >= 2 AND true_one THEN 'truth' ELSE 'kept' END AS how FROM j)
SELECT row_id, CASE WHEN how IN ('variant', 'truth') THEN known ELSE sub_topic END AS valid, how FROM h""",
    "token_overlaps": """
WITH t AS (SELECT p_partkey, list_distinct(string_split(replace(p_name, ' ', '_'), '_')) AS a, list_distinct(string_split(replace(lower(p_type), ' ', '_') || '_' || split_part(p_name, ' ', 1), '_')) AS b FROM part)
SELECT p_partkey, len(list_intersect(a, b)) / least(len(a), len(b)) AS overlap FROM t""",
    "counts_read": "SELECT p_partkey, CASE p_partkey % 6 WHEN 1 THEN 0 WHEN 2 THEN p_partkey WHEN 3 THEN p_partkey END::INT AS n FROM part",
    "quality_report": f"""{_SEG}
SELECT count(*) AS total, count(topic) AS labelled, count(*) FILTER (topic IS NULL) AS unlabelled, round(avg((segment_id % 5 = 0)::INT), 9) AS noise,
  count(*) FILTER (topic IS NOT NULL AND least(CASE WHEN segment_id % 5 <> 0 THEN 0.9 ELSE 0.0 END, coalesce(confidence, 0)) < 0.6) AS low,
  count(DISTINCT topic) FILTER (topic <> 'user') AS unconfirmed_topics, count(DISTINCT sub_topic) FILTER (sub_topic <> 'user') AS unconfirmed_subs FROM seg_gt""",
    "adjusted_labels": f"{_SEG} SELECT segment_id, CASE WHEN has_user THEN confidence ELSE 1.0 END::DOUBLE AS confidence, CASE WHEN has_user THEN 'neutral' END AS sentiment FROM seg_gt",
    "cluster_rollup": f"WITH {CLUSTERED_SQL} SELECT topic, count(DISTINCT cluster) AS clusters, count(*) AS n, string_agg(DISTINCT sub_topic, ',' ORDER BY sub_topic) AS sub_topics FROM cd GROUP BY topic",
    "cluster_noise": f"WITH {CLUSTERED_SQL} SELECT count(*) AS n, count(DISTINCT cluster) AS clusters, round(avg((cluster IS NULL)::INT), 9) AS noise, round(avg(vec_id % 10 / 10) FILTER (cluster IS NOT NULL), 9) AS membership FROM cd",
    "cluster_report": f"""WITH {CLUSTERED_SQL},
z AS (SELECT cluster, count(*) AS n FROM cd GROUP BY 1), w AS (SELECT sum(n) AS a, coalesce(sum(n) FILTER (cluster IS NULL), 0) AS noise, count(cluster) AS c, max(n) FILTER (cluster IS NOT NULL) AS m FROM z)
{_graded(("G2.1", "noise < 0.4 * a", "noise / a", "w"), ("G2.2", "c BETWEEN 10 AND 100", "c", "w"), ("G2.3", "m <= 0.3 * a", "m / a", "w"))}""",
    "own_distance": """
WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings), s AS (SELECT label, i, sum(x) AS s FROM e GROUP BY ALL),
q AS (SELECT label, sqrt(sum(s * s)) AS q FROM s GROUP BY 1), n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT label, n, round(1 - q / n, 6) AS distance FROM q JOIN n USING (label)""",
    "silhouette": """
WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings), s AS (SELECT label AS g, i, sum(x) AS s FROM e GROUP BY ALL),
n AS (SELECT label AS g, count(*) AS n FROM embeddings GROUP BY 1),
d AS (SELECT vec_id, any_value(label) AS label, g, sum(x * s) AS dot FROM e JOIN s USING (i) GROUP BY vec_id, g),
f AS (SELECT vec_id, g = label AS own, CASE WHEN g <> label THEN 1 - dot / n WHEN n > 1 THEN 1 - (dot - 1) / (n - 1) END AS far FROM d JOIN n USING (g)),
p AS (SELECT vec_id, max(far) FILTER (own) AS a, min(far) FILTER (NOT own) AS b FROM f GROUP BY 1)
SELECT count(*) AS n, round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM p""",
    "size_report": f"""{_SEG},
pu AS (SELECT avg(n) AS mean, max(n) AS most, sum(m) AS messages FROM (SELECT user_id, count(*) AS n, sum(n_messages) AS m FROM seg_gt GROUP BY 1)),
w AS (SELECT pu.*, (SELECT count(*) FROM timeline) AS total, (SELECT avg((c_custkey NOT IN (SELECT user_id FROM timeline))::INT) FROM customer) AS share FROM pu)
{_graded(("G1.1 mean", "mean > 0", "mean", "w"), ("G1.1 most", "most >= mean", "most", "w"), ("G1.3", "messages = total", "messages / total", "w"), ("G1.5", "share < 0.5", "share", "w"))}""",
    "label_report": f"""{_SEG},
w AS (SELECT count(DISTINCT topic) AS t, count(*) FILTER (topic IS NOT NULL AND coalesce(confidence, 0) < 0.6) AS low, count(*) FILTER (topic = 'team') AS ut, count(*) FILTER (sub_topic = 'team') AS us,
  count(*) FILTER (topic IS NULL) AS un, avg((topic = 'user')::INT) FILTER (segment_id % 7 = 0) AS acc FROM seg_gt)
{_graded(("G3.2", "t >= 10", "t", "w"), ("G3.3", "low = 0", "low", "w"), ("G3.4", "ut = 0", "ut", "w"), ("G3.5", "us = 0", "us", "w"), ("G3.7", "un = 0", "un", "w"), ("G3.8", "acc >= 0.8", "acc", "w"))}""",
    "report_order": f"""{COMPARED_SQL},
sc AS ({_SCOPED.format("total", "true")} UNION ALL {_SCOPED.format("user_engaged", "engaged")})
SELECT *, (row_number() OVER (PARTITION BY scope ORDER BY coalesce(unified_score, -1) DESC, coalesce(topic_accuracy, -1) DESC, coalesce(sub_accuracy, -1) DESC, run_id))::INT AS rank FROM sc""",
    "failure_streaks": f"""{_SEG},
g AS (SELECT *, sum((NOT has_failure)::INT) OVER w AS grp, avg(response_rate) OVER (PARTITION BY user_id ORDER BY started_at, segment_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent FROM seg_gt WINDOW w AS (PARTITION BY user_id ORDER BY started_at, segment_id)),
r AS (SELECT user_id, grp, count(*) FILTER (has_failure) AS n FROM g GROUP BY ALL)
SELECT user_id, max(n) AS longest, (SELECT round(max(recent), 6) FROM g WHERE g.user_id = r.user_id) AS best_recent FROM r GROUP BY user_id""",
    "sub_topic_ranking": f"""{_SEG}, n AS (SELECT topic, sub_topic, count(*) AS n, round(avg(response_rate), 9) AS rate, round(avg(has_failure::INT), 9) AS failures FROM seg_gt GROUP BY ALL)
SELECT *, (row_number() OVER (PARTITION BY topic ORDER BY rate DESC, failures, sub_topic))::INT AS rank FROM n""",
    "engagement": f"""WITH {EVENTS_SQL},
a AS (SELECT *, type = 'user' AND coalesce(lead(type) OVER (PARTITION BY chat_id ORDER BY at_us, msg_id), 'user') = 'user' AS un FROM timeline),
u AS (SELECT user_id, count(*) FILTER (type = 'user') AS sent, count(*) FILTER (un) AS missed, count(DISTINCT at_us // {ms.DAY}) AS days FROM a GROUP BY 1)
SELECT *, round((sent - 0.5 * missed + 2 * days)::DOUBLE, 6) AS score FROM u""",
    "journeys": f"{_SEG}, s AS (SELECT topic, lead(topic) OVER (PARTITION BY user_id ORDER BY started_at, segment_id) AS next_topic FROM seg_gt) SELECT topic, next_topic, count(*) AS n FROM s WHERE next_topic IS NOT NULL GROUP BY ALL",
    "before_after": f"""{_SEG}, t AS (SELECT user_id, min(at_us) AS t FROM timeline WHERE type = 'automated' GROUP BY 1)
SELECT started_at >= t AS after, count(*) AS n, round(avg(response_rate), 6) AS rate FROM seg_gt JOIN t USING (user_id) WHERE abs(started_at - t) <= {7 * ms.DAY} GROUP BY 1""",
    "feedback_rows": """
WITH r AS (SELECT o_orderkey, o_custkey AS user_id, 'reviewer' AS part, 1 AS credit FROM orders UNION ALL SELECT o_orderkey, o_custkey + 1, 'reviewed', CASE WHEN o_orderstatus = 'F' THEN 2 ELSE -1 END FROM orders)
SELECT *, (sum(credit) OVER w)::BIGINT AS total, (row_number() OVER w)::INT AS version FROM r WINDOW w AS (PARTITION BY user_id ORDER BY o_orderkey, part ROWS UNBOUNDED PRECEDING)""",
    "credit_as_of": """
WITH r AS (SELECT o_custkey AS user_id, 1 AS credit FROM orders WHERE o_orderkey <= 3000 UNION ALL SELECT o_custkey + 1, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE -1 END FROM orders WHERE o_orderkey <= 3000)
SELECT user_id, sum(credit)::BIGINT AS credit, count(*)::INT AS version FROM r GROUP BY 1""",
    "field_coverage": f"""WITH {TURNS_SQL},
r AS (SELECT msg_id, at_us, CASE WHEN msg_id % 3 <> 0 THEN type END AS type, CASE WHEN msg_id % 2 = 0 AND length(message) > 400 THEN message END AS message FROM turns),
w AS (SELECT * FROM r ORDER BY at_us DESC, msg_id LIMIT 200),
f AS (SELECT 'type' AS field, (SELECT count(type) / count(*) FROM r) AS overall, (SELECT count(type) / count(*) FROM w) AS newest UNION ALL SELECT 'message', (SELECT count(message) / count(*) FROM r), (SELECT count(message) / count(*) FROM w)
  UNION ALL SELECT 'at_us', (SELECT count(at_us) / count(*) FROM r), (SELECT count(at_us) / count(*) FROM w))
SELECT field, round(overall, 9) AS overall, round(newest, 9) AS newest, round(newest, 9) < 0.5 * round(overall, 9) AS deprecated FROM f""",
}
