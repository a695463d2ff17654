"""Registered queries on segments: routes, graders, matching and metrics, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadline.operators import chunks as ch
from threadline.operators import graders as gr
from threadline.operators import matching as mt
from threadline.operators import messages as ms
from threadline.operators import metrics as mx
from threadline.operators import segments as sg
from threadline.sources.views import event_messages
from threadline.work import kept

from .timeline_queries import chunked, chunks_sql

H, D = ms.HOUR, ms.DAY
#: run_id: gap and window of the model segmentations compared.
RUNS = {1: (12 * H, 2 * D), 2: (6 * H, 2 * D), 3: (24 * H, 3 * D)}


def segments(spark, sf_dir):
    return sg.segments(chunked(spark, sf_dir))


def routes(spark, sf_dir):
    rows = chunked(spark, sf_dir)
    rows = rows.withColumn("message", F.when(F.col("message") == "view 3", F.lit("When are you free?")).otherwise(F.col("message")))
    return sg.routes(rows, ch.chunk_table(rows))


def _defects(spark, sf_dir):
    """Bridge and segments with planted faults."""
    whole = kept(sg.bridge(ms.unanswered(chunked(spark, sf_dir))))
    rows = whole.select("segment_id", "user_id", "msg_id", "pos")
    twice = rows.where("msg_id % 89 = 0").withColumn("segment_id", F.col("segment_id") + 1)
    rows = rows.where("msg_id % 97 <> 0").unionByName(twice)
    s = F.col("segment_id")
    mark = lambda c: F.when(s % 7 == 0, c)
    segs = sg.of_bridge(whole).withColumns(
        {
            "topic": F.when(s % 53 != 0, F.col("topic")),
            "confidence": F.when(s % 41 == 0, F.lit(1.0)).otherwise(F.col("confidence")),
            "true_topic": mark(F.lit("t")),
            "true_sub_topic": mark(F.lit("s")),
            "reviewed_by": F.when(s % 70 != 0, mark(F.lit("r"))),
        }
    )
    return rows, segs, ms.timeline(event_messages(spark, sf_dir))


def graders(spark, sf_dir):
    rows, segs, source = _defects(spark, sf_dir)
    return gr.run_all(rows, segs, source)


def grader_details(spark, sf_dir):
    rows, _, source = _defects(spark, sf_dir)
    return gr.user_details(rows, source)


def _compared(spark, sf_dir):
    """Truth (run 0) and the runs, segmented at once: each row stands there once per run."""
    runs = [(0, 6 * H, 3 * D), *((run, gap, window) for run, (gap, window) in RUNS.items())]
    of_run = F.explode(F.array(*[F.struct(F.lit(r).alias("run_id"), F.lit(g).alias("gap"), F.lit(w).alias("span")) for r, g, w in runs]))
    rows = ms.timeline(event_messages(spark, sf_dir)).withColumn("run", of_run).select("*", "run.run_id", "run.gap", "run.span").drop("run")
    rows = ch.chunks(rows, F.col("gap"), F.col("span"), H, "run_id")
    bridge = kept(sg.bridge(ms.unanswered(rows, "run_id"), "run_id").select("run_id", "msg_id", "chat_id", "user_id", "type", "at_us", "kind", "segment_id", "unanswered"))
    segs = kept(sg.of_bridge(bridge, "run_id"))
    truth, model = segs.where("run_id = 0").drop("run_id"), segs.where("run_id > 0")
    return truth, model, mt.overlaps(bridge.where("run_id = 0").drop("run_id"), bridge.where("run_id > 0"), truth, model)


def _scattered(spark, sf_dir):
    """Truth and runs whose segments deal a chat's messages out in turn, so that pairs entangle."""
    truth_rows = kept(sg.bridge(ms.unanswered(chunked(spark, sf_dir))))
    truth = sg.of_bridge(truth_rows)
    of_run = F.explode(F.array(F.lit(2), F.lit(3))).alias("run_id")
    rows = truth_rows.drop("segment_id").select("*", of_run).withColumn("segment_id", F.col("chat_id") * 10 + F.col("msg_id") % F.col("run_id"))
    rows = rows.withColumn("kind", F.lit("user_engaged"))
    return truth, mt.overlaps(truth_rows, rows, truth, sg.of_bridge(rows, "run_id"))


def scattered_matches(spark, sf_dir):
    return mt.optimal(_scattered(spark, sf_dir)[1]).select("run_id", "gt_id", "model_id", "jaccard", "score")


def overlap_pairs(spark, sf_dir):
    return _compared(spark, sf_dir)[2].drop("user_id")


def mutual_best(spark, sf_dir):
    return mt.mutual_best(_compared(spark, sf_dir)[2]).select("run_id", "gt_id", "model_id", "jaccard")


def matching(spark, sf_dir):
    return mt.optimal(_compared(spark, sf_dir)[2]).select("run_id", "gt_id", "model_id", "jaccard", "score")


def _records(spark, sf_dir):
    truth, model, pairs = _compared(spark, sf_dir)
    pairs = kept(pairs)
    return kept(mt.records(truth, model, pairs, mt.optimal(pairs))), model


def match_records(spark, sf_dir):
    return _records(spark, sf_dir)[0]


def leaderboard(spark, sf_dir):
    records, model = _records(spark, sf_dir)
    unified, topic = mx.unified(records, model).withColumn("unified_score", F.round("unified_score", 6)), mx.topic_scores(records, model)
    sub = mx.sub_topic_scores(records).select("run_id", F.col("recall").alias("sub_accuracy"))
    cover = mx.coverage(records, model).where("scope = 'all'").select("run_id", "match_rate")
    scores = unified.join(topic.select("run_id", F.col("recall").alias("topic_accuracy")), "run_id").join(sub, "run_id").join(cover, "run_id")
    ranked = mx.leaderboard(scores.withColumn("group_id", F.lit(1)))
    return ranked.select("run_id", "rank", "unified_score", "topic_accuracy", "sub_accuracy", "match_rate")


def _over(metric, with_model=False, rounded=()):
    """A query of a metric over the records; the columns ``rounded`` to six places, as in its SQL."""

    def query(spark, sf_dir):
        records, model = _records(spark, sf_dir)
        out = metric(records, model) if with_model else metric(records)
        return out.withColumns({c: F.round(c, 6) for c in rounded})

    return query


def mismatches(records):
    return records.where(F.col("matched") & ~F.col("gt_topic").eqNullSafe(F.col("model_topic"))).select("run_id", "gt_id", "model_id", "gt_topic", "model_topic")


def unmatched(records):
    return records.where("NOT matched").select("run_id", "gt_id", "gt_topic", "iou")


SEGMENTS_SQL = """
ans_{p} AS (SELECT *, coalesce(lead(type) OVER (PARTITION BY chat_id ORDER BY at_us, msg_id), 'user') = 'user' AND type = 'user' AS unanswered,
  chat_id * 100000 + chunk_no AS segment_id, row_number() OVER (PARTITION BY chat_id ORDER BY at_us, msg_id) - 1 AS pos FROM {src}),
counts_{p} AS (SELECT segment_id, type, count(*) AS c FROM ans_{p} GROUP BY ALL),
topics_{p} AS (SELECT segment_id, arg_min(type, (-c, type)) AS topic FROM counts_{p} GROUP BY segment_id),
seg_{p} AS (
  SELECT s.*, topic FROM (
    SELECT segment_id, chat_id, user_id, kind, count(*) AS n_messages, min(at_us) AS started_at, max(at_us) AS ended_at, bool_or(type = 'user') AS has_user,
      bool_or(unanswered) AS has_failure, arg_min(type, (at_us, msg_id)) AS sub_topic,
      CASE WHEN count(*) FILTER (type = 'user') > 0 AND count(*) FILTER (type <> 'user') > 0 THEN least(count(*) FILTER (type = 'user') / count(*) FILTER (type <> 'user'), 1.0) ELSE 0.0 END::DOUBLE AS response_rate,
      CASE WHEN bool_or(type = 'user') THEN (count(*) * 37 % 100) / 100 ELSE 1.0 END::DOUBLE AS confidence
    FROM ans_{p} GROUP BY segment_id, chat_id, user_id, kind) s JOIN topics_{p} USING (segment_id))"""


#: Pairs of ``ans_gt`` and ``model_rows`` that share a message.
PAIRS_SQL = """shared AS (SELECT m.run_id, g.segment_id AS gt_id, m.segment_id AS model_id, count(*) AS n FROM ans_gt g JOIN model_rows m USING (msg_id) GROUP BY ALL),
raw_pairs AS (
  SELECT s.*, n / (a.n_messages + b.n_messages - n) AS jaccard, greatest(a.ended_at, b.ended_at) - least(a.started_at, b.started_at) AS u,
    greatest(least(a.ended_at, b.ended_at) - greatest(a.started_at, b.started_at), 0) AS i
  FROM shared s JOIN seg_gt a ON a.segment_id = gt_id JOIN model b ON b.run_id = s.run_id AND b.segment_id = model_id),
pairs AS (SELECT run_id, gt_id, model_id, n, jaccard, CASE WHEN u > 0 THEN i / u ELSE 0.0 END::DOUBLE AS time_iou FROM raw_pairs),
scored AS (SELECT *, 0.7::DOUBLE * jaccard + (1 - 0.7::DOUBLE) * time_iou AS score FROM pairs)"""

#: The best one-to-one choice of each connected component of ``scored``, by trying all of them.
OPTIMAL_SQL = """edges AS (SELECT * FROM scored WHERE score >= 0.3),
linked AS (SELECT DISTINCT a.run_id, a.gt_id AS x, b.gt_id AS y FROM edges a JOIN edges b ON a.run_id = b.run_id AND a.model_id = b.model_id),
reach AS (SELECT run_id, x, y FROM linked UNION SELECT r.run_id, r.x, l.y FROM reach r JOIN linked l ON l.run_id = r.run_id AND l.x = r.y),
parts AS (SELECT run_id, x AS gt_id, min(y) AS part FROM reach GROUP BY ALL),
ordered AS (SELECT *, row_number() OVER (PARTITION BY run_id, part ORDER BY gt_id) AS i, count(*) OVER (PARTITION BY run_id, part) AS size FROM parts),
tried AS (
  SELECT DISTINCT run_id, part, size, 0::BIGINT AS i, []::BIGINT[] AS gts, []::BIGINT[] AS models, 0::DOUBLE AS total FROM ordered
  UNION ALL
  SELECT t.run_id, t.part, t.size, t.i + 1, CASE WHEN e.model_id IS NULL THEN t.gts ELSE list_append(t.gts, o.gt_id::BIGINT) END,
    CASE WHEN e.model_id IS NULL THEN t.models ELSE list_append(t.models, e.model_id::BIGINT) END, t.total + coalesce(e.score, 0)
  FROM tried t JOIN ordered o ON o.run_id = t.run_id AND o.part = t.part AND o.i = t.i + 1
  JOIN (SELECT run_id, gt_id, model_id, score FROM edges UNION ALL SELECT DISTINCT run_id, gt_id, NULL, NULL FROM edges) e
    ON e.run_id = o.run_id AND e.gt_id = o.gt_id AND (e.model_id IS NULL OR NOT list_contains(t.models, e.model_id))),
tops AS (SELECT * FROM tried WHERE i = size QUALIFY row_number() OVER (PARTITION BY run_id, part ORDER BY total DESC, gts, models) = 1),
pairs_of AS (SELECT run_id, unnest(gts) AS gt_id, unnest(models) AS model_id FROM tops),
chosen AS (SELECT e.* FROM pairs_of JOIN edges e USING (run_id, gt_id, model_id))"""


def _segments_sql() -> str:
    return chunks_sql() + "," + SEGMENTS_SQL.format(p="gt", src="chunked")


def _compared_sql() -> str:
    """Truth and the three runs; each run's chunks are a query of their own."""
    out = _segments_sql()
    for run, (gap, window) in RUNS.items():
        inner = chunks_sql(gap, window) + " SELECT * FROM chunked"
        out += f",\nrun_{run} AS ({inner}), {SEGMENTS_SQL.format(p=f'r{run}', src=f'run_{run}')}"
    union = lambda x: " UNION ALL ".join(f"SELECT {r} AS run_id, * FROM {x}_r{r}" for r in RUNS)
    return (
        out
        + f""",
model AS ({union("seg")}), model_rows AS ({union("ans")}),
""" + PAIRS_SQL + """,
mutual AS (
  SELECT * FROM scored WHERE score >= 0.3
  QUALIFY row_number() OVER (PARTITION BY run_id, gt_id ORDER BY score DESC, model_id) = 1 AND row_number() OVER (PARTITION BY run_id, model_id ORDER BY score DESC, gt_id) = 1),
"""
        + OPTIMAL_SQL
        + """,
best AS (SELECT run_id, gt_id, max(jaccard) AS b FROM scored GROUP BY ALL),
records AS (
  SELECT r.run_id, g.segment_id AS gt_id, g.topic AS gt_topic, g.sub_topic AS gt_sub, g.has_user AS engaged, m.model_id, x.topic AS model_topic, x.sub_topic AS model_sub, x.confidence,
    coalesce(m.jaccard, b.b, 0.0) AS iou, m.model_id IS NOT NULL AS matched
  FROM seg_gt g CROSS JOIN (SELECT unnest([1, 2, 3]) AS run_id) r
  LEFT JOIN chosen m ON m.run_id = r.run_id AND m.gt_id = g.segment_id LEFT JOIN model x ON x.run_id = r.run_id AND x.segment_id = m.model_id
  LEFT JOIN best b ON b.run_id = r.run_id AND b.gt_id = g.segment_id),
totals AS (SELECT run_id, count(*) AS n_model FROM model GROUP BY run_id),
topic_scores AS (
  SELECT run_id, count(*) AS n_gt, any_value(n_model) AS n_model, count(*) FILTER (matched) AS n_matched, count(*) FILTER (matched AND gt_topic = model_topic) AS correct
  FROM records JOIN totals USING (run_id) GROUP BY run_id),
topic_prf AS (SELECT *, correct / n_model AS precision, correct / n_gt AS recall FROM topic_scores),
per_topic AS (
  SELECT coalesce(a.run_id, b.run_id) AS run_id, coalesce(a.topic, b.topic) AS topic, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn, coalesce(support, 0) AS support
  FROM (SELECT run_id, gt_topic AS topic, count(*) FILTER (matched AND gt_topic = model_topic) AS tp, count(*) FILTER (NOT (matched AND gt_topic = model_topic)) AS fn, count(*) AS support FROM records GROUP BY ALL) a
  FULL JOIN (SELECT run_id, model_topic AS topic, count(*) AS fp FROM records WHERE matched AND gt_topic <> model_topic GROUP BY ALL) b ON a.run_id = b.run_id AND a.topic = b.topic),
per_topic_prf AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END::DOUBLE AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END::DOUBLE AS recall FROM per_topic),
per_topic_f1 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END::DOUBLE AS f1 FROM per_topic_prf),
sub_scores AS (
  SELECT run_id, count(gt_sub) AS n_gt, count(*) FILTER (matched AND model_sub IS NOT NULL) AS n_model, count(*) FILTER (matched AND gt_sub = model_sub) AS correct FROM records GROUP BY run_id),
unified AS (
  SELECT run_id, round(sum(CASE WHEN matched AND gt_topic = model_topic THEN iou * (0.5 + 0.5 * (gt_sub = model_sub)::INT) ELSE 0 END) / greatest(count(*), any_value(n_model)), 6) AS unified_score,
    round(sum(CASE WHEN matched AND gt_topic = model_topic THEN iou ELSE 0 END) / greatest(count(*), any_value(n_model)), 6) AS topic_score, round(avg(iou) FILTER (matched), 6) AS avg_jaccard
  FROM records JOIN totals USING (run_id) GROUP BY run_id),
scopes AS (SELECT 'all' AS scope, * FROM records UNION ALL SELECT 'user_engaged', * FROM records WHERE engaged),
coverage AS (
  SELECT run_id, scope, count(*) AS n_gt, count(*) FILTER (matched) AS n_matched, count(*) FILTER (matched) / count(*) AS match_rate, round(avg(iou) FILTER (matched), 6) AS avg_iou,
    CASE WHEN scope = 'all' THEN any_value(n_model) ELSE count(*) FILTER (matched) END / count(*) AS segment_ratio
  FROM scopes JOIN totals USING (run_id) GROUP BY run_id, scope),
bins AS (SELECT * FROM (VALUES (0, 0.0, 0.3), (1, 0.3, 0.6), (2, 0.6, 0.8), (3, 0.8, 1.01)) t(bin, lo, hi)),
binned AS (
  SELECT r.run_id, b.bin, count(x.gt_id) AS n, coalesce(avg((x.gt_topic = x.model_topic)::INT), 0) AS a, avg(x.confidence) AS c, (any_value(b.lo) + least(any_value(b.hi), 1.0)) / 2 AS mid
  FROM (SELECT DISTINCT run_id FROM records) r CROSS JOIN bins b LEFT JOIN records x ON x.run_id = r.run_id AND x.matched AND x.confidence >= b.lo::DOUBLE AND x.confidence < b.hi::DOUBLE GROUP BY r.run_id, b.bin),
calibration AS (
  SELECT run_id, bin::INT AS bin, n, round(a, 6) AS accuracy, round(coalesce(c, mid::DOUBLE), 6) AS confidence,
    round(sum(n * abs(a - coalesce(c, 0))) OVER (PARTITION BY run_id) / sum(n) OVER (PARTITION BY run_id), 6) AS ece FROM binned)"""
    )


COMPARED_SQL = _compared_sql()

GRADERS_SQL = f"""{_segments_sql()},
rows_ok AS (SELECT segment_id, user_id, msg_id, pos FROM ans_gt),
br AS (SELECT * FROM rows_ok WHERE msg_id % 97 <> 0 UNION ALL SELECT segment_id + 1, user_id, msg_id, pos FROM rows_ok WHERE msg_id % 89 = 0),
sd AS (
  SELECT * EXCLUDE (topic, confidence), CASE WHEN segment_id % 53 <> 0 THEN topic END AS topic, CASE WHEN segment_id % 41 = 0 THEN 1.0 ELSE confidence END AS confidence,
    (segment_id % 7 = 0)::INT * 2 + (segment_id % 7 = 0 AND segment_id % 70 <> 0)::INT AS marks FROM seg_gt),
used AS (SELECT user_id, msg_id, count(*) AS uses FROM br GROUP BY ALL),
pu AS (
  SELECT coalesce(s.user_id, u.user_id) AS user_id, count(*) FILTER (u.uses IS NULL) AS gaps, count(*) FILTER (s.msg_id IS NULL) AS extras, count(*) FILTER (u.uses > 1) AS repeats
  FROM timeline s FULL JOIN used u ON s.user_id = u.user_id AND s.msg_id = u.msg_id GROUP BY 1),
g08 AS (SELECT u.user_id, bool_or(uses > 1 AND coalesce(type, '') <> 'user') AS bad FROM used u LEFT JOIN timeline t USING (msg_id) GROUP BY 1),
holes AS (SELECT user_id, bool_or(h) AS h FROM (SELECT user_id, segment_id, max(pos) - min(pos) + 1 <> count(DISTINCT pos) AS h FROM br GROUP BY ALL) GROUP BY 1),
twice AS (SELECT user_id, bool_or(t) AS t FROM (SELECT user_id, pos, count(*) > 1 AS t FROM br GROUP BY ALL) GROUP BY 1),
res AS (
  SELECT 'G0.3' AS grader, 0.05 AS share, count(*) AS total, count(*) FILTER (gaps > 0 OR extras > 0 OR repeats > 0) AS failures FROM pu
  UNION ALL SELECT 'G0.7', 0.05, count(*), count(*) FILTER (gaps > 0 OR extras > 0) FROM pu
  UNION ALL SELECT 'G0.8', 0.05, count(*), count(*) FILTER (bad) FROM g08
  UNION ALL SELECT 'G0.9', 0, count(*), count(*) FILTER (marks IN (1, 2)) FROM sd
  UNION ALL SELECT 'G0.10', 0, count(*), count(*) FILTER (coalesce(topic, '') = '' OR coalesce(sub_topic, '') = '') FROM sd
  UNION ALL SELECT 'G0.11', 0, count(*), count(*) FILTER (CASE WHEN has_user THEN confidence < 0 OR confidence >= 1 ELSE confidence <> 1 END) FROM sd
  UNION ALL SELECT 'G1.2', 0.2, count(*), count(*) FILTER (n_messages = 1) FROM sd
  UNION ALL SELECT 'G1.4', 0.05, count(*), count(*) FILTER (h OR t) FROM holes JOIN twice USING (user_id)
  UNION ALL SELECT 'G0.1', 0, count(*), count(*) FILTER (bad) FROM (SELECT segment_id, count(*) > count(DISTINCT msg_id) AS bad FROM br GROUP BY 1)
  UNION ALL SELECT 'G0.2', 0, count(*), count(*) FILTER (msg_id NOT IN (SELECT msg_id FROM timeline)) FROM br
  UNION ALL SELECT 'G1.4d', 0, count(*), count(*) FILTER (started_at > ended_at) FROM sd),
tops AS (SELECT count(*) AS n FROM sd GROUP BY topic)"""

_ok = "matched AND gt_topic IS DISTINCT FROM model_topic"
QUERIES = {
    "segments": segments,
    "routes": routes,
    "graders": graders,
    "grader_details": grader_details,
    "overlap_pairs": overlap_pairs,
    "mutual_best": mutual_best,
    "matching": matching,
    "scattered_matches": scattered_matches,
    "match_records": match_records,
    "topic_scores": _over(mx.topic_scores, True),
    "per_topic": _over(mx.per_topic),
    "averaged_f1": _over(lambda r: mx.averaged_f1(mx.per_topic(r)), rounded=("macro_f1", "weighted_f1")),
    "confusion": _over(mx.confusion),
    "sub_topic_scores": _over(mx.sub_topic_scores),
    "unified_score": _over(mx.unified, True, ("unified_score", "topic_score", "avg_jaccard")),
    "calibration": _over(mx.calibration, rounded=("accuracy", "confidence", "ece")),
    "coverage": _over(mx.coverage, True, ("avg_iou",)),
    "mismatches": _over(mismatches),
    "unmatched": _over(unmatched),
    "leaderboard": leaderboard,
}
ORACLE_SQL = {
    "segments": f"{_segments_sql()} SELECT segment_id, chat_id, user_id, kind, n_messages, started_at, ended_at, has_user, has_failure, topic, sub_topic, response_rate, confidence FROM seg_gt",
    "routes": f"""{chunks_sql()},
t AS (SELECT chat_id, user_id, chunk_no, max(kind) AS kind, bool_and(type = 'automated') AS aa, bool_or(message = 'view 3') AS sch FROM chunked GROUP BY ALL),
l AS (SELECT *, kind = 'bot_only' AND coalesce(lead(kind) OVER (PARTITION BY chat_id ORDER BY chunk_no) = 'user_engaged', false) AS pre FROM t),
d AS (SELECT *, kind = 'bot_only' AND chunk_no = 1 AND aa AS opening FROM l),
e AS (SELECT *, kind = 'bot_only' AND NOT pre AND NOT opening AND sch AS due FROM d),
f AS (SELECT *, sum(due::INT) OVER (PARTITION BY user_id ORDER BY chat_id, chunk_no) AS turn FROM e)
SELECT chat_id, chunk_no, kind, CASE WHEN pre THEN 'prepended' WHEN opening THEN 'onboarding' WHEN due AND turn = 1 THEN 'availability_request' WHEN due THEN 'availability_reminder'
  WHEN kind = 'bot_only' AND aa THEN 'template' WHEN kind = 'bot_only' THEN 'bot_label' ELSE 'user_label' END AS route FROM f""",
    "graders": f"""{GRADERS_SQL}
SELECT grader, CASE WHEN grader = 'G1.2' THEN failures < share * total ELSE failures = 0 OR failures < share * total END AS passed, total, failures FROM res
UNION ALL SELECT 'G3.1', max(n) <= 0.4 * sum(n), sum(n)::BIGINT, max(n) FROM tops""",
    "grader_details": f"""{GRADERS_SQL}
SELECT user_id, gaps, extras, repeats, (row_number() OVER (ORDER BY gaps + extras + repeats DESC, user_id))::INT AS rank FROM pu WHERE gaps + extras + repeats > 0 QUALIFY rank <= 20""",
    "overlap_pairs": f"{COMPARED_SQL} SELECT run_id, gt_id, model_id, n, jaccard, time_iou, score FROM scored",
    "mutual_best": f"{COMPARED_SQL} SELECT run_id, gt_id, model_id, jaccard FROM mutual",
    "matching": f"{COMPARED_SQL} SELECT run_id, gt_id, model_id, jaccard, score FROM chosen",
    "scattered_matches": f"""{_segments_sql()},
model_rows AS (SELECT run_id, user_id, at_us, msg_id, chat_id * 10 + msg_id % run_id AS segment_id FROM ans_gt, (SELECT unnest([2, 3]) AS run_id)),
model AS (SELECT run_id, segment_id, count(*) AS n_messages, min(at_us) AS started_at, max(at_us) AS ended_at FROM model_rows GROUP BY ALL),
{PAIRS_SQL},
{OPTIMAL_SQL} SELECT run_id, gt_id, model_id, jaccard, score FROM chosen""",
    "match_records": f"{COMPARED_SQL} SELECT * FROM records",
    "topic_scores": f"{COMPARED_SQL} SELECT run_id, n_gt, n_model, n_matched, correct, precision, recall, 2 * precision * recall / (precision + recall) AS f1, correct / n_matched AS matched_accuracy FROM topic_prf",
    "per_topic": f"{COMPARED_SQL} SELECT run_id, topic, tp, fp, fn, support, precision, recall, f1 FROM per_topic_f1",
    "averaged_f1": f"{COMPARED_SQL} SELECT run_id, round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM per_topic_f1 GROUP BY run_id",
    "confusion": f"{COMPARED_SQL} SELECT run_id, gt_topic, coalesce(model_topic, '') AS model_topic, count(*) AS n FROM records WHERE matched GROUP BY ALL",
    "sub_topic_scores": f"{COMPARED_SQL} SELECT run_id, n_gt, n_model, correct, correct / n_model AS precision, correct / n_gt AS recall, 2 * (correct / n_model) * (correct / n_gt) / (correct / n_model + correct / n_gt) AS f1 FROM sub_scores",
    "unified_score": f"{COMPARED_SQL} SELECT * FROM unified",
    "calibration": f"{COMPARED_SQL} SELECT * FROM calibration",
    "coverage": f"{COMPARED_SQL} SELECT * FROM coverage",
    "mismatches": f"{COMPARED_SQL} SELECT run_id, gt_id, model_id, gt_topic, model_topic FROM records WHERE {_ok}",
    "unmatched": f"{COMPARED_SQL} SELECT run_id, gt_id, gt_topic, iou FROM records WHERE NOT matched",
    "leaderboard": f"""{COMPARED_SQL},
s AS (SELECT u.run_id, unified_score, t.recall AS topic_accuracy, b.correct / b.n_gt AS sub_accuracy, match_rate FROM unified u JOIN topic_prf t USING (run_id) JOIN sub_scores b USING (run_id) JOIN coverage c ON c.run_id = u.run_id AND scope = 'all')
SELECT run_id, (row_number() OVER (ORDER BY coalesce(unified_score, -1) DESC, sub_accuracy DESC NULLS FIRST, topic_accuracy DESC NULLS FIRST, match_rate DESC NULLS FIRST, run_id))::INT AS rank, unified_score, topic_accuracy, sub_accuracy, match_rate FROM s""",
}
