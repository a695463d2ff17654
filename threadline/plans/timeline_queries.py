"""Registered queries on timelines, chunks and windows, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadline.functions import text as fx
from threadline.operators import chunks as ch
from threadline.operators import messages as ms
from threadline.sources.views import EVENTS_SQL, TURNS_SQL, event_messages, table, turns

GAP, SPAN, WINDOW, REPLY = 6 * ms.HOUR, 6 * ms.HOUR, 3 * ms.DAY, ms.HOUR


def timeline(spark, sf_dir):
    return ms.first_of_each_id(ms.timeline(event_messages(spark, sf_dir))).select("msg_id", "chat_id", "type", "message", "at_us")


def near_copies(spark, sf_dir):
    return ms.without_near_copies(ms.timeline(event_messages(spark, sf_dir)), SPAN).select("msg_id", "chat_id", "type", "at_us")


def chunked(spark, sf_dir, gap=GAP, window=WINDOW):
    return ch.chunks(ms.timeline(event_messages(spark, sf_dir)), gap, window, REPLY)


def chunk_rows(spark, sf_dir):
    return chunked(spark, sf_dir).select("msg_id", "chat_id", "chunk_no", "kind")


def chunk_links(spark, sf_dir):
    return ch.chunk_table(chunked(spark, sf_dir)).select("chat_id", "chunk_no", "kind", "n_messages", "started_at", "ended_at", "all_automated", "prepended", "owner_no")


def unanswered(spark, sf_dir):
    rows = ms.unanswered(ms.timeline(event_messages(spark, sf_dir)))
    return rows.where("type = 'user'").select("msg_id", "chat_id", "unanswered")


def windows(spark, sf_dir):
    return ch.windows(turns(spark, sf_dir).where("type <> 'system'"), 3).select("msg_id", "chat_id", "pos", "window_no")


def histories(spark, sf_dir):
    return ch.histories(ch.windows(turns(spark, sf_dir).where("type <> 'system'"), 3))


def image_merge(spark, sf_dir):
    rows = turns(spark, sf_dir).where("type <> 'system'")
    image = F.concat(F.lit("https://storage.googleapis.com/b/"), F.col("msg_id").cast("string"), F.lit(".png"))
    rows = rows.withColumn("message", F.when(F.col("msg_id") % 3 == 0, image).otherwise(F.concat(F.lit("turn "), F.col("msg_id").cast("string"))))
    return ch.merge_images(ch.windows(rows, 3))


def slugs(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit(" "), F.col("p_name"), F.lit("-"), F.col("p_type"), F.lit("_ "))
    return p.select("p_partkey", fx.slug(raw).alias("slug"), fx.display_name(fx.slug(raw)).alias("name"))


def url_tokens(spark, sf_dir):
    tokens = ((".com", "[com link]"), (".net", "[net link]"), (".org", "[image]"))
    u = table(spark, sf_dir, "pages")
    return u.select(
        "page_id",
        fx.url_token(F.col("url"), tokens).alias("token"),
        fx.replace_urls(F.concat(F.lit("see "), F.col("url"), F.lit(" and [media: "), F.col("url"), F.lit("] now")), tokens).alias("text"),
    )


def uploads(spark, sf_dir):
    k = F.col("msg_id") % 4
    note = F.concat(F.lit("NOTE: User uploaded "), F.when(k == 0, "an image").otherwise(F.concat(k.cast("string"), F.lit(" image(s)"))), F.lit(". User Message: "), F.when(k == 3, "").otherwise(F.concat(F.lit("text "), F.col("msg_id").cast("string"))), F.lit(" Image URL(s): https://storage.googleapis.com/x.png"))
    note = F.regexp_replace(note, r"URL\(s\)", "URLs")
    return turns(spark, sf_dir).select("msg_id", fx.clean_upload(note).alias("text"))


CHUNKS_SQL = f"""
anchors AS (
  SELECT chat_id, min(at_us) AS a FROM timeline WHERE type = 'user' GROUP BY chat_id
  UNION ALL
  SELECT n.chat_id, (SELECT min(t.at_us) FROM timeline t WHERE t.type = 'user' AND t.chat_id = n.chat_id AND t.at_us > n.a + {{window}})
  FROM anchors n
  WHERE EXISTS (SELECT 1 FROM timeline t WHERE t.type = 'user' AND t.chat_id = n.chat_id AND t.at_us > n.a + {{window}})),
opened AS (
  SELECT t.*, (t.type = 'user' AND a.a IS NOT NULL AND t.msg_id = min(CASE WHEN t.type = 'user' THEN t.msg_id END) OVER (PARTITION BY t.chat_id, t.at_us)) AS opens
  FROM timeline t LEFT JOIN anchors a ON a.chat_id = t.chat_id AND a.a = t.at_us),
placed AS (SELECT *, max(CASE WHEN opens THEN at_us END) OVER (PARTITION BY chat_id ORDER BY at_us, msg_id ROWS UNBOUNDED PRECEDING) AS anchor FROM opened),
inside AS (SELECT *, coalesce(at_us - anchor <= {{window}}, false) AS in_w FROM placed),
lasts AS (SELECT *, max(CASE WHEN type = 'user' AND in_w THEN at_us END) OVER (PARTITION BY chat_id, anchor) AS last_user FROM inside),
eng AS (SELECT *, in_w AND (last_user = anchor OR at_us <= last_user OR at_us - last_user <= {REPLY}) AS engaged FROM lasts),
starts AS (
  SELECT *, CASE WHEN engaged THEN opens ELSE coalesce(lag(engaged) OVER w, true) OR at_us - lag(at_us) OVER w > {{gap}} END AS starts
  FROM eng WINDOW w AS (PARTITION BY chat_id ORDER BY at_us, msg_id)),
chunked AS (
  SELECT msg_id, chat_id, user_id, type, message, at_us, sum(starts::INT) OVER (PARTITION BY chat_id ORDER BY at_us, msg_id ROWS UNBOUNDED PRECEDING)::BIGINT AS chunk_no,
    CASE WHEN engaged THEN 'user_engaged' ELSE 'bot_only' END AS kind
  FROM starts)"""


def chunks_sql(gap=GAP, window=WINDOW) -> str:
    return f"WITH RECURSIVE {EVENTS_SQL}, {CHUNKS_SQL.format(gap=gap, window=window)}"


WINDOWS_SQL = f"""WITH RECURSIVE {TURNS_SQL},
rows_in AS (SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY at_us, msg_id) - 1 AS pos FROM turns WHERE type <> 'system'),
starts AS (
  SELECT DISTINCT chat_id, 0::BIGINT AS s FROM rows_in
  UNION ALL
  SELECT x.chat_id, (SELECT min(r.pos) FROM rows_in r WHERE r.chat_id = x.chat_id AND r.type = 'user' AND r.pos >= x.s + 3)
  FROM starts x WHERE EXISTS (SELECT 1 FROM rows_in r WHERE r.chat_id = x.chat_id AND r.type = 'user' AND r.pos >= x.s + 3)),
windowed AS (SELECT r.*, (SELECT count(*) FROM starts x WHERE x.chat_id = r.chat_id AND x.s <= r.pos) - 1 AS window_no FROM rows_in r)"""

QUERIES = {
    "timeline": timeline,
    "near_copies": near_copies,
    "chunks": chunk_rows,
    "chunk_links": chunk_links,
    "unanswered": unanswered,
    "windows": windows,
    "histories": histories,
    "image_merge": image_merge,
    "slugs": slugs,
    "url_tokens": url_tokens,
    "uploads": uploads,
}

ORACLE_SQL = {
    "timeline": f"WITH {EVENTS_SQL} SELECT msg_id, chat_id, type, message, at_us FROM timeline",
    "near_copies": f"""WITH RECURSIVE {EVENTS_SQL},
bots AS (SELECT *, row_number() OVER (PARTITION BY chat_id, message ORDER BY at_us, msg_id) AS rn FROM timeline WHERE type <> 'user'),
kept AS (
  SELECT chat_id, message, rn, at_us FROM bots WHERE rn = 1
  UNION ALL
  SELECT k.chat_id, k.message, n.rn, n.at_us FROM kept k, LATERAL (
    SELECT b.rn, b.at_us FROM bots b WHERE b.chat_id = k.chat_id AND b.message = k.message AND b.rn > k.rn AND b.at_us > k.at_us + {SPAN} ORDER BY b.rn LIMIT 1) n)
SELECT msg_id, chat_id, type, at_us FROM timeline WHERE type = 'user'
UNION ALL SELECT b.msg_id, b.chat_id, b.type, b.at_us FROM bots b JOIN kept USING (chat_id, message, rn)""",
    "chunks": f"{chunks_sql()} SELECT msg_id, chat_id, chunk_no, kind FROM chunked",
    "chunk_links": f"""{chunks_sql()},
each_chunk AS (
  SELECT chat_id, chunk_no, max(kind) AS kind, count(*) AS n_messages, min(at_us) AS started_at, max(at_us) AS ended_at, bool_and(type = 'automated') AS all_automated
  FROM chunked GROUP BY chat_id, chunk_no),
linked AS (SELECT *, kind = 'bot_only' AND coalesce(lead(kind) OVER (PARTITION BY chat_id ORDER BY chunk_no) = 'user_engaged', false) AS prepended FROM each_chunk)
SELECT *, chunk_no + prepended::INT AS owner_no FROM linked""",
    "unanswered": f"""WITH {EVENTS_SQL}
SELECT msg_id, chat_id, coalesce(lead(type) OVER (PARTITION BY chat_id ORDER BY at_us, msg_id), 'user') = 'user' AS unanswered
FROM timeline QUALIFY type = 'user'""",
    "windows": f"{WINDOWS_SQL} SELECT msg_id, chat_id, pos, window_no FROM windowed",
    "histories": f"""{WINDOWS_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY chat_id, window_no ORDER BY pos) - 1 AS i FROM windowed)
SELECT chat_id, window_no, count(*) AS n_messages, string_agg(i::VARCHAR || ' [' || type || ']: ' || coalesce(message, ''), chr(10) ORDER BY pos) AS history
FROM numbered GROUP BY chat_id, window_no""",
    "image_merge": f"""{WINDOWS_SQL},
f AS (SELECT *, msg_id % 3 = 0 AND type <> 'user' AS image, row_number() OVER (PARTITION BY chat_id, window_no ORDER BY pos) AS rn FROM windowed),
g AS (SELECT *, image AND rn > 1 AS gone FROM f),
k AS (SELECT *, max(CASE WHEN NOT gone THEN pos END) OVER (PARTITION BY chat_id, window_no ORDER BY pos ROWS UNBOUNDED PRECEDING) AS keeper FROM g),
c AS (SELECT *, count(*) FILTER (gone) OVER (PARTITION BY chat_id, window_no, keeper) AS absorbed FROM k)
SELECT chat_id, window_no, msg_id, row_number() OVER (PARTITION BY chat_id, window_no ORDER BY pos) - 1 AS new_pos,
  CASE WHEN image THEN '[image]' WHEN msg_id % 3 = 0 THEN 'https://storage.googleapis.com/b/' || msg_id || '.png' ELSE 'turn ' || msg_id END || repeat(' [image]', absorbed) AS text, absorbed
FROM c WHERE NOT gone""",
    "slugs": """
WITH s AS (SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(trim(' ' || p_name || '-' || p_type || '_ ')), '[-\\s]+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM part)
SELECT p_partkey, slug, array_to_string(list_transform(string_split(replace(slug, '_', ' '), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS name FROM s""",
    "url_tokens": """
WITH d AS (SELECT page_id, url, split_part(regexp_replace(url, '^https?://(www\\.)?', ''), '/', 1) AS domain FROM pages),
t AS (SELECT *, CASE WHEN ends_with(domain, '.com') THEN '[com link]' WHEN ends_with(domain, '.net') THEN '[net link]'
  WHEN ends_with(domain, '.org') THEN CASE WHEN ends_with(lower(url), '.vcf') THEN '[contact card]' ELSE '[image]' END ELSE '[link]' END AS token FROM d)
SELECT page_id, token, 'see ' || token || ' and ' || token || ' now' AS text FROM t""",
    "uploads": f"""WITH {TURNS_SQL}
SELECT msg_id, CASE WHEN msg_id % 4 IN (2, 3) THEN 'User uploaded ' || (msg_id % 4) || ' image(s)' ELSE 'User uploaded an image' END
  || CASE WHEN msg_id % 4 = 3 THEN ' [image]' ELSE ': "text ' || msg_id || '" [image]' END AS text FROM turns""",
}
