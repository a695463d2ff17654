"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, gnat, kmeans, minhash, packing, passages, pieces, pii, quality, rans, suffixes, toxicity, warc
from .common import documents
from .quality_sql import OP8_SQL


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.replace(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select(
        "doc_id",
        "text",
        F.size("pii").cast("long").alias("n_entities"),
        *[pii.count_of(k).alias(f"n_{k}") for k in pii.PATTERNS],
        F.array_join(F.transform("pii", lambda e: e["surrogate"]), "|").alias("surrogates"),
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.round_trip(spark, documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read(warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(documents(spark, sf_dir)).drop("h")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    done = suffixes.remove(docs, beside=passages.shared_words(docs))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_shared_words")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.segmentations(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "rank", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "log_prob", "gumbel", "inclusion", "decodes")


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = spark.createDataFrame([(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").union(said)
    return chat.round_trip(chat.records_of(table)).withColumnRenamed("id", "conv_id")


OP11_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) AS r(i)),
w AS (
  SELECT *, length(regexp_replace(text, '{chat.ESCAPE}', '\1\\\2\3', 'g')) AS n,
    CASE role {" ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b) in chat.MARKS.items())}
      ELSE {sum(map(len, chat.OTHER))} + length(regexp_replace(role, '{chat.ESCAPE}', '\1\\\2\3', 'g')) END AS marks
  FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n + marks)::BIGINT AS formatted_chars
FROM w GROUP BY conv_id"""


def op12_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


def _op12_sql(k: int = 8, rounds: int = 10) -> str:
    """Each round as two tables: the nearest centroid of every vector, and the centroids after it."""

    def nearest(c: str) -> str:
        gaps = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
        return f"SELECT vec_id, row_no, x, min(c) AS c, any_value(d) AS d FROM (SELECT v.vec_id, v.row_no, v.x, c.c, {gaps} AS d, min({gaps}) OVER (PARTITION BY v.row_no) AS least FROM v, {c} c) WHERE d = least GROUP BY ALL"

    steps = [
        """v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row_no, list_transform(embedding, lambda y: floor(1024 * y::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = 64)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, x FROM v QUALIFY c < {k})",
    ]
    for i in range(rounds):
        steps += [
            f"a{i} AS MATERIALIZED ({nearest(f'c{i}')})",
            f"""c{i + 1} AS MATERIALIZED (
  WITH s AS (SELECT c, j, sum(y)::HUGEINT AS total, count(*) AS n FROM (SELECT c, unnest(range(64)) AS j, unnest(x) AS y FROM a{i}) GROUP BY c, j),
  m AS (SELECT c, list(((total - (((total % n) + n) % n)) // n)::BIGINT ORDER BY j) AS x FROM s GROUP BY c)
  SELECT c, coalesce(m.x, o.x) AS x FROM c{i} o LEFT JOIN m USING (c))""",
        ]
    steps.append(f"f AS MATERIALIZED ({nearest(f'c{rounds}')})")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM f JOIN c{rounds} k USING (c)"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return gnat.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 100 == 0, label)


OP13_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS g, list_transform(embedding, lambda y: floor(256 * y::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = len(embedding)),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.g = v.g AS same, list_sum(list_transform(list_zip(a.x, v.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


QUERIES = {"op13_hard_negatives": op13_hard_negatives, "op12_kmeans": op12_kmeans, "op11_chat": op11_chat, "op4_pieces": op4_pieces, "op5_suffixes": op5_suffixes, "op6_nearest": op6_nearest, "op1_minhash": op1_minhash, "op7_toxicity": op7_toxicity, "op10_warc": op10_warc, "op3_packing": op3_packing, "op9_token_files": op9_token_files, "op2_pii_surrogates": op2_pii_surrogates, "op8_quality_rules": op8_quality_rules}
ORACLE_SQL = {"op13_hard_negatives": OP13_SQL, "op12_kmeans": _op12_sql(), "op11_chat": OP11_SQL, "op10_warc": OP10_SQL, "op8_quality_rules": OP8_SQL}
