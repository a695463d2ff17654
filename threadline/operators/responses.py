"""Label responses as tables: valid segments, and a reject table with reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTIMENTS = ("positive", "neutral", "negative", "mixed")
FIELDS = ("topic", "subTopic", "summary", "messageIndices", "confidence")
_ITEM = "struct<topic:string,subTopic:string,summary:string,messageIndices:array<string>,confidence:string,sentiment:string>"


def parsed(responses: DataFrame) -> DataFrame:
    """window_id, item_no and the fields of each item, with ``reason`` set where it is rejected.

    responses: window_id, n_msgs, response.  Fences are dropped and the outermost braces
    taken.  Leaves are read as strings, so that one bad leaf rejects its item only.
    """
    bare = F.regexp_replace("response", r"```(?:json)?", "")
    body = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    rows = responses.select("window_id", "n_msgs", F.nullif(body, F.lit("")).alias("body"))
    rows = rows.withColumn("json", F.try_parse_json("body"))
    items = F.try_variant_get("json", "$.segments", "array<variant>")
    rows = rows.withColumn("items", items)
    whole = F.when(F.col("body").isNull(), "no object").when(F.col("json").isNull(), "bad JSON").when(F.col("items").isNull(), "no list")
    bad = rows.where(whole.isNotNull()).select("window_id", F.lit(-1).alias("item_no"), whole.alias("reason"), *[F.lit(None).cast(t).alias(c) for c, t in (("topic", "string"), ("sub_topic", "string"), ("summary", "string"), ("indices", "array<int>"), ("confidence", "double"), ("sentiment", "string"))])
    each = rows.where(whole.isNull()).select("window_id", "n_msgs", F.posexplode("items").alias("item_no", "item"))
    each = each.withColumn("s", F.from_json(F.to_json("item"), _ITEM))
    missing = F.lit(False)
    for f in FIELDS:
        missing = missing | F.try_variant_get("item", f"$.{f}", "variant").isNull()
    n = F.col("n_msgs")
    indices = F.filter(F.transform("s.messageIndices", lambda x: x.try_cast("double").cast("int")), lambda i: (i >= 0) & (i < n))
    each = each.withColumn("indices", F.coalesce(indices, F.array().cast("array<int>")))
    reason = (
        F.when(F.try_variant_get("item", "$", "map<string,variant>").isNull(), "not an object")
        .when(missing, "missing field")
        .when(F.size("indices") == 0, "no valid index")
        .when((F.trim("s.topic") == "") | (F.trim("s.subTopic") == ""), "empty label")
    )
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(0.99), F.coalesce(F.col("s.confidence").try_cast("double"), F.lit(0.0))))
    sentiment = F.when(F.col("s.sentiment").isNotNull(), F.when(F.lower("s.sentiment").isin(*SENTIMENTS), F.lower("s.sentiment")).otherwise(F.lit("neutral")))
    good = each.select("window_id", "item_no", reason.alias("reason"), F.col("s.topic").alias("topic"), F.col("s.subTopic").alias("sub_topic"), F.col("s.summary").alias("summary"), "indices", confidence.alias("confidence"), sentiment.alias("sentiment"))
    return bad.unionByName(good)


def count_value(text):
    """A count as a whole number of at least 0; null for anything else."""
    number = text.try_cast("double")
    return F.when((number >= 0) & (number < 2_147_483_648), number.cast("int")).when(number < 0, F.lit(0))


def template_labels(responses: DataFrame) -> DataFrame:
    """topic, sub_topic and summary of each template's response (template_id, response), with ``reason`` where it is rejected."""
    body = F.regexp_extract(F.regexp_replace("response", r"```(?:json)?", ""), r"(?s)\{.*\}", 0)
    rows = responses.select("template_id", F.nullif(body, F.lit("")).alias("body")).withColumn("json", F.try_parse_json("body"))
    get = lambda name: F.nullif(F.try_variant_get("json", f"$.{name}", "string"), F.lit(""))
    rows = rows.select("template_id", "body", "json", get("topic").alias("topic"), get("subTopic").alias("sub_topic"), get("summary").alias("summary"))
    reason = F.when(F.col("body").isNull(), "no object").when(F.col("json").isNull(), "bad JSON").when(F.col("topic").isNull() | F.col("sub_topic").isNull() | F.col("summary").isNull(), "missing field")
    return rows.select("template_id", "topic", "sub_topic", "summary", reason.alias("reason"))
