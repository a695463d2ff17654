"""Corpus preparation, stage by stage; each stage works on all that the one before kept.

quality rules -> near-duplicates -> repeated passages -> surrogates for personal
data -> packing.  Rows are told apart by doc_id and text; of rows equal in both the
second stage keeps one.  All stages but the last return the columns of documents,
with n_chars recounted where the text changed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.llm import minhash, packing, pii, quality, suffixes
from threadline.llm.common import boxed, stored

#: No single SQL statement can express near-duplicates, surrogates or packing.
ORACLE_SQL = None
#: Bytes of the passages removed: those of over 50 words that repeat are seldom shorter.
SPAN = 256


def _boxed(docs: DataFrame) -> tuple[DataFrame, str]:
    """doc_id, text and all other columns in one struct, so that no name clashes inside a stage."""
    return boxed(docs, [c for c in docs.columns if c not in ("doc_id", "text")])


def _unboxed(rows: DataFrame, box: str, columns: list[str]) -> DataFrame:
    """The columns of documents again, n_chars counted anew."""
    out = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[out.get(c, F.col(box)[c]).alias(c) for c in columns])


def _those(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, struct) that judged (doc_id, h) names; h stays."""
    named = judged.select(F.col("doc_id").alias("d"), F.col("h").alias("e")).distinct()
    rows = docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    return rows.join(named, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("e")), "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), pooled_too=False)
    rows, box = _boxed(docs)
    return _unboxed(_those(rows, judged.where("kept")), box, docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, box = _boxed(docs)
    kept = _those(rows, minhash.groups(docs).where("kept"))
    # of rows equal in doc_id and text the same one stays in every run
    first = F.min_by(F.struct("text", box), F.xxhash64(F.to_json(F.struct(box))))
    return _unboxed(kept.groupBy("doc_id", "h").agg(first.alias("r")).select("doc_id", "r.*"), box, docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, box = _boxed(docs)
    done = suffixes.remove(rows, more=(box,), span=SPAN)
    # a removed span may start or end inside a character: what is left of it goes too
    text = F.try_validate_utf8(F.col("kept").cast("string"))
    cut = F.when(text.isNotNull(), text).otherwise(F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\ufffd+", ""))
    return _unboxed(done.withColumn("text", cut), box, docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, box = _boxed(docs)
    return _unboxed(pii.replace(rows), box, docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("pii_surrogates", personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
