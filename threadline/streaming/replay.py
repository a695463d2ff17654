"""Segments kept current batch by batch, late rows included.

The table has a folder per bucket of chats and version: ``bucket=K/batch=N`` under ``path``.  A
micro-batch touches the buckets of its chats only.  For each chat, late rows or not, the chunks
from the last anchor before its first new row are made again together with the new rows; what is before
stays as it is.  The new versions are written first, then listed under the batch's number in
``path``_versions: readers take the newest listed version of each bucket, so a batch that failed leaves
nothing to see, and one that is tried again overwrites its own folders.  Rows that a bucket
has already are not added again, so it then changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.operators import chunks as ch
from threadline.sources.views import micros
from threadline.work import kept

ROWS = "chat_id long, msg_id long, user_id long, type string, message string, at_us long, chunk_no long, kind string, bucket int, batch long"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """bucket and its newest batch."""
    if not _exists(spark, f"{path}_versions"):
        return spark.createDataFrame([], "bucket int, batch long")
    return spark.read.schema("bucket int, batch long").parquet(f"{path}_versions").groupBy("bucket").agg(F.max("batch").alias("batch"))


def current(spark: SparkSession, path: str, buckets: DataFrame | None = None) -> DataFrame:
    """The rows of the newest versions (of ``buckets`` only, if given)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], ROWS)
    new = versions(spark, path)
    if buckets is not None:
        new = new.join(buckets, "bucket", "left_semi")
    # one row per bucket, which prunes the folders that are read
    return spark.read.schema(ROWS).parquet(path).join(F.broadcast(new), ["bucket", "batch"], "left_semi")


def merged(stored: DataFrame, new: DataFrame, **options) -> DataFrame:
    """stored chunk rows with new rows put in: from each chat's last anchor before its first new row on, chunks are made again."""
    base = new.columns
    new = new.dropDuplicates(["msg_id"]).join(stored.select("msg_id"), "msg_id", "left_anti")
    first = new.groupBy("chat_id").agg(F.min("at_us").alias("_first"))
    touched = stored.join(first, "chat_id", "left")
    anchors = touched.where("kind = 'user_engaged'").groupBy("chat_id", "chunk_no").agg(F.min("at_us").alias("_at"), F.first("_first").alias("_first"))
    # strictly before: a row of the anchor's own time may sort before it
    restart = anchors.where("_at < _first").groupBy("chat_id").agg(F.max("chunk_no").alias("_from"))
    marked = kept(touched.join(restart, "chat_id", "left"))
    stays = F.col("_first").isNull() | (F.col("chunk_no") < F.col("_from"))
    before = marked.where(F.coalesce(stays, F.lit(False))).select(*base, "chunk_no", "kind")
    again = ch.chunks(marked.where(~F.coalesce(stays, F.lit(False))).select(*base).unionByName(new.select(*base)), **options)
    offset = F.coalesce(F.col("_from") - 1, F.lit(0))
    return before.unionByName(again.join(restart, "chat_id", "left").withColumn("chunk_no", F.col("chunk_no") + offset).select(*base, "chunk_no", "kind"))


def segment_batch(batch: DataFrame, number: int, path: str, buckets: int = 64, **options) -> None:
    """One micro-batch (msg_id, chat_id, user_id, type, message, ts) put into the table under its number."""
    spark = batch.sparkSession
    columns = ["chat_id", "msg_id", "user_id", "type", "message", "at_us"]
    new = kept(batch.withColumn("at_us", micros(F.col("ts").cast("timestamp_ntz"))).select(*columns))
    bucket = F.pmod(F.xxhash64("chat_id"), F.lit(buckets)).cast("int")
    touched = kept(new.select(bucket.alias("bucket")).distinct())
    rows = merged(current(spark, path, touched).select(*columns, "chunk_no", "kind"), new, **options)
    out = kept(rows.withColumns({"bucket": bucket, "batch": F.lit(number).cast("long")}))
    out.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(path)
    listed = touched.withColumn("batch", F.lit(number).cast("long"))
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}_versions/number={number}")


def segment_batches(stream: DataFrame, path: str, checkpoint: str, buckets: int = 64, **options):
    """A writer that keeps the table at ``path`` current; start it with any trigger."""

    def put(batch: DataFrame, number: int) -> None:
        segment_batch(batch, number, path, buckets, **options)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete versions that a newer listed one replaces; the number deleted.  Not while readers of old versions run."""
    new = {r["bucket"]: r["batch"] for r in versions(spark, path).collect()}  # one row per bucket
    files = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = files.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for b, n in new.items():
        for status in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket={b}")):
            if int(status.getPath().getName().removeprefix("batch=")) < n:
                gone += fs.delete(status.getPath(), True)
    return gone
