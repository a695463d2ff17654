"""Shared helpers: the shared work folder, lineage cuts, column hygiene."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.work import folder

#: The word pattern of the contracts: runs of anything but ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends here, any executor may go."""
    spark = df.sparkSession
    path = f"{folder(spark)}/threadline-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: all that came from them is stored itself."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def boxed(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, str]:
    """docs with ``columns`` as fields of one struct, and its name, which clashes with none."""
    name = f"box_{uuid.uuid4().hex}"
    fields = [F.col(f"`{c}`").alias(c) for c in columns] or [F.lit(None).cast("int").alias("none")]
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in columns], F.struct(*fields).alias(name)), name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def words(text):
    """Array of words of a text column; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows while an action inside runs: rows may be large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
