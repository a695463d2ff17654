"""Tables in the shared work folder, so that plans are cut and what is used twice is computed once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """This application's folder in the one that ``spark.checkpoint.dir`` names.

    Where that is unset a temporary one is made, but only if driver and executors are one process: elsewhere
    executors would not see it, so that is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(named)
    return f"{named.rstrip('/')}/threadline-{sc.applicationId}"


def kept(df: DataFrame) -> DataFrame:
    """df written and read again: any executor may go.  ``clear`` deletes it."""
    path = f"{folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that were not written yet are lost with them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
